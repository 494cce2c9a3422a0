import datetime as dt

from arrivals_mart.contracts import TIME_DIM
from arrivals_mart.plans.tables import (
    airport_dimension,
    time_dimension,
    travel_mode_dimension,
    visa_dimension,
)


def _codes(spark, values, name):
    return spark.createDataFrame([(v,) for v in values], f"{name} double")


def test_travel_mode_fills_null_before_distinct(spark):
    df = _codes(spark, [1.0, 2.0, 3.0, 9.0, 0.0, None, None, 1.0, 4.7], "i94mode")
    got = sorted(tuple(r) for r in travel_mode_dimension(df).collect())
    assert got == [(0, "Undefined"), (1, "Air"), (2, "Sea"), (3, "Land"), (4, "Undefined"), (9, "Not reported")]


def test_visa_drops_null_codes_and_labels_the_rest(spark):
    df = _codes(spark, [1.0, 2.0, 3.0, 9.0, None, 2.0, float("nan")], "i94visa")
    got = sorted(tuple(r) for r in visa_dimension(df).collect())
    assert got == [(1, "Business"), (2, "Pleasure"), (3, "Student"), (9, "Student")]


def test_time_dimension(spark):
    df = _codes(spark, [20574.0, 20574.9, None, float("nan"), 1e12, 2e9, -2e9, 3e6, -8e5, 20575.0], "arrdate")
    out = time_dimension(df)
    assert out.columns == TIME_DIM.columns
    got = sorted(tuple(r) for r in out.collect())
    assert got == [
        (20574, dt.date(2016, 4, 30), 30, 4, 2016, "Sat"),
        (20575, dt.date(2016, 5, 1), 1, 5, 2016, "Sun"),
    ]


def test_airport_dimension(spark):
    cols = "ident type name elevation_ft continent iso_country iso_region municipality gps_code iata_code local_code coordinates"
    schema = ", ".join(f"{c} {'int' if c == 'elevation_ft' else 'string'}" for c in cols.split())
    rows = [
        ("A", " heliport", " One ", 1, "NA", "US", "US-PA", " Town", "00A", None, " 00A ", "-74.9, 40.0"),
        ("A", "heliport", "One", 1, "NA", "US", "US-PA", "Town", "00A", None, "00A", "-74.9, 40.0"),
        ("B", "small", "Two", 2, "NA", "US", "US-CA", "Two Oaks", "00B", None, None, "1, 2"),
        ("C", "small", "Three", 3, "NA", "US", "US-AK", "Anchor", "001", None, "001", "3, 4"),
        ("D", "small", "Three bis", 3, "NA", "US", "US-AK", "Anchor", "001", None, "001", "3, 4"),
    ]
    out = airport_dimension(spark.createDataFrame(rows, schema))
    got = sorted(tuple(r) for r in out.collect())
    # padded duplicate collapses, null code is dropped, code "001" stays text
    # and appears under both of its names
    assert [r[0] for r in got] == ["001", "001", "00A"]
    assert got[2][1:4] == (None, "One", "heliport")
