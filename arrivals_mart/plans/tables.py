"""The seven mart tables, each built by one generic operator.

Inputs use the column names of the raw files (see ``contracts``); every
function returns a lazy DataFrame in the column order of its contract.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrivals_mart.contracts import (
    COUNTRY_TEMPERATURE_DIM,
    DEMOGRAPHICS_DIM,
    IMMIG_FACT,
    TIME_DIM,
)
from arrivals_mart.functions.columns import as_double, as_int, as_text, char_date, trimmed
from arrivals_mart.functions.labels import (
    TRAVEL_MODE_DEFAULT,
    TRAVEL_MODE_LABELS,
    VISA_DEFAULT,
    VISA_LABELS,
)
from arrivals_mart.operators.aggregates import group_means, lookup_means
from arrivals_mart.operators.conform import fill_null_codes
from arrivals_mart.operators.dimensions import code_dimension, date_dimension, reference_dimension

# Airport dimension columns as (output, input, trimmed?).
AIRPORT_COLUMNS: tuple[tuple[str, str, bool], ...] = (
    ("airport_code", "local_code", True),
    ("iata_code", "iata_code", True),
    ("airport_name", "name", True),
    ("airport_type", "type", True),
    ("region", "iso_region", True),
    ("country_code", "iso_country", True),
    ("municipality", "municipality", True),
    ("gps_code", "gps_code", True),
    ("coordinates", "coordinates", False),
)

# State means as output name -> demographics input column.
DEMOGRAPHIC_MEANS: dict[str, str] = {
    "average_median_age": "medianAge",
    "average_male_population": "malePopulation",
    "average_female_population": "femalePopulation",
    "average_total_population": "totalPopulation",
    "average_no_of_veterans": "noOfVeterans",
    "average_foreign_born": "foreignBorn",
    "average_house_hold_size": "averageHouseHoldSize",
}

# Country means as output name -> temperature input column.
TEMPERATURE_MEANS: dict[str, str] = {
    "avg_country_temperature": "AverageTemperature",
    "avg_country_temperature_uncertainty": "AverageTemperatureUncertainty",
}


def fact_columns(arrivals: DataFrame, date_format: str = "yyyyMMdd") -> dict[str, tuple[str, Column]]:
    """Each fact column (plus ``i94_month``) as ``(source column, conversion)``.

    Numbers become INT by truncation (null if NaN or out of range), the port
    is trimmed, character dates are parsed with ``date_format`` (null when
    they do not parse); text passes through.
    """
    types = {f.name: f.dataType for f in arrivals.schema.fields}

    def date(src: str) -> tuple[str, Column]:
        return src, char_date(src, date_format, types.get(src))

    return {
        "cicid": ("cicid", as_int("cicid")),
        "i94_port": ("i94port", trimmed("i94port")),
        "i94_citizen": ("i94cit", as_int("i94cit")),
        "i94_resident": ("i94res", as_int("i94res")),
        "i94_arrival_date": ("arrdate", as_int("arrdate")),
        "travel_mode_id": ("i94mode", as_int("i94mode")),
        "state_code": ("i94addr", as_text("i94addr")),
        "i94_departure_date": ("depdate", as_int("depdate")),
        "i94_age": ("i94bir", as_int("i94bir")),
        "visa_category_id": ("i94visa", as_int("i94visa")),
        "i94_date_added": date("dtadfile"),
        "i94_date_admitted": date("dtaddto"),
        "i94_occupation": ("occup", as_text("occup")),
        "i94_arrival_flag": ("entdepa", as_text("entdepa")),
        "i94_departure_flag": ("entdepd", as_text("entdepd")),
        "i94_update_flag": ("entdepu", as_text("entdepu")),
        "i94_match_flag": ("matflag", as_text("matflag")),
        "i94_birth_year": ("biryear", as_int("biryear")),
        "i94_gender": ("gender", as_text("gender")),
        "i94_insnum": ("insnum", as_text("insnum")),
        "i94_airline": ("airline", as_text("airline")),
        "i94_admission_number": ("admnum", as_double("admnum")),
        "i94_flight_number": ("fltno", as_text("fltno")),
        "i94_visa_type": ("visatype", as_text("visatype")),
        "i94_month": ("i94mon", as_int("i94mon")),
    }


def build_fact(arrivals: DataFrame, date_format: str = "yyyyMMdd") -> DataFrame:
    """Arrival records -> the 24 fact columns plus ``i94_month`` (the month
    is a partition directory only). A pure projection: no shuffle. A missing
    travel mode becomes 0; see :func:`fact_columns` for the conversions."""
    cols = fact_columns(arrivals, date_format)
    fact = arrivals.select(*[expr.alias(name) for name, (_, expr) in cols.items()])
    return fill_null_codes(fact, 0, ["travel_mode_id"]).select(*IMMIG_FACT.columns, "i94_month")


def fact_directories(arrivals: DataFrame) -> Column:
    """Aggregate over the arrivals: about how many directories the fact has."""
    cols = fact_columns(arrivals)
    return F.approx_count_distinct(F.struct(*[cols[c][1] for c in IMMIG_FACT.partition_by.values()]))


def conversion_losses(arrivals: DataFrame, date_format: str = "yyyyMMdd") -> DataFrame:
    """Per fact column: how many raw values were present but did not convert
    (NaN, out of range, unparsable dates), i.e. became null silently.

    One global aggregate over the arrivals (partial in every scan task), then
    one row per column: ``column_name, source_column, lost_values``.
    """
    cols = fact_columns(arrivals, date_format)
    counts = arrivals.agg(
        *[F.count_if(F.col(src).isNotNull() & expr.isNull()).alias(name) for name, (src, expr) in cols.items()]
    )
    long = counts.unpivot([], list(cols), "column_name", "lost_values")
    sources = F.create_map(*[F.lit(x) for name, (src, _) in cols.items() for x in (name, src)])
    return long.select("column_name", sources[F.col("column_name")].alias("source_column"), "lost_values")


def arrival_codes(arrivals: DataFrame) -> DataFrame:
    """Distinct visa codes, travel modes and day numbers of the arrivals, under
    their input names: all that the three arrival dimensions need."""
    names = ("i94visa", "i94mode", "arrdate")
    return arrivals.select(*[as_int(n).alias(n) for n in names]).distinct()


def visa_dimension(arrivals: DataFrame, code: str = "i94visa", keep_null: bool = False) -> DataFrame:
    return code_dimension(
        arrivals, code, "visa_category_id", "visa_type", VISA_LABELS, VISA_DEFAULT, keep_null=keep_null
    )


def travel_mode_dimension(arrivals: DataFrame, code: str = "i94mode") -> DataFrame:
    return code_dimension(
        arrivals, code, "travel_mode_id", "travel_mode", TRAVEL_MODE_LABELS, TRAVEL_MODE_DEFAULT, null_key=0
    )


def time_dimension(arrivals: DataFrame, day_number: str = "arrdate", keep_null: bool = False) -> DataFrame:
    return date_dimension(arrivals, day_number, keep_null=keep_null).select(*TIME_DIM.columns)


def airport_dimension(airports: DataFrame, keep_null: bool = False) -> DataFrame:
    return reference_dimension(airports, AIRPORT_COLUMNS, required=None if keep_null else "local_code")


def demographics_dimension(demographics: DataFrame, keep_null: bool = False) -> DataFrame:
    """State means over distinct cities. Cities without a state code form a
    group of their own in the means; that group is left out here, since a
    dimension key may not be null."""
    means = group_means(demographics, "stateCode", DEMOGRAPHIC_MEANS, drop=("race", "count"))
    if not keep_null:
        means = means.where(F.col("stateCode").isNotNull())
    return means.select(*DEMOGRAPHICS_DIM.columns)


def country_dimension(countries: DataFrame, temperatures: DataFrame) -> DataFrame:
    return lookup_means(
        countries, temperatures, "country_code", "country", "Country", TEMPERATURE_MEANS
    ).select(*COUNTRY_TEMPERATURE_DIM.columns)

