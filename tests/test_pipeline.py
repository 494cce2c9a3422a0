import glob

import pytest

from arrivals_mart.contracts import IMMIG_FACT, MART
from arrivals_mart.operators import QualityError
from arrivals_mart.plans import (
    arrivals_by_airport_month,
    arrivals_country_temperature,
    arrivals_state_population,
    build_fact,
    read_inputs,
    run_pipeline,
)
from arrivals_mart.sinks import open_set, tables
from fixtures import ARRIVALS, arrival, write_inputs


def _counts(spark):
    return {c.name: spark.table(c.name).count() for c in MART}


def test_inputs_read_with_declared_schemas(spark, tmp_dir):
    inputs = read_inputs(spark, write_inputs(spark, f"{tmp_dir}/in"))
    assert inputs.arrivals.count() == len(ARRIVALS)
    demo = {r.city: r for r in inputs.demographics.collect()}
    assert demo["Buffalo"].noOfVeterans is None  # unparsable cell -> null
    assert demo["Buffalo"].totalPopulation == 220
    assert inputs.airports.where("local_code IS NULL").count() == 1


def test_run_publishes_checked_tables_and_reruns_idempotently(spark, tmp_dir):
    inputs = read_inputs(spark, write_inputs(spark, f"{tmp_dir}/in"))
    first = run_pipeline(spark, inputs, f"{tmp_dir}/out")
    counts = _counts(spark)
    assert counts == {
        "immig_fact": 6,
        "airport_dim": 2,
        "visa_type_dim": 4,
        "travel_mode_dim": 5,
        "time_dim": 2,
        "country_temperature_dim": 2,
        "demographics_dim": 2,
    }
    assert {r.table_name: r.null_keys for r in first.report} == dict.fromkeys(counts, 0)
    second = run_pipeline(spark, inputs, f"{tmp_dir}/out")
    assert _counts(spark) == counts
    from arrivals_mart.contracts import BY_NAME
    from arrivals_mart.sinks import read_table

    for name, path in first.paths.items():
        a = read_table(spark, path, BY_NAME[name])
        b = read_table(spark, second.paths[name], BY_NAME[name])
        assert path != second.paths[name]
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name

    fact = spark.table("immig_fact")
    by_month = {(r.airport_code, r.month): r.arrivals for r in arrivals_by_airport_month(
        fact, spark.table("time_dim"), spark.table("airport_dim")).collect()}
    assert by_month == {("NYC", 4): 2, ("LOS", 5): 1}
    temps = {r.country_code: r.arrivals for r in arrivals_country_temperature(
        fact, spark.table("country_temperature_dim")).collect()}
    assert temps == {582: 4, 101: 1}
    states = {r.state_code: r.arrivals for r in arrivals_state_population(
        fact, spark.table("demographics_dim")).collect()}
    assert states == {"NY": 4, "CA": 1}


def test_failed_check_publishes_nothing(spark, tmp_dir):
    good = read_inputs(spark, write_inputs(spark, f"{tmp_dir}/good"))
    run_pipeline(spark, good, f"{tmp_dir}/out")
    before = _counts(spark)
    bad_rows = [arrival(None, visa=1.0)]  # null cicid fails the key check
    bad = read_inputs(spark, write_inputs(spark, f"{tmp_dir}/bad", arrivals=bad_rows))
    with pytest.raises(QualityError) as err:
        run_pipeline(spark, bad, f"{tmp_dir}/out")
    assert "immig_fact contains 1 null values in column cicid" in err.value.failures
    assert _counts(spark) == before


def test_run_paths_are_templates(spark, tmp_dir):
    inputs = read_inputs(spark, write_inputs(spark, f"{tmp_dir}/2016-04/in").replace("2016-04", "{ds}"),
                         params={"ds": "2016-04"})
    result = run_pipeline(spark, inputs, f"{tmp_dir}/{{ds}}/out", publish_views=False, params={"ds": "2016-04"})
    assert all(p.startswith(f"{tmp_dir}/2016-04/out/") for p in result.paths.values())


def test_one_airport_one_month_reads_only_its_directories(spark, tmp_dir):
    from plan_util import plan_text

    inputs = read_inputs(spark, write_inputs(spark, f"{tmp_dir}/in"))
    result = run_pipeline(spark, inputs, f"{tmp_dir}/out", publish_views=False)
    from arrivals_mart.contracts import BY_NAME
    from arrivals_mart.sinks import read_table

    fact, days, airports = (read_table(spark, result.paths[n], BY_NAME[n])
                            for n in ("immig_fact", "time_dim", "airport_dim"))
    answer = arrivals_by_airport_month(fact, days, airports, airport_code="NYC", year=2016, month=4)
    assert [tuple(r) for r in answer.collect()] == [("NYC", "Pier Nine Heliport", 2016, 4, 2)]
    assert arrivals_by_airport_month(fact, days, airports, airport_code="NYC", month=5).count() == 0
    assert "PartitionFilters: [isnotnull(partition_port" in plan_text(answer)
    assert "(partition_port" in plan_text(answer) and "= NYC)" in plan_text(answer)


def test_csv_with_bom_and_crlf(spark, tmp_dir):
    from arrivals_mart.sources import read_csv

    path = f"{tmp_dir}/ports.csv"
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write("\ufeffPortCode,City,StateCode\r\nALC,Alcan, AK   \r\nANC,Anchorage,AK\r\n")
    df = read_csv(spark, path, infer=True)
    assert df.columns == ["PortCode", "City", "StateCode"]
    assert [tuple(r) for r in df.collect()] == [("ALC", "Alcan", " AK   "), ("ANC", "Anchorage", "AK")]


def test_arrivals_with_other_number_types(spark, tmp_dir):
    """Numbers stored as integers and dates as numbers, columns in another order."""
    from arrivals_mart.contracts import ARRIVALS_INPUT
    from arrivals_mart.plans import build_fact

    root = write_inputs(spark, f"{tmp_dir}/in")
    want = build_fact(read_inputs(spark, root).arrivals.where("dtadfile = '20160430'"))
    stored = read_inputs(spark, root).arrivals.where("dtadfile = '20160430'")
    stored = stored.selectExpr(
        *[
            f"CAST(`{f.name}` AS BIGINT) AS `{f.name}`"
            if f.name in ("cicid", "dtadfile", "dtaddto", "i94mode", "admnum")
            else f"`{f.name}`"
            for f in reversed(ARRIVALS_INPUT.fields)
        ]
    )
    stored.write.parquet(f"{tmp_dir}/typed")
    got = build_fact(read_inputs(spark, root, arrivals="../typed/*.parquet").arrivals)
    assert got.schema == want.schema
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert rows(got) == rows(want) and len(rows(got)) > 1


def test_missing_column_stops_the_run(spark, tmp_dir):
    import pytest

    root = write_inputs(spark, f"{tmp_dir}/in")
    read_inputs(spark, root).arrivals.drop("i94port").write.parquet(f"{tmp_dir}/cut")
    with pytest.raises(ValueError, match="i94port"):
        read_inputs(spark, root, arrivals="../cut/*.parquet")
    with open(f"{root}/country_code.csv", "w") as f:
        f.write("country_code,name\n1,a\n")
    with pytest.raises(ValueError, match="country"):
        read_inputs(spark, root)


def test_csv_columns_are_matched_by_header(spark, tmp_dir):
    root = write_inputs(spark, f"{tmp_dir}/in")
    with open(f"{root}/country_code.csv", "w") as f:
        f.write("country,note,country_code\nMexico,x,582\nAlbania,,101\n")
    rows = read_inputs(spark, root).countries.collect()
    assert sorted(map(tuple, rows)) == [(101, "Albania"), (582, "Mexico")]


def test_publish_that_fails_midway_leaves_the_old_views(spark, tmp_dir, monkeypatch):
    from arrivals_mart.sinks import tables

    inputs = read_inputs(spark, write_inputs(spark, f"{tmp_dir}/in"))
    run_pipeline(spark, inputs, f"{tmp_dir}/out")
    before = {c.name: tables._current_version(spark, c.name) for c in MART}
    assert all(before.values())
    point, calls = tables._point, []

    def failing(spark, view, version):
        calls.append(view)
        if len(calls) == 4:
            raise RuntimeError("catalog lost")
        point(spark, view, version)

    monkeypatch.setattr(tables, "_point", failing)
    with pytest.raises(RuntimeError, match="catalog lost"):
        run_pipeline(spark, inputs, f"{tmp_dir}/out")
    assert len(calls) == 7  # four forward, three back
    assert {c.name: tables._current_version(spark, c.name) for c in MART} == before


def test_expired_versions_go_but_the_published_one_stays(spark, tmp_dir):
    import os

    from arrivals_mart.contracts import AIRPORT_DIM
    from arrivals_mart.plans import airport_dimension
    from arrivals_mart.sinks import expire_versions, refresh_table, stage_path, write_table

    root, view = f"{tmp_dir}/o'ut", "expiring_airports"
    airports = airport_dimension(read_inputs(spark, write_inputs(spark, f"{tmp_dir}/in"), only=["airports"]).airports)
    paths = [refresh_table(spark, airports, root, AIRPORT_DIM, view=view) for _ in range(3)]
    later = [write_table(airports, stage_path(root, view), AIRPORT_DIM) for _ in range(2)]  # never published
    os.makedirs(f"{root}/{view}/not_a_version")
    assert expire_versions(spark, root, view, keep=1) == [*paths[:2], later[0]]
    assert sorted(os.listdir(f"{root}/{view}")) == sorted(
        [os.path.basename(paths[2]), os.path.basename(later[1]), "not_a_version"]
    )
    assert spark.table(view).count() == 2
    assert expire_versions(spark, f"{tmp_dir}/none", view) == []
    with pytest.raises(ValueError):
        expire_versions(spark, root, view, keep=0)


def test_full_report_and_required_keys(spark, tmp_dir):
    rows = [*ARRIVALS, arrival(1.0), arrival(1.0)]
    inputs = read_inputs(spark, write_inputs(spark, f"{tmp_dir}/in", arrivals=rows))
    result = run_pipeline(spark, inputs, f"{tmp_dir}/out", publish_views=False, full_report=True)
    report = {r.table_name: r for r in result.report}
    assert set(report) == {c.name for c in MART}
    fact = report["immig_fact"]
    assert (fact.row_count, fact.null_keys, fact.duplicate_keys, fact.left_out) == (8, 0, 1, 0)
    # NaN and out-of-range arrival and departure days, one date that does not parse
    assert fact.lost_values == 5
    assert {n: r.left_out for n, r in report.items() if r.left_out} == {
        "visa_type_dim": 1, "time_dim": 3, "airport_dim": 1, "country_temperature_dim": 1}
    for full in (True, False):
        with pytest.raises(QualityError, match="immig_fact contains 1 repeated values in column cicid"):
            run_pipeline(spark, inputs, f"{tmp_dir}/out", publish_views=False, full_report=full,
                         unique=["immig_fact", "time_dim"])


def test_run_scans_the_arrivals_twice(spark, tmp_dir):
    inputs = read_inputs(spark, write_inputs(spark, f"{tmp_dir}/in"))
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    inputs.arrivals = inputs.arrivals.mapInArrow(counted, inputs.arrivals.schema)
    run_pipeline(spark, inputs, f"{tmp_dir}/out", publish_views=False)
    assert read.value == 2 * len(ARRIVALS)


def test_a_run_of_many_directories_shares_them_for_every_reader(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(tables, "MAX_DIRECTORIES", 2)
    inputs = read_inputs(spark, write_inputs(spark, f"{tmp_dir}/in"))
    path = run_pipeline(spark, inputs, f"{tmp_dir}/out").paths["immig_fact"]
    assert glob.glob(f"{path}/partition_group=*/i94_month=*") and not glob.glob(f"{path}/partition_port=*")
    want = build_fact(inputs.arrivals).count()
    for fact in (open_set(spark, f"{tmp_dir}/out")["immig_fact"], spark.table("immig_fact")):
        assert fact.columns == IMMIG_FACT.read_schema().names and fact.count() == want
        assert fact.where("NOT i94_port <=> partition_port").count() == 0
