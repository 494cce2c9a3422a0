import glob
import os
import re
import uuid

import pytest

from arrivals_mart.contracts import ARRIVALS_INPUT, COUNTRIES_INPUT, DEMOGRAPHICS_INPUT, IMMIG_FACT, VISA_TYPE_DIM
from arrivals_mart.functions.columns import period_days
from arrivals_mart.operators import code_dimension_from_table
from arrivals_mart.plans import arrivals_by_airport_month, build_fact, read_inputs, time_dimension
from arrivals_mart.sinks import (
    compact_loads,
    load_by_position,
    materialize,
    read_table,
    write_bucketed,
    write_table,
)
from arrivals_mart.sinks import tables
from arrivals_mart.sources import csv_losses, files_of, read_parquet, read_parquet_conformed, schema_groups
from arrivals_mart.streaming import STREAMED_FACT, write_fact_batch
from fixtures import ARRIVALS, arrival, write_inputs
from plan_util import plan_text

DAY = 20_000.0  # 2014-10-04


def _airports(spark):
    return spark.createDataFrame([("NYC", "New York"), ("LOS", "Los Angeles")], "airport_code string, airport_name string")


def _fact(spark, n=400):
    """Half of the arrivals at one port, over 40 days."""
    rows = [arrival(float(i), port="NYC" if i % 2 else f"P{i % 7}", arrdate=DAY + i % 40) for i in range(n)]
    return spark.createDataFrame(rows, ARRIVALS_INPUT)


def test_buckets_spare_the_fact_its_exchange(spark, tmp_dir):
    arrivals = _fact(spark)
    name = f"bucketed_{uuid.uuid4().hex}"
    write_bucketed(build_fact(arrivals), name, f"{tmp_dir}/b", IMMIG_FACT, 4)
    days, airports = materialize(time_dimension(arrivals), "days"), _airports(spark)
    bucketed = arrivals_by_airport_month(spark.table(name), days, airports)
    plain = arrivals_by_airport_month(build_fact(arrivals), days, airports)
    exchange = r"Exchange\s+Input[^\n]*i94_port[^\n]*\n|hashpartitioning\(i94_port#\d+, i94_arrival_date"
    assert re.search(exchange, plan_text(plain)) and not re.search(r"hashpartitioning\(i94_port#\d+, i94_arrival_date", plan_text(bucketed))
    assert "Bucketed: true" in plan_text(bucketed)
    assert sorted(map(tuple, bucketed.collect())) == sorted(map(tuple, plain.collect()))
    # The hot port spans the buckets, and each bucket is one file.
    files = spark.table(name).where("i94_port = 'NYC'").selectExpr("input_file_name() AS f").distinct().count()
    assert files == 4 == len(glob.glob(f"{tmp_dir}/b/*.parquet"))
    with pytest.raises(ValueError, match="no bucket columns"):
        write_bucketed(spark.createDataFrame([(1, "x")], VISA_TYPE_DIM.schema), "never", f"{tmp_dir}/c", VISA_TYPE_DIM, 2)


def test_a_period_reaches_the_scan_and_skips_row_groups(spark, tmp_dir):
    arrivals = _fact(spark)
    path = write_table(build_fact(arrivals).coalesce(1), f"{tmp_dir}/f", IMMIG_FACT, partition_by={})
    fact = read_parquet(spark, path, IMMIG_FACT.schema)
    days = materialize(time_dimension(arrivals), "days")
    answer = arrivals_by_airport_month(fact, days, _airports(spark), year=2014, month=10)
    first, last = period_days(2014, 10)
    text = plan_text(answer)
    assert f"GreaterThanOrEqual(i94_arrival_date,{first}), LessThanOrEqual(i94_arrival_date,{last})" in text
    whole = {tuple(r) for r in arrivals_by_airport_month(fact, days, _airports(spark)).collect()}
    assert {tuple(r) for r in answer.collect()} == {r for r in whole if r[2:4] == (2014, 10)} and len(whole) > 1
    stored = [r[0] for r in fact.select("i94_arrival_date").collect()]
    assert stored == sorted(stored)  # sorted by day, so a row group covers few days
    assert period_days(1960) == (0, 365) and period_days(1960, 2) == (31, 59)
    year = arrivals_by_airport_month(fact, days, _airports(spark), year=2014)
    assert {tuple(r) for r in year.collect()} == whole


def test_compaction_makes_one_load_of_many(spark, tmp_dir):
    fact = build_fact(spark.createDataFrame(ARRIVALS, ARRIVALS_INPUT))
    for batch in range(5):
        write_fact_batch(fact.withColumn("cicid", fact.cicid + 100 * batch), batch, f"{tmp_dir}/loads")
    folders = "partition_port=*/i94_month=*"
    before = glob.glob(f"{tmp_dir}/loads/{folders}/*/*.parquet")
    target = compact_loads(spark, f"{tmp_dir}/loads", f"{tmp_dir}/compacted", STREAMED_FACT)
    after = glob.glob(f"{target}/{folders}/*/*.parquet")
    assert len(before) == 5 * len(after) and len(after) == len(glob.glob(f"{target}/{folders}"))
    old, new = (read_table(spark, p, STREAMED_FACT) for p in (f"{tmp_dir}/loads", target))
    assert {r.load_batch for r in new.select("load_batch").distinct().collect()} == {4}
    old, new = old.drop("load_batch"), new.drop("load_batch")
    assert old.exceptAll(new).count() == new.exceptAll(old).count() == 0 and new.count() == 5 * len(ARRIVALS)
    # Later loads go to the new version; a retried one replaces only itself.
    for _ in range(2):
        write_fact_batch(fact, 5, target)
    assert read_table(spark, target, STREAMED_FACT).count() == 6 * len(ARRIVALS)
    empty = read_table(spark, f"{tmp_dir}/loads", STREAMED_FACT).where("false")
    with pytest.raises(ValueError, match="no loads"):
        compact_loads(spark, write_table(empty, f"{tmp_dir}/none", STREAMED_FACT), f"{tmp_dir}/x", STREAMED_FACT)


def test_load_by_position(spark, tmp_dir):
    name = f"positional_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} (k INT, v STRING, d DOUBLE) USING parquet LOCATION '{tmp_dir}/t'")
    rows = spark.createDataFrame([(1, "a", 0.5), (2, None, None)], "x int, y string, z double")
    for _ in range(2):
        load_by_position(rows, name)
    assert sorted(map(tuple, spark.table(name).collect()), key=str) == [(1, "a", 0.5), (2, None, None)]
    load_by_position(rows, name, overwrite=False)
    assert spark.table(name).count() == 4
    with pytest.raises(ValueError, match="position 1: y is string, k is int; position 2: x is int, v is string"):
        load_by_position(rows.select("y", "x", "z"), name)
    with pytest.raises(ValueError, match="2 columns for 3"):
        load_by_position(rows.select("x", "y"), name)
    assert spark.table(name).count() == 4


def test_labels_from_a_table(spark):
    codes = spark.createDataFrame([(1.0,), (1.0,), (2.0,), (7.0,), (None,), (float("nan"),)], "c double")
    labels = spark.createDataFrame([(1, "b"), (1, "a"), (2, None), (None, "n"), (3, "z")], "code int, name string")
    got = code_dimension_from_table(codes, "c", "k", "label", labels, "code", "name", "other")
    assert sorted(map(tuple, got.collect())) == [(1, "a"), (2, "other"), (7, "other")]
    filled = code_dimension_from_table(codes, "c", "k", "label", labels, "code", "name", None, null_key=0)
    assert sorted(map(tuple, filled.collect()), key=str) == [(0, None), (1, "a"), (2, None), (7, None)]
    assert "CASE" not in plan_text(got)


def test_files_of_several_schemas(spark, tmp_dir):
    stored = spark.createDataFrame(ARRIVALS, ARRIVALS_INPUT).where("cicid IS NOT NULL")
    want = build_fact(stored.unionAll(stored).unionAll(stored).unionAll(stored))
    kinds = ["double", "int", "int", "bigint"]
    for i, kind in enumerate(kinds):
        part = stored.withColumn("cicid", stored.cicid.cast(kind))
        part.select(*(reversed(part.columns) if i == 2 else part.columns)).coalesce(1).write.parquet(f"{tmp_dir}/in/d{i}")
    glob_path = f"{tmp_dir}/in/*/*.parquet"
    files = files_of(spark, glob_path)
    groups = schema_groups(spark, files)
    assert len(files) == 4 and sorted(f for _, part in groups for f in part) == files
    assert len({s["cicid"].dataType.simpleString() for s, _ in groups}) == 3 and len(groups) <= 4
    got = build_fact(read_parquet_conformed(spark, glob_path, ARRIVALS_INPUT))
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    # One schema is one scan.
    assert plan_text(read_parquet_conformed(spark, f"{tmp_dir}/in/d0", ARRIVALS_INPUT)).count("Scan parquet") <= 2
    stored.drop("gender").write.parquet(f"{tmp_dir}/in/d9")
    with pytest.raises(ValueError, match="gender"):
        read_parquet_conformed(spark, f"{tmp_dir}/in/d9/*.parquet", ARRIVALS_INPUT)


def test_csv_losses(spark, tmp_dir):
    with open(f"{tmp_dir}/countries.csv", "w") as f:
        f.write("note,country_code,country\na,1,Mexico\nb,12.5,Norway\nc,,Peru\nd,x y,\"Chi,le\"\ne,7\nf,8,Fiji,more\n")
    lost = dict(map(tuple, csv_losses(spark, f"{tmp_dir}/countries.csv", COUNTRIES_INPUT, by_name=True).collect()))
    # two codes that are no INT; lines: these two, one cell short, one too many
    assert lost == {"country_code": 2, "country": 0, "*": 4}
    root = write_inputs(spark, f"{tmp_dir}/in")
    lost = dict(map(tuple, csv_losses(spark, f"{root}/us-cities-demographics.csv", DEMOGRAPHICS_INPUT, sep=";").collect()))
    read = read_inputs(spark, root, only=["demographics"]).demographics
    assert lost["noOfVeterans"] + lost["*"] >= 2 and set(lost) == {*read.columns, "*"}
    with pytest.raises(ValueError, match="missing columns"):
        csv_losses(spark, f"{tmp_dir}/countries.csv", DEMOGRAPHICS_INPUT, by_name=True)


def test_a_sorted_write_reads_pieces_that_fit_in_memory(spark, tmp_dir, monkeypatch):
    key, before = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    rows = spark.createDataFrame(ARRIVALS, ARRIVALS_INPUT)
    rows.crossJoin(spark.range(2_000)).drop("id").repartition(12).write.parquet(f"{tmp_dir}/in")
    arrivals = spark.read.parquet(f"{tmp_dir}/in")
    monkeypatch.setattr(tables, "SORTED_SCAN", min(os.path.getsize(f) for f in glob.glob(f"{tmp_dir}/in/*.parquet")))
    path = write_table(build_fact(arrivals), f"{tmp_dir}/fact", IMMIG_FACT, partition_by={})
    files = glob.glob(f"{path}/*.parquet")
    assert len(files) >= 12  # tasks as the pieces, not as the cores
    assert spark.conf.get(key) == before
    days = [[r[0] for r in spark.read.parquet(f).select("i94_arrival_date").collect()] for f in files]
    assert sum(map(len, days)) == 2_000 * len(ARRIVALS)
    assert all(d == sorted(d, key=lambda x: (x is not None, x)) for d in days)


def test_compaction_of_many_directories_shares_them(spark, tmp_dir, monkeypatch):
    fact = build_fact(spark.createDataFrame(ARRIVALS, ARRIVALS_INPUT))
    for batch in range(2):
        write_fact_batch(fact, batch, f"{tmp_dir}/loads")
    assert glob.glob(f"{tmp_dir}/loads/partition_port=*")
    monkeypatch.setattr(tables, "MAX_DIRECTORIES", 2)
    target = compact_loads(spark, f"{tmp_dir}/loads", f"{tmp_dir}/compacted", STREAMED_FACT)
    assert glob.glob(f"{target}/partition_group=*") and not glob.glob(f"{target}/partition_port=*")
    old, new = (read_table(spark, p, STREAMED_FACT).drop("load_batch") for p in (f"{tmp_dir}/loads", target))
    assert old.exceptAll(new).count() == new.exceptAll(old).count() == 0 and new.count() == 2 * len(ARRIVALS)
