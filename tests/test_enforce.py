import glob
import json

import pytest

from arrivals_mart.contracts import AIRPORT_DIM, ARRIVALS_INPUT, IMMIG_FACT, VISA_TYPE_DIM
from arrivals_mart.operators import QualityError
from arrivals_mart.plans import build_fact, read_inputs, run_pipeline
from arrivals_mart.sinks import (
    count_rejects,
    open_set,
    read_accepted,
    read_rejects,
    read_table,
    write_enforced,
    write_table,
)
from fixtures import ARRIVALS, arrival, write_inputs


def test_rows_are_split_in_one_pass_and_none_is_lost(spark, tmp_dir):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = [("1", "Business", 7), (None, "Pleasure", 8), ("two", "Student", 9), ("3", None, 10)]
    df = spark.createDataFrame(rows, "visa_category_id string, visa_type string, note int")
    written = write_enforced(df.mapInArrow(counted, df.schema), f"{tmp_dir}/v", VISA_TYPE_DIM)
    assert (written.row_count, written.rejected_count, read.value) == (2, 2, 4)
    good = read_accepted(spark, written, VISA_TYPE_DIM)
    assert good.schema == VISA_TYPE_DIM.read_schema()
    assert sorted(map(tuple, good.collect())) == [(1, "Business"), (3, None)]
    rejects = read_rejects(spark, written, VISA_TYPE_DIM)
    assert sorted((r.reject_reasons, json.loads(r.rejected_row)) for r in rejects.collect()) == [
        (["visa_category_id: not int"], {"visa_category_id": "two", "visa_type": "Student", "note": 9}),
        (["visa_category_id: null"], {"visa_type": "Pleasure", "note": 8}),
    ]
    assert sorted(map(tuple, count_rejects(rejects).collect())) == [
        ("visa_category_id: not int", 1), ("visa_category_id: null", 1)]


def test_directories_of_the_accepted_rows_are_those_of_the_contract(spark, tmp_dir):
    fact = build_fact(spark.createDataFrame([*ARRIVALS, arrival(None)], ARRIVALS_INPUT))
    written = write_enforced(fact, f"{tmp_dir}/f", IMMIG_FACT)
    assert (written.row_count, written.rejected_count) == (len(ARRIVALS), 1)
    plain = read_table(spark, write_table(fact.where("cicid IS NOT NULL"), f"{tmp_dir}/g", IMMIG_FACT), IMMIG_FACT)
    good = read_accepted(spark, written, IMMIG_FACT)
    assert good.schema == plain.schema and good.exceptAll(plain).count() == plain.exceptAll(good).count() == 0


@pytest.mark.parametrize("codes, want", [([], (0, 0)), ([1, 2], (2, 0)), ([None], (0, 1))])
def test_tables_without_rows(spark, tmp_dir, codes, want):
    df = spark.createDataFrame([(c, "x") for c in codes], "visa_category_id int, visa_type string")
    written = write_enforced(df, f"{tmp_dir}/v", VISA_TYPE_DIM)
    assert (written.row_count, written.rejected_count) == want
    assert read_accepted(spark, written, VISA_TYPE_DIM).count() == want[0]
    assert read_rejects(spark, written, VISA_TYPE_DIM).count() == want[1]


def test_a_write_refuses_another_type(spark, tmp_dir):
    df = spark.createDataFrame([("1", "x")], "visa_category_id string, visa_type string")
    with pytest.raises(ValueError, match="visa_type_dim does not match its contract"):
        write_table(df, f"{tmp_dir}/v", VISA_TYPE_DIM)


def test_a_run_that_rejects_goes_on_where_another_fails(spark, tmp_dir):
    inputs = read_inputs(spark, write_inputs(spark, f"{tmp_dir}/in", arrivals=[*ARRIVALS, arrival(None)]))
    with pytest.raises(QualityError, match="immig_fact contains 1 null"):
        run_pipeline(spark, inputs, f"{tmp_dir}/out")
    result = run_pipeline(spark, inputs, f"{tmp_dir}/out", reject=True)
    report = {r.table_name: r for r in result.report}
    assert (report["immig_fact"].row_count, report["immig_fact"].rejected) == (len(ARRIVALS), 1)
    assert report["airport_dim"].rejected == report["airport_dim"].left_out == 1
    assert spark.table("immig_fact").count() == len(ARRIVALS)
    assert open_set(spark, f"{tmp_dir}/out")["airport_dim"].columns == AIRPORT_DIM.columns


def test_the_ordinary_report_says_what_is_left_out(spark, tmp_dir):
    inputs = read_inputs(spark, write_inputs(spark, f"{tmp_dir}/in"))
    short = run_pipeline(spark, inputs, f"{tmp_dir}/out", publish_views=False)
    full = run_pipeline(spark, inputs, f"{tmp_dir}/out", publish_views=False, full_report=True)
    assert {r.table_name: r.left_out for r in short.report} == {r.table_name: r.left_out for r in full.report}
    assert sum(r.left_out for r in short.report) > 3


def test_a_split_without_directories_of_its_own_is_not_shuffled(spark, tmp_dir):
    rows = spark.range(4000, numPartitions=4).selectExpr(
        "CASE WHEN id % 10 = 0 THEN NULL ELSE CAST(id AS INT) END AS visa_category_id", "'x' AS visa_type"
    )
    done = write_enforced(rows, f"{tmp_dir}/t", VISA_TYPE_DIM)
    assert (done.row_count, done.rejected_count) == (3600, 400)
    # Each task wrote its own rows; a shuffle would have put them into one file.
    assert len(glob.glob(f"{done.accepted_path}/*.parquet")) == len(glob.glob(f"{done.rejected_path}/*.parquet")) == 4
    assert read_accepted(spark, done, VISA_TYPE_DIM).count() == 3600


def test_rejects_of_many_ports_share_directories(spark, tmp_dir):
    fact = build_fact(spark.createDataFrame(ARRIVALS, ARRIVALS_INPUT))
    done = write_enforced(fact, f"{tmp_dir}/t", IMMIG_FACT, directories=2400)
    assert not glob.glob(f"{tmp_dir}/t/*/partition_port=*") and glob.glob(f"{tmp_dir}/t/*/partition_group=*")
    back = read_accepted(spark, done, IMMIG_FACT)
    assert back.schema == IMMIG_FACT.read_schema() and back.count() == done.row_count
    assert back.where("NOT i94_port <=> partition_port").count() == 0
