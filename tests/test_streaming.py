import glob

from arrivals_mart.contracts import ARRIVALS_INPUT, IMMIG_FACT
from arrivals_mart.plans.tables import build_fact
from arrivals_mart.sinks import read_table, tables
from arrivals_mart.streaming import STREAMED_FACT, load_fact_incrementally, write_fact_batch
from fixtures import ARRIVALS, arrival


def _count(spark, out):
    return read_table(spark, out, STREAMED_FACT).count()


def test_incremental_load_is_exactly_once(spark, tmp_dir):
    src, out, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/fact", f"{tmp_dir}/ckpt"
    spark.createDataFrame(ARRIVALS, ARRIVALS_INPUT).coalesce(1).write.parquet(f"{src}/day1")
    load_fact_incrementally(spark, f"{src}/*/*.parquet", ARRIVALS_INPUT, out, checkpoint=ckpt)
    assert _count(spark, out) == len(ARRIVALS)
    # a rerun with no new files adds nothing
    load_fact_incrementally(spark, f"{src}/*/*.parquet", ARRIVALS_INPUT, out, checkpoint=ckpt)
    assert _count(spark, out) == len(ARRIVALS)
    # a new day's file is appended
    spark.createDataFrame([arrival(100.0), arrival(101.0)], ARRIVALS_INPUT).coalesce(1).write.parquet(f"{src}/day2")
    load_fact_incrementally(spark, f"{src}/*/*.parquet", ARRIVALS_INPUT, out, checkpoint=ckpt)
    back = read_table(spark, out, STREAMED_FACT)
    assert back.count() == len(ARRIVALS) + 2
    assert back.drop("load_batch").schema == IMMIG_FACT.read_schema()
    assert sorted(r.load_batch for r in back.select("load_batch").distinct().collect()) == [0, 1]


def test_retried_batch_replaces_only_itself(spark, tmp_dir):
    out = f"{tmp_dir}/fact"
    fact = build_fact(spark.createDataFrame(ARRIVALS, ARRIVALS_INPUT))
    write_fact_batch(fact, 0, out)
    write_fact_batch(fact.limit(2), 1, out)
    write_fact_batch(fact.limit(2), 1, out)  # the same batch again, as after a failure
    assert _count(spark, out) == len(ARRIVALS) + 2
    # one file per directory of a batch (rebalanced write)
    dirs = glob.glob(f"{out}/partition_port=*/i94_month=*/load_batch=*")
    assert len(glob.glob(f"{out}/partition_port=*/i94_month=*/load_batch=*/*.parquet")) == len(dirs)


def test_a_batch_of_many_directories_shares_them_and_later_ones_follow(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(tables, "MAX_DIRECTORIES", 2)  # the batches have more
    out = f"{tmp_dir}/fact"
    fact = build_fact(spark.createDataFrame(ARRIVALS, ARRIVALS_INPUT))
    write_fact_batch(fact, 0, out)
    for _ in range(2):  # the second of them is a retry
        write_fact_batch(fact.limit(1), 1, out)
    assert glob.glob(f"{out}/partition_group=*/i94_month=*/load_batch=1") and not glob.glob(f"{out}/partition_port=*")
    back = read_table(spark, out, STREAMED_FACT)
    assert back.schema == STREAMED_FACT.read_schema() and back.count() == len(ARRIVALS) + 1
    assert back.where("NOT i94_port <=> partition_port").count() == 0


def test_no_batch_is_stored_first_and_shared_directories_are_not_counted(spark, tmp_dir, monkeypatch):
    def refuse(*_, **__):
        raise AssertionError("a pass that is not needed")

    monkeypatch.setattr(tables, "MAX_DIRECTORIES", 2)
    frame = type(spark.range(1))
    monkeypatch.setattr(frame, "persist", refuse)
    monkeypatch.setattr(frame, "cache", refuse)
    out = f"{tmp_dir}/fact"
    fact = build_fact(spark.createDataFrame(ARRIVALS, ARRIVALS_INPUT))
    write_fact_batch(fact, 0, out)
    monkeypatch.setattr(frame, "agg", refuse)  # the table shares its directories by now
    write_fact_batch(fact.limit(2), 1, out)
    monkeypatch.undo()
    assert _count(spark, out) == len(ARRIVALS) + 2


def test_a_batch_is_prepared_as_it_is_written(spark, tmp_dir):
    src, out, seen = f"{tmp_dir}/in", f"{tmp_dir}/fact", []
    spark.createDataFrame(ARRIVALS, ARRIVALS_INPUT).coalesce(1).write.parquet(f"{src}/day1")

    def prepare(raw):
        seen.append(raw.isStreaming)
        return raw.where("cicid IS NOT NULL")

    load_fact_incrementally(spark, f"{src}/*/*.parquet", ARRIVALS_INPUT, out, f"{tmp_dir}/ckpt", prepare=prepare)
    assert seen == [False]
    fact = build_fact(spark.createDataFrame(ARRIVALS, ARRIVALS_INPUT).where("cicid IS NOT NULL"))
    back = read_table(spark, out, STREAMED_FACT).select(*fact.columns)
    assert back.exceptAll(fact).count() == fact.exceptAll(back).count() == 0
