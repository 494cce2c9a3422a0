"""What the reference leaves to Catalyst, checked on our plans."""

from pyspark.sql import functions as F

from arrivals_mart.contracts import DEMOGRAPHICS_INPUT
from arrivals_mart.functions import day_number_to_date
from arrivals_mart.operators import group_means
from arrivals_mart.plans.tables import DEMOGRAPHIC_MEANS
from arrivals_mart.sources import register_view
from plan_util import plan_text


def test_view_serves_sql_text(spark):
    register_view(spark.createDataFrame([(1.0,), (2.0,), (None,)], "i94visa double"), "arrivals_view_test")
    rows = spark.sql("SELECT try_cast(i94visa AS INT) AS k FROM arrivals_view_test WHERE i94visa IS NOT NULL").collect()
    assert sorted(r.k for r in rows) == [1, 2]


def test_epoch_literal_is_folded(spark):
    df = spark.createDataFrame([(20574,)], "n int").select(day_number_to_date("n").alias("d"))
    text = plan_text(df, "extended")
    optimized = text.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert "date_add(1960-01-01" in optimized
    assert "to_date" not in optimized


def test_redundant_distinct_over_groups_is_removed(spark):
    demo = spark.createDataFrame([], DEMOGRAPHICS_INPUT)
    means = group_means(demo, "stateCode", DEMOGRAPHIC_MEANS, drop=("race", "count"))
    tree = lambda df: plan_text(df).split("\n\n")[0]
    assert tree(means.distinct()).count("HashAggregate") == tree(means).count("HashAggregate")


def test_null_filter_reaches_parquet_scan(spark, tmp_dir):
    spark.createDataFrame([("a", None), ("b", "x")], "name string, local_code string").write.parquet(tmp_dir + "/a")
    df = spark.read.parquet(tmp_dir + "/a").where(F.col("local_code").isNotNull()).select("name")
    assert "PushedFilters: [IsNotNull(local_code)]" in plan_text(df)
