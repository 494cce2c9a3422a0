import pytest
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from arrivals_mart.contracts import BY_NAME, IMMIG_FACT, MART
from arrivals_mart.operators import conform, contract_mismatches, require_contract

SMALL = StructType([StructField("k", IntegerType()), StructField("v", StringType())])


def test_conform_orders_and_converts(spark):
    df = spark.createDataFrame([("x", 1.9), ("y", float("nan"))], "v string, k double")
    out = conform(df, SMALL)
    assert out.schema == SMALL
    assert [tuple(r) for r in out.collect()] == [(1, "x"), (None, "y")]


def test_conform_missing_column(spark):
    with pytest.raises(ValueError):
        conform(spark.createDataFrame([(1,)], "k int"), SMALL)


def test_mismatches(spark):
    df = spark.createDataFrame([("a", 1, 2)], "k string, v int, extra int")
    bad = contract_mismatches(df, SMALL)
    assert [b["position"] for b in bad] == [1, 2, 3]
    with pytest.raises(ValueError):
        require_contract(df, SMALL)


def test_contracts_match_the_ddl_shape():
    assert len(IMMIG_FACT.columns) == 24
    assert [c.name for c in MART] == [
        "immig_fact",
        "airport_dim",
        "visa_type_dim",
        "travel_mode_dim",
        "time_dim",
        "country_temperature_dim",
        "demographics_dim",
    ]
    assert BY_NAME["time_dim"].read_schema().names[-1] == "partition_month"
    assert IMMIG_FACT.read_schema().names[-2:] == ["partition_port", "i94_month"]
