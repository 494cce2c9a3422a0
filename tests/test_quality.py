import pytest

from arrivals_mart.operators import QualityError, key_duplicates, quality_report, require_quality


def test_report_counts_rows_and_null_keys(spark):
    a = spark.createDataFrame([(1,), (None,), (None,)], "k int")
    b = spark.createDataFrame([("x",)], "code string")
    rows = {r.table_name: r for r in quality_report({"a": (a, "k"), "b": (b, "code")}).collect()}
    assert (rows["a"].row_count, rows["a"].null_keys) == (3, 2)
    assert (rows["b"].row_count, rows["b"].null_keys, rows["b"].key_column) == (1, 0, "code")


def test_require_passes_clean_tables(spark):
    a = spark.createDataFrame([(1,), (2,)], "k int")
    assert len(require_quality(quality_report({"a": (a, "k")}))) == 1


def test_require_reports_empty_tables_first_and_real_null_count(spark):
    empty = spark.createDataFrame([], "k int")
    nulls = spark.createDataFrame([(None,), (None,), (3,)], "k int")
    with pytest.raises(QualityError) as err:
        require_quality(quality_report({"nulls": (nulls, "k"), "empty": (empty, "k")}))
    assert err.value.failures == ["empty contains 0 rows", "nulls contains 2 null values in column k"]


def test_key_duplicates(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 1), (2, 1), (2, 1)], "a int, b int")
    got = sorted(tuple(r) for r in key_duplicates(df, ["a", "b"]).collect())
    assert got == [(1, 1, 2), (2, 1, 3)]
