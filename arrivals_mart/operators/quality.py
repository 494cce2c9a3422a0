"""Data-quality checks: rows present, key never null, key unique.

The report is one small DataFrame (one row per table) computed with one
global aggregate per table; only that report ever reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F


def quality_report(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """``table_name, key_column, row_count, null_keys`` per table.

    ``tables`` maps a table name to ``(frame, key column)``.
    """
    parts = []
    for name, (df, key) in tables.items():
        parts.append(
            df.select(F.col(key).alias("__key")).agg(
                F.lit(name).alias("table_name"),
                F.lit(key).alias("key_column"),
                F.count(F.lit(1)).alias("row_count"),
                F.count_if(F.col("__key").isNull()).alias("null_keys"),
            )
        )
    if not parts:
        raise ValueError("no tables to check")
    return reduce(DataFrame.unionByName, parts)


def key_report(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """:func:`quality_report` with ``duplicate_keys``: the number of key values
    (nulls aside) that occur more than once.

    Counts per key are aggregated in the scan tasks first, so only distinct
    keys are shuffled, however often one of them occurs.
    """
    parts = []
    for name, (df, key) in tables.items():
        null = F.col("__key").isNull()
        counts = df.select(F.col(key).alias("__key")).groupBy("__key").agg(F.count(F.lit(1)).alias("__n"))
        parts.append(
            counts.agg(
                F.lit(name).alias("table_name"),
                F.lit(key).alias("key_column"),
                F.coalesce(F.sum("__n"), F.lit(0)).alias("row_count"),
                F.coalesce(F.sum(F.when(null, F.col("__n"))), F.lit(0)).alias("null_keys"),
                F.count_if(~null & (F.col("__n") > 1)).alias("duplicate_keys"),
            )
        )
    if not parts:
        raise ValueError("no tables to check")
    return reduce(DataFrame.unionByName, parts)


def require_unique(rows: Iterable, names: Iterable[str]) -> None:
    """Raise :class:`QualityError` for rows of :func:`key_report` that belong to
    ``names`` and hold duplicate keys."""
    names = set(names)
    failures = [
        f"{r.table_name} contains {r.duplicate_keys} repeated values in column {r.key_column}"
        for r in rows
        if r.table_name in names and r.duplicate_keys > 0
    ]
    if failures:
        raise QualityError(failures)


class QualityError(ValueError):
    """A table failed a check; ``failures`` lists every failed check."""

    def __init__(self, failures: list[str]):
        super().__init__("data quality check failed: " + "; ".join(failures))
        self.failures = failures


def require_quality(report: DataFrame) -> list[Row]:
    """Collect the report and raise :class:`QualityError` when any table is
    empty or has null keys (see :func:`check_report`)."""
    return check_report(report.collect())


def check_report(rows: Iterable) -> list:
    """Raise :class:`QualityError` for report rows (``table_name``,
    ``key_column``, ``row_count``, ``null_keys``) of empty tables or tables
    with null keys. Emptiness is checked for all tables first, then the null
    keys; the message carries the real null count."""
    rows = list(rows)
    failures = [f"{r.table_name} contains 0 rows" for r in rows if r.row_count < 1]
    failures += [
        f"{r.table_name} contains {r.null_keys} null values in column {r.key_column}"
        for r in rows
        if r.null_keys > 0
    ]
    if failures:
        raise QualityError(failures)
    return rows


def key_duplicates(df: DataFrame, keys: Iterable[str], count_name: str = "n") -> DataFrame:
    """Key values that occur more than once, with their count."""
    keys = list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name)).where(F.col(count_name) > 1)
