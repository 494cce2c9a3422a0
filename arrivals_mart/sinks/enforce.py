"""Writes that enforce a contract: rows that break it go to a rejects table.

A row is rejected if a value of a required column is missing, or if a value
does not convert to its column's type. The rules are expressions on the row, so
one job writes both tables: the split is the first directory level of the
write (``status=accepted`` / ``status=rejected``), below which the contract's
own directories follow. Nothing is scanned twice and nothing is lost: a rejected
row keeps its raw values as JSON, next to the reasons.
"""

from __future__ import annotations

from collections.abc import Mapping
from contextlib import nullcontext
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from arrivals_mart.contracts import Contract
from arrivals_mart.operators.conform import conform
from arrivals_mart.sinks.tables import (
    SHARED_PARTITIONS,
    path_exists,
    read_table,
    rebalanced,
    share_directories,
    small_scans,
    too_many,
    with_partition_copies,
)

STATUS = "status"
ACCEPTED, REJECTED = "accepted", "rejected"
REASONS, RAW = "reject_reasons", "rejected_row"


@dataclass(frozen=True)
class EnforcedWrite:
    """Where the two tables are, and how many rows went to each. A table without rows has no folder."""

    accepted_path: str
    rejected_path: str
    row_count: int
    rejected_count: int


def violations(df: DataFrame, contract: Contract) -> Column:
    """Array of the contract's rules that a row of ``df`` breaks, such as
    ``cicid: null`` or ``i94_age: not int``; empty for a good row."""
    have = {f.name: f.dataType for f in df.schema.fields}
    rules = []
    for f in contract.schema.fields:
        value = F.col(f"`{f.name}`")
        if have[f.name] != f.dataType:
            lost = value.isNotNull() & value.try_cast(f.dataType).isNull()
            rules.append(F.when(lost, F.lit(f"{f.name}: not {f.dataType.simpleString()}")))
        if f.name in contract.required:
            rules.append(F.when(value.isNull(), F.lit(f"{f.name}: null")))
    return F.array_compact(F.array(*rules)) if rules else F.array().cast("array<string>")


def write_enforced(
    df: DataFrame,
    path: str,
    contract: Contract,
    partition_by: Mapping[str, str] | None = None,
    directories: int | None = None,
) -> EnforcedWrite:
    """Write the rows of ``df`` that keep ``contract`` below
    ``path/status=accepted`` and all others below ``path/status=rejected``.

    ``df`` has the contract's columns (a missing one is an error), of any type;
    further columns are only kept in a rejected row's raw values. The accepted
    table is read with ``read_table(spark, result.accepted_path, contract)``,
    the other with :func:`read_rejects`.
    """
    parts = dict(contract.partition_by if partition_by is None else partition_by)
    extra = [s for s in parts.values() if s not in contract.columns]
    reasons = violations(df, contract)
    marked = df.withColumns(
        {
            REASONS: reasons,
            RAW: F.when(F.size(reasons) > 0, F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))),
            STATUS: F.when(F.size(reasons) > 0, REJECTED).otherwise(ACCEPTED),
        }
    )
    rows = with_partition_copies(conform(marked, contract, extra=[*extra, REASONS, RAW, STATUS]), parts)
    rows = rows.drop(*[s for p, s in parts.items() if p != s and s not in contract.columns])
    levels, sort_by = list(parts), contract.sort_by
    if levels and too_many(directories):
        rows, levels, sort_by = share_directories(rows, levels, sort_by)
        directories = SHARED_PARTITIONS
    if levels:
        rows = rebalanced(rows, [STATUS, *levels], sort_by, directories)
    else:
        # Two directories need no shuffle: each task writes a file in each.
        rows = rows.sortWithinPartitions(STATUS, *sort_by)
    counted = Observation(f"enforced_{contract.name}")
    rejected = F.col(STATUS) == REJECTED
    rows = rows.observe(
        counted, F.count_if(~rejected).alias("row_count"), F.count_if(rejected).alias("rejected_count")
    )
    with nullcontext() if levels else small_scans(df.sparkSession):
        rows.write.partitionBy(STATUS, *levels).parquet(path)
    return EnforcedWrite(f"{path}/{STATUS}={ACCEPTED}", f"{path}/{STATUS}={REJECTED}", **counted.get)


def read_accepted(spark: SparkSession, written: EnforcedWrite, contract: Contract) -> DataFrame:
    """The accepted rows, with the contract's columns and directories."""
    schema = contract.read_schema()
    if not path_exists(spark, written.accepted_path):
        return spark.createDataFrame([], schema)
    return read_table(spark, written.accepted_path, contract)


def read_rejects(spark: SparkSession, written: EnforcedWrite, contract: Contract) -> DataFrame:
    """The rejected rows: the contract's columns as far as they convert, the
    reasons, and the raw values as JSON."""
    schema = StructType(
        [*contract.schema.fields, StructField(REASONS, ArrayType(StringType())), StructField(RAW, StringType())]
    )
    if not path_exists(spark, written.rejected_path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(written.rejected_path)


def count_rejects(rejects: DataFrame) -> DataFrame:
    """``reason, rejected``: rows of :func:`read_rejects` by reason (a row with
    two reasons counts for both)."""
    reasons = rejects.select(F.explode(REASONS).alias("reason"))
    return reasons.groupBy("reason").agg(F.count(F.lit(1)).alias("rejected"))
