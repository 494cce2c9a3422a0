"""Physical layouts beyond directories: buckets, positional loads, compaction.

* A **bucketed** table is hashed on its contract's bucket columns when it is
  written, so that a later aggregate or join on these columns needs no
  exchange of the table. The fact's are the port and the arrival day: the port
  alone would put a hot port into one bucket.
* A **positional load** fills a catalog table by column position, as a bulk
  load does, after a check of the number of columns and their types.
* **Compaction** rewrites a table of many small loads into advisory-sized files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivals_mart.contracts import Contract
from arrivals_mart.operators.conform import require_contract
from arrivals_mart.sinks.tables import read_table, write_table


def write_bucketed(
    df: DataFrame, table: str, path: str, contract: Contract, buckets: int, mode: str = "errorifexists"
) -> str:
    """Write ``df`` as the catalog table ``table`` with its files at ``path``,
    in ``buckets`` buckets on ``contract.bucket_by``; returns ``table``.

    The rows are shuffled once, by the buckets' own hash, so every bucket is one
    file, sorted by the bucket columns. Choose ``buckets`` for about 256 MB a bucket."""
    if not contract.bucket_by:
        raise ValueError(f"{contract.name} has no bucket columns")
    rows = require_contract(df.select(*contract.columns), contract)
    rows = rows.repartition(buckets, *contract.bucket_by)
    writer = rows.write.format("parquet").mode(mode).option("path", path)
    writer.bucketBy(buckets, *contract.bucket_by).sortBy(*contract.bucket_by).saveAsTable(table)
    return table


def position_mismatches(df: DataFrame, table: DataFrame) -> list[str]:
    """What keeps ``df`` from being loaded into ``table`` by position."""
    have, want = df.schema.fields, table.schema.fields
    if len(have) != len(want):
        return [f"{len(have)} columns for {len(want)}"]
    return [
        f"position {i}: {a.name} is {a.dataType.simpleString()}, {b.name} is {b.dataType.simpleString()}"
        for i, (a, b) in enumerate(zip(have, want, strict=True), 1)
        if a.dataType != b.dataType
    ]


def load_by_position(df: DataFrame, table: str, overwrite: bool = True) -> None:
    """Fill the catalog table ``table`` from ``df`` by position, whatever the
    names; by default what it held is replaced, in the same job.

    Raises ValueError, before anything is written, unless the columns agree in
    number and, position by position, in type."""
    bad = position_mismatches(df, df.sparkSession.table(table))
    if bad:
        raise ValueError(f"{table} cannot be loaded by position: {'; '.join(bad)}")
    df.write.insertInto(table, overwrite=overwrite)


def compact_loads(
    spark: SparkSession,
    path: str,
    target: str,
    contract: Contract,
    load: str = "load_batch",
    directories: int | None = None,
) -> str:
    """Rewrite the table at ``path``, whose last directory level ``load`` numbers
    its loads, to ``target``: the loads of a directory become one, under the
    highest number of all loads; returns ``target``.

    The directories are counted here, in the pass that finds the highest number, if
    ``directories`` is not given. The rewrite is rebalanced, so a directory is one file, or several of
    advisory size. ``path`` stays as it is: publish ``target`` as the new version, let
    later loads (with higher numbers) go there, and expire the old one when its readers are done.
    """
    rows = read_table(spark, path, contract)
    parts = F.struct(*[p for p in contract.partition_by if p != load])
    newest, counted = rows.agg(F.max(load), F.approx_count_distinct(parts)).first()
    if newest is None:
        raise ValueError(f"{path}: no loads")
    directories = counted if directories is None else directories
    folded = rows.withColumn(load, F.lit(newest).cast(contract.source_type(load)))
    return write_table(folded, target, contract, mode="errorifexists", directories=directories)
