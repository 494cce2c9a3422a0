"""The daily fact refresh as an incremental file stream.

New arrival files that land in the input folder are converted by the same
``build_fact`` projection and added to the partitioned fact. The stream's
checkpoint (in the shared folder) records which files were done, so a rerun
only picks up files it has not seen; with ``availableNow`` the query
processes everything present and then stops, which fits a daily run.

Each micro-batch is written by ``foreachBatch`` as an ordinary batch write,
so AQE applies: a REBALANCE on the directory columns gives one file per
directory and splits a hot port into several tasks (inside a plain file sink
every task would write into every directory it touches). The batch id is the
last directory level (``load_batch``) and the batch is written with dynamic
partition overwrite: a batch that is retried after a failure replaces exactly
its own directories and nothing else, so rows are never doubled.

The conversion is stateless: no watermark, no state store. The stream carries
the raw rows, and each batch is converted as it is written. So the number of its
directories is counted from the columns that name them, and no converted row is
stored before its write; a table that shares its directories needs no count.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from arrivals_mart.contracts import IMMIG_FACT
from arrivals_mart.plans.tables import build_fact
from arrivals_mart.sinks.tables import GROUP, first_level, write_table

# The fact as the stream writes it: one more directory level per batch.
STREAMED_FACT = dataclasses.replace(IMMIG_FACT, partition_by={**IMMIG_FACT.partition_by, "load_batch": "load_batch"})


def raw_stream(
    spark: SparkSession, source: str, schema: StructType, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Streaming DataFrame of the rows of the Parquet files matching ``source``."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(source)


def fact_stream(
    spark: SparkSession,
    source: str,
    schema: StructType,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming DataFrame of fact rows (plus ``i94_month``) over the
    Parquet files matching ``source``."""
    raw = raw_stream(spark, source, schema, max_files_per_trigger)
    return build_fact(prepare(raw) if prepare else raw)


def write_fact_batch(batch: DataFrame, batch_id: int, output: str) -> None:
    """Write one micro-batch below ``output``; idempotent per ``batch_id``."""
    directories = None
    if first_level(batch.sparkSession, output) != GROUP:
        parts = [c for c in STREAMED_FACT.partition_by.values() if c != "load_batch"]
        directories = batch.agg(F.approx_count_distinct(F.struct(*parts))).first()[0]
    write_table(
        batch.withColumn("load_batch", F.lit(batch_id).cast("bigint")),
        output,
        STREAMED_FACT,
        mode="overwrite",
        dynamic_overwrite=True,
        directories=directories,
    )


def load_fact_incrementally(
    spark: SparkSession,
    source: str,
    schema: StructType,
    output: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Add the fact rows of all not yet loaded files below ``source`` to the
    partitioned fact at ``output`` and wait until done. ``prepare`` makes raw arrivals of
    the rows of a batch. ``checkpoint`` must be the same folder in every call for an output: it
    knows the loaded files. Read the result with ``read_table(spark, output, STREAMED_FACT)``."""

    def write(raw: DataFrame, batch_id: int) -> None:
        write_fact_batch(build_fact(prepare(raw) if prepare else raw), batch_id, output)

    query = (
        raw_stream(spark, source, schema, max_files_per_trigger)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
