"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import arrivals_mart
from arrivals_mart.sinks import materialize

__all__ = [
    "ASCII_SPACE",
    "let_workers_import",
    "materialize",
    "quoted",
    "runs",
    "table",
    "text_bytes",
    "word_count",
]

#: White space of the word rule ``[^\x20\x09-\x0D]+``.
ASCII_SPACE = r"[\x20\x09-\x0D]+"


def let_workers_import(spark: SparkSession) -> None:
    """Put the place this package was imported from on the path of Python
    workers that start from now on. On a cluster the package is installed, or
    sent with ``--py-files``; there an unknown folder on the path does no harm."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(arrivals_mart.__file__)))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    # Another environment means other workers, so leave it if they have the path.
    if root not in [*paths, *os.environ.get("PYTHONPATH", "").split(os.pathsep)]:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    let_workers_import(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quoted(names: Iterable[str]) -> list[Column]:
    """Columns of exactly these names, whatever characters they hold (a dot
    would else reach into a struct)."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in names]


def word_count(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``; 0 for null.

    Every word is reduced to one ``x`` and the white space dropped, so no
    array of words is built.
    """
    marks = F.regexp_replace(F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "x"), ASCII_SPACE, "")
    return F.coalesce(F.length(marks), F.lit(0)).cast("long")


def text_bytes(column: pa.ChunkedArray | pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of an Arrow string column."""
    return column.cast(pa.binary()).to_pylist()


def runs(batches: Iterator[pa.RecordBatch], key: Sequence[str]) -> Iterator[pa.Table]:
    """Regroup the batches of a partition sorted by ``key`` so that no run of
    equal keys is cut: each yielded table holds whole runs. Memory is one
    batch plus the longest run, which callers must bound."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = np.zeros(batch.num_rows, bool)
        for name in key:
            values = batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)
            last[1:] |= values[1:] != values[:-1]
            if held:
                before = held[-1].column(held[-1].schema.get_field_index(name))[-1].as_py()
                last[0] |= before != values[0]
        starts = np.flatnonzero(last)
        if not len(starts):
            held.append(batch)
            continue
        cut = int(starts[-1])
        whole = [*held, batch.slice(0, cut)] if cut else held
        if whole:
            yield pa.Table.from_batches(whole)
        held = [batch.slice(cut)]
    if held:
        yield pa.Table.from_batches(held)
