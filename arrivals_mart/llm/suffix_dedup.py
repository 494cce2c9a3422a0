r"""Repeated passages by grouped suffixes and window hashes.

A passage is repeated if a run of ``min_words`` words (``[^\x20\x09-\x0D]+``)
stands in at least two documents. A full suffix array would hold a suffix per
word. Here only suffixes at content-selected positions are kept: each window
of ``min_words`` words keeps the start of its smallest ``ANCHOR``-word hash
among the first ``min_words - RIGHT + 1`` starts, so equal windows keep the same place
and neighbouring windows mostly share it (one suffix per 16 words or so).

This stands in for a sorted suffix array, whose neighbours cannot give the whole
result: a window needs words on both sides of its kept position, and the
suffixes that agree with one the longest to the right (its neighbours) need not be those that agree to
the left. With a passage ``L X R``, copies of ``X R`` alone keep a
document that shares ``L X`` and the beginning of ``R`` from ever being a neighbour, and
extending the neighbours to the left finds nothing (there is a test of this). So suffixes are
grouped by the hash of their first words (neighbours below are all members
of a group) and windows are hashed where a suffix array would extend one
match. Texts are shuffled only where a context has to be extended (step 4), one row for each document. In steps:

1. Each kept suffix becomes a record: the hash of its first ``RIGHT`` words, the
   hash of its whole context (all windows that kept it), and its place.
2. Records are grouped by the first hash. Suffixes without a neighbour in
   another document are done: no window that kept them is repeated.
3. Inside a group of neighbours, equal contexts match as a whole; they are
   never compared in pairs, however many copies there are.
4. One record of each remaining context is extended to its windows:
   these are hashed from the text, and a window met in
   two documents, next to the same first hash, is a match (128 bits agree).
   So is every window of a context that matched as a whole: other documents
   hold it, whichever of its records is extended.
5. Matches of a document are merged to maximal spans.

Steps 2 to 4 are grouped minima and joins on hashes, so one passage may stand in a
third of all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arrivals_mart.llm.common import materialize, text_bytes

MIN_WORDS = 50
#: Words of the hash that selects positions.
ANCHOR = 8
#: Words to the right of a kept position inside every window that keeps it.
RIGHT = 20
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hashes:
    """Hashes of any run of words of one text, from prefix sums."""

    def __init__(self, text: bytes | None):
        words = (text or b"").split()
        self.n = len(words)
        self._sum = np.zeros(self.n + 1, np.uint64)
        if words:
            h = np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(7)), np.uint64, self.n)
            np.cumsum(h * _powers(_BASE, self.n), out=self._sum[1:])
            self._undo = _powers(_INVERSE, self.n)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self._sum[end] - self._sum[start]) * self._undo[start])


def kept_positions(hashes: Hashes, min_words: int, right: int = RIGHT, anchor: int = ANCHOR):
    """Kept positions of a text, and the first and last window of each."""
    windows = hashes.n - min_words + 1
    if windows < 1:
        none = np.zeros(0, np.int64)
        return none, none, none
    width = min_words - right + 1
    starts = np.arange(windows + width - 1)
    rank = hashes.of(starts, starts + anchor)
    best = np.argmin(np.lib.stride_tricks.sliding_window_view(rank, width), axis=1) + np.arange(windows)
    first = np.flatnonzero(np.concatenate([[True], best[1:] != best[:-1]]))
    last = np.concatenate([first[1:], [windows]]) - 1
    return best[first], first, last


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _record_batches(min_words: int, right: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: list[tuple[np.ndarray, ...]] = []
            for rid, text in zip(batch.column(0).to_numpy(), text_bytes(batch.column(1)), strict=True):
                hashes = Hashes(text)
                at, first, last = kept_positions(hashes, min_words, right, anchor)
                if len(at):
                    context = hashes.of(first, last + min_words)
                    shape = ((at - first) << 32 | (last - first)).astype(np.uint64)
                    parts.append(
                        (
                            np.full(len(at), rid),
                            hashes.of(at, at + right),
                            _mix(context ^ _mix(shape + np.uint64(1))),
                            first,
                            last - first + 1,
                        )
                    )
            if parts:
                rid, head, context, first, n = (np.concatenate(x) for x in zip(*parts, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rid),
                        _signed(head),
                        _signed(context),
                        pa.array(first.astype(np.int32)),
                        pa.array(n.astype(np.int32)),
                    ],
                    ["rid", "head", "context", "start", "n"],
                )

    return run


def _window_batches(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            rows = zip(
                batch.column(0).to_numpy(), text_bytes(batch.column(1)), batch.column(2).to_pylist(), strict=True
            )
            for rid, text, ranges in rows:
                hashes = Hashes(text)
                # A window has one kept position, so one head, even if its range is given twice.
                at, which = np.unique(
                    np.concatenate([np.arange(r["start"], r["start"] + r["n"]) for r in ranges]), return_index=True
                )
                sizes = [r["n"] for r in ranges]
                head = np.repeat([r["head"] for r in ranges], sizes)[which]
                whole = np.repeat([r["whole"] for r in ranges], sizes)[which]
                parts.append((np.full(len(at), rid), head, hashes.of(at, at + min_words), at, whole))
            if parts:
                rid, head, window, at, whole = (np.concatenate(x) for x in zip(*parts, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rid), pa.array(head), _signed(window), pa.array(at.astype(np.int32)), pa.array(whole)],
                    ["rid", "head", "window", "start", "whole"],
                )

    return run


def repeated_passages(
    docs: DataFrame, min_words: int = MIN_WORDS, right: int = RIGHT, anchor: int = ANCHOR
) -> DataFrame:
    """Maximal spans of ``docs (doc_id, text)`` in which every word lies in a
    run of ``min_words`` words that also stands in another document.

    Returns ``doc_id``, ``start_word`` (from 0) and ``n_words``. Documents are
    told apart by id and text: a row that repeats both is the same document
    and no repetition. Null, empty and shorter texts have no passage. Null ids
    are kept; other columns are ignored; an empty table gives an empty result.
    """
    if not anchor <= right <= min_words:
        raise ValueError("anchor <= right <= min_words is needed")
    keyed = docs.select(
        F.xxhash64("doc_id", "text").alias("rid"),
        F.col("text").cast("string").alias("text"),
        F.col("doc_id").cast("long").alias("doc_id"),
    ).where(F.col("text").isNotNull())
    records = materialize(
        keyed.select("rid", "text").mapInArrow(
            _record_batches(min_words, right, anchor), "rid long, head long, context long, start int, n int"
        ),
        "suffix_records",
    )
    # Grouped results are written before they are joined to their rows: the
    # join then has an exchange of its own, which Spark splits at a hot key.
    neighbours = materialize(
        records.groupBy("head")
        .agg(
            (F.min("rid") != F.max("rid")).alias("shared"),
            (F.min("context") != F.max("context")).alias("mixed"),
        )
        .where("shared")
        .select("head", "mixed"),
        "suffix_heads",
    )
    held = materialize(records.join(neighbours, "head"), "suffix_neighbours")
    contexts = materialize(
        held.groupBy("head", "context").agg(
            F.min(F.struct("rid", "start")).alias("first"), (F.min("rid") != F.max("rid")).alias("whole")
        ),
        "suffix_contexts",
    )
    matched = materialize(
        held.join(contexts, ["head", "context"]).select(
            "rid",
            "head",
            "start",
            "n",
            "whole",
            (
                F.col("mixed")
                & (~F.col("whole") | (F.struct("rid", "start") == F.col("first")))
            ).alias("extend"),
        ),
        "suffix_matches",
    )
    whole = matched.where("whole").select("rid", "start", (F.col("start") + F.col("n") - 1 + min_words).alias("end"))
    # Rows that repeat id and text have the same records: once is enough.
    extended_records = matched.where("extend").select("rid", "start", "n", "head", "whole").distinct()
    ranges = extended_records.groupBy("rid").agg(F.collect_list(F.struct("start", "n", "head", "whole")).alias("ranges"))
    windows = materialize(
        keyed.select("rid", "text")
        .join(ranges, "rid")
        .dropDuplicates(["rid"])
        .select("rid", "text", "ranges")
        .mapInArrow(_window_batches(min_words), "rid long, head long, window long, start int, whole boolean"),
        "suffix_windows",
    )
    again = materialize(
        windows.groupBy("head", "window")
        .agg(((F.min("rid") != F.max("rid")) | F.bool_or("whole")).alias("shared"))
        .where("shared")
        .select("head", "window"),
        "suffix_again",
    )
    extended = windows.join(again, ["head", "window"]).select("rid", "start", (F.col("start") + min_words).alias("end"))
    spans = whole.unionByName(extended).distinct()
    order = Window.partitionBy("rid").orderBy("start", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    merged = (
        spans.withColumn("new", F.coalesce((F.col("start") > reached).cast("int"), F.lit(1)))
        .withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("rid", "island")
        .agg(F.min("start").alias("start_word"), F.max("end").alias("end"))
    )
    ids = keyed.select("rid", "doc_id").distinct()
    return merged.join(ids, "rid").select(
        "doc_id", "start_word", (F.col("end") - F.col("start_word")).cast("int").alias("n_words")
    )
