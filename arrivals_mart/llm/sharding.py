"""Shards of near-equal bytes by histogram sort.

Rows are ordered by (hash of the text, ``doc_id``), so equal texts stand
together. A narrow table of keys and sizes is written once; then candidate
boundaries (probes) are refined: every round counts, across all partitions,
the exact bytes and rows between neighbouring probes, keeps for every wanted
cut the two probes around it, and puts new probes between the smallest and the
largest key found there. Rounds end when each cut is within tolerance or no
two keys are left to separate. Only then are the rows exchanged, once.

A cut between two shards is accepted within ``tolerance`` of a shard's bytes
and prefers a place between two different texts, so at most the few groups of
equal texts that are heavier than the tolerance and lie on a cut are divided
(a group may hold a third of all rows, more than a whole shard).

The exchange has one task per range; there are about
``spark.sql.shuffle.partitions`` ranges, or as many as keep a range near
``RANGE_BYTES``, all found by the same rounds, and what the driver holds is a few
numbers per range.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrivals_mart.llm.common import materialize, quoted

_LOW = 1 << 63
_PROBES = 16
#: Bytes of text that a task sorts, about, where there are more than shuffle partitions hold.
RANGE_BYTES = 1 << 30
_MAX_ROUNDS = 64


def _key(h: int, d: int) -> int:
    """One ordered number of the two signed halves of a key."""
    return ((h + _LOW) << 64) | (d + _LOW)


def _halves(key: int) -> tuple[int, int]:
    return (key >> 64) - _LOW, (key & ((1 << 64) - 1)) - _LOW


def _arrays(probes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Both halves of sorted probes: made once, and sent to the tasks."""
    pairs = np.array([_halves(p) for p in probes], np.int64).reshape(-1, 2)
    return np.ascontiguousarray(pairs[:, 0]), np.ascontiguousarray(pairs[:, 1])


def _places(probes: tuple[np.ndarray, np.ndarray], h: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Number of probes at or below each key."""
    ph, pd = probes
    at = np.searchsorted(ph, h, "left")
    over = np.searchsorted(ph, h, "right")
    for i in np.unique(at[over > at]):
        same = (at == i) & (over > at)
        end = np.searchsorted(ph, ph[i], "right")
        at[same] = i + np.searchsorted(pd[i:end], d[same], "right")
    return at


@dataclass
class _Bin:
    """What lies between two probes: bytes and rows, smallest and largest key."""

    bytes: int
    rows: int
    low: int
    high: int


def _histogram(keys: DataFrame, probes: list[int]) -> dict[int, _Bin]:
    halves = _arrays(probes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            h, d, size = (batch.column(i).to_numpy() for i in range(3))
            at = _places(halves, h, d)
            order = np.lexsort((d, h, at))
            at, h, d, size = at[order], h[order], d[order], size[order]
            first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            last = np.concatenate([first[1:], [len(at)]]) - 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(at[first].astype(np.int64)),
                    pa.array(np.add.reduceat(size, first)),
                    pa.array((last - first + 1).astype(np.int64)),
                    *(pa.array(x) for x in (h[first], d[first], h[last], d[last])),
                ],
                ["at", "size", "n", "h0", "d0", "h1", "d1"],
            )

    counted = (
        keys.select("h", "d", "size")
        .mapInArrow(run, "at long, size long, n long, h0 long, d0 long, h1 long, d1 long")
        .groupBy("at")
        .agg(
            F.sum("size").alias("size"),
            F.sum("n").alias("n"),
            F.min(F.struct("h0", "d0")).alias("low"),
            F.max(F.struct("h1", "d1")).alias("high"),
        )
    )
    # A row per gap between probes at most.
    return {r["at"]: _Bin(r["size"], r["n"], _key(*r["low"]), _key(*r["high"])) for r in counted.collect()}


@dataclass
class _Cut:
    """A wanted cut: ``at`` bytes should lie below it."""

    at: float
    slack: float
    low: int  # keys below this lie before the cut
    high: int  # keys from this on lie after it (exclusive bound)
    below: int  # bytes and rows before ``low``
    rows: int
    done: int | None = None
    left: int = 0  # rows before the chosen boundary


def _refine(cut: _Cut, edges: list[tuple[int, int, _Bin | None]], lows: list[int], first: int, last: int) -> None:
    """Narrow a cut by the gaps ``edges[first:last + 1]``, each a boundary with
    the rows before it and what follows, and ``lows`` the bytes before it, in key order; choose a
    boundary if one is good enough. Found by bisection: many cuts may share the gaps."""
    near = [
        (edges[i][0], lows[i], edges[i][1])
        for i in range(
            bisect_left(lows, cut.at - cut.slack, first, last + 1), bisect_right(lows, cut.at + cut.slack, first, last + 1)
        )
    ]
    between = [o for o in near if _halves(o[0])[1] == -_LOW]
    if between or near:
        best = min(between or near, key=lambda o: abs(o[1] - cut.at))
        cut.done, cut.left = best[0], best[2]
        return
    i = bisect_right(lows, cut.at, first, last + 1) - 1
    if first <= i < last:
        (_, rows, held), (after, _, _), low = edges[i], edges[i + 1], lows[i]
        if held is not None:
            if held.low == held.high:  # one key: the nearer side of it
                nearer = held.low if cut.at - low <= low + held.bytes - cut.at else held.high + 1
                cut.done, cut.left = nearer, rows if nearer == held.low else rows + held.rows
            else:
                cut.low, cut.high, cut.below, cut.rows = held.low, min(after, held.high + 1), low, rows


def _probes(cut: _Cut) -> list[int]:
    """New boundaries between the smallest and largest key around a cut; while
    several hashes are left they lie between hashes, that is between texts."""
    low, high = _halves(cut.low)[0], _halves(cut.high - 1)[0]
    if low < high:
        inner = {low + (high - low) * i // (_PROBES + 1) for i in range(1, _PROBES + 1)} | {low + 1, high}
        keys = {_key(h, -_LOW) for h in inner if h > low}
    else:
        span = cut.high - cut.low
        keys = {cut.low + span * i // (_PROBES + 1) for i in range(1, _PROBES + 1)} | {cut.low + 1, cut.high - 1}
    return [k for k in keys if cut.low < k < cut.high]


def find_boundaries(
    keys: DataFrame, shards: int, ranges: int | None, tolerance: float
) -> tuple[list[tuple[int, int, int]], int]:
    """Boundaries that cut ``keys (h, d, size)`` into ``shards * ranges``
    ranges: ``(boundary, shard from here on, rows before)`` in key order, and
    the ranges of a shard. By default there are as many as shuffle
    partitions, and more where a range would exceed ``RANGE_BYTES``."""
    whole = _histogram(keys, [])
    if not whole:
        return [], 1
    total = whole[0].bytes
    if ranges is None:
        usual = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        ranges = -(-max(usual, -(-total // RANGE_BYTES)) // shards)
    cuts: list[_Cut] = []
    for i in range(1, shards * ranges):
        share = total / shards
        slack = share * tolerance if i % ranges == 0 else share / ranges / 4
        cuts.append(_Cut(total * i / (shards * ranges), slack, whole[0].low, whole[0].high + 1, 0, 0))
    for _ in range(_MAX_ROUNDS):
        todo = [c for c in cuts if c.done is None]
        if not todo:
            break
        new: set[int] = set()
        gaps: dict[tuple[int, int], list[_Cut]] = {}
        for c in todo:
            gaps.setdefault((c.low, c.high), []).append(c)
        for (low, high), around in gaps.items():
            new.update(_probes(around[0]))
            if len(around) > 1:  # many cuts in one gap: as many more probes
                a, b = _halves(low)[0], _halves(high - 1)[0]
                n = 4 * len(around)
                more = {_key(a + (b - a) * i // n, -_LOW) for i in range(1, n)} if a < b else {
                    low + (high - low) * i // n for i in range(1, n)
                }
                new.update(k for k in more if low < k < high)
        probes = sorted(new | {c.low for c in todo} | {c.high for c in todo})
        bins = _histogram(keys, probes)
        edges, lows, low, rows = [], [], bins[0].bytes if 0 in bins else 0, bins[0].rows if 0 in bins else 0
        for i, p in enumerate(probes, 1):
            held = bins.get(i)
            edges.append((p, rows, held))
            lows.append(low)
            if held is not None:
                low, rows = low + held.bytes, rows + held.rows
        where = {p: i for i, p in enumerate(probes)}
        for c in todo:
            _refine(c, edges, lows, where[c.low], where[c.high])
    out: list[tuple[int, int, int]] = []
    for i, c in enumerate(cuts, 1):
        if c.done is None:
            raise RuntimeError("a cut was not found")
        out.append((c.done, i // ranges, c.left))
    # A heavy key may swallow neighbouring cuts: keep the order.
    for i in range(1, len(out)):
        if out[i][0] < out[i - 1][0]:
            out[i] = (out[i - 1][0], out[i][1], out[i - 1][2])
    return out, ranges


def text_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 1."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def histogram_shards(
    docs: DataFrame, shards: int = 8, tolerance: float = 0.002, ranges: int | None = None
) -> DataFrame:
    """``docs (doc_id, text, ...)`` with ``shard`` (0 to ``shards - 1``) and
    ``slot``, the gapless place of a row in its shard, from 0.

    Shards hold near-equal bytes (:func:`text_size`): a cut is off by at most
    ``tolerance`` of a shard, or by half of the heaviest row that lies on it.
    Equal texts lie next to each other. Null texts are one group of size 1; a
    null ``doc_id`` sorts first. Equal rows may take each other's slots, which
    no reader can tell. Texts of any length are whole rows of a shard; one longer
    than a range has that range's task to itself. With fewer rows than shards some shards are empty; an
    empty table gives an empty result. Input columns named ``shard`` or
    ``slot`` are replaced, others pass through.
    """
    docs = docs.drop("shard", "slot")
    marked = docs.withColumns(
        {
            "__h": F.xxhash64("text"),
            "__d": F.coalesce(F.col("doc_id").cast("long"), F.lit(-_LOW + 1)),
            "__size": text_size(F.col("text")),
        }
    )
    keys = materialize(
        marked.select(F.col("__h").alias("h"), F.col("__d").alias("d"), F.col("__size").alias("size")),
        "shard_keys",
    )
    cuts, ranges = find_boundaries(keys, shards, ranges, tolerance)
    probes = _arrays([c[0] for c in cuts])
    shard_of = np.array([0, *(c[1] for c in cuts)], np.int32)
    before = np.array([0, *(c[2] for c in cuts)], np.int64)
    used, first = np.unique(shard_of, return_index=True)
    start = np.zeros(shards, np.int64)
    start[used] = before[first]
    offset = before - start[shard_of]

    @F.pandas_udf("range int, shard int, offset long")
    def place_of(h: pd.Series, d: pd.Series) -> pd.DataFrame:
        at = _places(probes, h.to_numpy(), d.to_numpy())
        return pd.DataFrame({"range": at.astype(np.int32), "shard": shard_of[at], "offset": offset[at]})

    placed = marked.withColumn("__at", place_of("__h", "__d")).withColumn("__range", F.col("__at.range"))
    tasks = shards * ranges
    order = Window.partitionBy("__range").orderBy("__h", "__d")
    return (
        placed.repartitionById(tasks, "__range")  # a task for each range
        .withColumn("__n", F.row_number().over(order))
        .select(
            *quoted(docs.columns),
            F.col("__at.shard").alias("shard"),
            (F.col("__at.offset") + F.col("__n") - 1).cast("long").alias("slot"),
        )
    )
