r"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman.

Words are runs of letters and digits of the lower-cased text. The n-grams
(``GRAM`` words; fewer where an item is so short that edits may leave none of
that length, or is shorter itself) of the benchmark items are counted over all documents. A copy of
an item with at most ``1 - least`` of its words edited still shares a known
number ``t`` of the item's ``G`` n-grams, hence at least one of the
``G - t + 1`` rarest: these are the item's seeds. A document joins an item
where it holds a seed and, near it, at least ``t`` of the item's n-grams; the passage
around is then aligned with the item (Smith-Waterman over words: match 1,
mismatch and gap -1). The similarity is the share of the item's words that the best
local alignment matches.

The distinct texts of the benchmark are taken in blocks of about ``BLOCK_WORDS``
words at most; only a block's table of n-grams goes to the executors, and every
block meets all documents whole, in two map-only passes (counts, matches).
Nothing but counts and matches leaves a task, so a passage may stand in a third
of all documents. An item text that many rows repeat is matched once; its
matches get the rows' ids in a join.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivals_mart.llm.common import materialize

GRAM = 3
LEAST = 0.8
#: Words of benchmark text whose n-grams are sent to the executors together.
BLOCK_WORDS = 1_000_000
_WORD = re.compile(r"[^\W_]+")
_K = 1 << 20  # score * _K + matched words in one number
#: Different words of a block, so that ``GRAM`` of them make a 63-bit code.
_MOST_WORDS = 1 << 63 // GRAM
MATCH_COLUMNS = "doc_id long, text_hash long, item long, similarity double, start_word int, n_words int"


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def align(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Best local alignment of word numbers ``a`` in ``b`` (Smith-Waterman):
    words matched, and the end (exclusive) of the aligned passage in ``b``."""
    n, m = len(a), len(b)
    # Cells of a diagonal depend on the two diagonals before only.
    two, one = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
    best, end = 0, 0
    for d in range(2, n + m + 1):
        low, high = max(1, d - m), min(n, d - 1)
        i = np.arange(low, high + 1)
        same = a[i - 1] == b[d - i - 1]
        step = two[i - 1] + np.where(same, _K + 1, -_K)
        gap = np.maximum(one[i - 1], one[i]) - _K
        cell = np.maximum(step, gap)
        cell[cell < _K] = 0
        now = np.zeros(n + 1, np.int64)
        now[i] = cell
        top = int(cell.argmax())
        if cell[top] > best:
            best, end = int(cell[top]), d - int(i[top])
        two, one = one, now
    return best % _K, end


@dataclass
class Block:
    """The n-grams of some benchmark items, as arrays."""

    ids: list[int]  # of each item
    words: dict[str, int]  # word -> number from 1
    items: list[np.ndarray]  # word numbers of each item
    codes: np.ndarray  # distinct n-grams, sorted
    gram: np.ndarray  # n-gram of each (item, place), by n-gram
    item: np.ndarray
    place: np.ndarray
    first: np.ndarray  # where an n-gram's (item, place) begin; one more at the end
    needed: np.ndarray  # n-grams that a copy of each item still has
    seed: np.ndarray | None = None  # of each (item, place): whether it is a seed
    lengths: list[int] = field(default_factory=list)  # words of an n-gram, as items use them

    def grams(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of a text where an item's n-gram begins, and which n-gram."""
        places, grams = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for length in self.lengths:
            code = self._codes(numbers, length)
            at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            place = np.flatnonzero(self.codes[at] == code)
            places.append(place)
            grams.append(at[place])
        return np.concatenate(places), np.concatenate(grams)

    def _codes(self, numbers: np.ndarray, length: int) -> np.ndarray:
        """Codes of the runs of ``length`` words, -1 with an unknown word; a
        shorter run is filled up with zeros, so no two lengths share a code."""
        size = np.int64(len(self.words) + 1)
        n = max(0, len(numbers) - length + 1)
        code, known = np.zeros(n, np.int64), np.ones(n, bool)
        for k in range(GRAM):
            code *= size
            if k < length:
                code += numbers[k : k + n]
                known &= numbers[k : k + n] != 0
        code[~known] = -1
        return code

    def numbers(self, text: str | None) -> np.ndarray:
        found = words_of(text)
        get = self.words.get
        return np.fromiter((get(w, 0) for w in found), np.int64, len(found))


def gram_length(n: int, edits: int) -> int:
    """Words of the n-grams of an item of ``n`` words: at most ``GRAM`` or the
    whole item, and so few that one survives all edits; 0 for an item without words."""
    return next((g for g in range(min(GRAM, n), 1, -1) if n - g + 1 > g * edits), min(n, 1))


def make_block(rows: list[tuple[int, str]], least: float) -> Block:
    words: dict[str, int] = {}
    items = []
    for _, text in rows:
        items.append(np.array([words.setdefault(w, len(words) + 1) for w in words_of(text)], np.int64))
    if len(words) + 1 >= _MOST_WORDS or max(map(len, items), default=0) >= _K:
        raise ValueError(f"fewer than {_K} words an item and {_MOST_WORDS - 1} different words a block are needed")
    block = Block(
        [r[0] for r in rows], words, items, *(np.zeros(0, np.int64) for _ in range(6))
    )
    code, item, place, needed, lengths = [], [], [], [], set()
    for k, a in enumerate(items):
        edits = int((1 - least) * len(a) + 1e-9)
        length = gram_length(len(a), edits)
        c = block._codes(a, length) if length else np.zeros(0, np.int64)
        code.append(c)
        item.append(np.full(len(c), k))
        place.append(np.arange(len(c)))
        needed.append(max(1, len(c) - length * edits))
        lengths.add(length)
    block.lengths = sorted(lengths - {0})
    flat = np.concatenate([*code, np.zeros(0, np.int64)])
    block.codes, gram = np.unique(flat, return_inverse=True)
    order = np.argsort(gram, kind="stable")
    block.gram = gram[order]
    block.item = np.concatenate([*item, np.zeros(0, np.int64)])[order].astype(np.int64)
    block.place = np.concatenate([*place, np.zeros(0, np.int64)])[order].astype(np.int64)
    block.first = np.searchsorted(block.gram, np.arange(len(block.codes) + 1))
    block.needed = np.array(needed, np.int64)
    return block


def choose_seeds(block: Block, counts: np.ndarray) -> None:
    """Mark the rarest n-grams of each item: as many that a copy must hold one."""
    block.seed = np.zeros(len(block.gram), bool)
    order = np.lexsort((block.place, counts[block.gram], block.item))
    item = block.item[order]
    start = np.searchsorted(item, np.arange(len(block.items) + 1))
    for k in range(len(block.items)):
        own = order[start[k] : start[k + 1]]
        block.seed[own[: len(own) - int(block.needed[k]) + 1]] = True


def _expand(first: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each n-gram met: which of them, and each of its (item, place)."""
    n = first[grams + 1] - first[grams]
    which = np.repeat(np.arange(len(grams)), n)
    inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return which, np.repeat(first[grams], n) + inner


def matches(block: Block, numbers: np.ndarray, least: float) -> list[tuple[int, float, int, int]]:
    """Best match of each item in a text: item id, similarity, span."""
    at, gram = block.grams(numbers)
    if not len(at):
        return []
    seeded = np.zeros(len(block.codes), bool)
    seeded[block.gram[block.seed]] = True
    if not seeded[gram].any():
        return []
    which, entry = _expand(block.first, gram)
    item, place, seed = block.item[entry], block.place[entry], block.seed[entry]
    diagonal = at[which] - place
    order = np.lexsort((diagonal, item))
    item, place, seed, diagonal = item[order], place[order], seed[order], diagonal[order]
    size = np.array([len(a) for a in block.items])
    slack = size[item] - block.needed[item]
    new = np.ones(len(item), bool)
    new[1:] = (item[1:] != item[:-1]) | (diagonal[1:] - diagonal[:-1] > slack[1:])
    starts = np.flatnonzero(new)
    ends = np.concatenate([starts[1:], [len(item)]])
    best: dict[int, tuple[float, int, int]] = {}
    for s, e in zip(starts, ends, strict=True):
        k = int(item[s])
        if best.get(k, (0.0,))[0] >= 1.0:
            continue  # found whole already; the first such passage counts
        if e - s < block.needed[k] or not seed[s:e].any() or len(np.unique(place[s:e])) < block.needed[k]:
            continue
        a = block.items[k]
        edge = len(a) - int(block.needed[k])
        # Passages of a long run of hits are aligned one item length at a time.
        low, stop = max(0, int(diagonal[s]) - edge), min(len(numbers), int(diagonal[e - 1]) + len(a) + edge)
        while low < stop:
            high = min(stop, low + 4 * len(a) + 2 * edge)
            matched, end = align(a, numbers[low:high])
            share = matched / len(a)
            if share >= least - 1e-9 and share > best.get(k, (0.0,))[0]:
                length = align(a[::-1], numbers[low : low + end][::-1])[1]
                best[k] = (share, low + end - length, length)
            if high == stop:
                break
            low = high - 2 * len(a) - edge
    return [(block.ids[k], *found) for k, found in sorted(best.items())]


def _count_batches(block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = block.value
        counts = np.zeros(len(table.codes), np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts[np.unique(table.grams(table.numbers(text))[1])] += 1
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(counts[met])], ["gram", "n"])

    return run


def _match_batches(block, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = block.value
        for batch in batches:
            out = []
            for i, text in enumerate(batch.column(2).to_pylist()):
                out += [(i, *m) for m in matches(table, table.numbers(text), least)]
            if out:
                row, item, share, start, n = zip(*out, strict=True)
                row = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(row),
                        batch.column(1).take(row),
                        pa.array(item, pa.int64()),
                        pa.array(share, pa.float64()),
                        pa.array(start, pa.int32()),
                        pa.array(n, pa.int32()),
                    ],
                    ["doc_id", "text_hash", "item", "similarity", "start_word", "n_words"],
                )

    return run


def _keyed_items(benchmark: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    items = benchmark.select(F.col("item_id").cast("long"), text.alias("text")).where("text is not null")
    return items.withColumn("item", F.xxhash64("text"))


def _matches(docs: DataFrame, items: DataFrame, least: float, block_words: int) -> DataFrame:
    """``MATCH_COLUMNS`` of every document and distinct item text found in it."""
    spark = docs.sparkSession
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        F.col("text").cast("string").alias("text"),
    ).where(F.col("text").isNotNull())
    distinct = materialize(items.select("item", "text").distinct(), "benchmark_texts")
    letters = distinct.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-int(letters) // (2 * block_words)))  # a word and its end are two letters at least
    parts = []
    for k in range(blocks):
        block = make_block(sorted(map(tuple, distinct.where(F.pmod("item", F.lit(blocks)) == k).collect())), least)
        sent = spark.sparkContext.broadcast(block)
        counted = texts.select("text").mapInArrow(_count_batches(sent), "gram long, n long")
        counts = np.zeros(len(block.codes), np.int64)
        for r in counted.groupBy("gram").agg(F.sum("n").alias("n")).collect():  # the block's n-grams at most
            counts[r["gram"]] = r["n"]
        sent.destroy()
        choose_seeds(block, counts)
        sent = spark.sparkContext.broadcast(block)
        parts.append(materialize(texts.mapInArrow(_match_batches(sent, least), MATCH_COLUMNS), "benchmark_matches"))
        sent.destroy()
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def contaminated(
    docs: DataFrame, benchmark: DataFrame, least: float = LEAST, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """Matches of ``benchmark (item_id, text)`` in ``docs (doc_id, text)``.

    One row per input row and item found in it: ``doc_id``, ``text_hash``
    (xxhash64 of the text), ``item_id``, ``similarity`` (at least ``least``) and
    the words that the best match lies in (``start_word``, ``n_words``).

    Every copy with at most ``(1 - least)`` of the item's words edited is
    aligned, however short the item; an edit beside its first or last word may
    cost the local alignment that word too, and so the match. An item of one or
    two words is its own seed and found where it stands whole; items without a
    word, null and empty texts match nothing. A text is read whole, whatever its length; an item of
    2^20 words or more, or that many different words in a block, is an error. Repeated items, rows and ids are taken
    as they come, null ids stay null, other columns are ignored, empty tables
    give an empty result.
    """
    items = materialize(_keyed_items(benchmark), "benchmark_items")
    found = _matches(docs, items, least, block_words)
    return found.join(items.select("item", "item_id"), "item").select(
        "doc_id", "text_hash", "item_id", "similarity", "start_word", "n_words"
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, least: float = LEAST) -> DataFrame:
    """``docs`` without the rows in which an item was found."""
    found = _matches(docs, _keyed_items(benchmark), least, BLOCK_WORDS)
    hits = found.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    return docs.join(
        hits,
        F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__hash")),
        "left_anti",
    )
