"""Alignment of two tokenizers over the same text.

Tokenizer A is the public byte-level BPE, run on a space and the text (its ids
always spell what they encode); B is the public piece BPE, which adds that space
itself. Both see strings of special tokens as ordinary text. A text takes part
if both token sequences spell the same bytes (:func:`align` says which do not).

**Groups.** The cumulative ends of A's tokens are the keys of a dictionary
from end to index, B's of another. Their hash-set intersection, taken in the order of
A's keys, holds the byte offsets where tokens of both end; neighbouring keys slice both
id lists into groups. **Links** are expanded slice by slice: within a group the tokens of
A and B overlap like the steps of a staircase, ``a + b - 1`` links.

**Words.** Tokens of both end wherever a space follows a character that is no white
space, so the groups and links of a text are those of its words, one after the other
(:data:`_WORD_END`). A worker remembers the words it met, and texts of one batch
give those it has not met, each once; joined, these are texts that are tokenized and aligned
as above.

**Counts.** A document carries its different id pairs with their multiplicities, so
that the corpus-wide counts of pairs are grouped sums with map-side combining.
To bring them back, the ``TOP`` most frequent pairs at most (a bound, found by a
histogram of counts) are broadcast, which settles nearly all links in the scan
tasks; links of all other, rare pairs are joined to the table of pairs, so
nothing is dropped and no frequent pair is ever shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivals_mart.llm import bpe
from arrivals_mart.llm.common import materialize

MODEL_B = "piece_bpe_32k.model"
#: Pairs broadcast at most: 17 bytes each.
TOP = 200_000
#: Texts of pairs that a task remembers; beyond that many the store starts anew.
PAIR_TEXTS = 200_000
#: Numbers of tokens, made once for all texts of up to that many.
_NUMBERS = list(range(1, 1 + (1 << 16)))
#: Characters of texts whose words are looked up at once, about; links in an Arrow batch returned.
_BATCH_BYTES, _BATCH_LINKS = 1 << 20, 1_000_000
#: Words that a Python worker remembers, each of ``WORD_CHARS`` characters and ``WORD_LINKS`` links
#: at most; beyond that many it goes on with those of the texts at hand.
WORDS, WORD_CHARS, WORD_LINKS = 200_000, 48, 24
#: New words tokenized and aligned as one text.
_RUN_WORDS = 1000
#: Where the words of a text end: at a space behind a character that is no white space,
#: unless only white space follows. With the space that stands before each of them (A's
#: texts get one, B adds it), words are tokenized alike in any text: A's pre-tokens
#: never go from such a character on to a space, nor do B's pieces (checked when they are
#: loaded), and nothing looks back or past the end of a word.
_WORD_END = re.compile(r"(?<=\S) (?!\s*\Z)")
#: Spaces that may not end a word; without them, every space does.
_ODD_SPACE = re.compile(r"\s(?: |\Z)")


class _Pieces:
    """Bytes of the ids of a sentencepiece model."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.token_bytes = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            byte = self.model.is_byte(i)
            self.token_bytes.append(bytes([int(piece[3:5], 16)]) if byte else piece.replace("▁", " ").encode())
        #: No piece goes from another character on to a space (rules of a normalizer that
        #: span a space are not foreseen; the public model has none at all).
        self.by_word = not any(b" " in t.lstrip(b" ") for t in self.token_bytes)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)

    def bytes_of(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids))


@lru_cache(maxsize=2)
def _load_pieces(path: str) -> _Pieces:
    return _Pieces(path)


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class _Letters:
    """Ids of the byte-level vocabulary, special strings as text.

    Texts of Latin-1 characters go through tiktoken, over the same vocabulary:
    it merges whatever makes the token of the lowest rank, which is the merge list's choice
    because every token's own bytes encode to it (tested). On other characters
    the two libraries follow different Unicode versions; such texts go
    through the streaming encoder."""

    def __init__(self, path: str):
        import tiktoken

        self.merges = bpe.load_merges(path)
        self.token_bytes = self.merges.token_bytes
        ranks = {t: i for i, t in enumerate(self.token_bytes) if i not in self.merges.added.values()}
        self.plain = tiktoken.Encoding(
            "byte_bpe", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.any = bpe.Encoder(self.merges, specials=False)

    def encode(self, text: str) -> list[int]:
        if _is_latin(text):
            return self.plain.encode_ordinary(text)
        return [t for part in self.any.encode(text) for t in part]


@lru_cache(maxsize=2)
def _load_letters(path: str) -> _Letters:
    return _Letters(path)


def _index(ends: list[int]) -> dict[int, int]:
    """Number of tokens up to each end."""
    return dict(zip(ends, _NUMBERS if len(ends) <= len(_NUMBERS) else range(1, len(ends) + 1)))


def cuts(a_ends: list[int], b_ends: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The end of each group, as counts of tokens of A and of B."""
    a_at, b_at = _index(a_ends), _index(b_ends)
    # The keys of A come in order, so those that B has too need no sort.
    common = list(filter(b_at.__contains__, a_at))
    return tuple(np.fromiter(map(at.__getitem__, common), np.int64, len(common)) for at in (a_at, b_at))


def links(a_ends: np.ndarray, b_ends: np.ndarray, groups: tuple[np.ndarray, np.ndarray]):
    """Index pairs ``(in A, in B)`` of all overlapping tokens, slice by slice.

    A slice of one token each is one link. Within another slice, the ends of
    both sides in order are the steps of the staircase: up to each of them,
    one token of A and one of B lie over each other."""
    i1, j1 = groups
    i0, j0 = (np.concatenate([[0], x[:-1]]) for x in groups)
    one = (i1 - i0 == 1) & (j1 - j0 == 1)
    more_i, more_j = np.ones(len(a_ends), bool), np.ones(len(b_ends), bool)
    more_i[i0[one]] = more_j[j0[one]] = False
    steps = np.union1d(a_ends[more_i], b_ends[more_j])
    at_a = np.concatenate([i0[one], np.searchsorted(a_ends, steps)])
    at_b = np.concatenate([j0[one], np.searchsorted(b_ends, steps)])
    return at_a, at_b


class _PairTexts(dict):
    """Texts of pairs by code, made when they are first asked for."""

    def __init__(self, a: list[str], b: list[str]):
        self.a, self.b = a, b

    def __missing__(self, code: int) -> str:
        x, y = divmod(code, len(self.b))
        text = self[code] = f"{self.a[x]}|{self.b[y]}"
        return text


class _Teller:
    """Groups as text, with a store of the texts of pairs."""

    def __init__(self, n_a: int, n_b: int):
        self.a, self.b = [str(i) for i in range(n_a)], [str(i) for i in range(n_b)]
        self.known = _PairTexts(self.a, self.b)

    def __call__(self, a: np.ndarray, b: np.ndarray, groups: tuple[np.ndarray, np.ndarray]) -> str:
        return ";".join(self.each(a, b, groups))

    def each(self, a: np.ndarray, b: np.ndarray, groups: tuple[np.ndarray, np.ndarray]) -> list[str]:
        i1, j1 = groups
        i0, j0 = (np.concatenate([[0], x[:-1]]) for x in groups)
        n_i, n_j = i1 - i0, j1 - j0
        more = (n_i > 1) | (n_j > 1)
        if len(self.known) > PAIR_TEXTS:
            self.known.clear()
        # Other groups take the place of the first pair until their text is put there.
        codes = np.where(more, 0, a[i0] * len(self.b) + b[j0])
        told = list(map(self.known.__getitem__, codes.tolist()))
        texts = zip(_joined(self.a, a, n_i, more), _joined(self.b, b, n_j, more), strict=True)
        for k, (x, y) in zip(np.flatnonzero(more).tolist(), texts, strict=True):
            told[k] = f"{x}|{y}"
        return told


def _joined(told: list[str], ids: np.ndarray, sizes: np.ndarray, wanted: np.ndarray) -> Iterator[str]:
    """Ids as text with commas, for each of the ``wanted`` groups."""
    inside = list(map(told.__getitem__, ids[: sizes.sum()][np.repeat(wanted, sizes)].tolist()))
    ends = sizes[wanted].cumsum()
    return (",".join(inside[p:q]) for p, q in zip((ends - sizes[wanted]).tolist(), ends.tolist(), strict=True))


def _pieces_of(texts: list[str | None], size: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``size`` characters of text."""
    start = chars = 0
    for i, text in enumerate(texts):
        chars += len(text or "")
        if chars >= size:
            yield start, i + 1
            start, chars = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


class _Aligner:
    """Groups and links of texts, by their words."""

    def __init__(self, path_a: str, path_b: str):
        self.letters, self.pieces = _load_letters(path_a), _load_pieces(path_b)
        tables = self.letters.token_bytes, self.pieces.token_bytes
        self.a_size, self.b_size = (np.array([len(t) for t in table]) for table in tables)
        self.tell = _Teller(*map(len, tables))
        self.known: dict[str, tuple] = {}

    def words(self, text: str) -> list[str]:
        return _WORD_END.split(text) if text[0] == " " or _ODD_SPACE.search(text) else text.split(" ")

    def parts(self, words: list[str], b: list[int]) -> list[tuple]:
        """For each of the ``words`` of a text, which ``b`` are B's ids of: its groups as text, its
        links as bytes and its number of A's tokens. Nothing if B's ids do not
        spell the text (A's spell whatever they encode)."""
        text = " " + " ".join(words)
        data = text.encode()
        if self.pieces.bytes_of(b) != data:
            return []
        a, b = (np.array(x, np.int64) for x in (self.letters.encode(text), b))
        a_ends, b_ends = self.a_size[a].cumsum(), self.b_size[b].cumsum()
        groups = cuts(a_ends.tolist(), b_ends.tolist())
        at_a, at_b = links(a_ends, b_ends, groups)
        codes = (a[at_a] * len(self.b_size) + b[at_b])[np.argsort(at_a, kind="stable")].tobytes()
        told = self.tell.each(a, b, groups)
        sizes = map(len, words) if len(data) == len(text) else (len(w.encode()) for w in words)
        # Groups, tokens and links up to the end of each word; x and y tokens of a group have x + y - 1 links.
        g = np.searchsorted(a_ends[groups[0] - 1], np.cumsum([n + 1 for n in sizes])) + 1
        i, j = (x[g - 1] for x in groups)
        out, g0, l0 = [], 0, 0
        for g1, l1, n_a in zip(g.tolist(), (8 * (i + j - g)).tolist(), np.diff(i, prepend=0).tolist(), strict=True):
            out.append((";".join(told[g0:g1]), codes[l0:l1], n_a))
            g0, l0 = g1, l1
        return out

    def learn(self, words: set[str], alone: set[str]) -> None:
        """:meth:`parts` of new words, empty if B does not spell one; many are a text, but those ``alone``."""
        runs = [[w] for w in words & alone]
        words = list(words - alone)
        for i in range(0, len(words), _RUN_WORDS):
            run = words[i : i + _RUN_WORDS]
            if _is_latin(" ".join(run)):
                runs.append(run)
            else:  # A has another way for these
                latin = set(filter(_is_latin, run))
                runs += filter(None, (list(latin), [w for w in run if w not in latin]))
        for run, b in zip(runs, self.pieces.encode([" ".join(r) for r in runs]), strict=True):
            found = self.parts(run, b)
            if not found:  # leave out what B does not spell
                self.known.update(dict.fromkeys(run, ()))
                run = [w for w, b in zip(run, self.pieces.encode(run), strict=True) if self.pieces.bytes_of(b) == f" {w}".encode()]
                found = run and self.parts(run, self.pieces.encode([" ".join(run)])[0])
            self.known.update(zip(run, found, strict=False))

    def __call__(self, texts: list[str | None]) -> Iterator[tuple]:
        """For each text: its groups as text, numbers of tokens of A and B and of groups,
        different linked pairs and how often each is linked."""
        words = [self.words(t) if t else [] for t in texts]
        new = set().union(*words).difference(self.known)
        # Behind white space at its end, a word would not end.
        alone = {own[-1] for own in words if own and own[-1][-1].isspace()}
        if not self.pieces.by_word or 3 * len(new) > 2 * sum(map(len, words)):
            # Words do not hold for themselves, or too few come again to be worth it: texts are taken as they are.
            words = [[t] if t else [] for t in texts]
            new = alone = set().union(*words).difference(self.known)
        self.learn(new, alone)
        none = np.zeros(0, np.int64)
        for text, own in zip(texts, words, strict=True):
            found = list(map(self.known.__getitem__, own))
            if len(own) > 1 and not all(found):  # the whole text decides whether it is spelled
                found = self.parts([text], self.pieces.encode([text])[0])
            if not any(found):
                yield ("", 0, 0, 0, none, none)
                continue
            told, codes, n_a = zip(*found, strict=True)
            told, codes, n_a = ";".join(told), np.frombuffer(b"".join(codes), np.int64), sum(n_a)
            n_groups = told.count("|")
            yield (told, n_a, len(codes) + n_groups - n_a, n_groups, *np.unique(codes, return_counts=True))
        for word in new:
            known = self.known[word]
            if len(word) > WORD_CHARS or known and len(known[1]) > 8 * WORD_LINKS:
                del self.known[word]
        if len(self.known) > WORDS:
            self.known = {w: self.known[w] for w in set().union(*words) if w in self.known}


@lru_cache(maxsize=2)
def _load_aligner(path_a: str, path_b: str) -> _Aligner:
    return _Aligner(path_a, path_b)


def _align_batches(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligned = _load_aligner(path_a, path_b)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            texts = batch.column(1).to_pylist()
            ids = batch.column(0)
            found: list[tuple] = []
            done, size = 0, 0
            for start, end in _pieces_of(texts, _BATCH_BYTES):
                for one in aligned(texts[start:end]):
                    found.append(one)
                    size += len(one[-1])
                texts[start:end] = [None] * (end - start)
                if size >= _BATCH_LINKS or end == len(texts):
                    told, *numbers, codes, times = zip(*found, strict=True)
                    ends = pa.array(np.cumsum([0, *map(len, codes)]), pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.arange(row, row + end - done)),
                            ids.slice(done, end - done),
                            *(pa.array(x, pa.int64()) for x in numbers),
                            pa.array(told, pa.string()),
                            pa.ListArray.from_arrays(ends, pa.array(np.concatenate(codes))),
                            pa.ListArray.from_arrays(ends, pa.array(np.concatenate(times))),
                        ],
                        ["row", "doc_id", "n_a", "n_b", "n_groups", "groups", "pairs", "times"],
                    )
                    row += end - done
                    done, found, size = end, [], 0

    return run


def align(
    docs: DataFrame, folder: str = bpe.TOKENIZERS, model_a: str = bpe.MODEL, model_b: str = MODEL_B
) -> DataFrame:
    """Alignment of every row of ``docs (doc_id, text)``.

    Returns ``row`` (a number of its own for each row of one run), ``doc_id``,
    ``n_a`` and ``n_b`` tokens, ``n_groups``, the groups as text
    (``a1,a2|b1;a3|b2,b3``: decimal ids in order), and the document's different
    linked id pairs (``A id * size of B + B id``) with the number of times each
    is linked.

    Texts that are null or empty, or whose tokens do not spell the text (a
    U+2581 inside it does not survive B, for example), have no tokens: zeros,
    empty text, no pairs. Repeated rows keep a row each, null ids stay null,
    other columns are ignored, an empty table gives an empty result. Both
    take new words, many at once; a text whose words B does not spell goes to B as a whole.
    """
    a, b = (f"{folder.rstrip('/')}/{model}" for model in (model_a, model_b))
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _align_batches(a, b),
        "row long, doc_id long, n_a long, n_b long, n_groups long, groups string, pairs array<long>, times array<long>",
    )


def pair_counts(aligned: DataFrame, n_b: int) -> DataFrame:
    """``(pair, count, best)`` over all rows of :func:`align`: links that hold
    the pair, and whether no other pair of its B id (``n_b`` ids in all) has more."""
    counts = materialize(
        aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("p"))
        .groupBy(F.col("p.pairs").alias("pair"))
        .agg(F.sum("p.times").alias("count")),
        "pair_counts",
    )
    # Pairs of one B id: as many as the ids of A at most.
    most = counts.groupBy((F.col("pair") % n_b).alias("b")).agg(F.max("count").alias("most"))
    return materialize(
        counts.withColumn("b", F.col("pair") % n_b).join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best")),
        "pair_best",
    )


def _frequent(counts: DataFrame, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs of the highest counts, as many as ``top`` allows, by pair."""
    steps = F.floor(F.log2(F.col("count").cast("double"))).cast("int").alias("step")
    sizes = sorted(((r["step"], r["count"]) for r in counts.groupBy(steps).count().collect()), reverse=True)
    least, total = None, 0
    for step, n in sizes:  # 63 at most
        total += n
        if total > top:
            break
        least = step
    rows = counts.where(F.lit(False) if least is None else F.col("count") >= 1 << least).toArrow()
    pair = rows.column("pair").to_numpy()
    order = np.argsort(pair)
    best = rows.column("best").to_numpy().astype(bool)
    return pair[order], rows.column("count").to_numpy()[order], best[order]


def _resolve_batches(known):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, count, best = known.value
        for batch in batches:
            lists, times = batch.columns[-2:]
            lengths = np.diff(lists.offsets.to_numpy())
            codes, n = lists.flatten().to_numpy(), times.flatten().to_numpy()
            at = np.searchsorted(pair, codes)
            hit = np.zeros(len(codes), bool)
            inside = at < len(pair)
            hit[inside] = pair[at[inside]] == codes[inside]
            of = np.repeat(np.arange(batch.num_rows), lengths)
            sums = []
            for value in (count, best.astype(np.int64), None):
                part = np.zeros(len(codes), np.int64)
                part[hit] = n[hit] if value is None else n[hit] * value[at[hit]]
                ends = np.concatenate([[0], np.cumsum(part)])
                stops = np.concatenate([[0], np.cumsum(lengths)])
                sums.append(pa.array(ends[stops[1:]] - ends[stops[:-1]]))
            ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(of[~hit], minlength=batch.num_rows))]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-2],
                    *sums,
                    pa.ListArray.from_arrays(ends, pa.array(codes[~hit])),
                    pa.ListArray.from_arrays(ends, pa.array(n[~hit])),
                ],
                [*batch.schema.names[:-2], "count_sum", "n_best", "n_links", "pairs", "times"],
            )

    return run


def with_counts(aligned: DataFrame, n_b: int, top: int = TOP) -> DataFrame:
    """The rows of ``aligned`` (as :func:`align` makes them; written here, so
    leave out what is not needed) with ``n_links``, ``n_best`` (links whose pair
    has the highest corpus-wide count of its B id, ties included) and
    ``count_sum`` (those counts, over the links) in place of ``row``, ``pairs`` and
    ``times``. ``top`` bounds what is broadcast."""
    spark = aligned.sparkSession
    others = [c for c in aligned.columns if c not in ("row", "pairs", "times")]
    aligned = materialize(aligned.select("row", *others, "pairs", "times"), "aligned")
    counts = pair_counts(aligned, n_b)
    known = spark.sparkContext.broadcast(_frequent(counts, top))
    head = [f"{f.name} {f.dataType.simpleString()}" for f in aligned.schema.fields[:-2]]
    schema = ", ".join([*head, "count_sum long, n_best long, n_links long, pairs array<long>, times array<long>"])
    settled = materialize(aligned.mapInArrow(_resolve_batches(known), schema), "aligned_settled")
    known.destroy()
    n = F.col("times")
    rest = (
        settled.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p"))
        .select("row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
        .join(counts, "pair")
        .groupBy("row")
        .agg(
            F.sum(n * F.col("count")).alias("rare_sum"),
            F.sum(F.when(F.col("best"), n).otherwise(0)).alias("rare_best"),
            F.sum(n).alias("rare_links"),
        )
    )
    added = {"count_sum": "rare_sum", "n_best": "rare_best", "n_links": "rare_links"}
    return settled.join(rest, "row", "left").select(
        *others, *[(F.col(c) + F.coalesce(F.col(r), F.lit(0))).alias(c) for c, r in added.items()]
    )


def vocabulary_size(folder: str = bpe.TOKENIZERS, model_b: str = MODEL_B) -> int:
    """Number of ids of B."""
    return len(_load_pieces(f"{folder.rstrip('/')}/{model_b}").token_bytes)
