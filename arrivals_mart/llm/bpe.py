r"""Byte-level BPE as a bounded-lookahead streaming transducer, and back.

**Sufficient lookahead.** BPE applies its merges in rank order. Run it on a
text and on a longer text with the same beginning: both runs hold the same
tokens up to a frontier, at first the end of the shorter text. A merge
``u v`` moves the frontier left, by the length of ``u``, only if ``u`` ends at
it and ``v`` begins at it, and then a later merge ``u' v'`` moves it on only if
``u`` starts ``v'``: ``u`` is ``v'``, or the left part of its left part, and so
on. The heaviest such chain of merges, by the lengths of their left parts, is
found in one pass over the merge list (:attr:`Merges.lookahead`; 320 bytes for
the public 50k vocabulary). Tokens that end this many bytes before the end of
what has been read are the same for every continuation, so they are emitted,
and the rest is encoded on its own: no merge crosses a token's end.

**Pre-tokens** are cut by the public pattern, streaming as well: a run of letters,
digits, other signs or white space is open until the character after it is
known (two more after an apostrophe). A run that grows past ``OPEN`` characters goes to
the transducer piece by piece. What an :class:`Encoder` holds is bounded by
``OPEN``, the lookahead and ``STEP``, however long a text or a word is.

**Decoding** goes from ids to bytes to text through an incremental state
machine (:class:`Decoder`), ``CHUNK`` ids at a time: a character whose bytes
are spread over tokens waits for its last byte; bytes that are no UTF-8
become U+FFFD, one for each longest valid beginning.
"""

from __future__ import annotations

import codecs
import heapq
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Folder of the public tokenizers; a parameter, never copied.
TOKENIZERS = "/opt/tokenizers"
MODEL = "byte_bpe_50k.json"
#: Characters that the ``regex`` module counts as letters or numbers
#: and the tokenizers library, by an older Unicode version, as other signs.
_SIGNS = (
    "\\u0558 \\u058b-\\u058c \\u088f \\u0c5c \\u0cdc \\u208f \\u209d-\\u209f \\ua7ce-\\ua7cf \\ua7d2 \\ua7d4 \\ua7dd "
    "\\ua7e2 \\ua7f1 \\uab6c-\\uab6d \\U000107bb-\\U000107bf \\U00010940-\\U00010959 \\U00010ec5-\\U00010ec7 "
    "\\U00010ed9-\\U00010eee \\U00011b0a \\U00011db0-\\U00011ddb \\U00011de0-\\U00011de9 \\U00011df1 \\U0001246f "
    "\\U00012475-\\U0001247f \\U00012550-\\U00012686 \\U00016ea0-\\U00016eb8 \\U00016ebb-\\U00016ed3 "
    "\\U00016ff2-\\U00016ff6 \\U000187f8-\\U000187ff \\U00018cd6-\\U00018cda \\U00018d09-\\U00018d20 "
    "\\U00018d80-\\U00018df2 \\U00018e00-\\U00019191 \\U000191a0-\\U000191d2 \\U0001b123-\\U0001b128 \\U0001b168 "
    "\\U0001d6a6 \\U0001df1f-\\U0001df24 \\U0001df2b-\\U0001df81 \\U0001df90-\\U0001df96 \\U0001dfcd-\\U0001dfff "
    "\\U0001e6c0-\\U0001e6de \\U0001e6e0-\\U0001e6e2 \\U0001e6e4-\\U0001e6e5 \\U0001e6e7-\\U0001e6ed "
    "\\U0001e6f0-\\U0001e6f4 \\U0001e6fe-\\U0001e6ff \\U0002b73a-\\U0002b73f \\U0002b81e \\U0002cea2-\\U0002cead "
    "\\U000323b0-\\U00033479 \\U0003d000-\\U0003fc3f"
).replace(" ", "")
_KNOWN_SIGN = r"[^\s\p{L}\p{N}]"
_LETTER, _NUMBER = rf"[\p{{L}}--[{_SIGNS}]]", rf"[\p{{N}}--[{_SIGNS}]]"
_SIGN = rf"[{_KNOWN_SIGN}||[{_SIGNS}]]"


def _pattern(letter: str, number: str, sign: str) -> str:
    # The pattern of pre-tokens of the public byte-level vocabularies.
    return rf"'s|'t|'re|'ve|'m|'ll|'d| ?{letter}+| ?{number}+| ?{sign}+|\s+(?!\S)|\s+"


#: Beginnings of the pattern's contractions that more text may complete.
_OPEN_SIGNS = ("'", "'r", "'v", "'l")
#: Characters of a run that is still open before it is encoded piece by piece.
OPEN = 4096
#: Bytes a transducer takes beyond its lookahead before it emits.
STEP = 1024
#: Ids decoded at once, characters fed at once.
CHUNK = 65_536
#: Pre-tokens whose ids a Python worker remembers, each of ``MEMO_CHARS`` characters at most;
#: beyond that many it forgets those not met lately.
MEMO = 300_000
MEMO_CHARS = 48
#: Ids in an Arrow batch that a task returns, about.
_BATCH_IDS = 500_000

#: The pattern, and a faster one that agrees with it on texts without ``_SIGNS``.
_WORDS = regex.compile(_pattern(_LETTER, _NUMBER, _SIGN), regex.V1)
PATTERN = _pattern(r"\p{L}", r"\p{N}", _KNOWN_SIGN)
_WORDS_WITHOUT = regex.compile(PATTERN)
_HAS_SIGNS = regex.compile(f"[{_SIGNS}]")


def _latin_pattern() -> re.Pattern:
    """The pattern with Latin-1 characters listed by kind, for the faster ``re`` module."""
    every = "".join(map(chr, range(256)))
    letter, number, space = (re.escape("".join(regex.findall(kind, every))) for kind in (r"\p{L}", r"\p{N}", r"\s"))
    return re.compile(
        _pattern(f"[{letter}]", f"[{number}]", f"[^{space}{letter}{number}]")
        .replace(r"\S", f"[^{space}]")
        .replace(r"\s", f"[{space}]")
    )


_WORDS_LATIN = _latin_pattern()
_RUNS = {
    "letter": regex.compile(f"{_LETTER}+", regex.V1),
    "number": regex.compile(f"{_NUMBER}+", regex.V1),
    "sign": regex.compile(f"{_SIGN}+", regex.V1),
    "space": regex.compile(r"\s+"),
}


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable
    Latin-1 characters stand for themselves, the others follow from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in own}
    others = (b for b in range(256) if b not in set(own))
    letters.update((chr(0x100 + i), b) for i, b in enumerate(others))
    return letters


def _words(text: str) -> regex.Pattern | re.Pattern:
    try:
        text.encode("latin-1")  # the quickest way to see that a text has no others
    except UnicodeEncodeError:
        return _WORDS if _HAS_SIGNS.search(text) else _WORDS_WITHOUT
    return _WORDS_LATIN


class _Memo(dict):
    """Ids of pre-tokens, encoded when first met. A store that is half of ``MEMO`` full
    becomes the older half, from which those met again are taken over."""

    def __init__(self, merges: Merges):
        self._merges = merges
        self._older: dict[str, tuple[int, ...]] = {}

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = self._older.get(word)
        if ids is None:
            if len(word) > MEMO_CHARS:
                stream = Transducer(self._merges)
                return (*stream.feed(word.encode()), *stream.finish())
            ids = tuple(self._merges.encode(word.encode()))
        if len(self) >= MEMO // 2:
            self._older = dict(self)
            self.clear()
        self[word] = ids
        return ids


class Merges:
    """A merge list over ids, with its sufficient lookahead.

    ``ranks`` maps ``left id * number of ids + right id`` to a rank, ``wholes`` a rank to the
    merged id; ``token_bytes`` holds the bytes of each id. ``memo`` are the ids of
    pre-tokens met before.
    """

    def __init__(self, vocabulary: dict[str, int], merges: Iterable[tuple[str, str]], added: dict[str, int]):
        letters = byte_letters()
        self.added = dict(added)
        self.token_bytes: list[bytes] = [b""] * (max([*vocabulary.values(), *added.values()]) + 1)
        for token, i in vocabulary.items():
            self.token_bytes[i] = bytes(letters[c] for c in token)
        for token, i in added.items():
            self.token_bytes[i] = token.encode()
        self.byte_ids = [0] * 256
        for letter, b in letters.items():
            self.byte_ids[b] = vocabulary[letter]
        self.ranks: dict[int, int] = {}  # integers are found faster than pairs
        self.wholes: list[int] = []
        self.memo = _Memo(self)
        made: dict[int, tuple[int, int]] = {}
        heaviest: dict[int, int] = {}  # by left part: its heaviest chain so far
        self.lookahead = 0
        for rank, (u, v) in enumerate(merges):
            left, right, whole = vocabulary[u], vocabulary[v], vocabulary[u + v]
            if whole in made or any(len(self.token_bytes[t]) > 1 and t not in made for t in (left, right)):
                raise ValueError(f"merge {rank}: its parts must be made before it, and each token once")
            before, start = 0, right
            while True:
                before = max(before, heaviest.get(start, 0))
                if start not in made:
                    break
                start = made[start][0]
            weight = len(self.token_bytes[left]) + before
            heaviest[left] = max(weight, heaviest.get(left, 0))
            self.lookahead = max(self.lookahead, weight)
            made[whole] = (left, right)
            self.ranks[left * len(self.token_bytes) + right] = rank
            self.wholes.append(whole)

        # Ranks of the pairs of bytes.
        n, none = len(self.token_bytes), len(self.wholes)
        self._first = [self.ranks.get(u * n + v, none) for u in self.byte_ids for v in self.byte_ids]

    def encode(self, data: bytes) -> list[int]:
        """Ids of ``data`` as one pre-token."""
        ids = list(map(self.byte_ids.__getitem__, data))
        if len(ids) > 64:
            return self._merge_long(ids)
        first = self._first
        return self._merge_short(ids, [first[u << 8 | v] for u, v in zip(data, data[1:], strict=False)])

    def _merge_short(self, ids: list[int], found: list[int]) -> list[int]:
        """``found``: the rank of each two neighbours."""
        get, none, n = self.ranks.get, len(self.wholes), len(self.token_bytes)
        while found:
            rank = min(found)
            if rank == none:
                break
            at = found.index(rank)
            whole = ids[at] = self.wholes[rank]
            del ids[at + 1], found[at]
            if at:
                found[at - 1] = get(ids[at - 1] * n + whole, none)
            if at < len(found):
                found[at] = get(whole * n + ids[at + 1], none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same in n log n: a heap of ranks over a linked list."""
        get, many, n = self.ranks.get, len(self.token_bytes), len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs = enumerate(zip(ids, ids[1:], strict=False))
        heap = [(rank, i, u, v) for i, (u, v) in pairs if (rank := get(u * many + v)) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue
            ids[i], ids[j] = self.wholes[rank], -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (new := get(ids[i] * many + ids[k])) is not None:
                    heapq.heappush(heap, (new, i, ids[i], ids[k]))
            h = before[i]
            if h >= 0 and (new := get(ids[h] * many + ids[i])) is not None:
                heapq.heappush(heap, (new, h, ids[h], ids[i]))
        return [t for t in ids if t >= 0]


class Transducer:
    """BPE of one pre-token that arrives in pieces; see the module's text."""

    def __init__(self, merges: Merges, step: int = STEP):
        self.merges = merges
        self.width = merges.lookahead + max(step, max(map(len, merges.token_bytes)))
        self.held = bytearray()

    def feed(self, data: bytes) -> list[int]:
        """The ids that have become stable."""
        out: list[int] = []
        lengths = self.merges.token_bytes
        for i in range(0, len(data), STEP):
            self.held += data[i : i + STEP]
            while len(self.held) >= self.width:
                end, stable = 0, self.width - self.merges.lookahead
                for t in self.merges.encode(bytes(self.held[: self.width])):
                    if end + len(lengths[t]) > stable:
                        break
                    end += len(lengths[t])
                    out.append(t)
                del self.held[:end]
        return out

    def finish(self) -> list[int]:
        out = self.merges.encode(bytes(self.held))
        self.held.clear()
        return out


class Encoder:
    """Ids of a text that arrives in pieces; ``finish`` ends the text and makes
    the encoder ready for the next one.

    ``specials``: the strings of added tokens become their ids; else they are
    ordinary text.
    """

    def __init__(self, merges: Merges, specials: bool = True, open_chars: int = OPEN, step: int = STEP):
        self.merges = merges
        self._open_chars = open_chars
        self._step = step
        self._added = merges.added if specials else {}
        self._split = regex.compile("|".join(map(regex.escape, sorted(self._added, key=len, reverse=True)))) if self._added else None
        self._starts = {t[:i] for t in self._added for i in range(1, len(t))}
        self._longest = max(map(len, self._starts), default=0)
        self._edge = ""  # may be the beginning of an added token
        self._tail = ""  # its pre-tokens are not known yet
        self._run: str | None = None  # kind of the run that the transducer is in
        self._stream: Transducer | None = None

    def feed(self, text: str) -> list[int]:
        out: list[int] = []
        if self._split is None:
            self._take(text, out)
            return out
        text = self._edge + text
        at = 0
        for found in self._split.finditer(text):
            self._take(text[at : found.start()], out)
            self._end(out)
            out.append(self._added[found.group()])
            at = found.end()
        keep = next(
            (n for n in range(min(self._longest, len(text) - at), 0, -1) if text[-n:] in self._starts), 0
        )
        self._take(text[at : len(text) - keep], out)
        self._edge = text[len(text) - keep :]
        return out

    def finish(self) -> list[int]:
        out: list[int] = []
        self._take(self._edge, out)
        self._edge = ""
        self._end(out)
        return out

    def _take(self, text: str, out: list[int]) -> None:
        text = self._tail + text
        if self._run is not None:
            text = self._go_on(text, out)
        # White space after another character always starts a pre-token.
        cut = text.rfind(" ")
        if cut > 0:
            cut = len(text[:cut].rstrip())
            if 0 < cut and text[cut] in " \n\t\r":
                self._encode(_words(text).findall(text, 0, cut), out)
                text = text[cut:]
        if len(text) > self._open_chars:
            text = self._open(text, out)
        self._tail = text

    def _open(self, text: str, out: list[int]) -> str:
        """Encode what is sure of a text without a safe cut; if its last run is
        long, send the run to a transducer."""
        at, last = 0, None
        for found in _words(text).finditer(text):
            if found.end() == len(text) or text[found.start() :] in _OPEN_SIGNS:
                last = found
                break
            self._encode([found.group()], out)
            at = found.end()
        if last is None or len(text) - at <= self._open_chars:
            return text[at:]
        for kind, run in _RUNS.items():
            if run.fullmatch(text, at + (text[at] == " " and kind != "space")):
                self._run, self._stream = kind, Transducer(self.merges, self._step)
                return self._go_on(text[at:], out, first=True)
        return text[at:]

    def _go_on(self, text: str, out: list[int], first: bool = False) -> str:
        """Feed the open run; returns what is behind it."""
        if not text:
            return text
        skip = int(first and text[0] == " " and self._run != "space")
        found = _RUNS[self._run].match(text, skip)
        end = found.end() if found else skip
        if self._run == "space":
            # Its last character may belong to the next pre-token.
            end = max(end - 1, 0)
            done = found is None or found.end() < len(text)
        else:
            done = end < len(text)
        out += self._stream.feed(text[:end].encode())
        if done:
            out += self._stream.finish()
            self._run = self._stream = None
        return text[end:]

    def _end(self, out: list[int]) -> None:
        text, self._tail = self._tail, ""
        if self._run is not None:
            # All that is left of a run of white space at the end is part of it.
            out += self._stream.feed(text.encode())
            out += self._stream.finish()
            self._run = self._stream = None
        else:
            self._encode(_words(text).findall(text), out)

    def _encode(self, words: list[str], out: list[int]) -> None:
        out += chain.from_iterable(map(self.merges.memo.__getitem__, words))

    def encode(self, text: str, chunk: int = CHUNK) -> Iterator[list[int]]:
        """Ids of a whole text, a piece at a time."""
        for i in range(0, len(text), chunk):
            yield self.feed(text[i : i + chunk])
        yield self.finish()


class Decoder:
    """Text of ids that arrive in pieces. The state between pieces is the
    beginning of a character whose other bytes are still to come."""

    def __init__(self, merges: Merges):
        self._bytes = merges.token_bytes
        self._state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self._state.decode(b"".join(map(self._bytes.__getitem__, ids)))

    def finish(self) -> str:
        out = self._state.decode(b"", True)
        self._state.reset()
        return out


@lru_cache(maxsize=2)
def load_merges(path: str) -> Merges:
    """The merge list of a byte-level BPE file of the tokenizers library.
    Settings under which this module would not agree with it are refused."""
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    model, cut = told["model"], told["pre_tokenizer"]
    plain = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    marked = any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in told["added_tokens"])
    if not plain or marked or told["normalizer"] or cut["type"] != "ByteLevel" or cut["add_prefix_space"] or not cut["use_regex"]:
        raise ValueError(f"{path}: not a plain byte-level BPE")
    merges = (tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"])
    return Merges(model["vocab"], merges, {t["content"]: t["id"] for t in told["added_tokens"]})


def _path(folder: str, model: str) -> str:
    return f"{folder.rstrip('/')}/{model}"


def encode_batches(path: str, specials: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(load_merges(path), specials)
        for batch in batches:
            done, found, size = 0, [], 0
            for i, text in enumerate(batch.column(0), 1):
                parts = [np.array(ids, np.int32) for ids in encoder.encode(text.as_py() or "")]
                found.append(np.concatenate(parts))
                size += len(found[-1])
                if size >= _BATCH_IDS or i == batch.num_rows:
                    ends = np.cumsum([0, *map(len, found)])
                    ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(found)))
                    rest = batch.slice(done, i - done).columns[1:]
                    yield pa.RecordBatch.from_arrays([*rest, ids], [*batch.schema.names[1:], "ids"])
                    done, found, size = i, [], 0

    return run


def _decode_batches(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(load_merges(path))
        at = None
        for batch in batches:
            at = batch.schema.get_field_index("ids") if at is None else at
            texts = []
            for row in batch.column(at):
                ids = row.values.to_numpy(zero_copy_only=False) if row.is_valid else ()
                parts = [decoder.feed(ids[i : i + CHUNK].tolist()) for i in range(0, len(ids), CHUNK)]
                texts.append("".join([*parts, decoder.finish()]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"]
            )

    return run


def encode(docs: DataFrame, folder: str = TOKENIZERS, model: str = MODEL, specials: bool = True) -> DataFrame:
    """``(doc_id, ids)`` of every row of ``docs (doc_id, text)``: the ids that
    the tokenizers library gives without added special tokens. With ``specials``
    the strings of special tokens inside a text become their ids.

    Null and empty texts have no ids (an empty array). Repeated rows keep a row
    each, null ids stay null, other columns are ignored, an empty table gives
    an empty result. A text is encoded piece by piece, whatever its length or
    that of its longest word; its ids alone are held whole. ``folder`` must
    hold the model on every executor.
    """
    return docs.select(F.col("text").cast("string"), F.col("doc_id").cast("long")).mapInArrow(
        encode_batches(_path(folder, model), specials), "doc_id long, ids array<int>"
    )


def decode(tokens: DataFrame, folder: str = TOKENIZERS, model: str = MODEL) -> DataFrame:
    """``tokens (doc_id, ids)`` with the text of the ids as ``decoded``.

    Special tokens keep their strings. Null and empty ids give an empty text; an
    id that the vocabulary lacks, or a null one inside ``ids``, is an error.
    Other columns are left out, repeated rows keep a row each.
    """
    return tokens.select("doc_id", "ids").mapInArrow(
        _decode_batches(_path(folder, model)), "doc_id long, ids array<int>, decoded string"
    )
