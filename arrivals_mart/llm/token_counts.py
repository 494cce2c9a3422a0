"""Token counts under a unigram vocabulary by trie-shared dynamic programming.

A text is cut at ASCII white space into pre-tokens, each starting with the
word mark of the vocabulary. The tokens of a pre-token are those of the
segmentation with the highest sum of piece scores (of equal sums the one with
fewer tokens). Distinct pre-tokens are inserted in a trie; walking it in
order, the forward scores (best score and token count up to a position) of a
node are computed once from those of its ancestors and serve every pre-token
that shares the prefix. The count at a terminal node is stored, and a
document's count is the sum over its words.

All of this is local to a task: counts go from text to number without a
shuffle. A task's store of terminal counts is bounded by ``MEMO`` entries.

The scores are a Zipf law over the vocabulary's ranks: the public
vocabularies carry merge ranks, not probabilities, and tokenizers are not
trained here. A character that no piece covers costs as many tokens as
it has UTF-8 bytes.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

#: Folder of the public tokenizers; a parameter, never copied.
TOKENIZERS = "/opt/tokenizers"
MODEL = "piece_bpe_32k.model"
MARK = "▁"
#: Stored terminal counts per task at most; beyond it the store starts anew.
MEMO = 500_000
#: Score of a byte of an uncovered character, below any sum of pieces that covers it.
_UNKNOWN = -40.0


class Vocabulary:
    """Pieces with scores in one dictionary, and by last character the lengths
    of the pieces that end there."""

    def __init__(self, pieces: dict[str, float]):
        self.pieces = pieces
        self.longest = max(map(len, pieces), default=1)
        # By last character: which lengths end there at all.
        ends: dict[str, set[int]] = {}
        for piece in pieces:
            ends.setdefault(piece[-1], set()).add(len(piece))
        self.ends = {c: sorted(lengths) for c, lengths in ends.items()}

    @classmethod
    def from_ranks(cls, ranked: Iterable[str]) -> Vocabulary:
        return cls({p: -math.log(i + 2) for i, p in enumerate(ranked) if p})


@lru_cache(maxsize=2)
def load_vocabulary(path: str) -> Vocabulary:
    """Normal pieces of a sentencepiece model in rank order."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
    ids.sort(key=lambda i: (-sp.get_score(i), i))
    return Vocabulary.from_ranks(sp.id_to_piece(i) for i in ids)


def trie_counts(words: Iterable[str], vocabulary: Vocabulary) -> dict[str, int]:
    """Token count of each distinct word (given with its mark).

    The sorted words are the trie in depth-first order: the scores of the
    prefix shared with the word before stay on the stack, only the new suffix
    is computed.
    """
    pieces, ends = vocabulary.pieces, vocabulary.ends
    get = pieces.get
    score, count = [0.0], [0]
    before = ""
    out: dict[str, int] = {}
    for word in sorted(set(words)):
        shared = 0
        for a, b in zip(before, word, strict=False):
            if a != b:
                break
            shared += 1
        del score[shared + 1 :]
        del count[shared + 1 :]
        for at in range(shared, len(word)):
            end = at + 1
            c = word[at]
            n = len(c.encode("utf-8", "surrogatepass"))
            best, tokens = score[at] + _UNKNOWN * n, count[at] + n
            for length in ends.get(c, ()):
                if length > end:
                    break
                s = get(word[end - length : end])
                if s is not None:
                    s += score[end - length]
                    if s >= best:
                        k = count[end - length] + 1
                        if s > best or k < tokens:
                            best, tokens = s, k
            score.append(best)
            count.append(tokens)
        out[word] = count[len(word)]
        before = word
    return out


def _count_batches(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = load_vocabulary(path)
        memo: dict[bytes, int] = {}
        for batch in batches:
            words_of = [(t or b"").split() for t in batch.column(1).cast(pa.binary()).to_pylist()]
            new: set[bytes] = set()
            for words in words_of:
                new.update(words)
            new.difference_update(memo)
            if len(memo) + len(new) > MEMO:
                memo = {}
                new = set().union(*words_of)
            found = trie_counts((MARK + w.decode("utf-8", "replace") for w in new), vocabulary)
            memo.update((w, found[MARK + w.decode("utf-8", "replace")]) for w in new)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(words) for words in words_of], pa.int64()),
                    pa.array([sum(map(memo.__getitem__, words)) for words in words_of], pa.int64()),
                ],
                ["doc_id", "n_words", "n_tokens"],
            )

    return run


def token_counts(docs: DataFrame, folder: str = TOKENIZERS, model: str = MODEL) -> DataFrame:
    """``(doc_id, n_words, n_tokens)`` of every row of ``docs (doc_id, text)``.

    Null, empty and blank texts count 0. Repeated ids keep a row each, null
    ids stay null, other columns are ignored, an empty table gives an empty
    result. ``folder`` must hold the model on every executor.
    """
    from pyspark.sql import functions as F

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _count_batches(f"{folder.rstrip('/')}/{model}"), "doc_id long, n_words long, n_tokens long"
    )
