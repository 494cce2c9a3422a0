import hashlib
import random
from collections import Counter

import pytest
import sentencepiece
from corpus import no_docs, odd_docs
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from arrivals_mart.llm import bpe, queries
from arrivals_mart.llm import token_alignment as A
from arrivals_mart.llm.common import table

SF001 = "/root/testdata/sf0.001"
LIBRARY = Tokenizer.from_file(f"{bpe.TOKENIZERS}/{bpe.MODEL}")
LIBRARY.encode_special_tokens = True
PIECES = sentencepiece.SentencePieceProcessor(model_file=f"{bpe.TOKENIZERS}/{A.MODEL_B}")


def brute(rows):
    """Every token as a byte range; links and groups by comparing ranges."""
    letters = bpe.byte_letters()
    docs = []
    for doc_id, text in rows:
        spans, groups = [[], []], []
        if text:
            a = LIBRARY.encode(" " + text, add_special_tokens=False).ids
            b = PIECES.encode(text)
            told = [
                [bytes(letters[c] for c in LIBRARY.id_to_token(t)) for t in a],
                [
                    bytes([int(p[3:5], 16)]) if PIECES.is_byte(t) else p.replace("▁", " ").encode()
                    for t, p in zip(b, map(PIECES.id_to_piece, b), strict=True)
                ],
            ]
            if b"".join(told[0]) == b"".join(told[1]) == (" " + text).encode():
                for ids, parts, out in zip((a, b), told, spans, strict=True):
                    at = 0
                    for t, part in zip(ids, parts, strict=True):
                        out.append((at, at + len(part), t))
                        at += len(part)
        both = {e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]}
        told = []
        for side in spans:
            part, out = [], []
            for _, e, t in side:
                part.append(str(t))
                if e in both:
                    out.append(",".join(part))
                    part = []
            told.append(out)
        groups = [f"{x}|{y}" for x, y in zip(*told, strict=True)]
        links, j0 = [], 0
        for s, e, t in spans[0]:
            while j0 < len(spans[1]) and spans[1][j0][1] <= s:
                j0 += 1
            for s2, e2, t2 in spans[1][j0:]:
                if s2 >= e:
                    break
                links.append((t, t2))
        docs.append((doc_id, len(spans[0]), len(spans[1]), groups, links))
    count = Counter(p for d in docs for p in d[4])
    most = {}
    for (_, b), n in count.items():
        most[b] = max(n, most.get(b, 0))
    return sorted(
        (
            (i, a, b, len(g), len(links), sum(count[p] == most[p[1]] for p in links), sum(count[p] for p in links), ";".join(g))
            for i, a, b, g, links in docs
        ),
        key=str,
    )


def got(docs, top=A.TOP):
    found = A.with_counts(A.align(docs), A.vocabulary_size(), top)
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    return sorted((tuple(r) for r in found.select(*columns).collect()), key=str)


def test_both_ways_of_a_agree_with_the_library():
    letters = A._load_letters(f"{bpe.TOKENIZERS}/{bpe.MODEL}")
    for i, own in enumerate(letters.token_bytes[:-1]):
        assert letters.merges.encode(own) == [i]
    latin = [chr(c) for c in range(256)]
    rng = random.Random(4)
    texts = [f"a{c}b 1{c}2 !{c}? x {c}{c} z" for c in latin] + ["".join(rng.choices(latin, k=60)) for _ in range(2000)]
    texts += ["a" * 5000, " " * 3000 + "x", "'" * 900, "<|endoftext|>", "\u0558a \U000323b0", "日本 ½"]
    for text in texts:
        assert letters.encode(" " + text) == LIBRARY.encode(" " + text, add_special_tokens=False).ids


def test_query_against_byte_ranges(spark):
    rows = [tuple(r) for r in table(spark, SF001, "documents").select("doc_id", "text").collect()]
    want = [(*d[:-1], d[-1] and hashlib.sha256(d[-1].encode()).hexdigest()) for d in brute(rows)]
    assert sorted((tuple(r) for r in queries.op13_token_alignment(spark, SF001).collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("top", [A.TOP, 40, 0])
def test_rare_pairs_are_joined(spark, top):
    """Whatever share of the pairs is broadcast, the counts are those of all."""
    rng = random.Random(top)
    parts = ["the", " ", "  ", "ing", "日本", "é", "\U0001f600", "==", "\n", "<s>", "<|endoftext|>", "x", "12", "qzx"]
    rows = [(i % 50, "".join(rng.choices(parts, k=rng.randrange(30)))) for i in range(120)]
    rows += [(1, "a hot text " * 9)] * 60 + [(None, "▁ does not survive"), (7, None), (8, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(docs, top) == brute(rows)


def test_odd_rows(spark):
    docs = odd_docs(spark).withColumns({c: F.lit(0) for c in ("row", "pairs", "groups")})
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(docs) == brute(rows)
    assert got(no_docs(spark)) == []


def test_only_pairs_of_single_tokens_are_stored_and_long_texts_are_numbered(monkeypatch):
    import numpy as np

    tell = A._Teller(10, 10)
    groups = A.cuts([1, 3, 4], [1, 2, 3, 4])
    assert [g.tolist() for g in groups] == [[1, 2, 3], [1, 3, 4]]
    ids = np.array([5, 6, 7]), np.array([1, 2, 3, 4])
    assert tell(*ids, groups) == "5|1;6|2,3;7|4"
    assert tell.known.get(5 * 10 + 1) == "5|1" and tell.known.get(6 * 10 + 2) is None
    monkeypatch.setattr(A, "_NUMBERS", [1])  # texts of more tokens than there are numbers kept
    assert [g.tolist() for g in A.cuts([1, 3, 4], [1, 2, 3, 4])] == [[1, 2, 3], [1, 3, 4]]
    monkeypatch.setattr(A, "PAIR_TEXTS", 1)  # the store starts anew
    assert tell(*ids, groups) == "5|1;6|2,3;7|4" and 6 * 10 + 2 not in tell.known


def one_by_one(aligner, texts):
    return [(told, *numbers, codes.tolist(), times.tolist()) for told, *numbers, codes, times in aligner(texts)]


def new_aligner():
    return A._Aligner(f"{bpe.TOKENIZERS}/{bpe.MODEL}", f"{bpe.TOKENIZERS}/{A.MODEL_B}")


def test_words_met_before_are_not_tokenized_again(monkeypatch):
    aligner, taken = new_aligner(), []
    for side in (aligner.letters, aligner.pieces):
        # Both sides are shared by all aligners of this process: the patch is undone.
        monkeypatch.setattr(side, "encode", lambda x, encode=side.encode: taken.append(x) or encode(x))
    first = one_by_one(aligner, ["one text of some words\nand lines, " * 9 + "end"])
    assert "".join(taken[0]).count("some") == 1
    taken.clear()
    assert one_by_one(aligner, ["one text of some words\nand lines, " * 9 + "end", None, ""])[0] == first[0]
    assert not any(taken)


@pytest.mark.parametrize("store", [A.WORDS, 3])
def test_texts_are_aligned_alike_by_words_and_as_they_are(monkeypatch, store):
    monkeypatch.setattr(A, "WORDS", store)
    rng = random.Random(store)
    spaces = [" "] * 9 + ["  ", "\n", " \n", "\n ", "\n\n  ", "\t", "　 ", " \xa0 ", "\x1c", "\x85 ", "​ ", "᠎ ", "\x00 "]
    parts = ["the", "ing", "don't", "日本語", "é", "é", "\U0001f600", "==", "<s>", "x", "12.", "'s", "՘", "w" * 60, "\U0001f600" * 12]
    texts = ["".join(rng.choice(parts) + rng.choice(spaces) for _ in range(rng.randrange(60))) for _ in range(300)]
    texts = [t.rstrip() if rng.random() < 0.5 else rng.choice(spaces) + t for t in texts]
    texts += ["a ▁ b the the", "▁", " ", "  ", "\n", "x ", *(" " * n + "x  the" for n in range(20))]
    words, whole = new_aligner(), new_aligner()
    whole.words = lambda text: [text]
    want = one_by_one(whole, texts)
    assert want[texts.index("▁")] == want[texts.index("a ▁ b the the")] == ("", 0, 0, 0, [], [])
    for _ in range(2):
        for i in range(0, len(texts), 80):
            assert one_by_one(words, texts[i : i + 80]) == want[i : i + 80]
        assert words.known and all(len(w) <= A.WORD_CHARS and len(k[1]) <= 8 * A.WORD_LINKS for w, k in words.known.items() if k)
        if store == 3:
            assert len(words.known) < len({w for t in filter(None, texts) for w in words.words(t)})


def test_white_space_of_a_is_white_space_between_words():
    import re

    import regex

    signs = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    assert set(regex.findall(r"\s", signs)) <= set(re.findall(r"\s", signs))
    assert A._load_pieces(f"{bpe.TOKENIZERS}/{A.MODEL_B}").by_word
