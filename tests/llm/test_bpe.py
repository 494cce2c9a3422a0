import hashlib
import random

import pytest
from corpus import LONG, no_docs, odd_docs
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from arrivals_mart.llm import bpe, queries
from arrivals_mart.llm.common import table

PATH = f"{bpe.TOKENIZERS}/{bpe.MODEL}"
SF001 = "/root/testdata/sf0.001"
MERGES = bpe.load_merges(PATH)
LIBRARY = Tokenizer.from_file(PATH)
#: Characters and strings at which the rules of pre-tokens meet.
PARTS = [
    "a", "the", "ing", " ", "  ", "\n", "\t", "\xa0", "\x1c", "　", "'", "'s", "'r", "'re", "'ll", "1", "22", "½", "!", "===",
    "é", "日本", "\U0001f600", "\U000323b0", "՘", "<|endoftext|>", "<|end", "oftext|>", "|>",
]


def library(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def streamed(text, chunk, **how):
    encoder = bpe.Encoder(MERGES, **how)
    return [i for ids in encoder.encode(text, chunk) for i in ids]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=40).map("".join), st.sampled_from([1, 3, 1000]), st.sampled_from([2, 9, 4096]))
def test_any_pieces_give_the_ids_of_the_library(text, chunk, open_chars):
    want = library(text)
    assert streamed(text, chunk, open_chars=open_chars, step=1) == want
    decoder = bpe.Decoder(MERGES)
    assert "".join(decoder.feed([i]) for i in want) + decoder.finish() == LIBRARY.decode(want, skip_special_tokens=False)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=200))
def test_any_text(text):
    assert streamed(text, 7, open_chars=3) == library(text)


def test_every_character_is_of_the_kind_the_library_takes_it_for():
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    cut = LIBRARY.pre_tokenizer.pre_tokenize_str
    for i in range(0, len(every), 5000):
        text = "".join(f"a{c}b 1{c}2 !{c}? x {c}{c} z" for c in every[i : i + 5000])
        assert bpe._words(text).findall(text) == [text[a:b] for _, (a, b) in cut(text)]


def test_the_latin_pattern_cuts_as_the_general_one():
    latin = [chr(c) for c in range(256)]
    text = "".join(f"{a}{b}{a} {b}{b} 's{a}" for a in latin for b in latin)
    assert bpe._words(text) is bpe._WORDS_LATIN
    assert bpe._WORDS_LATIN.findall(text) == bpe._WORDS_WITHOUT.findall(text) == bpe._WORDS.findall(text)


def test_words_that_come_again_stay_known_when_the_store_is_full(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 40)
    merges, met = bpe.load_merges.__wrapped__(PATH), []
    encode = merges.encode
    monkeypatch.setattr(merges, "encode", lambda data: met.append(data) or encode(data))
    text = "".join(f" often x{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyz'[i // 100]}" for i in range(600))
    encoder = bpe.Encoder(merges)
    assert [i for ids in encoder.encode(text) for i in ids] == library(text)
    assert met.count(b" often") == 1 and len(met) == 601
    assert len(merges.memo) + len(merges.memo._older) <= 40


@pytest.mark.parametrize(
    "text",
    ["a" * 6000, "ab" * 4000, " " + "=" * 9000, " " * 7000 + "x", "\n" * 5000, " \n" * 4000 + "\nx", "'" * 6000,
     "abcdefghijklmnopqrstuvwxyz" * 400, "日" * 5000 + "s", "1" * 6000 + "'ll"],
    ids=range(10),
)
def test_runs_of_any_length_in_bounded_memory(text):
    want = library(text)
    for chunk in (100, bpe.CHUNK):
        assert streamed(text, chunk) == want
    rng = random.Random(len(text))
    text = "".join(rng.choice("etaoinshrd") for _ in range(30_000))
    encoder = bpe.Encoder(MERGES)
    out, held = [], 0
    for i in range(0, len(text), 500):
        out += encoder.feed(text[i : i + 500])
        held = max(held, len(encoder._tail) + (len(encoder._stream.held) if encoder._stream else 0))
    assert out + encoder.finish() == library(text) and len(out) > 100
    assert held < 2 * bpe.OPEN


def test_lookahead_holds_for_every_continuation():
    """Tokens that end ``lookahead`` bytes before the end of a beginning are
    those of the whole, whatever follows; a small merge list shows that the
    bound can be met and that less is not enough."""
    letters = {c: i for i, c in enumerate(bpe.byte_letters())}
    #  Each merge takes the left part away from the one before it.
    merges = [("c", "d"), ("b", "c"), ("a", "b")]
    vocabulary = letters | {u + v: 256 + i for i, (u, v) in enumerate(merges)}
    small = bpe.Merges(vocabulary, merges, {})
    assert small.lookahead == 3

    def ends(merges, data):
        out, end = [], 0
        for t in merges.encode(data):
            end += len(merges.token_bytes[t])
            out.append((end, t))
        return out

    assert ends(small, b"abc")[0] == (1, letters["a"]) and ends(small, b"abcd")[0] == (2, 258)
    rng = random.Random(3)
    for merges, alphabet, n in ((small, "abcd", 30), (MERGES, "aeinst h=", 700)):
        for _ in range(200):
            whole = "".join(rng.choices(alphabet, k=n)).encode()
            begun = whole[: rng.randrange(1, n)]
            stable = len(begun) - merges.lookahead
            assert [x for x in ends(merges, begun) if x[0] <= stable] == [x for x in ends(merges, whole) if x[0] <= stable]


def test_a_list_whose_parts_come_later_is_refused():
    letters = {c: i for i, c in enumerate(bpe.byte_letters())}
    with pytest.raises(ValueError):
        bpe.Merges(letters | {"ab": 256, "abc": 257}, [("ab", "c"), ("a", "b")], {})


def test_decoder_takes_ids_of_any_bytes():
    rng = random.Random(5)
    decoder = bpe.Decoder(MERGES)
    for _ in range(300):
        ids = [rng.randrange(50_257) for _ in range(rng.randrange(30))]
        assert "".join(decoder.feed([i]) for i in ids) + decoder.finish() == LIBRARY.decode(ids, skip_special_tokens=False)


def digests(text):
    ids = library(text)
    told = LIBRARY.decode(ids, skip_special_tokens=False)
    return len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), told))


def test_query_against_the_library(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF001, "documents").collect()}
    got = {r[0]: tuple(r)[1:] for r in queries.op11_bpe(spark, SF001).collect()}
    assert got == {i: digests(t or "") for i, t in texts.items()} and len(got) >= 200


def test_odd_rows(spark):
    docs = odd_docs(spark)
    want = sorted(((r.doc_id, library(r.text or "")) for r in docs.collect()), key=str)
    tokens = bpe.encode(docs)
    assert sorted(((r.doc_id, r.ids) for r in tokens.collect()), key=str) == want
    texts = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=str)
    assert sorted(((r.doc_id, r.decoded) for r in bpe.decode(tokens).collect()), key=str) == texts
    assert bpe.decode(bpe.encode(no_docs(spark))).count() == 0


def test_special_strings_as_text_and_very_long_texts(spark):
    text = "x<|endoftext|>y " + LONG * 20
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    assert bpe.encode(docs, specials=False).first().ids == plain.encode(text, add_special_tokens=False).ids
    assert bpe.encode(docs).first().ids == library(text)
