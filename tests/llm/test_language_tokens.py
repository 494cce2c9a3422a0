import random
import zlib

import pytest
from corpus import no_docs, odd_docs, odd_rows

from arrivals_mart.llm import language_id as L
from arrivals_mart.llm import token_counts as T
from arrivals_mart.llm.common import table

SF01 = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    from arrivals_mart.llm.queries import op2_language_id

    rows = op2_language_id(spark, SF01).collect()
    lang = {r["doc_id"]: r["lang"] for r in table(spark, SF01, "documents").collect()}
    assert len(rows) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    for part in (True, False):
        own = [r for r in rows if r["held_out"] == part and lang[r["doc_id"]] is not None]
        right = sum(r["lang_pred"] == lang[r["doc_id"]] for r in own)
        assert right / len(own) > 0.97, right / len(own)


def test_svm_separates():
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.standard_normal((200, 5))
    y = np.where(x @ [1, -2, 0.5, 0, 1] + 0.3 > 0, 1, -1)
    w, b = L.linear_svm(x, y)
    assert ((x @ w + b > 0) == (y > 0)).mean() > 0.97


def test_hierarchy_asks_only_inside_the_family(spark):
    docs = table(spark, SF01, "documents")
    model = L.train(docs, per_language=60)
    assert sorted(map(sorted, model.families)) == [["de", "en"], ["es", "fr"]]
    assert sorted(tuple(sorted(p[1:])) for p in model.pairs) == [("de", "en"), ("es", "fr")]


def test_odd_rows(spark):
    docs = odd_docs(spark)
    model = L.train(docs)
    got = L.identify(docs, model)
    assert got.columns == [c for c in docs.columns if c != "score"] + ["lang_pred", "score"]
    rows = got.collect()
    assert len(rows) == len(odd_rows())
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and (letters or r["score"] == 0)


@pytest.mark.parametrize("langs", [[], ["en"], ["xx", "yy"], ["en", "de", "nl"]])
def test_few_languages(spark, langs):
    words = {"en": "the of and", "de": "der und ist", "nl": "het een van", "xx": "qqq www", "yy": "zzz vvv"}
    rows = [(i, words[lang] + " " + words[lang], lang) for i, lang in enumerate(langs * 6)] + [(99, "the", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = L.identify(docs, L.train(docs)).collect()
    for r in got:
        if r["lang"] is not None:
            assert r["lang_pred"] == r["lang"]
        assert r["lang_pred"] in {*langs, "und"}


def test_repeated_text_is_learned_once(spark):
    docs = spark.range(900).selectExpr(
        "concat(if(id % 3 = 0, 'same words', concat('text ', hex(id), 'q')), if(id % 2 = 0, ' the', ' der')) AS text",
        "if(id % 2 = 0, 'en', 'de') AS lang",
    )
    assert L.training_sample(docs, per_language=500).count() == 602


def test_copies_do_not_thin_out_the_sample(spark):
    """Far more rows than ``per_language``, nearly all of them copies of one text."""
    few = spark.range(10030).selectExpr(
        "if(id < 10000, 'der und ist', concat('der und ist das ', hex(id), 'q')) AS text", "'de' AS lang"
    )
    many = spark.range(6000).selectExpr(
        "if(id % 2 = 0, 'the of and', concat('the of and ', hex(id), 'q')) AS text", "'en' AS lang"
    )
    docs = few.unionByName(many)

    def seen(n):
        return {r["lang"]: r["count"] for r in L.training_sample(docs, per_language=n).groupBy("lang").count().collect()}

    assert seen(400)["de"] == 31 and 320 < seen(400)["en"] < 480
    assert 10 < seen(20)["de"] < 31 and 8 < seen(20)["en"] < 36
    model = L.train(docs, per_language=400)
    got = L.identify(docs, model)
    assert got.where("lang_pred = lang").count() == docs.count()


def plain_prediction(model, text):
    """Language and score by dictionary counts of trigrams and plain voting."""
    import math
    from collections import Counter

    if text is None or not any(c.isalpha() for c in text):
        return "und", 0.0
    grams = Counter()
    for word, n in Counter(text.lower().encode("utf-8", "replace").split()).items():
        marks = [b if b >= 128 or chr(b).isalpha() else 32 for b in word]
        marks = [32, 32, *marks, 32, 32]
        for at in range(len(marks) - 2):
            if marks[at : at + 3] != [32, 32, 32]:
                grams[tuple(marks[at : at + 3])] += int(math.log2(n)) + 1
    total = sum(grams.values())
    bucket = {g: ((g[0] << 16 | g[1] << 8 | g[2]) * 2654435761 % 2**32) >> 19 for g in grams}
    weights = model.weights.astype(float)
    margin = [sum(n * w[bucket[g]] for g, n in grams.items()) / max(1, total) + b for w, b in zip(weights, model.bias)]

    def chance(m):
        return 1 / (1 + math.exp(-m))

    first = margin[: len(model.families)]
    family = first.index(max(first))
    sure = chance(max(first) - max(m for f, m in enumerate(first) if f != family))
    votes, belief = Counter(dict.fromkeys(model.families[family], 0)), dict.fromkeys(model.families[family], 1.0)
    for (f, a, b), m in zip(model.pairs, margin[len(model.families) :]):
        if f == family:
            votes[a if m >= 0 else b] += 1
            belief[a], belief[b] = min(belief[a], chance(2 * m)), min(belief[b], chance(-2 * m))
    best = max(model.families[family], key=lambda lang: (votes[lang], belief[lang]))
    return best, sure * belief[best]


def test_every_row_against_a_plain_prediction(spark):
    docs = table(spark, SF01, "documents")
    model = L.train(docs.where(~L.held_out()))
    rows = L.identify(docs.select("doc_id", "text"), model).collect()
    assert len(rows) == docs.count()
    for r in rows:
        lang, score = plain_prediction(model, r["text"])
        assert r["lang_pred"] == lang
        assert r["score"] == pytest.approx(score, abs=1e-5)


def test_many_languages(spark):
    """Every value of ``lang`` is a family of its own; machines are fitted in tasks."""
    docs = spark.range(120 * 6).selectExpr(
        "concat_ws(' ', transform(sequence(1, 9), i -> substr(sha1(concat(id % 120, '-', (i + id) % 12)), 1, 8))) AS text",
        "concat('q', id % 120) AS lang",
    ).where("text rlike '[a-f]'")
    model = L.train(docs, side=200)
    assert len(model.families) == 120 and not model.pairs
    got = L.identify(docs, model)
    assert got.where("lang_pred = lang").count() > 0.97 * docs.count()
    again = L.train(docs.repartition(5), side=200)
    assert (again.weights == model.weights).all() and (again.bias == model.bias).all()


def test_language_empty_table(spark):
    model = L.train(no_docs(spark))
    assert L.identify(no_docs(spark), model).count() == 0


def plain_count(word, pieces):
    """Best score and fewest tokens of every segmentation, by recursion."""
    from functools import cache

    @cache
    def best(at):
        if at == len(word):
            return (0.0, 0)
        s, k = best(at + 1)
        n = len(word[at].encode())
        options = [(s + T._UNKNOWN * n, k - n)]
        for end in range(at + 1, len(word) + 1):
            if word[at:end] in pieces:
                s, k = best(end)
                options.append((s + pieces[word[at:end]], k - 1))
        return max((round(a, 9), b) for a, b in options)

    return -best(0)[1]


def test_trie_matches_plain_segmentation():
    rng = random.Random(2)
    ranked = list(dict.fromkeys("".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(60)))
    vocabulary = T.Vocabulary.from_ranks(ranked)
    words = {"".join(rng.choice("abcdé") for _ in range(rng.randint(0, 9))) for _ in range(400)} | {"ab" * 400}
    got = T.trie_counts(words, vocabulary)
    assert got == {w: plain_count(w, vocabulary.pieces) for w in words if len(w) < 100} | {"ab" * 400: got["ab" * 400]}


def test_token_counts_of_documents(spark):
    vocabulary = T.load_vocabulary(f"{T.TOKENIZERS}/{T.MODEL}")
    docs = table(spark, "/root/testdata/sf0.001", "documents").limit(40)
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    store = {}
    for r in T.token_counts(docs).collect():
        words = text[r["doc_id"]].encode().split()
        for w in set(words) - set(store):
            store[w] = plain_count(T.MARK + w.decode(), vocabulary.pieces)
        assert (r["n_words"], r["n_tokens"]) == (len(words), sum(store[w] for w in words))


def test_token_store_is_bounded(spark, monkeypatch):
    docs = odd_docs(spark)
    whole = sorted((tuple(r) for r in T.token_counts(docs).collect()), key=str)
    assert len(whole) == len(odd_rows())
    assert {r[1:] for r in whole if r[0] in (3, 4, 5)} == {(0, 0)}
    import pyarrow as pa

    monkeypatch.setattr(T, "MEMO", 3)
    batches = [pa.RecordBatch.from_pydict({"doc_id": [r[0]], "text": [r[1]]}) for r in odd_rows()]
    out = [tuple(b.to_pylist()[0].values()) for b in T._count_batches(f"{T.TOKENIZERS}/{T.MODEL}")(iter(batches))]
    assert sorted(out, key=str) == whole


def test_tokens_empty_table(spark):
    assert T.token_counts(no_docs(spark)).count() == 0
