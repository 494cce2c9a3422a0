import random

import numpy as np
import pytest
from corpus import no_docs, odd_docs

from arrivals_mart.llm import decontaminate as D
from arrivals_mart.llm.common import table

SF001 = "/root/testdata/sf0.001"


def smith_waterman(a, b):
    """Matched words of the best local alignment, cell by cell."""
    best = (0, 0)
    row = [(0, 0)] * (len(b) + 1)
    for x in a:
        now = [(0, 0)]
        for j, y in enumerate(b, 1):
            s, m = row[j - 1]
            cell = max((s + 1, m + 1) if x == y else (s - 1, m), (row[j][0] - 1, row[j][1]), (now[j - 1][0] - 1, now[j - 1][1]))
            now.append(cell if cell[0] > 0 else (0, 0))
            best = max(best, now[-1])
        row = now
    return best[1]


def test_alignment():
    rng = random.Random(1)
    for _ in range(300):
        a = [rng.randint(1, 6) for _ in range(rng.randint(1, 14))]
        b = [rng.randint(0, 6) for _ in range(rng.randint(1, 20))]
        if rng.random() < 0.5:
            b[3:5] = a
        assert D.align(np.array(a), np.array(b))[0] == smith_waterman(a, b)


def edited(words, n, rng):
    words = list(words)
    for _ in range(n):
        i = rng.randrange(len(words))
        words[i : i + rng.choice([0, 1, 1])] = [f"new{rng.randrange(10**6)}"] * rng.choice([0, 1, 1])
    return words


def test_edited_copies_are_found_and_clean_documents_left(spark):
    rng = random.Random(8)
    vocabulary = [f"v{i}" for i in range(400)]
    items = [(i, [rng.choice(vocabulary) for _ in range(rng.randint(15, 60))]) for i in range(40)]
    rows, want = [], set()
    for d in range(300):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 300))]
        if d % 3 == 0:
            i, a = items[0] if d % 2 else rng.choice(items)  # one item in a sixth of all documents
            at = rng.randint(0, len(words))
            words[at:at] = edited(a, rng.randint(0, len(a) // 10), rng)
            want.add((d, i))
        text = " ".join(w.upper() + rng.choice(["", ",", "."]) if rng.random() < 0.2 else w for w in words)
        rows.append((d, text))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(a)) for i, a in items], "item_id long, text string")
    for block in (D.BLOCK_WORDS, 200):
        found = D.contaminated(docs, bench, block_words=block).collect()
        assert {(r["doc_id"], r["item_id"]) for r in found} == want
    texts = {d: D.words_of(t) for d, t in rows}
    item = dict(items)
    for r in found:
        passage = texts[r["doc_id"]][r["start_word"] : r["start_word"] + r["n_words"]]
        assert abs(smith_waterman(item[r["item_id"]], passage) / len(item[r["item_id"]]) - r["similarity"]) < 1e-9
    left = D.remove_contaminated(docs, bench)
    assert {r["doc_id"] for r in left.collect()} == {d for d, _ in rows} - {d for d, _ in want}


def test_documents_against_brute_force(spark):
    docs = table(spark, SF001, "documents").select("doc_id", "text")
    bench = table(spark, SF001, "benchmark")
    items = [(r["item_id"], D.words_of(r["text"])) for r in bench.collect()]
    want = set()
    for r in docs.collect():
        words = D.words_of(r["text"])
        known = set(words)
        for i, a in items:
            if sum(w in known for w in a) >= 0.8 * len(a):
                numbers = {w: k for k, w in enumerate(dict.fromkeys(a), 1)}
                x = np.array([numbers[w] for w in a])
                y = np.array([numbers.get(w, 0) for w in words])
                if D.align(x, y)[0] >= 0.8 * len(a):
                    want.add((r["doc_id"], i))
    got = D.contaminated(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want and want


def test_short_items_with_an_edit(spark):
    """No 3-gram of a five-word item survives an edit of its middle word."""
    bench = spark.createDataFrame(
        [(3, "a3 b3 c3"), (4, "a4 b4 c4 d4"), (5, "a5 b5 c5 d5 e5"), (6, "a6 b6 c6 d6 e6 f6")],
        "item_id long, text string",
    )
    hits = {
        "x a3 b3 c3 y": 3,
        "a4 b4 c4 d4": 4,
        "x a5 b5 NEW d5 e5 y": 5,
        "x a5 b5 c5 NEW e5 y": 5,
        "x NEW b5 c5 d5 e5": 5,
        "x a5 b5 d5 e5": 5,
        "x a5 b5 NEW c5 d5 e5": 5,
        "a6 b6 NEW d6 e6 f6": 6,
    }
    clean = ["a3 b3", "a3 NEW c3", "a4 b4 NEW d4", "a5 b5 NEW NEW e5", "a5 b5", "d5 e5 a5 b5", "a6 NEW c6 NEW e6 f6"]
    docs = spark.createDataFrame(list(enumerate([*hits, *clean])), "doc_id long, text string")
    for block in (D.BLOCK_WORDS, 8):
        got = {(r["doc_id"], r["item_id"]) for r in D.contaminated(docs, bench, block_words=block).collect()}
        assert got == set(enumerate(hits.values()))


def test_items_of_one_and_two_words(spark):
    bench = spark.createDataFrame(
        [(1, "forty two"), (2, "the answer is"), (3, "Zyzzyva!"), (4, "... ?"), (5, "hot")], "item_id long, text string"
    )
    texts = ["the answer is forty two indeed", "forty-two", "two forty", "a zyzzyva", "forty", "hot " * 5000 + "end"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for block in (D.BLOCK_WORDS, 2):
        found = [tuple(r) for r in D.contaminated(docs, bench, block_words=block).select("doc_id", "item_id", "start_word", "n_words").collect()]
        assert sorted(found) == [(0, 1, 3, 2), (0, 2, 0, 3), (1, 1, 0, 2), (3, 3, 1, 1), (5, 5, 0, 1)]


def test_blocks_that_do_not_fit_are_refused(monkeypatch):
    monkeypatch.setattr(D, "_K", 4)
    with pytest.raises(ValueError):
        D.make_block([(1, "a b c d")], 0.8)
    monkeypatch.setattr(D, "_MOST_WORDS", 3)
    with pytest.raises(ValueError):
        D.make_block([(1, "a b c")], 0.8)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    bench = spark.createDataFrame(
        [(1, "The cat sat on the mat and the dog ran."), (2, None), (3, ""), (4, "one"), (5, "dog ran"),
         (None, "der Hund und die Katze sind im Haus"), (1, "The cat sat on the mat and the dog ran.")],
        "item_id long, text string",
    )
    got = [(r["doc_id"], r["item_id"]) for r in D.contaminated(docs, bench).collect()]
    assert got.count((1, 1)) == 4 and got.count((2, 1)) == 2 and (None, None) in got
    # items of one and two words are found where they stand whole
    assert got.count((1, 5)) == 2 and (2, 5) in got and (9, 4) in got and len(got) == 11
    left = D.remove_contaminated(docs, bench)
    assert left.columns == docs.columns and left.count() == docs.count() - 5


def test_repeated_items_are_matched_once(spark):
    """A text that most items repeat stays one entry of its block."""
    text = "one two three four five six seven eight nine ten"
    rows = [(i, text) for i in range(300)] + [(1000 + i, f"a{i} b{i} c{i} d{i} e{i} f{i}") for i in range(50)]
    bench = spark.createDataFrame([*rows, (None, text)], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"so {text} end"), (2, "a7 b7 c7 d7 e7 f7"), (3, "no")], "doc_id long, text string")
    for block in (D.BLOCK_WORDS, 100):
        found = [(r["doc_id"], r["item_id"]) for r in D.contaminated(docs, bench, block_words=block).collect()]
        assert len(found) == 302
        assert set(found) == {(1, i) for i in range(300)} | {(1, None), (2, 1007)}
    sizes = []
    make = D.make_block
    D.make_block = lambda rows, least: sizes.append(len(rows)) or make(rows, least)
    try:
        D.contaminated(docs, bench)
    finally:
        D.make_block = make
    assert sizes == [51]


def test_empty_tables(spark):
    bench = table(spark, SF001, "benchmark")
    assert D.contaminated(no_docs(spark), bench).count() == 0
    assert D.contaminated(odd_docs(spark), bench.limit(0)).count() == 0
    assert D.remove_contaminated(odd_docs(spark), bench.limit(0)).count() == odd_docs(spark).count()
