import random

import pytest
from corpus import LONG, no_docs, odd_docs

from arrivals_mart.llm import suffix_dedup as X
from arrivals_mart.llm.common import table

SF001 = "/root/testdata/sf0.001"


def brute(rows, n=50):
    """Spans of words in runs of n words that another document holds."""
    docs = {(d, t): (t or "").encode().split() for d, t in rows}
    where = {}
    for key, words in docs.items():
        for i in range(len(words) - n + 1):
            where.setdefault(tuple(words[i : i + n]), set()).add(key)
    out = []
    for key, words in docs.items():
        start = end = -1
        for i in range(len(words) - n + 1):
            if len(where[tuple(words[i : i + n])]) > 1:
                if start >= 0 and i > end:
                    out.append((key[0], start, end - start))
                    start = -1
                start, end = (i if start < 0 else start), i + n
        if start >= 0:
            out.append((key[0], start, end - start))
    return sorted(out, key=str)


def got(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_documents(spark):
    docs = table(spark, SF001, "documents").select("doc_id", "text")
    want = brute([tuple(r) for r in docs.collect()])
    assert got(X.repeated_passages(docs)) == want and len(want) > 20


@pytest.mark.parametrize("words", [12, 2000])
def test_planted_passages(spark, words):
    """Few words make many equal runs of all lengths."""
    rng = random.Random(words)

    def text(n):
        return [f"w{rng.randrange(words)}" for _ in range(n)]

    passages = [text(n) for n in (19, 20, 21, 30, 49, 50, 51, 80, 200)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            a, b = sorted(rng.choices(range(len(p) + 1), k=2))
            parts += text(rng.randint(0, 40)) + (p if rng.random() < 0.6 else p[a:b])
        rows.append((i, " ".join(parts)))
    rows += [(100 + i, " ".join(passages[-1] + text(3))) for i in range(30)]  # one passage in a third
    rows += [(200, "a " * 300), (201, "a " * 120), (202, "b " * 120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(X.repeated_passages(docs)) == brute(rows)


@pytest.mark.parametrize("length", [60, 150])
def test_passage_twice_in_the_document_that_stands_for_it(spark, length):
    """'X P Y' and 'X P Y Z P W': the second P lies in a context of its own."""
    rows = []
    for k in range(12):
        x, y, z, w = ([f"{c}{k}n{i}" for i in range(110)] for c in "xyzw")
        p = [f"p{k}n{i}" for i in range(length)]
        rows += [(2 * k, " ".join(x + p + y)), (2 * k + 1, " ".join(x + p + y + z + p + w))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    rid = {r[0]: r[1] for r in docs.selectExpr("doc_id", "xxhash64(doc_id, text)").collect()}
    assert {rid[2 * k] < rid[2 * k + 1] for k in range(12)} == {True, False}
    want = brute(rows)
    assert len(want) == 36 and got(X.repeated_passages(docs)) == want


def test_neighbours_of_a_suffix_array_are_not_enough(spark):
    """``L X R``: two documents share ``L X`` and six words of ``R``; copies of ``X R``
    alone stand between them in any order of the suffixes that start at ``X``."""
    left, core, right = ([f"{c}{i}" for i in range(n)] for c, n in (("l", 24), ("x", 20), ("r", 40)))
    whole = left + core + right
    rows = [(0, [*whole, "z"]), (1, left + core + right[:6] + ["other"] * 60)]
    rows += [(10 + i, [f"p{i}n{k}" for k in range(60)] + core + right + [f"s{i}"]) for i in range(4)]

    def shared(a, b, at_a, at_b):
        back = next((k for k in range(min(at_a, at_b)) if a[at_a - 1 - k] != b[at_b - 1 - k]), min(at_a, at_b))
        ahead = next((k for k, (x, y) in enumerate(zip(a[at_a:], b[at_b:], strict=False)) if x != y), min(len(a) - at_a, len(b) - at_b))
        return back + ahead

    order = sorted((words[words.index("x0") :], i, words) for i, words in rows)
    by_neighbours = set()
    for (_, i, a), (_, j, b) in zip(order, order[1:], strict=False):
        if shared(a, b, a.index("x0"), b.index("x0")) >= 50:
            by_neighbours |= {i, j}
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    found = got(X.repeated_passages(docs))
    assert found == brute([(i, " ".join(w)) for i, w in rows])
    assert (1, 0, 50) in found and 1 not in by_neighbours


def test_repeated_rows_are_extended_once(spark):
    """Rows that repeat id and text count once, also where a context is extended."""
    passage = [f"p{i}" for i in range(60)]
    a, b = ([f"{c}{i}" for i in range(100)] for c in "ab")
    rows = [(1, " ".join(a + passage))] * 800 + [(2, " ".join(passage + b))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(X.repeated_passages(docs)) == brute(rows) == [(1, 100, 60), (2, 0, 60)]
    seen = []
    keep = X.materialize
    X.materialize = lambda df, name: seen.append((name, keep(df, name))) or seen[-1][1]
    try:
        X.repeated_passages(docs).collect()
    finally:
        X.materialize = keep
    windows = dict(seen)["suffix_windows"]
    assert windows.count() == windows.distinct().count() < 300


def test_odd_rows(spark):
    docs = odd_docs(spark)
    n = len(LONG.split())
    assert got(X.repeated_passages(docs)) == [(7, 0, n), (8, 0, n)]
    again = spark.createDataFrame([(1, LONG), (1, LONG), (None, LONG + " x")], "doc_id long, text string")
    assert got(X.repeated_passages(again)) == [(1, 0, n), (None, 0, n)]
    assert got(X.repeated_passages(again.where("doc_id = 1"))) == []


def test_empty_table(spark):
    assert X.repeated_passages(no_docs(spark)).count() == 0
