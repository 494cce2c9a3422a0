import re
from collections import defaultdict

import numpy as np
import pytest
from corpus import no_docs, odd_docs, odd_rows
from pyspark.sql import functions as F

from arrivals_mart.llm import mixing as M
from arrivals_mart.llm.common import table, word_count

SF001 = "/root/testdata/sf0.001"


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = float(sum(sizes.values())), set(order), {}
    while True:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total >= most * sizes[s]] if total else []
        if not over:
            break
        for s in over:
            out[s] = float(most * sizes[s])
            left -= out[s]
            open_.remove(s)
    out.update({s: left * weight[s] / total for s in open_})
    return out


def check(rows):
    """rows: (source, size, source_size, target, copies)."""
    sizes, taken, largest, target = defaultdict(int), defaultdict(int), defaultdict(int), {}
    for source, size, _, goal, copies in rows:
        assert 0 <= copies <= 3
        sizes[source] += size
        taken[source] += size * copies
        largest[source] = max(largest[source], size)
        target[source] = goal
    want = plain_targets(dict(sizes))
    for source, size in sizes.items():
        assert target[source] == pytest.approx(want[source], rel=1e-9)
        assert abs(taken[source] - target[source]) <= largest[source]
        assert target[source] <= 3 * size + 1e-6
    assert all(r[2] == sizes[r[0]] for r in rows)


@pytest.mark.parametrize("limits", [{"chunk": 5}, {"chunk": 2048}, {"chunk": 64}])
def test_documents(spark, limits):
    docs = table(spark, SF001, "documents")
    mixed = M.mix(docs, **limits)
    rows = mixed.select("source", "size", "source_size", "target", "copies").collect()
    assert len(rows) == docs.count()
    check([tuple(r) for r in rows])
    again = M.mix(docs.repartition(7), **limits)
    key = ["doc_id", "copies"]
    assert sorted(map(tuple, mixed.select(key).collect())) == sorted(map(tuple, again.select(key).collect()))


def test_sources_above_their_limit(spark):
    rows = [(i, "w " * 40, "big") for i in range(300)] + [(1000 + i, "w " * 5, s) for i, s in enumerate("bcdef" * 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = M.mix(docs).select("source", "size", "source_size", "target", "copies").collect()
    check([tuple(r) for r in mixed])
    assert any(r["target"] == 3 * r["source_size"] for r in mixed)


def test_rounding_keeps_mass_and_expectation():
    rng = np.random.default_rng(2)
    size = rng.integers(1, 200, 300).astype(float)
    p = rng.random(300)
    out = M.pivotal(p, size, rng.random(300))
    assert ((out > 0) & (out < 1)).sum() <= 1
    assert (out * size).sum() == pytest.approx((p * size).sum())
    few = np.array([0.3, 0.5, 0.9, 0.2])
    mean = np.mean([M.pivotal(few, np.array([4.0, 9.0, 2.0, 5.0]), rng.random(4)) for _ in range(20_000)], axis=0)
    assert np.abs(mean - few).max() < 0.02


def test_word_count(spark):
    texts = [None, "", " ", "a", " a\tb\x0bc\x0c\r\nd\x1ce é ", "x" * 10, "a b c"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(word_count(F.col("t"))).collect()
    assert [r[0] for r in got] == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]


def test_odd_rows(spark):
    docs = odd_docs(spark)
    mixed = M.mix(docs)
    rows = mixed.select("source", "size", "source_size", "target", "copies").collect()
    assert len(rows) == len(odd_rows())
    check([tuple(r) for r in rows])
    assert M.take_copies(mixed).count() == sum(r["copies"] for r in rows)


def test_empty_table_and_empty_texts(spark):
    assert M.mix(no_docs(spark)).count() == 0
    blank = M.mix(odd_docs(spark, [r for r in odd_rows() if not (r[1] or "").strip()]))
    assert {r["copies"] for r in blank.collect()} == {0}


def test_rows_that_repeat_are_one_class(spark):
    """A third of all rows agree in id, size and text: their copies are dealt
    by position through the partitions, and no group holds them all."""
    rows = [(None, "one two three", "a")] * 4000 + [(i, "w " * (1 + i % 50), "ab"[i % 2]) for i in range(8000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(13)
    mixed = M.mix(docs, chunk=16)
    got = mixed.select("source", "size", "source_size", "target", "copies", "doc_id").collect()
    assert len(got) == len(rows)
    check([tuple(r)[:5] for r in got])
    same = [r["copies"] for r in got if r["doc_id"] is None]
    assert max(same) - min(same) <= 1
    rate = next(r["target"] / r["source_size"] for r in got if r["source"] == "a")
    assert abs(sum(same) - 4000 * rate) < 1
    again = M.mix(docs.repartition(3), chunk=16).select("doc_id", "copies").collect()
    assert sorted(map(str, again)) == sorted(str(r) for r in mixed.select("doc_id", "copies").collect())
