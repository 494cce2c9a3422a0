import bisect
import random
import zlib

import pytest
from corpus import no_docs, odd_docs, odd_rows

from arrivals_mart.llm import sharding as H
from arrivals_mart.llm.common import table

SF001 = "/root/testdata/sf0.001"


def law_holds(rows, n=8, tolerance=0.002):
    """rows: (text, shard, slot). Near-equal bytes, gapless slots."""
    size = [len((t or "").encode()) + 1 for t, _, _ in rows]
    share = sum(size) / n
    total = [0] * n
    slots = [[] for _ in range(n)]
    for s, (_, shard, slot) in zip(size, rows, strict=True):
        total[shard] += s
        slots[shard].append(slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots)
    assert max(abs(t - share) for t in total) <= max(size) + 2 * tolerance * share, total
    return total


@pytest.mark.parametrize("ranges", [1, 3])
def test_documents(spark, ranges):
    docs = table(spark, SF001, "documents")
    got = H.histogram_shards(docs, 8, ranges=ranges).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(r["doc_id"] for r in docs.collect())
    law_holds([(r["text"], r["shard"], r["slot"]) for r in got])
    shards = {}
    for r in got:
        shards.setdefault(r["text"], set()).add(r["shard"])
    assert sum(len(s) > 1 for s in shards.values()) <= 7


def test_ranges_follow_the_bytes(spark, monkeypatch):
    docs = table(spark, SF001, "documents")
    total = sum(len((r["text"] or "").encode()) + 1 for r in docs.collect())
    monkeypatch.setattr(H, "RANGE_BYTES", total // 200)
    got = H.histogram_shards(docs, 8)
    assert got.rdd.getNumPartitions() >= 200
    rows = got.selectExpr("text", "shard", "slot", "xxhash64(text) as h", "doc_id").collect()
    law_holds([(r["text"], r["shard"], r["slot"]) for r in rows])
    assert [(r["h"], r["doc_id"]) for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))] == sorted(
        (r["h"], r["doc_id"]) for r in rows
    )


def test_many_probes_are_placed_like_few(spark):
    rng = random.Random(8)
    keys = sorted({H._key(rng.randint(-50, 50), rng.randint(-50, 50)) for _ in range(4000)})
    probes = keys[::3]
    h, d = H._arrays(keys)
    assert list(H._places(H._arrays(probes), h, d)) == [bisect.bisect_right(probes, k) for k in keys]


def test_slots_follow_one_order(spark):
    docs = table(spark, SF001, "documents")
    got = H.histogram_shards(docs, 4, ranges=5).selectExpr("shard", "slot", "xxhash64(text) as h", "doc_id").collect()
    assert [(r["h"], r["doc_id"]) for r in sorted(got, key=lambda r: (r["shard"], r["slot"]))] == sorted(
        (r["h"], r["doc_id"]) for r in got
    )


def test_one_text_in_a_third_of_all_rows(spark):
    rng = random.Random(3)
    rows = [(i, "hot " * 30 if i % 3 == 0 else f"text {rng.random()} " * rng.randint(1, 6)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = H.histogram_shards(docs, 8).collect()
    total = law_holds([(r["text"], r["shard"], r["slot"]) for r in got])
    assert max(total) < 1.01 * min(total)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    got = H.histogram_shards(docs, 8)
    assert got.columns == [c for c in docs.columns if c != "shard"] + ["shard", "slot"]
    rows = got.collect()
    assert len(rows) == len(odd_rows())
    law_holds([(r["text"], r["shard"], r["slot"]) for r in rows])


def test_one_key_in_all_rows(spark):
    docs = spark.createDataFrame([(1, "same")] * 50, "doc_id long, text string")
    rows = H.histogram_shards(docs, 8).collect()
    assert sorted(r["slot"] for r in rows) == list(range(50))


def test_empty_table(spark):
    assert H.histogram_shards(no_docs(spark)).count() == 0


def test_query(spark):
    from arrivals_mart.llm.queries import op3_sharding

    text = {r["doc_id"]: r["text"] for r in table(spark, SF001, "documents").collect()}
    for r in op3_sharding(spark, SF001).collect():
        raw = text[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (
            len(raw) + 1, zlib.crc32(raw), "bytes", None
        )
