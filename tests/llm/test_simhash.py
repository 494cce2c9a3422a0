import random
from itertools import combinations

import numpy as np
import pytest
import xxhash
from corpus import no_docs, odd_docs, odd_rows, roots
from pyspark.sql import functions as F

from arrivals_mart.llm import golay
from arrivals_mart.llm import simhash_dedup as S
from arrivals_mart.llm.common import table
from arrivals_mart.llm.components import connected_components

SF001 = "/root/testdata/sf0.001"


def plain_fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_golay_code_is_perfect():
    _, error = golay._tables()
    assert (error[1:] > 0).all() and error[0] == 0  # a pattern of at most three bits for every syndrome
    words = np.random.default_rng(1).integers(0, 1 << 23, 50_000)
    index = golay.nearest(words)
    assert len(np.unique(index)) == 1 << 12
    words, index = words[:5000], index[:5000]
    for flip in (1 << 3, 1 << 22):
        near = golay.nearby(words, 23)
        other = golay.nearest(words ^ flip)
        assert (near == other[:, None]).any(axis=1).all()  # one bit: met by the neighbours
    assert (near >= 0).sum(axis=1).max() == 6 and (near == index[:, None]).any(axis=1).all()


def test_keys_meet_for_every_two_bits():
    rng = random.Random(5)
    for _ in range(20):
        a = rng.getrandbits(64)
        flips = [()] + [(i,) for i in range(64)] + rng.sample(list(combinations(range(64), 2)), 200)
        others = np.array([signed(a ^ sum(1 << i for i in f)) for f in flips], np.int64)
        import pyarrow as pa

        batch = pa.RecordBatch.from_arrays([pa.array(np.concatenate([[signed(a)], others]))], ["fp"])
        index, probe = {}, set()
        for out in S._key_batches([batch]):
            for key, fp, is_probe in zip(*(c.to_pylist() for c in out.columns), strict=True):
                if is_probe and fp == signed(a):
                    probe.add(key)
                if not is_probe:
                    index.setdefault(fp, set()).add(key)
        assert all(index[int(o)] & probe for o in others)


@pytest.mark.parametrize("text", [None, "", " \t", "One", "A b", "A B c", "É x\x0by z " * 40, "a b c d " * 40_000])
def test_fingerprint(text):
    assert S.fingerprint(None if text is None else text.encode()) == plain_fingerprint(text)


def test_hash_is_sparks_xxhash64(spark):
    text = "the cat sat"
    assert spark.range(1).select(F.xxhash64(F.lit(text))).first()[0] == signed(
        xxhash.xxh64_intdigest(text.encode(), 42)
    )


def brute(rows):
    """(doc_id, fp, component) of rows by comparing all fingerprints."""
    prints = [signed(plain_fingerprint(t)) for _, t in rows]
    distinct = sorted(set(prints))
    pairs = [(x, x) for x in distinct] + [
        (a, b) for a, b in combinations(distinct, 2) if bin((a ^ b) & (2**64 - 1)).count("1") <= 2
    ]
    root = roots(pairs)
    least = {}
    for (d, _), p in zip(rows, prints, strict=True):
        if d is not None:
            least[root[p]] = min(d, least.get(root[p], d))
    return sorted(((d, p, least.get(root[p])) for (d, _), p in zip(rows, prints, strict=True)), key=str)


@pytest.mark.parametrize("bucket", [64, 1])
def test_clusters_match_brute_force(spark, monkeypatch, bucket):
    """With a bucket of 1 every shared key goes the crowded way."""
    monkeypatch.setattr(S, "BUCKET", bucket)
    monkeypatch.setattr(S.links, "__defaults__", (2, bucket))
    docs = table(spark, SF001, "documents").select("doc_id", "text")
    got = S.simhash_clusters(docs)
    want = brute([tuple(r) for r in docs.collect()])
    assert sorted((tuple(r) for r in got.select("doc_id", "fp", "component_id").collect()), key=str) == want
    assert any(d != c for d, _, c in want)


@pytest.mark.parametrize("bucket", [64, 2])
def test_links_of_planted_fingerprints(spark, bucket):
    rng = random.Random(7)
    prints = set()
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(40):
            x = base
            for i in rng.sample(range(64), rng.randint(0, 3)):
                x ^= 1 << i
            prints.add(signed(x))
    prints = sorted(prints)
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    edges = [tuple(r) for r in S.links(frame, 2, bucket).collect()]
    assert all(bin((a ^ b) & (2**64 - 1)).count("1") <= 2 for a, b in edges)
    want = roots([(a, b) for a, b in combinations(prints, 2) if bin((a ^ b) & (2**64 - 1)).count("1") <= 2])
    assert roots(edges) == want


def test_odd_rows(spark):
    docs = odd_docs(spark)
    got = S.simhash_clusters(docs).select("doc_id", "fp", "component_id")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute([r[:2] for r in odd_rows()])
    kept = S.keep_representatives(docs)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"], (r["text"] or "")[:8]) for r in kept.where("doc_id is not null").collect())
    assert (1, "the cat ") in ids and (2, "le chat ") in ids and (2, "the cat ") not in ids
    assert len(ids) == len(set(ids))
    assert (3, "") in ids and not any(d in (4, 5) for d, _ in ids)  # no words: one group
    assert kept.where("doc_id is null").count() == 1


def test_empty_table(spark):
    assert S.simhash_clusters(no_docs(spark)).count() == 0
    assert S.keep_representatives(no_docs(spark)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 90), (90, 95), (7, 7), (None, 3), (100, 90)]
    edges += [(500, 500 + i) for i in range(1, 60)]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["root"] for r in connected_components(frame, "a", "b").collect()}
    want = roots([e for e in edges if None not in e and e[0] != e[1]])
    assert got == {k: v for k, v in want.items() if k != v}
