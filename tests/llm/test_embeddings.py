import numpy as np
import pyarrow as pa
import pytest
from corpus import roots

from arrivals_mart.llm import embedding_dedup as V
from arrivals_mart.llm.common import table

SF1 = "/root/testdata/sf0.1"
SCHEMA = "vec_id long, embedding array<float>, label int, dim string, links string"


def brute(rows, least=0.98):
    """(vec_id, n_links, component) by comparing all pairs."""

    def usable(e, label):
        return (
            label is not None and e is not None and len(e) and None not in e
            and bool(np.isfinite(np.array(e, float)).all()) and any(e)
        )

    unit = {}
    for i, (_, e, label) in enumerate(rows):
        if usable(e, label):
            x = np.array(e, float)
            unit[i] = x / np.sqrt((x * x).sum())
    links = dict.fromkeys(range(len(rows)), 0)
    pairs = [(i, i) for i in range(len(rows))]
    for i in unit:
        for j in unit:
            if i < j and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least:
                links[i] += 1
                links[j] += 1
                pairs.append((i, j))
    root = roots(pairs)
    ids = {}
    for i, (v, _, _) in enumerate(rows):
        if v is not None:
            ids[root[i]] = min(v, ids.get(root[i], v))
    return sorted(((v, links[i], ids.get(root[i])) for i, (v, _, _) in enumerate(rows)), key=str)


def got(frame):
    rows = frame.collect()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in rows)
    return sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in rows), key=str)


def test_table(spark):
    """The table's vectors, and noisy copies of them around the threshold."""
    rows = [tuple(r) for r in table(spark, SF1, "embeddings").select("vec_id", "embedding", "label").collect()]
    rng = np.random.default_rng(9)
    for v, e, label in rows[:600]:
        for k in range(v % 4):
            noise = rng.normal(0, rng.choice([0.005, 0.02, 0.0255]), len(e))
            rows.append((10_000 * (k + 1) + v, [float(np.float32(x)) for x in np.array(e) + noise], label))
    want = brute(rows)
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert got(V.embedding_clusters(vectors)) == want
    assert sum(n > 0 for _, n, _ in want) > 500


@pytest.mark.parametrize("block", [8, 512])
def test_crowded_and_odd_vectors(spark, block):
    rng = np.random.default_rng(4)
    rows = []
    for center in rng.standard_normal((4, 16)):
        for k in range(40):
            e = center / np.linalg.norm(center) + rng.normal(0, 0.025, 16)
            rows += [(len(rows), [float(np.float32(x)) for x in e], k % 2)] * (3 if k == 0 else 1)
    n = len(rows)
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [1.0, None] * 8, [float("inf")] + [0.0] * 15, [1.0, 2.0], [-1.0, 0.0]]
    rows += [(n + i, e, 0) for i, e in enumerate(odd)] + [(n + 50, rows[0][1], None), (None, rows[0][1], 0)]
    rows += [(n + 60, [2.0, 4.0], 0), (n + 61, [2.0, 4.0], 1), (n + 62, [-0.0, 1.0], 0), (n + 63, [0.0, 1.0], 0)]
    frame = spark.createDataFrame([r + ("x", "y") for r in rows], SCHEMA)
    assert got(V.embedding_clusters(frame, block=block)) == brute(rows)


def test_buckets_that_clash_are_compared_by_label_and_length():
    """One bucket holding two labels and two lengths, as a clash of hashes would make it."""
    vectors = [[1.0, 2.0], [2.0, 4.0], [1.0, 2.0], [1.0, 2.0, 3.0], [1.0, 2.0], [2.0, 4.0, 6.0]]
    labels = ["a", "a", "b", "a", "b", "a"]
    n = len(vectors)
    batch = pa.RecordBatch.from_pydict(
        {
            "bucket": [5] * n, "nth": [0] * n, "bi": [0] * n, "bj": [0] * n, "node": list(range(n)), "m": [1] * n,
            "left": [True] * n, "dim": [len(v) for v in vectors], "label": labels, "embedding": vectors,
        }
    )
    out = [r for b in V._group_batches(0.98)(iter([batch])) for r in b.to_pylist()]
    assert {r["node"]: (r["new"], r["root"]) for r in out} == {
        0: (1, 0), 1: (1, 0), 2: (1, 2), 4: (1, 2), 3: (1, 3), 5: (1, 3)
    }


def test_very_large_and_small_components(spark):
    rows = [(i, [1.0 * s, 2.0 * s], "x") for i, s in enumerate([1.0, 1e200, 1e-200, 1e308 / 2, 1e-320])]
    rows += [(9, [2e200, -1e200], "x")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    assert got(V.embedding_clusters(frame)) == [(i, 4, 0) for i in range(5)] + [(9, 0, 9)]


def test_empty_table(spark):
    assert V.embedding_clusters(spark.createDataFrame([], SCHEMA)).count() == 0


def test_threshold_below_the_layout_is_refused(spark):
    with pytest.raises(ValueError):
        V.embedding_clusters(spark.createDataFrame([], SCHEMA), 0.9)
