import numpy as np
import pytest

from arrivals_mart.llm import queries
from arrivals_mart.llm import whitening as W
from arrivals_mart.llm.common import table

SF001 = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, x string, dim string, whitened string"


def brute(rows, components=8):
    """Exact whole numbers, then the covariance as a whole."""
    kept = [(i, e) for i, e in rows if e is not None and len(e) and None not in e and np.isfinite(np.array(e, float)).all()]
    x = np.array([[int(np.floor(float(c) * 1024)) + 100_000 for c in e] for _, e in kept], object)
    n = len(x)
    sums = x.sum(axis=0)
    scaled = n * x - sums
    deviation = [int(d) for d in (scaled * scaled).sum(axis=1)]
    xc = scaled.astype(float) / n
    values, vectors = np.linalg.eigh(xc.T @ xc / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, int((values > 1e-9 * values[0]).sum()))
    return [i for i, _ in kept], n, deviation, xc @ vectors[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


def same(got, want):
    """Columns agree up to a sign each."""
    sign = np.sign((got * want).sum(axis=0))
    return np.abs(got * sign - want).max()


def frame(spark, rows):
    return spark.createDataFrame([(i, e, 1, "x", "d", "w") for i, e in rows], SCHEMA)


def test_query_against_the_whole_covariance(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF001, "embeddings").collect()]
    ids, n, deviation, whitened, explained = brute(rows)
    got = queries.op12_whitening(spark, SF001).toPandas()
    assert len(got) == 8 * len(ids) and set(got.n) == {n}
    assert dict(zip(got.vec_id, got.deviation, strict=True)) == dict(zip(ids, deviation, strict=True))
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    assert same(wide, whitened) < 1e-9
    shares = got.groupby("component").explained.unique()
    assert all(len(s) == 1 and abs(s[0] / e - 1) < 1e-10 for s, e in zip(shares, explained, strict=True))
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-10


@pytest.mark.parametrize("dim", [1, 40, 130])
def test_spectra(spark, dim):
    """A steep spectrum, a flat one, and one of low rank."""
    rng = np.random.default_rng(dim)
    for scale in (np.logspace(0, -3, dim), np.linspace(1, 0.97, dim), (np.arange(dim) < 5) * 1.0):
        e = (rng.standard_normal((600, dim)) * scale) @ np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        rows = [(i, v.tolist()) for i, v in enumerate(e)]
        vectors = W.whole_vectors(frame(spark, rows).repartition(2))
        model = W.fit_whitening(vectors, guard=12)
        ids, _, _, whitened, explained = brute([(i, np.float32(v).tolist()) for i, v in rows])
        k = len(explained)
        assert len(model.values) == k and np.allclose(model.values / model.trace, explained, rtol=1e-9)
        assert W.identity_error(vectors, model) < 1e-8
        got = {r.vec_id: r.whitened for r in W.whiten(vectors, model).collect()}
        assert same(np.array([got[i] for i in ids]), whitened) < 1e-6
        assert model.residual < 1e-12 and model.dim == dim


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i % 7 if i else None, [float(i % 5), float(i % 3) / 8, -float(i)]) for i in range(20)]
    odd = [(90, None), (91, []), (92, [1.0, None, 2.0]), (93, [nan, 1.0, 1.0]), (94, [inf, 0.0, 0.0]), (95, [1.0, 2.0]),
           (96, [3e38, 0.0, 0.0])]
    vectors = W.whole_vectors(frame(spark, good + odd))
    assert vectors.count() == 20
    model = W.fit_whitening(vectors)
    _, n, deviation, whitened, _ = brute(good)
    got = W.whiten(vectors, model).collect()
    assert n == model.n == 20 and len(model.values) == 3
    key = sorted(range(20), key=lambda i: (str(good[i][0]), deviation[i], abs(whitened[i][0])))
    rows = sorted(got, key=lambda r: (str(r.vec_id), r.deviation, abs(r.whitened[0])))
    assert [int(r.deviation) for r in rows] == [deviation[i] for i in key]
    assert same(np.array([r.whitened for r in rows]), whitened[key]) < 1e-9


def test_numbers_past_a_long_stay_exact(spark):
    rows = [(i, [1e12 * (i % 3), float(i)]) for i in range(9)]
    vectors = W.whole_vectors(frame(spark, rows))
    model = W.fit_whitening(vectors)
    _, _, deviation, _, _ = brute([(i, np.float32(v).tolist()) for i, v in rows])
    assert {r.vec_id: int(r.deviation) for r in W.whiten(vectors, model).collect()} == dict(enumerate(deviation))
    assert max(deviation) > 1 << 63


def test_nothing_to_fit(spark):
    empty = W.whole_vectors(frame(spark, []))
    assert W.fit_whitening(empty) is None and W.whiten(empty, None).count() == 0
    assert W.identity_error(empty, None) is None
    equal = W.whole_vectors(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]))
    model = W.fit_whitening(equal)
    assert len(model.values) == 0 and W.identity_error(equal, model) is None
    assert [list(r.whitened) for r in W.whiten(equal, model).collect()] == [[], []]
