"""Near-duplicate vectors by Euclidean p-stable hashing.

For normalised vectors a cosine of 0.98 is a distance of 0.2. Each of
``TABLES`` tables hashes a vector to ``HASHES`` numbers
``floor((a.x + b) / WIDTH)`` with Gaussian ``a`` and uniform ``b``; vectors that
agree in all numbers of some table, and in label, are compared exactly in
double precision. One number agrees with probability 0.90 at distance 0.2, so
a pair at the threshold is missed by all 48 tables with probability
(1 - 0.9^12)^48 < 2e-7, closer pairs less, while two unrelated vectors meet in
a table with probability 2e-5.

Equal vectors are one class with a count. A bucket is compared in blocks of
``BLOCK`` vectors, each pair of blocks a group of its own, so a bucket of any
size spreads over tasks, no pair is dropped and none is written: a group
returns one row per vector, with its number of new links and a
representative it is linked with. A pair that meets in several tables counts in
the first of them only, which a group sees from the hash numbers of both.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivals_mart.llm.common import materialize, runs
from arrivals_mart.llm.components import connected_components

TABLES = 48
HASHES = 12
WIDTH = 1.6
BLOCK = 256
_SEED = 20


@cache
def _projections(dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng((_SEED, dim))
    a = rng.standard_normal((dim, TABLES * HASHES))
    b = rng.uniform(0, WIDTH, TABLES * HASHES)
    odd = rng.integers(1, 1 << 62, (TABLES, HASHES), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, b, odd


def bucket_keys(unit: np.ndarray) -> np.ndarray:
    """Hash of each vector's numbers in each table."""
    a, b, odd = _projections(unit.shape[1])
    numbers = np.floor((unit @ a + b) / WIDTH).astype(np.int64).view(np.uint64)
    mixed = (numbers.reshape(len(unit), TABLES, HASHES) * odd).sum(axis=2, dtype=np.uint64)
    return (mixed ^ (mixed >> np.uint64(29))).view(np.int64)


def _unit(vectors: np.ndarray) -> np.ndarray:
    # By a power of two first, which is exact, so that no square over- or underflows.
    vectors = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=-1, keepdims=True))[1])
    return vectors / np.sqrt((vectors * vectors).sum(axis=-1, keepdims=True))


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), dim)


def _key_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        node, label, dims = (batch.column(i).to_numpy() for i in range(3))
        for dim in np.unique(dims):
            rows = np.flatnonzero(dims == dim)
            keys = bucket_keys(_unit(_vectors(batch.column(3).take(pa.array(rows)), int(dim))))
            table = np.arange(TABLES, dtype=np.int64)
            salt = (label[rows, None].astype(np.int64) * 1000003 + int(dim)) * TABLES + table
            salted = keys ^ (salt * np.int64(0x5851F42D4C957F2D))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(node[rows], TABLES)),
                    pa.array(np.tile(table.astype(np.int32), len(rows))),
                    pa.array(salted.ravel()),
                ],
                ["node", "nth", "bucket"],
            )


def _compare(
    unit: np.ndarray, m: np.ndarray, left: np.ndarray, nth: int, cross: bool, least: float
) -> tuple[np.ndarray, np.ndarray]:
    """New links (in rows) and root of each vector of one group."""
    if cross:
        a, b = np.flatnonzero(left), np.flatnonzero(~left)
        i, j = np.nonzero(unit[a] @ unit[b].T >= least)
        i, j = a[i], b[j]
    else:
        i, j = np.nonzero(np.triu(unit @ unit.T >= least, 1))
    new, root = np.zeros(len(unit), np.int64), np.arange(len(unit))
    if not len(i):
        return new, root
    fresh = np.ones(len(i), bool)
    if nth:  # pairs that met in an earlier table were counted there
        keys = bucket_keys(unit)[:, :nth]
        for at in range(0, len(i), 1 << 14):
            part = slice(at, at + (1 << 14))
            fresh[part] = ~(keys[i[part]] == keys[j[part]]).any(axis=1)
    np.add.at(new, i[fresh], m[j[fresh]])
    np.add.at(new, j[fresh], m[i[fresh]])
    while True:
        low = root.copy()
        np.minimum.at(low, i, root[j])
        np.minimum.at(low, j, root[i])
        low = low[low]
        if (low == root).all():
            return new, root
        root = low


def _alike(dims: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
    """Rows of one group by dimension and label: its bucket is a hash of both,
    so nearly always they are all alike."""
    if (dims == dims[0]).all() and (labels == labels[0]).all():
        return [np.arange(len(dims))]
    parts: dict[tuple[int, str], list[int]] = {}
    for i, part in enumerate(zip(dims.tolist(), labels.tolist(), strict=True)):
        parts.setdefault(part, []).append(i)
    return [np.array(rows) for rows in parts.values() if len(rows) > 1]


def _group_batches(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = ("bucket", "nth", "bi", "bj")
        for table in runs(batches, group):
            table = table.combine_chunks()
            columns = [table.column(c).to_numpy() for c in group]
            cut = np.zeros(table.num_rows, bool)
            cut[0] = True
            for c in columns:
                cut[1:] |= c[1:] != c[:-1]
            starts = np.flatnonzero(cut)
            ends = np.concatenate([starts[1:], [table.num_rows]])
            node, m, left = (table.column(c).to_numpy(zero_copy_only=False) for c in ("node", "m", "left"))
            vectors = table.column("embedding").combine_chunks()
            dims = table.column("dim").to_numpy()
            labels = table.column("label").to_numpy(zero_copy_only=False)
            found: list[tuple[np.ndarray, ...]] = []
            for s, e in zip(starts, ends, strict=True):
                if e - s < 2:
                    continue
                cross = columns[2][s] != columns[3][s]
                for rows in _alike(dims[s:e], labels[s:e]):
                    at = s + rows
                    dim = int(dims[at[0]])
                    unit = _unit(_vectors(vectors.take(pa.array(at)), dim))
                    new, root = _compare(unit, m[at], left[at], int(columns[1][s]), cross, least)
                    use = np.flatnonzero((new > 0) | (root != np.arange(len(at))))
                    if len(use):
                        found.append((node[at][use], new[use], node[at][root[use]]))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in zip(*found, strict=True)], ["node", "new", "root"]
                )

    return run


def embedding_clusters(vectors: DataFrame, least: float = 0.98, block: int = BLOCK) -> DataFrame:
    """Links and groups of ``vectors (vec_id, embedding, label)``.

    Vectors link if their labels are equal and not null and their cosine, in
    double precision, is at least ``least`` (0.98 or more: the hash tables
    are laid out for a distance of 0.2 at most). Returns a row per input row:
    ``vec_id``, ``n_links`` (other rows linked directly, equal vectors
    included), ``component_id`` (smallest ``vec_id`` of the group) and ``kept``
    (``vec_id`` is its group's id).

    Null, empty and zero vectors, and vectors with a null or non-finite
    component, link with nothing; so does a null label. Vectors of different
    length do not link. Repeated rows are rows of their own; a null
    ``vec_id`` is counted as a link but never a group's id unless it is alone. Other columns
    are ignored; an empty table gives an empty result.
    """
    if least < 0.98:
        raise ValueError("the hash tables are laid out for a cosine of 0.98 or more")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
    wide = F.col("embedding").cast("array<double>")
    finite = ~F.exists(wide, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    usable = (
        F.col("label").isNotNull()
        & F.col("embedding").isNotNull()
        & F.coalesce(finite & F.exists(wide, lambda v: v != 0), F.lit(False))
    )
    classes = materialize(
        rows.where(usable)
        .groupBy("label", "embedding")
        .agg(F.count(F.lit(1)).alias("m"), F.min("vec_id").alias("first_id"))
        .withColumns({"node": F.monotonically_increasing_id(), "dim": F.size("embedding")}),
        "vector_classes",
    )
    keys = materialize(
        classes.select("node", F.xxhash64("label").alias("label"), "dim", "embedding").mapInArrow(
            _key_batches, "node long, nth int, bucket long"
        ),
        "vector_keys",
    )
    sizes = materialize(
        keys.groupBy("bucket", "nth")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
        .drop("n"),
        "vector_buckets",
    )
    met = (
        keys.join(sizes, ["bucket", "nth"])
        .withColumn("own", F.pmod(F.xxhash64("node", "nth"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "node",
            "bucket",
            "nth",
            F.least("own", "other").alias("bi"),
            F.greatest("own", "other").alias("bj"),
            (F.col("own") <= F.col("other")).alias("left"),
        )
    )
    compared = materialize(
        met.join(
            classes.select("node", "m", "dim", F.col("label").cast("string").alias("label"), "embedding"), "node"
        )
        .repartition("bucket", "nth", "bi", "bj")
        .sortWithinPartitions("bucket", "nth", "bi", "bj")
        .mapInArrow(_group_batches(least), "node long, new long, root long"),
        "vector_links",
    )
    links = compared.groupBy("node").agg(F.sum("new").alias("links"))
    roots = connected_components(compared.select("node", "root"), "node", "root").withColumnRenamed("root", "top")
    placed = classes.join(links, "node", "left").join(roots, "node", "left").withColumn(
        "top", F.coalesce("top", "node")
    )
    ids = placed.groupBy("top").agg(F.min("first_id").alias("component"))
    described = materialize(
        placed.join(ids, "top").select(
            F.col("label").alias("c_label"),
            F.col("embedding").alias("c_embedding"),
            (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("links"),
            "component",
        ),
        "vector_groups",
    )
    key = F.when(usable, F.col("embedding"))
    out = rows.join(
        described, (F.col("label") == F.col("c_label")) & (key == F.col("c_embedding")), "left"
    )
    component = F.when(F.col("links").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return out.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
