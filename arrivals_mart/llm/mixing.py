"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target number of words; a document of the source should
then be taken ``target / source size`` times, a number such as 1.37. The whole
part is settled, the rest is a copy probability. Pivotal rounding pairs two
documents with fractional probabilities and moves mass from one to the other,
at random and without bias, until one probability is 0 or 1. Mass is counted
in words (probability times size), so each move keeps the source's expected
words exactly: the words taken differ from the target by less than the one
document per source that is left at the end.

Rows that agree in source, id, size and text are one class, however many they
are: a class of n rows at probability p is sure of floor(n p) copies, and only
the rest is a copy probability to round. Classes, which hold no text, are dealt to chunks of
bounded size by a hash; a task settles a chunk
and leaves at most one open class, and the open classes of all chunks
are dealt to chunks again until each source has one: a reduction tree of a few
levels, each written to the shared folder. Within a chunk larger documents go
first, so the open one tends to be small. All random numbers come from hashes of
the seed, the ids and the level, so reruns agree. Last, the copies of a class go
to its first rows, counted through the partitions of the written input, so a
class may be spread over any number of tasks.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrivals_mart.llm.common import materialize, quoted, word_count

#: Classes of equal rows that one task settles together.
CHUNK = 2048
#: Largest number of copies of a document.
MAX_COPIES = 3


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = MAX_COPIES) -> DataFrame:
    """Targets of ``sizes (source, source_size)``, one row per source.

    Sources by code point, null last, weigh ``weights``, repeating, and share
    the total of all sizes. A target stops at ``most`` times its source's size;
    the excess is shared again by weight until none is above. Adds ``__rank``
    and ``target``. The numbering is a range partitioning with offsets per
    partition; the sharing is one aggregate a round.
    """
    spread = sizes.repartitionByRange(F.col("source").isNull(), F.col("source")).withColumn(
        "part", F.spark_partition_id()
    )
    spread = materialize(spread, "mix_sources")
    offset, offsets = 0, []
    for r in spread.groupBy("part").count().orderBy("part").collect():  # a row per partition
        offsets += [F.lit(r["part"]), F.lit(offset)]
        offset += r["count"]
    order = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    start = F.element_at(F.create_map(*offsets), F.col("part")) if offsets else F.lit(0)
    ranked = spread.withColumn("__rank", (F.row_number().over(order) - 1 + start).cast("long"))
    picked = F.element_at(F.array(*map(F.lit, weights)), (F.col("__rank") % len(weights) + 1).cast("int"))
    ranked = materialize(ranked.withColumn("weight", picked.cast("double")).drop("part"), "mix_ranks")

    limit = F.col("source_size") * F.lit(float(most))
    total = float(ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0])
    rate = 0.0  # words per weight of the sources that are not at their limit
    while True:
        full = limit <= F.col("weight") * F.lit(rate)
        used, free = ranked.agg(
            F.coalesce(F.sum(F.when(full, limit)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)),
        ).first()
        after = (total - used) / free if free else rate
        if not free or after <= rate:
            break
        rate = after
    return ranked.withColumn("target", F.least(limit, F.col("weight") * F.lit(rate))).drop("weight")


def _uniform(seed: int, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers in [0, 1) from hashes of two keys."""
    with np.errstate(over="ignore"):
        x = a.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x ^= b.astype(np.int64).view(np.uint64) + np.uint64(seed * 1000003 + level)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def pivotal(p: np.ndarray, size: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Round the probabilities ``p`` in order, keeping ``sum(p * size)``:
    all but at most one come out as 0 or 1. ``u`` holds a uniform number for
    each element; sizes are positive."""
    p = p.copy()
    open_at = -1
    for j in range(len(p)):
        if not 0.0 < p[j] < 1.0:
            continue
        if open_at < 0:
            open_at = j
            continue
        i = open_at
        up = min((1.0 - p[i]) * size[i], p[j] * size[j])  # words that i can take from j
        down = min(p[i] * size[i], (1.0 - p[j]) * size[j])
        moved = up if u[j] * (up + down) < down else -down
        p[i] += moved / size[i]
        p[j] -= moved / size[j]
        for k in (i, j):
            if p[k] < 1e-9:
                p[k] = 0.0
            elif p[k] > 1.0 - 1e-9:
                p[k] = 1.0
        open_at = next((k for k in (i, j) if 0.0 < p[k] < 1.0), -1)
    return p


def _settle(seed: int, level: int, last: bool) -> Callable[[pa.Table], pa.Table]:
    def run(group: pa.Table) -> pa.Table:
        p, size, tie = (group.column(c).to_numpy() for c in ("__p", "__size", "__tie"))
        order = np.lexsort((tie, -size))
        u = _uniform(seed, level, size[order], tie[order])
        out = p.copy()
        out[order] = pivotal(p[order], size[order].astype(float), u)
        if last:
            rest = np.flatnonzero((out > 0) & (out < 1))
            out[rest] = _uniform(seed, level + 1, size[rest], tie[rest]) < out[rest]
        return group.set_column(group.schema.get_field_index("__p"), "__p", pa.array(out))

    return run


def mix(
    docs: DataFrame,
    size: Column | None = None,
    weights: tuple[int, ...] = (1, 2, 3),
    most: int = MAX_COPIES,
    seed: int = 11,
    chunk: int = CHUNK,
) -> DataFrame:
    """``docs (doc_id, text, source, ...)`` with ``copies`` (0 to ``most``),
    how often the mix takes a row, and ``size``, ``source_size``, ``target``.

    ``size`` defaults to the words of ``text``. Rows of size 0 add no words;
    they are taken ``floor(target / source_size)`` times (0 in a source
    without words). Null sources are a source of their own, null ids and
    repeated rows are rows like any other; rows equal in source, id, size and text may take
    each other's copies. Texts of any length pass through unread, but for their
    words and hash. Input columns named like the outputs are replaced.
    An empty table gives an empty result.
    """
    size = word_count(F.col("text")) if size is None else size
    size = F.coalesce(size.cast("long"), F.lit(0).cast("long"))
    source = F.col("source").cast("string")
    names = [c for c in docs.columns if c not in ("copies", "size", "source_size", "target")]
    # Input columns travel under plain names, whatever their own are.
    held = [f"__column{i}" for i in range(len(names))]
    same = ["doc_id", *(["text"] if "text" in names else [])]
    rows = materialize(
        docs.select(
            *[c.alias(h) for c, h in zip(quoted(names), held, strict=True)],
            F.coalesce(source, F.lit("")).alias("__source"),
            source.isNull().alias("__none"),
            size.alias("__size"),
            F.xxhash64(*same).alias("__tie"),
            F.spark_partition_id().alias("__part"),
        ),
        "mix_rows",
    )
    of_source, of_class = ["__source", "__none"], ["__source", "__none", "__size", "__tie"]
    parts = materialize(rows.groupBy(*of_class, "__part").agg(F.count(F.lit(1)).alias("__n")), "mix_parts")
    classes = parts.groupBy(*of_class).agg(F.sum("__n").alias("__n"))
    per_source = classes.groupBy(*of_source).agg(
        F.sum(F.col("__size") * F.col("__n")).alias("source_size"), F.count(F.lit(1)).alias("n_classes")
    )
    per_source = per_source.select(
        F.when(~F.col("__none"), F.col("__source")).alias("source"), "source_size", "n_classes"
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = materialize(source_targets(per_source, weights, most), "mix_targets").select(
        F.coalesce("source", F.lit("")).alias("__source"),
        F.col("source").isNull().alias("__none"),
        F.col("source_size").cast("long").alias("source_size"),
        F.col("target").cast("double").alias("target"),
        "__rank",
        F.floor(rate).cast("int").alias("__whole"),
        (rate - F.floor(rate)).alias("__rest"),
        F.ceil(F.col("n_classes") / chunk).alias("__chunks"),
    )
    share = F.when(F.col("__size") > 0, F.col("__n") * F.col("__rest")).otherwise(0.0)
    columns = [*of_class, "__rank", "__sure", "__p", "__chunks", "__chunk"]
    open_classes = (
        classes.join(targets.select(*of_source, "__rank", "__rest", "__chunks"), of_source)
        .withColumn("__sure", F.floor(share))
        .withColumn("__p", share - F.col("__sure"))
        .withColumn("__chunk", F.pmod(F.xxhash64(F.lit(seed), "__size", "__tie"), F.col("__chunks")))
        .select(*columns)
    )
    schema = open_classes.schema
    closed: list[DataFrame] = []
    level = 0
    chunks = targets.agg(F.max("__chunks")).first()[0] or 0  # of the largest source
    while True:
        last = chunks <= 1
        settled = materialize(
            open_classes.groupBy("__rank", "__chunk").applyInArrow(_settle(seed, level, last), schema), "mix_level"
        )
        is_open = (F.col("__p") > 0) & (F.col("__p") < 1)
        closed.append(settled if last else settled.where(~is_open))
        if last:
            break
        level, chunks = level + 1, -(-chunks // chunk)
        # Each chunk left one open class at most: deal these out again.
        open_classes = settled.where(is_open).withColumn(
            "__chunks", F.ceil(F.col("__chunks") / chunk).cast("long")
        )
        open_classes = open_classes.withColumn("__chunk", F.col("__chunk") % F.col("__chunks")).select(*columns)
    extra = closed[0]
    for more in closed[1:]:
        extra = extra.unionByName(more)
    extra = extra.select(*of_class, (F.col("__sure") + F.col("__p").cast("long")).alias("__extra"))
    # Rows of a class in earlier partitions: a row here for each partition, not each document.
    earlier = Window.partitionBy(*of_class).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        parts.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
        .join(extra, of_class)
        .join(targets.select(*of_source, "source_size", "target", "__whole"), of_source)
        .drop("__n")
    )
    here = Window.partitionBy(*of_class, "__part").orderBy("__tie")
    taken = rows.withColumn("__at", F.row_number().over(here)).join(placed, [*of_class, "__part"])
    return taken.select(
        *[F.col(h).alias(name) for h, name in zip(held, names, strict=True)],
        F.col("__size").alias("size"),
        "source_size",
        "target",
        (F.col("__whole") + (F.col("__before") + F.col("__at") <= F.col("__extra")).cast("int")).alias("copies"),
    )


def take_copies(mixed: DataFrame) -> DataFrame:
    """The mix itself: every row as often as its ``copies`` say."""
    return (
        mixed.where("copies > 0")
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .drop("__copy", "copies", "size", "source_size", "target")
    )
