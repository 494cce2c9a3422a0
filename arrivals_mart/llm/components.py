"""Connected components of a graph that is larger than any one machine.

Alternating large-star and small-star steps (Kiveris et al., 2014): each step
is one grouped minimum and one join, and the number of edges never grows.
Every round is written to the shared scratch folder, so a round never
recomputes its predecessors; the driver sees a count and a checksum only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivals_mart.llm.common import materialize


def _signature(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))
        ).first()
    )


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, root)`` of every node that some edge joins to a smaller one.

    ``a`` and ``b`` are long columns; the root is the smallest node of the
    component. A node without a row is its own root (it is the smallest of
    its component, or has no edge). Null ends and loops are ignored, repeated
    edges count once; no edges give no rows.
    """
    edges = materialize(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v")))
        .distinct(),
        "components",
    )
    before = _signature(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Written first, so that the join has an exchange of its own, which
        # Spark splits at a node with very many edges.
        low = materialize(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "components_low")
        large = (
            both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        edges = materialize(
            small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "components"
        )
        after = _signature(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
