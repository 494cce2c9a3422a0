"""Checked loads: a table grown load by load, whose key is checked across loads.

``append_load`` writes a load to its own version path, checks it there, and only
then adds it to the table by publishing a manifest that names the earlier loads and
the new one. A load that fails a check is never seen by a reader.

Whether a key repeats is decided without shuffling the keys of the loads
before. Every load leaves a sketch: a Bloom filter in blocks of 32,768 bits, a row
of 4 KB each, with ``BITS`` bits a key. The keys of a new load meet the
blocks they fall into; those that a sketch cannot rule out (about 0.2 % of the keys
that are new) are looked up in the key column of the earlier loads, so the
answer is exact.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from arrivals_mart.contracts import Contract
from arrivals_mart.operators.quality import QualityError, check_report
from arrivals_mart.sinks.manifest import manifests, publish_manifest, read_manifest
from arrivals_mart.sinks.tables import materialize, read_table, remove_path, stage_path, write_table

#: Bits of a sketch for each key, at least.
BITS = 16
#: Bits that a key sets in its block.
PROBES = 4
#: Bits of a block: the size of Spark's bitmap aggregates.
BLOCK = 1 << 15
_KEYS = ".keys"


@dataclass(frozen=True)
class Load:
    """``repeats`` has a row for each key value that occurs more than once:
    the key, ``n_load`` (its rows in the load) and ``n_earlier`` (in the loads before)."""

    name: str
    path: str
    row_count: int
    repeats: DataFrame


def _block(key: str, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(key), blocks)


def _places(key: str) -> list[Column]:
    """The bits of a key inside its block: 15 bits each of a second hash."""
    second = F.xxhash64(F.lit("place"), F.col(key))
    return [F.shiftrightunsigned(second, 15 * i).bitwiseAND(BLOCK - 1) for i in range(PROBES)]


def _is_set(bits: Column, place: Column) -> Column:
    byte = F.substring(bits, (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), place.bitwiseAND(7).cast("int")) == 1


def key_sketch(keys: DataFrame, key: str, n: int) -> DataFrame:
    """Sketch of ``n`` key values: ``blocks`` (how many there are, a power of
    two), ``block`` and ``bits``. Blocks without a key have no row; null keys
    are left out."""
    blocks = 1 << max(0, math.ceil(math.log2(max(1, n) * BITS / BLOCK)))
    return (
        keys.where(F.col(key).isNotNull())
        .select(F.lit(blocks).cast("long").alias("blocks"), _block(key, F.lit(blocks)).alias("block"),
                F.explode(F.array(*_places(key))).alias("place"))
        .groupBy("blocks", "block")
        .agg(F.bitmap_construct_agg("place").alias("bits"))
    )


def not_ruled_out(keys: DataFrame, key: str, sketches: DataFrame) -> DataFrame:
    """The different values of ``key`` that may be in one of ``sketches``; all
    that are there are returned, and few others."""
    sizes = [r[0] for r in sketches.select("blocks").distinct().collect()]  # powers of two: 64 at most
    if not sizes:
        return keys.select(key).where(F.lit(False))
    # Sketches of one size share their block numbers: a key meets each size once.
    held = sketches.groupBy("blocks", "block").agg(F.collect_list("bits").alias("held"))
    places = [f"__place{i}" for i in range(PROBES)]
    met = (
        keys.where(F.col(key).isNotNull())
        .select(key, *[c.alias(p) for c, p in zip(_places(key), places, strict=True)],
                F.explode(F.array(*[F.lit(s).cast("long") for s in sizes])).alias("blocks"))
        .withColumn("block", _block(key, F.col("blocks")))
        .join(held, ["blocks", "block"])
    )
    hit = F.exists("held", lambda b: reduce(lambda x, y: x & y, [_is_set(b, F.col(p)) for p in places]))
    return met.where(hit).select(key).distinct()


def repeated_keys(counts: DataFrame, key: str, earlier: Sequence[DataFrame], sketches: DataFrame | None) -> DataFrame:
    """``key, n_load, n_earlier`` of the values of ``counts (key, n_load)``, a
    row per value of the load, that occur more than once in it or that one of
    the ``earlier`` frames, which ``sketches`` describe, holds too. Null keys never repeat."""
    counts = counts.where(F.col(key).isNotNull())
    if not earlier:
        return counts.where("n_load > 1").withColumn("n_earlier", F.lit(0).cast("long"))
    suspects = materialize(not_ruled_out(counts, key, sketches), "key_suspects")
    before = reduce(DataFrame.unionAll, [e.select(key) for e in earlier])
    found = before.join(suspects, key, "left_semi").groupBy(key).agg(F.count(F.lit(1)).alias("n_earlier"))
    return (
        counts.join(found, key, "left")
        .withColumn("n_earlier", F.coalesce("n_earlier", F.lit(0).cast("long")))
        .where("n_load > 1 OR n_earlier > 0")
        .select(key, "n_load", "n_earlier")
    )


def _folder(root: str, contract: Contract) -> str:
    return f"{root.rstrip('/')}/{contract.name}"


def _loads(spark: SparkSession, root: str, contract: Contract) -> dict[str, str]:
    folder = _folder(root, contract)
    return read_manifest(spark, folder).paths if manifests(spark, folder) else {}


def append_load(spark: SparkSession, df: DataFrame, root: str, contract: Contract, unique: bool = True) -> Load:
    """Add ``df`` as one load to the table of ``contract`` below ``root``.

    The load is written once, rows and null keys are counted on the way.
    An empty load, a null key and, with ``unique``, a key value that repeats in the load or
    across loads raise :class:`QualityError`: the load's files are removed and the table stays
    as it was. Without ``unique`` the repeats are only reported. One writer
    adds to a table at a time; readers need no care.
    """
    key = contract.key[0]
    known = _loads(spark, root, contract)
    observation = Observation(f"load_{contract.name}")
    path = write_table(df, stage_path(_folder(root, contract), "loads"), contract, observation=observation)
    kept = [path]
    try:
        seen = observation.get
        check_report([Row(table_name=contract.name, key_column=key, **seen)])
        counts = materialize(
            read_table(spark, path, contract).groupBy(key).agg(F.count(F.lit(1)).alias("n_load")), "load_keys"
        )
        sketch = stage_path(_folder(root, contract), "keys")
        kept.append(sketch)
        key_sketch(counts, key, counts.count()).write.parquet(sketch)
        earlier = [read_table(spark, p, contract) for n, p in known.items() if not n.endswith(_KEYS)]
        sketches = [p for n, p in known.items() if n.endswith(_KEYS)]
        held = spark.read.parquet(*sketches) if sketches else None
        repeats = materialize(repeated_keys(counts, key, earlier, held), "load_repeats")
        repeated = repeats.count() if unique else 0
        if repeated:
            raise QualityError([f"{contract.name} contains {repeated} repeated values in column {key}"])
        name = path.rsplit("/", 1)[-1]
        publish_manifest(spark, _folder(root, contract), {**known, name: path, name + _KEYS: sketch})
    except Exception:
        for p in kept:
            remove_path(spark, p)
        raise
    return Load(name, path, seen["row_count"], repeats)


def read_loads(spark: SparkSession, root: str, contract: Contract) -> DataFrame:
    """All rows of the loads of the newest manifest."""
    paths = [p for n, p in _loads(spark, root, contract).items() if not n.endswith(_KEYS)]
    if not paths:
        raise FileNotFoundError(f"{_folder(root, contract)}: no load was added")
    return reduce(DataFrame.unionByName, [read_table(spark, p, contract) for p in paths])
