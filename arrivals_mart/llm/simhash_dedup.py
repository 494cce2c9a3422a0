r"""SimHash near-duplicates by Golay-code fuzzy hashing.

**Fingerprint.** A text is lower-cased in A-Z and cut into words
``[^\x20\x09-\x0D]+``; every run of ``shingle_words`` words, repeats included,
is hashed with XXH64 (seed 42). Bit i of the fingerprint is set if bit i is
set in more than half of the hashes. Map-only; texts are never shuffled.

**Keys.** The 64 bits are cut into segments of 22, 21 and 21 bits. If two
fingerprints differ in at most two bits, some segment is equal in both, and
it can be chosen so that the segment after it (cyclically) differs in at most
one bit. So there are three tables, each keyed by one exact segment and one
codeword index of the segment after it. A fingerprint is *indexed* under the
codewords next to the segment and to its one-bit neighbours (at most six),
and *probes* with the codeword next to the segment itself; one bit of
difference always meets (see :mod:`arrivals_mart.llm.golay`).

**Join and verify.** Probes meet index rows on the key; pairs with at most
``max_bits`` differing bits become links. Fingerprints are deduplicated
first, so exact copies never make pairs. Where a key gathers more than
``bucket`` fingerprints, no pairs are made: those fingerprints are linked
through the 65 words within one bit of them, since two fingerprints are within
two bits exactly when they share such a word. A word is shared by at most 65
fingerprints, so the cost stays linear and nothing is dropped.

**Groups** are the connected components of the links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arrivals_mart.llm import golay
from arrivals_mart.llm.common import materialize, quoted, text_bytes
from arrivals_mart.llm.components import connected_components

SEED = 42
#: (shift, width) of the three segments.
SEGMENTS = ((42, 22), (21, 21), (0, 21))
#: A key with more fingerprints is linked through one-bit neighbours.
BUCKET = 64
_CHUNK = 1 << 16
_BYTE_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_PLACE = np.arange(8, dtype=np.int64) * 256


def fingerprint(text: bytes | None, shingle_words: int = 3) -> int:
    """64-bit fingerprint of one text, unsigned; 0 without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < shingle_words:
        words = [b" ".join(words)]
        grams = words
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle_words)), strict=False))
    n = len(words) if grams is words else len(words) - shingle_words + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64, n)
    seen = np.zeros(2048, np.int64)
    for at in range(0, n, _CHUNK):
        part = hashes[at : at + _CHUNK].view(np.uint8).reshape(-1, 8)
        seen += np.bincount((part + _PLACE).ravel(), minlength=2048)
    ones = (seen.reshape(8, 256) @ _BYTE_BITS).ravel()
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def _fingerprint_batches(shingle_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t, shingle_words) for t in text_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(np.array(prints, np.uint64).view(np.int64))],
                ["doc_id", "text_hash", "fp"],
            )

    return run


def fingerprints(docs: DataFrame, shingle_words: int = 3) -> DataFrame:
    """``(doc_id, text_hash, fp)`` of every row; ``fp`` is the signed form."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.xxhash64("text").alias("text_hash"),
    ).mapInArrow(_fingerprint_batches(shingle_words), "doc_id long, text_hash long, fp long")


def _key_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        signed = batch.column(0).to_numpy()
        bits = signed.view(np.uint64)
        parts = [((bits >> np.uint64(s)) & np.uint64((1 << w) - 1)).astype(np.int64) for s, w in SEGMENTS]
        for t in range(3):
            after = (t + 1) % 3
            head = (t << 40) | (parts[t] << 12)
            index = golay.nearby(parts[after], SEGMENTS[after][1])
            rows, columns = np.nonzero(index >= 0)
            keys = np.concatenate([head | golay.nearest(parts[after]), head[rows] | index[rows, columns]])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys),
                    pa.array(np.concatenate([signed, signed[rows]])),
                    pa.array(np.arange(len(keys)) < len(signed)),
                ],
                ["key", "fp", "probe"],
            )


def _neighbour_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    flips = np.concatenate([[0], np.uint64(1) << np.arange(64, dtype=np.uint64)]).astype(np.uint64)
    for batch in batches:
        signed = batch.column(0).to_numpy()
        words = (signed.view(np.uint64)[:, None] ^ flips).view(np.int64).ravel()
        yield pa.RecordBatch.from_arrays(
            [pa.array(words), pa.array(np.repeat(signed, len(flips)))], ["word", "fp"]
        )


def links(prints: DataFrame, max_bits: int = 2, bucket: int = BUCKET) -> DataFrame:
    """Edges ``(a, b)`` between distinct fingerprints ``fp`` such that their
    components are those of all pairs within ``max_bits`` (0 to 2) bits.

    Each edge is a pair within ``max_bits``; with ``max_bits`` below 2 no
    bucket is treated as crowded by way of neighbours two bits apart.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("the codeword keys hold for at most two differing bits")
    keys = prints.select("fp").mapInArrow(_key_batches, "key long, fp long, probe boolean")
    sizes = materialize(
        keys.groupBy("key").agg(F.count_if(~F.col("probe")).alias("n")).where("n > 1"), "simhash_buckets"
    )
    shared = materialize(keys.join(sizes, "key"), "simhash_keys")
    crowded = F.col("n") > bucket if max_bits == 2 else F.lit(False)
    small = shared.where(~crowded)
    probe = small.where("probe").select("key", F.col("fp").alias("a"))
    index = small.where(~F.col("probe")).select("key", F.col("fp").alias("b"))
    pairs = probe.join(index, "key").where(
        (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    )
    met = (
        shared.where(crowded)
        .select("fp")
        .distinct()
        .mapInArrow(_neighbour_batches, "word long, fp long")
        .groupBy("word")
        .agg(F.collect_set("fp").alias("near"))  # 65 at most
        .where(F.size("near") > 1)
        .select(F.array_min("near").alias("a"), F.explode("near").alias("b"))
        .where("a != b")
    )
    return pairs.select("a", "b").unionByName(met)


def simhash_clusters(docs: DataFrame, shingle_words: int = 3, max_bits: int = 2) -> DataFrame:
    """Near-duplicate groups of ``docs (doc_id, text)``.

    Returns one row per input row: ``doc_id``, ``text_hash`` (xxhash64 of the
    text), ``fp``, ``component_id`` (smallest ``doc_id`` of the group) and
    ``rep_hash`` (smallest ``text_hash`` of the group's rows with that id).

    Null, empty and blank texts have fingerprint 0 and are linked like any
    other. A null ``doc_id`` is never a group's id unless the group has no
    other. Repeated ids and rows each keep their row. Other columns are
    ignored; an empty table gives an empty result.
    """
    rows = materialize(fingerprints(docs, shingle_words), "simhash_rows")
    prints = materialize(
        rows.groupBy("fp").agg(
            F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_hash"))).alias("first"),
            F.min("text_hash").alias("any_hash"),
        ),
        "simhash_prints",
    )
    roots = connected_components(links(prints, max_bits), "a", "b")
    labelled = prints.join(roots, prints["fp"] == roots["node"], "left").select(
        "fp", "first", "any_hash", F.coalesce("root", "fp").alias("root")
    )
    groups = labelled.groupBy("root").agg(F.min("first").alias("g"), F.min("any_hash").alias("any_hash"))
    classes = materialize(
        labelled.select("fp", "root")
        .join(groups, "root")
        .select(
            "fp",
            F.col("g.doc_id").alias("component_id"),
            F.coalesce("g.text_hash", "any_hash").alias("rep_hash"),
        ),
        "simhash_groups",
    )
    return rows.join(classes, "fp").select("doc_id", "text_hash", "fp", "component_id", "rep_hash")


def keep_representatives(docs: DataFrame, shingle_words: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: that of the group's
    smallest ``doc_id`` (then smallest text hash; of equal rows any one). All
    columns are kept."""
    found = simhash_clusters(docs, shingle_words, max_bits)
    kept = (
        found.where(F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_hash") == F.col("rep_hash")))
        .select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
        .distinct()
    )
    wide = docs.withColumns({"__key_id": F.col("doc_id").cast("long"), "__key_hash": F.xxhash64("text")})
    one = wide.join(
        kept,
        F.col("__key_id").eqNullSafe(F.col("__id")) & (F.col("__key_hash") == F.col("__hash")),
        "left_semi",
    )
    # Rows that repeat id and text: one stays.
    order = Window.partitionBy("__key_id", "__key_hash").orderBy("__key_hash")
    return one.withColumn("__n", F.row_number().over(order)).where("__n = 1").select(*quoted(docs.columns))
