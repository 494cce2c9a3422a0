"""A corpus pipeline of five of the corpus operators.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame that is written as Parquet and read again as
the next stage's ``docs``. All but the last return the columns of
``documents`` (and any further columns untouched); the last adds ``shard`` and
``slot``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivals_mart.llm import decontaminate, language_id, mixing, sharding, simhash_dedup
from arrivals_mart.llm.common import materialize, quoted, table


#: Columns that operators read; others are set aside while an operator adds its own.
_READ = ("doc_id", "text", "lang", "source")


def _set_aside(docs: DataFrame) -> DataFrame:
    return docs.toDF(*[c if c in _READ else f"__kept_{c}" for c in docs.columns])


def _bring_back(found: DataFrame, columns: list[str]) -> DataFrame:
    held = quoted([c if c in _READ else f"__kept_{c}" for c in columns])
    return found.select(*[c.alias(name) for c, name in zip(held, columns, strict=True)])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without a letter go.

    Which language it is, and how sure, rejects no document. Without a labelled
    row to learn from, texts with a letter stay as well.
    """
    model = language_id.train(docs.where(~language_id.held_out()))
    if not model.families:
        return docs.where(language_id.with_letter(F.col("text")))
    found = language_id.identify(_set_aside(docs), model)
    return _bring_back(found.where(F.col("lang_pred") != language_id.UNDETERMINED), docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return simhash_dedup.keep_representatives(docs, shingle_words=3, max_bits=2)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return _bring_back(mixing.take_copies(mixing.mix(_set_aside(docs))), docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard (of 8, near equal in bytes) and slot."""
    return sharding.histogram_shards(docs, 8)


STAGES = [
    ("language_id", identify_language),
    ("simhash_dedup", drop_near_duplicates),
    ("decontaminate", decontaminate_benchmark),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: Fingerprint links, alignments and random copies have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
