"""Registered queries of the corpus operators, with their oracles.

Each query runs one operator over its whole table with production parameters;
columns that a query adds are digests of the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from arrivals_mart.llm import (
    bpe,
    chat_format,
    decontaminate,
    embedding_dedup,
    language_id,
    line_dedup,
    mixing,
    sharding,
    simhash_dedup,
    suffix_dedup,
    token_alignment,
    token_counts,
    whitening,
)
from arrivals_mart.llm.common import table


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of 50 words or more that other documents hold too."""
    return suffix_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs.where(~language_id.held_out()))
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = sharding.histogram_shards(table(spark, sf_dir, "documents"), 8)
    return sharded.select(
        "doc_id",
        sharding.text_size(F.col("text")).alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_clusters(table(spark, sf_dir, "embeddings"))


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.simhash_clusters(table(spark, sf_dir, "documents"), shingle_words=3, max_bits=2)
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, a row per item found."""
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.remove_boilerplate(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_removed", F.md5(F.col("text").cast("binary")).alias("clean_md5"))


#: A conversation whose texts try to close their turns.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["conv_id", "turn", "role", "text"]
    schema = StructType(
        [StructField("conv_id", LongType()), StructField("turn", LongType())]
        + [StructField(c, StringType()) for c in columns[2:]]
    )
    extra = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)], schema)
    turns = table(spark, sf_dir, "conversations").select(*columns).unionByName(extra)
    formatted = chat_format.format_conversations(turns)
    told = F.array_join(
        F.transform(
            chat_format.read_turns(F.col("formatted")),
            lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")),
        ),
        "",
    )
    read = formatted.withColumns(
        {"told": told, "loss_text": chat_format.read_loss_text(F.col("segments"))}
    )
    return read.select(
        "conv_id",
        "n_turns",
        F.sha2(F.col("told").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("words"))
    mixed = mixing.mix(sized, F.col("words"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = bpe.decode(bpe.encode(table(spark, sf_dir, "documents")))
    told = F.array_join(F.col("ids").cast("array<string>"), ",")
    return tokens.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(told.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = whitening.whole_vectors(table(spark, sf_dir, "embeddings"))
    model = whitening.fit_whitening(vectors)
    error = whitening.identity_error(vectors, model)
    rows = whitening.whiten(vectors, model).select("vec_id", "deviation", F.posexplode("whitened"))
    shares = [] if model is None else [float(e / model.trace) for e in model.values]
    return rows.select(
        "vec_id",
        (F.col("pos") + 1).cast("int").alias("component"),
        F.lit(model.n if model else 0).cast("long").alias("n"),
        F.col("deviation").try_cast("long").alias("deviation"),
        F.col("col").alias("whitened"),
        F.get(F.array(*[F.lit(x) for x in shares]).cast("array<double>"), F.col("pos")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = token_alignment.align(table(spark, sf_dir, "documents"))
    digest = F.when(F.col("n_a") == 0, F.lit("")).otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    aligned = aligned.withColumn("groups_sha256", digest).drop("groups")
    found = token_alignment.with_counts(aligned, token_alignment.vocabulary_size())
    return found.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "pipeline": corpus_pipeline.run,
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_language_id": op2_language_id,
    "op3_sharding": op3_sharding,
    "op4_token_counts": op4_token_counts,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_simhash_dedup": op6_simhash_dedup,
    "op7_decontaminate": op7_decontaminate,
    "op8_line_dedup": op8_line_dedup,
    "op9_chat_format": op9_chat_format,
    "op10_mixing": op10_mixing,
    "op11_bpe": op11_bpe,
    "op12_whitening": op12_whitening,
    "op13_token_alignment": op13_token_alignment,
}

LINE_SQL = f"""
WITH l AS (
  SELECT DISTINCT coalesce('s' || source, '-') AS site, unnest(string_split(text, chr(10))) AS line FROM documents
),
b AS (
  SELECT list(line) AS bad FROM (
    SELECT line FROM l WHERE trim(line, ' ') <> '' GROUP BY line HAVING count(*) >= {line_dedup.MIN_SITES})
),
d AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS ls,
         [x FOR x IN string_split(text, chr(10)) IF NOT coalesce(list_contains(bad, x), false)] AS kept
  FROM documents, b
)
SELECT doc_id,
       CAST(coalesce(len(ls), 0) AS INTEGER) AS n_lines,
       CAST(coalesce(len(ls) - len(kept), 0) AS INTEGER) AS n_removed,
       CASE WHEN text IS NULL THEN NULL ELSE md5(coalesce(array_to_string(kept, chr(10)), '')) END AS clean_md5
FROM d"""


def _escaped_sql(text: str) -> str:
    out = f"replace({text}, '\\', '\\\\')"
    for c in chat_format.TEMPLATE.control:
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return out


_MARKS = len(chat_format.TEMPLATE.start) + len(chat_format.TEMPLATE.end) + 1
CHAT_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{CONTROL_TEXT}'
  UNION ALL SELECT -1, 1, 'assistant', '{CONTROL_TEXT}'
),
s AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before FROM t
),
c AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS told,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss_text,
         sum({_MARKS} + length(role) + length({_escaped_sql("text")})) AS chars,
         bool_and(CASE WHEN before IS NULL THEN role IN ('system', 'user')
                       WHEN before IN ('system', 'assistant') THEN role = 'user'
                       WHEN before = 'user' THEN role = 'assistant'
                       ELSE false END) AS valid
  FROM s GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(told) AS turns_sha256, CAST(length(loss_text) AS BIGINT) AS loss_chars,
       sha256(loss_text) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars, valid
FROM c"""

ORACLES: dict[str, str] = {
    "op8_line_dedup": LINE_SQL,
    "op9_chat_format": CHAT_SQL,
}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
