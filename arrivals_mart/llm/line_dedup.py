"""Removal of lines that many sites share.

A line (between newlines) is boilerplate if it stands on ``min_sites``
different sites or more; blank lines never are. Each line is hashed, and a
HyperLogLog sketch of its sites is aggregated per hash: partial sketches merge
in the map tasks and again after the shuffle, so a line that stands in a third of
all documents costs one small sketch per task. Lines whose estimate lies
within ``MARGIN`` standard errors of the threshold, or within one site of it,
get an exact count of distinct sites; the others are decided by the sketch.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrivals_mart.llm.common import materialize, quoted

MIN_SITES = 8
#: Sketch size: 2^12 registers, a standard error of about 1.6 %.
LG_K = 12
MARGIN = 4.0
_ERROR = 1.04 / 2 ** (LG_K / 2)


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _line_key(line: Column) -> Column:
    return F.xxhash64(line)


def _keep_marks(places: str) -> Column:
    """Of sorted 0-based ``places``, an array that is false there and true at
    the places between and before: one look for each line of the text, where a
    search of the list would be quadratic in its lines."""
    before = F.concat(F.array(F.lit(-1)), F.slice(F.col(places), 1, F.size(places) - 1))
    gaps = F.zip_with(
        before, F.col(places), lambda a, b: F.concat(F.array_repeat(F.lit(True), b - a - 1), F.array(F.lit(False)))
    )
    return F.flatten(gaps)


def boilerplate_lines(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """Hashes (``line``) of ``lines (line, site)`` that stand on ``min_sites``
    sites or more; a null site is a site of its own."""
    site = F.coalesce(F.concat(F.lit("s"), F.col("site").cast("string")), F.lit("-"))
    estimated = (
        lines.groupBy("line")
        .agg(F.hll_sketch_agg(site, F.lit(LG_K)).alias("sketch"))
        .select("line", F.hll_sketch_estimate("sketch").alias("sites"))
    )
    band = max(1.0, MARGIN * _ERROR * min_sites)
    candidates = materialize(estimated.where(F.col("sites") >= min_sites - band), "line_candidates")
    near = candidates.where(F.col("sites") <= min_sites + band).select("line")
    exact = (
        lines.join(near, "line", "left_semi")
        .select("line", site.alias("site"))
        .distinct()
        .groupBy("line")
        .agg(F.count(F.lit(1)).alias("sites"))
        .where(F.col("sites") >= min_sites)
        .select("line")
    )
    return candidates.where(F.col("sites") > min_sites + band).select("line").unionByName(exact)


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, site: str = "source") -> DataFrame:
    """``docs (text, <site>, ...)`` with shared lines removed from ``text``, and
    ``n_lines`` and ``n_removed`` of each row.

    A null text stays null with 0 lines; an empty text has one blank line. If
    all lines go the text is empty. Repeated rows, null ids and other columns
    pass through; input columns named like the outputs are replaced; an empty
    table gives an empty result. Texts of any length are read whole; the work
    is linear in their lines.
    """
    docs = docs.drop("n_lines", "n_removed")
    lines = materialize(
        # The text is hashed before it is split: once, not once a line.
        docs.select(F.col(site).alias("site"), F.xxhash64("text").alias("text_key"), _lines(F.col("text")).alias("ls"))
        .select("site", "text_key", F.posexplode("ls").alias("at", "l"))
        .where(F.trim("l") != "")
        .select("site", "text_key", "at", _line_key(F.col("l")).alias("line"))
        .distinct(),
        "lines",
    )
    shared = materialize(boilerplate_lines(lines.select("line", "site"), min_sites), "boilerplate")
    bad = (
        lines.join(shared, "line")
        .groupBy(F.col("text_key").alias("__key"))
        .agg(F.sort_array(F.collect_set("at")).alias("__at"))  # places in one text
    )
    marks = materialize(bad.select("__key", _keep_marks("__at").alias("__keep")), "boilerplate_of_text")
    # Past the last removed line there is no mark.
    kept = F.filter(_lines(F.col("text")), lambda x, i: F.coalesce(F.get("__keep", i), F.lit(True)))
    n_lines = F.coalesce(F.size(_lines(F.col("text"))), F.lit(0))
    found = F.col("__keep").isNotNull()
    # A merge join at every size: how many texts have such a line is not bounded.
    joined = docs.join(marks.hint("merge"), F.xxhash64("text") == F.col("__key"), "left")
    return (
        joined.withColumn("__kept", F.when(found, kept))
        .withColumns(
            {
                "n_lines": F.when(F.col("text").isNull(), 0).otherwise(n_lines),
                "n_removed": F.when(found, n_lines - F.size("__kept")).otherwise(0),
                "text": F.when(found, F.array_join("__kept", "\n")).otherwise(F.col("text")),
            }
        )
        .select(*quoted(docs.columns), "n_lines", "n_removed")
    )
