"""Dimension builders: code lists, calendar days, reference lists.

Each dimension is a DISTINCT over a few columns of a possibly huge input.
Spark plans it as a partial aggregate in every scan task (so a hot code is
collapsed before the shuffle) and a final aggregate after a shuffle that only
carries the distinct keys. The key is made distinct first and the derived
columns are computed afterwards, so the shuffle carries one INT.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivals_mart.functions.columns import (
    SAS_EPOCH,
    as_int,
    as_text,
    calendar_columns,
    day_number_to_date,
    trimmed,
    valid_day_number,
)
from arrivals_mart.functions.labels import code_label


def code_dimension(
    df: DataFrame,
    code: str,
    key: str,
    label: str,
    labels: Mapping[int, str],
    default: str,
    null_key: int | None = None,
    keep_null: bool = False,
) -> DataFrame:
    """Distinct INT codes of ``code`` with their label.

    A null code becomes ``null_key`` when one is given (filled *before* the
    DISTINCT, so 0 and null together give one row); otherwise rows without a
    code are left out, since a dimension key may not be null (``keep_null``
    keeps them as one row, for a write that rejects it by name).
    """
    k = as_int(code)
    if null_key is not None:
        k = F.coalesce(k, F.lit(null_key))
    keys = df.select(k.alias(key)).distinct()
    if not keep_null:
        keys = keys.where(F.col(key).isNotNull())
    return keys.select(F.col(key), code_label(F.col(key), labels, default).alias(label))


def code_dimension_from_table(
    df: DataFrame,
    code: str,
    key: str,
    label: str,
    labels: DataFrame,
    label_code: str,
    label_name: str,
    default: str | None,
    null_key: int | None = None,
) -> DataFrame:
    """:func:`code_dimension` with its labels in a table of any length.

    The distinct codes are joined (left) to ``labels (label_code, label_name)``
    and codes without a label, or with a null one, get ``default``: the ELSE of
    the CASE. A code that ``labels`` repeats has its least label. Spark
    broadcasts the smaller side within its byte threshold.
    """
    k = as_int(code)
    if null_key is not None:
        k = F.coalesce(k, F.lit(null_key))
    keys = df.select(k.alias(key)).where(F.col(key).isNotNull()).distinct()
    told = labels.select(as_int(label_code).alias("__code"), as_text(label_name).alias("__label"))
    told = told.where(F.col("__code").isNotNull()).groupBy("__code").agg(F.min("__label").alias("__label"))
    joined = keys.join(told, F.col(key) == F.col("__code"), "left")
    return joined.select(F.col(key), F.coalesce("__label", F.lit(default)).alias(label))


def date_dimension(
    df: DataFrame,
    day_number: str,
    key: str = "arrival_sas",
    date_name: str = "arrival_date",
    epoch: _dt.date = SAS_EPOCH,
    keep_null: bool = False,
) -> DataFrame:
    """One row per distinct day number: the date and its calendar parts.
    Day numbers that are missing or name no representable date are left out
    (``keep_null``: they are one row with a null key)."""
    keys = df.select(valid_day_number(day_number, epoch).alias(key)).distinct()
    if not keep_null:
        keys = keys.where(F.col(key).isNotNull())
    dated = keys.select(F.col(key), day_number_to_date(F.col(key), epoch).alias(date_name))
    parts = calendar_columns(F.col(date_name))
    return dated.select(F.col(key), F.col(date_name), *[c.alias(n) for n, c in parts.items()])


def reference_dimension(
    df: DataFrame,
    columns: Sequence[tuple[str, str, bool]],
    required: str | None,
) -> DataFrame:
    """Rows of a reference list that carry ``required`` (None: all rows),
    projected and made distinct over all output columns.

    ``columns`` holds ``(output name, input column, trim?)``; untrimmed
    columns are cast to text. A key may still repeat when other columns
    differ; the quality report shows it.
    """
    cols = [(trimmed(src) if trim else as_text(src)).alias(out) for out, src, trim in columns]
    if required is not None:
        df = df.where(F.col(required).isNotNull())
    return df.select(*cols).distinct()
