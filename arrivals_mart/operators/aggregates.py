"""Grouped means and the lookup of a grouped table by a code list.

Both run as partial aggregation in the scan tasks followed by a final
aggregation after the shuffle, so a key that holds a large share of the rows
costs one partial row per task, not a hot reducer. Means of fractional columns
are taken from decimal sums (:func:`exact_mean`), so that they do not depend on
the order in which partial sums meet.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

_NAME = "__lookup_name"
_CODE_NAME = "__code_name"
#: A value's first six decimal places, and what they leave over.
_DECIMAL = "decimal(28,6)"
_REST = "decimal(38,30)"


def exact_mean(column: str) -> Column:
    """Aggregate: mean of the values as the same double on every run, from
    the sums of their first six decimal places and of the rest. Where a value
    does not survive that unchanged (infinite, not a number, 1e22 or more, or
    digits past the thirtieth place) it is the plain ``avg``; nulls are
    ignored, no values give null."""
    value = F.col(column).cast("double")
    number = F.col(column).try_cast(_DECIMAL)
    rest = (value - number.cast("double")).try_cast(_REST)
    total, left = F.try_sum(number), F.try_sum(rest)
    whole = F.count(F.when(number.cast("double") + rest.cast("double") == value, True))
    fits = (whole == F.count(column)) & total.isNotNull() & left.isNotNull()
    return F.when(fits, F.try_divide(total.cast("double") + left.cast("double"), F.count(column))).otherwise(
        F.avg(column)
    )


def _means(df: DataFrame, means: Mapping[str, str]) -> list[Column]:
    fractional = {f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))}
    return [(exact_mean(src) if src in fractional else F.avg(src)).alias(out) for out, src in means.items()]


def group_means(
    df: DataFrame,
    key: str,
    means: Mapping[str, str],
    drop: Iterable[str] = (),
    distinct_rows: bool = True,
) -> DataFrame:
    """Per ``key``: the mean of each input column, named by ``means``
    (output name -> input column).

    ``drop`` removes columns first; with ``distinct_rows`` identical rows
    then count once (one row per city even when the input has one per city
    and race). Means are unweighted, ignore nulls and are null for a group
    without values; a null key is a group of its own.
    """
    base = df.drop(*drop)
    if distinct_rows:
        base = base.distinct()
    return base.groupBy(key).agg(*_means(base, means))


def lookup_means(
    codes: DataFrame,
    facts: DataFrame,
    code: str,
    code_name: str,
    fact_name: str,
    means: Mapping[str, str],
    out_code: str = "country_code",
    out_name: str = "country",
) -> DataFrame:
    """Codes with the means of the facts that carry the code's name.

    The facts are aggregated per name first (a derived table), then the code
    list is joined to it on the exact, case-sensitive name. Codes with no
    facts are not returned (see :func:`lookup_unmatched`).
    """
    grouped = facts.groupBy(F.col(fact_name).alias(_NAME)).agg(*_means(facts, means))
    code_list = codes.select(F.col(code).alias(out_code), F.col(code_name).alias(_CODE_NAME))
    # LEFT JOIN ... WHERE name IS NOT NULL: Catalyst turns it into an inner join.
    joined = code_list.join(grouped, F.col(_CODE_NAME) == F.col(_NAME), "left").where(F.col(_NAME).isNotNull())
    return joined.select(F.col(out_code), F.col(_NAME).alias(out_name), *[F.col(m) for m in means])


def lookup_unmatched(
    codes: DataFrame,
    facts: DataFrame,
    code_name: str,
    fact_name: str,
) -> DataFrame:
    """Rows of the code list whose name no fact carries.

    The facts are read once and shuffled as distinct names only; Spark
    broadcasts the smaller side if its measured size allows.
    """
    names = facts.select(F.col(fact_name).alias(_NAME)).where(F.col(_NAME).isNotNull()).distinct()
    return codes.join(names, codes[code_name] == names[_NAME], "left_anti")
