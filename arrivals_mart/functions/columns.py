"""Typed casts and date helpers.

Spark 4 runs with ANSI mode on: a plain CAST of NaN, of an out-of-range
number or of a malformed date string raises. Raw arrival files contain all
of those, so every conversion here is the ``try_`` form, which yields null.
"""

from __future__ import annotations

import calendar
import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType

# Day numbers in the arrival files count days from this date.
SAS_EPOCH = _dt.date(1960, 1, 1)

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_int(c: ColumnOrName) -> Column:
    """DOUBLE/STRING to INT, truncating toward zero; NaN or overflow -> null."""
    return _col(c).try_cast("int")


def as_double(c: ColumnOrName) -> Column:
    return _col(c).try_cast("double")


def as_text(c: ColumnOrName) -> Column:
    """Any value as STRING (DOUBLE 93.0 becomes '93.0')."""
    return _col(c).cast("string")


def trimmed(c: ColumnOrName) -> Column:
    """Strip leading and trailing spaces (not tabs) of the value as text."""
    return F.trim(as_text(c))


def char_date(c: ColumnOrName, fmt: str = "yyyyMMdd", source_type: DataType | None = None) -> Column:
    """Parse a character date such as '20160430'; anything else -> null.

    A numeric source (20160430.0) is first turned into its digits through
    BIGINT, since its plain text form would be '2.016043E7'.
    """
    col = _col(c)
    if isinstance(source_type, NumericType):
        col = col.try_cast("bigint")
    return F.try_to_date(col.cast("string"), fmt)


def day_number_range(epoch: _dt.date = SAS_EPOCH) -> tuple[int, int]:
    """Day numbers whose date lies in 0001-01-01 .. 9999-12-31, the dates
    Spark represents; beyond them date arithmetic and formatting fail."""
    return (_dt.date.min - epoch).days, (_dt.date.max - epoch).days


def day_number(day: _dt.date, epoch: _dt.date = SAS_EPOCH) -> int:
    """The day number of a date: the inverse of :func:`day_number_to_date`."""
    return (day - epoch).days


def period_days(year: int, month: int | None = None, epoch: _dt.date = SAS_EPOCH) -> tuple[int, int]:
    """First and last day number of a year, or of one of its months."""
    first = _dt.date(year, month or 1, 1)
    last_month = month or 12
    last = _dt.date(year, last_month, calendar.monthrange(year, last_month)[1])
    return day_number(first, epoch), day_number(last, epoch)


def valid_day_number(c: ColumnOrName, epoch: _dt.date = SAS_EPOCH) -> Column:
    """The day number as INT, or null when it is missing, not a number, or
    names a date outside the representable range (a corrupt value must not
    fail the whole job)."""
    lo, hi = day_number_range(epoch)
    n = as_int(c)
    return F.when(n.between(lo, hi), n)


def day_number_to_date(c: ColumnOrName, epoch: _dt.date = SAS_EPOCH) -> Column:
    """A day count (INT) from ``epoch`` as a DATE; the epoch literal folds."""
    return F.date_add(F.lit(epoch), _col(c))


def calendar_columns(d: ColumnOrName) -> dict[str, Column]:
    """day, month, year (INT) and the abbreviated weekday (Mon..Sun)."""
    d = _col(d)
    return {
        "day": F.dayofmonth(d),
        "month": F.month(d),
        "year": F.year(d),
        "weekday": F.date_format(d, "E"),
    }
