"""Code -> label mapping as one CASE expression."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The visa category codes and their labels; any other code is
# a student visa.
VISA_LABELS: dict[int, str] = {1: "Business", 2: "Pleasure"}
VISA_DEFAULT = "Student"

# The travel mode codes and their labels; any other code
# (including 0, the filled-in null) is undefined.
TRAVEL_MODE_LABELS: dict[int, str] = {1: "Air", 2: "Sea", 3: "Land", 9: "Not reported"}
TRAVEL_MODE_DEFAULT = "Undefined"


def code_label(code: Column, labels: Mapping[int, str], default: str | None) -> Column:
    """``CASE code WHEN k THEN label ... ELSE default END``.

    Meant for short fixed lists; a long code list is a table, joined by code
    (``operators.code_dimension_from_table``).
    """
    expr = None
    for value, label in labels.items():
        cond = code == F.lit(value)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))
