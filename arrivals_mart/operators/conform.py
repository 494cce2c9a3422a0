"""Schema conformance: order, names and types of a table.

``conform`` turns any frame that has the contract's columns into exactly the
contract (order and types, with null for values that do not convert);
``contract_mismatches`` reports how a frame differs from it without touching
any data (schemas only).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from arrivals_mart.contracts import Contract


def _schema_of(target: Contract | StructType) -> StructType:
    return target.schema if isinstance(target, Contract) else target


def conform(df: DataFrame, target: Contract | StructType, extra: Iterable[str] = ()) -> DataFrame:
    """Select the target's columns in order, converting types with try_cast.

    ``extra`` names further columns to keep after the contract's (partition
    sources such as ``i94_month``). A missing column is an error.
    """
    schema = _schema_of(target)
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in schema.fields if f.name not in have]
    if missing:
        raise ValueError(f"cannot conform: missing columns {missing}")
    cols = []
    for f in schema.fields:
        col = F.col(f.name)
        if have[f.name] != f.dataType:
            col = col.try_cast(f.dataType)
        cols.append(col.alias(f.name))
    cols.extend(F.col(name) for name in extra)
    return df.select(*cols)


def contract_mismatches(df: DataFrame, target: Contract | StructType) -> list[dict]:
    """One entry per differing position: name, expected and actual type."""
    schema = _schema_of(target)
    actual = df.schema.fields
    out = []
    for pos in range(max(len(schema.fields), len(actual))):
        exp = schema.fields[pos] if pos < len(schema.fields) else None
        act = actual[pos] if pos < len(actual) else None
        exp_sig = (exp.name, exp.dataType.simpleString()) if exp else (None, None)
        act_sig = (act.name, act.dataType.simpleString()) if act else (None, None)
        if exp_sig != act_sig:
            out.append(
                {
                    "position": pos + 1,
                    "expected_column": exp_sig[0],
                    "expected_type": exp_sig[1],
                    "actual_column": act_sig[0],
                    "actual_type": act_sig[1],
                }
            )
    return out


def require_contract(df: DataFrame, target: Contract | StructType) -> DataFrame:
    """Raise ValueError unless ``df`` has exactly the target's columns."""
    bad = contract_mismatches(df, target)
    if bad:
        name = target.name if isinstance(target, Contract) else "schema"
        raise ValueError(f"{name} does not match its contract: {bad}")
    return df


def fill_null_codes(df: DataFrame, value: int, columns: Iterable[str]) -> DataFrame:
    """Replace nulls in the named numeric columns by ``value``."""
    return df.na.fill(value, subset=list(columns))
