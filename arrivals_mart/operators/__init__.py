"""Relational operators of the mart, each a composition of DataFrame calls."""

from arrivals_mart.operators.aggregates import group_means, lookup_means, lookup_unmatched
from arrivals_mart.operators.conform import (
    conform,
    contract_mismatches,
    fill_null_codes,
    require_contract,
)
from arrivals_mart.operators.dimensions import (
    code_dimension,
    code_dimension_from_table,
    date_dimension,
    reference_dimension,
)
from arrivals_mart.operators.joins import (
    star_join,
)
from arrivals_mart.operators.quality import (
    QualityError,
    check_report,
    key_duplicates,
    key_report,
    quality_report,
    require_quality,
    require_unique,
)

__all__ = [
    "group_means",
    "lookup_means",
    "lookup_unmatched",
    "conform",
    "contract_mismatches",
    "fill_null_codes",
    "require_contract",
    "code_dimension",
    "code_dimension_from_table",
    "date_dimension",
    "reference_dimension",
    "star_join",
    "QualityError",
    "check_report",
    "key_duplicates",
    "key_report",
    "quality_report",
    "require_quality",
    "require_unique",
]
