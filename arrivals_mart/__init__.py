"""Arrivals mart: a Spark-first star-schema builder.

Raw arrival records, airport codes, city demographics and city temperatures
become one fact table and six dimensions; every step is a DataFrame plan that
Catalyst optimises and Spark runs distributed. See README.md for the map from
the operator inventory to modules.
"""

from arrivals_mart import contracts
from arrivals_mart.session import build_session, scratch_path

__all__ = ["contracts", "build_session", "scratch_path"]
