"""Star joins.

No side is hinted. Spark broadcasts a side whose bytes are known to be within
``spark.sql.autoBroadcastJoinThreshold`` (from the files of a written table, or
measured at run time by adaptive execution); beyond it the join is a shuffle
join whose skewed keys adaptive execution splits. The threshold is set once, in
``session.SESSION_DEFAULTS``; planning a join starts no job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def star_join(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, how: str = "inner") -> DataFrame:
    """``fact`` joined to ``dim`` on ``fact_key = dim_key``."""
    return fact.join(dim, fact[fact_key] == dim[dim_key], how)
