"""Operators for preparing training corpora, each a Spark job of its own.

Nothing else in the library imports this subpackage. Conventions shared by
all modules:

* An operator takes and returns DataFrames; what it must keep between jobs it
  writes as Parquet below the shared scratch folder (``spark.checkpoint.dir``),
  so lost executors cost a re-read and never the lineage.
* Internal columns start with ``__``. An output column replaces an input
  column of the same name; other extra columns pass through untouched.
* Executors only ever hold one Arrow batch or one bounded group at a time.
"""
