"""File scans.

Declare the schema wherever it is known: inference costs an extra pass over
the input (a full one for CSV) and its result changes with the data. Paths are
any Hadoop URI or glob, so the same call reads local files and object stores.
"""

from __future__ import annotations

from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from arrivals_mart.operators.conform import conform


def read_parquet(spark: SparkSession, path: str | list[str], schema: StructType | None = None) -> DataFrame:
    """Parquet scan over one path, a glob such as ``in/sas_data/*.parquet``,
    or a list of them. With ``schema`` only the declared columns are read and
    their types are fixed; filters and projections push into the scan."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    paths = [path] if isinstance(path, str) else list(path)
    return reader.parquet(*paths)


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | None = None,
    sep: str = ",",
    header: bool = True,
    infer: bool = False,
    by_name: bool = False,
) -> DataFrame:
    """CSV scan. Cells that do not parse as their declared type become null
    (PERMISSIVE mode); a BOM and CRLF line ends are handled by the reader.
    ``infer=True`` without a schema samples the types (an extra pass).

    A schema applies by position, whatever the header says; with ``by_name``
    its columns are found by the header's names in any order (the first
    line is read for it), further columns are left out and a missing one is an error."""
    if by_name and schema is not None:
        names = spark.read.option("header", True).option("sep", sep).csv(path).columns
        missing = [f.name for f in schema.fields if f.name not in names]
        if missing:
            raise ValueError(f"{path}: missing columns {missing}")
        known = {f.name: f for f in schema.fields}
        in_file = StructType([known.get(n, StructField(n, StringType())) for n in names])
        return read_csv(spark, path, in_file, sep).select(*[f.name for f in schema.fields])
    reader = spark.read.option("header", header).option("sep", sep).option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def files_of(spark: SparkSession, path: str | list[str]) -> list[str]:
    """The files of a path, a glob or a list of them; no footer is read."""
    paths = [path] if isinstance(path, str) else list(path)
    # Any schema will do: it keeps Spark from looking for one.
    return sorted(spark.read.schema("path string").parquet(*paths).inputFiles())


def schema_groups(spark: SparkSession, files: list[str]) -> list[tuple[StructType, list[str]]]:
    """The files of a list, grouped so that the footers of a group agree.

    Footers are read and merged by Spark jobs over many files at once; a list whose footers do not
    merge (INT in one file, DOUBLE in another) is halved, so a few groups
    of files that lie together in path order take a few jobs each, whatever
    the number of files. Groups of the same schema are put together."""
    if not files:
        return []
    found: dict[str, tuple[StructType, list[str]]] = {}
    left = [files]
    while left:
        part = left.pop()
        try:
            schema = spark.read.option("mergeSchema", True).parquet(*part).schema
        except (PySparkException, Py4JJavaError) as error:
            if len(part) == 1 or "CANNOT_MERGE" not in str(error):
                raise
            left += [part[len(part) // 2 :], part[: len(part) // 2]]
            continue
        found.setdefault(schema.json(), (schema, []))[1].extend(part)
    return list(found.values())


def read_parquet_conformed(spark: SparkSession, path: str | list[str], target: StructType) -> DataFrame:
    """Parquet files whose footers may differ in order and types, as ``target``:
    each group of :func:`schema_groups` is converted on its own, then they are
    united. A column that a file lacks is an error. Files of one schema are
    one plain scan."""
    groups = schema_groups(spark, files_of(spark, path))
    if not groups:
        raise FileNotFoundError(f"{path}: no files")
    frames = [conform(read_parquet(spark, files, schema), target) for schema, files in groups]
    return reduce(DataFrame.unionByName, frames)


#: Column of a scan by :func:`read_csv_checked` that holds a row with a bad cell.
CORRUPT = "_corrupt_record"


def read_csv_checked(
    spark: SparkSession, path: str | list[str], schema: StructType, sep: str = ",", by_name: bool = False
) -> tuple[DataFrame, StructType]:
    """:func:`read_csv` with the text of each row that did not parse as a whole
    in :data:`CORRUPT`, and the schema of the file's columns."""
    in_file = schema
    if by_name:
        names = spark.read.option("header", True).option("sep", sep).csv(path).columns
        known = {f.name: f for f in schema.fields}
        missing = [n for n in known if n not in names]
        if missing:
            raise ValueError(f"{path}: missing columns {missing}")
        in_file = StructType([known.get(n, StructField(n, StringType())) for n in names])
    kept = StructType([*in_file.fields, StructField(CORRUPT, StringType())])
    reader = spark.read.option("header", True).option("sep", sep).option("mode", "PERMISSIVE")
    # A pruned scan does not see a wrong number of cells.
    reader = reader.option("columnPruning", False)
    return reader.option("columnNameOfCorruptRecord", CORRUPT).schema(kept).csv(path), in_file


def csv_losses(
    spark: SparkSession, path: str | list[str], schema: StructType, sep: str = ",", by_name: bool = False
) -> DataFrame:
    """What a CSV scan with ``schema`` loses: ``column_name, lost_values``.

    A row per column: cells that are there and did not parse as the declared type (they
    are null in the scan); and a row ``*``: lines with any bad
    cell or a wrong number of cells. One pass: a row is parsed once, and
    only a row that did not parse is taken apart again as text."""
    rows, in_file = read_csv_checked(spark, path, schema, sep, by_name)
    text = ", ".join(f"`{f.name}` string" for f in in_file.fields)
    raw = F.from_csv(F.col(CORRUPT), text, {"sep": sep, "mode": "PERMISSIVE"})
    rows = rows.withColumn("__raw", F.when(F.col(CORRUPT).isNotNull(), raw))
    names = [f.name for f in schema.fields]
    counts = rows.agg(
        *[
            F.count_if(F.col("__raw")[n].isNotNull() & F.col(f"`{n}`").isNull()).alias(n)
            for n in names
        ],
        F.count_if(F.col(CORRUPT).isNotNull()).alias("__rows"),
    )
    long = counts.unpivot([], [f"`{n}`" for n in [*names, "__rows"]], "column_name", "lost_values")
    return long.replace({"__rows": "*"}, subset=["column_name"])


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Make ``df`` visible to SQL text as ``name`` (replacing an older one)."""
    df.createOrReplaceTempView(name)
    return df


def preview(df: DataFrame, n: int = 5, truncate: bool = True) -> None:
    """Print the first ``n`` rows; only those rows are computed."""
    df.show(n, truncate=truncate)
