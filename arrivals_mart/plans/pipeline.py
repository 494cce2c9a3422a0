"""The whole run: read the five inputs, build the seven tables, stage them,
check them, publish them.

One Spark application; each table is one write job over lazily planned
inputs, and independent writes run at the same time. The arrivals are scanned
twice: for the codes of the dimensions, and for the fact. The checks (rows present,
key never null) are computed while each table is written (``DataFrame.observe`` in the writing stage), so even the
fact is never read a second time to be checked. Nothing is published unless
every table passes, so a failed run leaves the previous version readable,
and every run writes fresh version paths, so a rerun never doubles rows.
"""

from __future__ import annotations

import dataclasses
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from arrivals_mart.contracts import (
    AIRPORTS_INPUT,
    ARRIVALS_INPUT,
    COUNTRIES_INPUT,
    DEMOGRAPHICS_INPUT,
    IMMIG_FACT,
    MART,
    TEMPERATURES_INPUT,
    Contract,
)
from arrivals_mart.functions.columns import as_int, valid_day_number
from arrivals_mart.operators.aggregates import lookup_unmatched
from arrivals_mart.operators.quality import check_report, key_report, require_unique
from arrivals_mart.plans.tables import (
    airport_dimension,
    arrival_codes,
    build_fact,
    conversion_losses,
    country_dimension,
    demographics_dimension,
    fact_directories,
    time_dimension,
    travel_mode_dimension,
    visa_dimension,
)
from arrivals_mart.session import scratch_path
from arrivals_mart.sinks.enforce import write_enforced
from arrivals_mart.sinks.manifest import publish_manifest
from arrivals_mart.sinks.tables import (
    publish_set,
    read_table,
    remove_path,
    render_path,
    stage_path,
    write_table,
)
from arrivals_mart.sources.files import read_csv, read_parquet_conformed


@dataclass
class Inputs:
    """The raw inputs; one that no wanted table needs may be missing."""

    arrivals: DataFrame | None = None
    airports: DataFrame | None = None
    demographics: DataFrame | None = None
    temperatures: DataFrame | None = None
    countries: DataFrame | None = None


#: Each table: the inputs it is built from, and how.
BUILDERS: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = {
    "immig_fact": (("arrivals",), build_fact),
    "airport_dim": (("airports",), airport_dimension),
    "visa_type_dim": (("arrivals",), visa_dimension),
    "travel_mode_dim": (("arrivals",), travel_mode_dimension),
    "time_dim": (("arrivals",), time_dimension),
    "country_temperature_dim": (("countries", "temperatures"), country_dimension),
    "demographics_dim": (("demographics",), demographics_dimension),
}

#: Tables that :func:`arrival_codes` is enough for.
FROM_CODES = ("visa_type_dim", "travel_mode_dim", "time_dim")


def read_inputs(
    spark: SparkSession,
    root: str,
    arrivals: str = "sas_data/*.parquet",
    airports: str = "airport-codes_csv.csv",
    demographics: str = "us-cities-demographics.csv",
    temperatures: str = "GlobalLandTemperaturesByCity.csv",
    countries: str = "country_code.csv",
    params: dict | None = None,
    only: Iterable[str] | None = None,
) -> Inputs:
    """Scan the inputs below ``root`` (any Hadoop URI) and conform them to
    their declared schemas. ``root`` may be a template filled from ``params``
    (e.g. ``in/{ds}``).

    The arrivals are read with the types of their own Parquet footers, which
    may store numbers as integers or dates as numbers and differ from file to
    file, and converted; CSV
    columns are matched by header, but for the demographics, whose header
    differs from the declared names. A missing column is an error. With
    ``only``, the inputs named there are read and the others left out."""
    root = render_path(root, **(params or {})).rstrip("/")
    readers = {
        "arrivals": lambda: read_parquet_conformed(spark, f"{root}/{arrivals}", ARRIVALS_INPUT),
        "airports": lambda: read_csv(spark, f"{root}/{airports}", AIRPORTS_INPUT, by_name=True),
        "demographics": lambda: read_csv(spark, f"{root}/{demographics}", DEMOGRAPHICS_INPUT, sep=";"),
        "temperatures": lambda: read_csv(spark, f"{root}/{temperatures}", TEMPERATURES_INPUT, by_name=True),
        "countries": lambda: read_csv(spark, f"{root}/{countries}", COUNTRIES_INPUT, by_name=True),
    }
    return Inputs(**{name: readers[name]() for name in (readers if only is None else only)})


#: Tables whose builder leaves out rows without a key.
LEAVING_OUT = ("visa_type_dim", "time_dim", "airport_dim", "demographics_dim")


def build_table(name: str, inputs: Inputs, keep_null: bool = False) -> DataFrame:
    """One of the seven tables as a lazy DataFrame, from its own inputs;
    with ``keep_null`` including rows without a key."""
    needs, build = BUILDERS[name]
    how = {"keep_null": True} if keep_null and name in LEAVING_OUT else {}
    return build(*(getattr(inputs, n) for n in needs), **how)


def build_mart(inputs: Inputs) -> dict[str, DataFrame]:
    """The seven tables as lazy DataFrames, keyed by table name.

    The visa, travel mode and time dimensions each read one column of the raw
    arrivals (the scan is pruned to it); the fact is a projection of them.
    """
    return {name: build_table(name, inputs) for name in BUILDERS}


def build_candidates(inputs: Inputs) -> dict[str, DataFrame]:
    """The seven tables with the rows whose key is missing, for a write that
    enforces the contracts (``sinks.write_enforced``) or a report that counts them."""
    return {name: build_table(name, inputs, keep_null=True) for name in BUILDERS}


def left_out(inputs: Inputs) -> DataFrame:
    """``table_name, left_out``: input rows that no row of the table stands for.

    Arrivals without a usable visa code or day number, airports without a
    code, cities' rows without a state, country codes without temperatures. The
    fact and the travel modes take every row. One pass over the arrivals.
    """

    def counted(df: DataFrame, **conditions) -> DataFrame:
        counts = df.agg(*[F.count_if(c).alias(n) for n, c in conditions.items()])
        return counts.unpivot([], list(conditions), "table_name", "left_out")

    unmatched = lookup_unmatched(inputs.countries, inputs.temperatures, "country", "Country")
    parts = [
        counted(
            inputs.arrivals,
            immig_fact=F.lit(False),
            visa_type_dim=as_int("i94visa").isNull(),
            travel_mode_dim=F.lit(False),
            time_dim=valid_day_number("arrdate").isNull(),
        ),
        counted(inputs.airports, airport_dim=F.col("local_code").isNull()),
        counted(inputs.demographics, demographics_dim=F.col("stateCode").isNull()),
        counted(unmatched, country_temperature_dim=F.lit(True)),
    ]
    return reduce(DataFrame.unionByName, parts)


def run_report(inputs: Inputs, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """What a run would say about its data, one row per table: ``row_count``,
    ``null_keys``, ``duplicate_keys``, ``left_out`` (see :func:`left_out`) and
    ``lost_values`` (values of the fact's inputs that did not convert; 0 for
    the dimensions, whose unusable codes are left out).

    ``tables`` are the tables to look at (default: built from the inputs; a
    run passes the written ones)."""
    tables = tables or build_mart(inputs)
    keys = key_report({c.name: (tables[c.name], c.key[0]) for c in MART})
    lost = conversion_losses(inputs.arrivals).agg(
        F.lit("immig_fact").alias("table_name"), F.sum("lost_values").alias("lost")
    )
    return (
        keys.join(left_out(inputs), "table_name")
        .join(lost, "table_name", "left")
        .select(
            "table_name",
            "key_column",
            "row_count",
            "null_keys",
            "duplicate_keys",
            "left_out",
            F.coalesce("lost", F.lit(0)).alias("lost_values"),
        )
    )


@dataclass
class RunResult:
    paths: dict[str, str]
    report: list[Row]
    manifest: str | None = None


def stage_table(
    df: DataFrame, contract: Contract, output: str, directories: int | None = None, reject: bool = False
) -> tuple[str, Row]:
    """Write ``df`` to a fresh version path below ``output``; returns the path
    and the report row counted while it was written. With ``reject``, rows that
    break the contract go to a rejects table beside it (``sinks.write_enforced``)
    and are counted as ``rejected``."""
    version = stage_path(output, contract.name)
    named = {"table_name": contract.name, "key_column": contract.key[0]}
    if reject:
        done = write_enforced(df, version, contract, directories=directories)
        if not done.row_count:
            write_table(df.where(F.lit(False)), done.accepted_path, contract)
        return done.accepted_path, Row(**named, row_count=done.row_count, null_keys=0, rejected=done.rejected_count)
    observation = Observation(f"quality_{contract.name}")
    path = write_table(df, version, contract, observation=observation, directories=directories)
    metrics = observation.get
    return path, Row(**named, row_count=metrics["row_count"], null_keys=metrics["null_keys"])


def _write_all(spark: SparkSession, stage: Callable[[Contract], tuple[str, Row]]) -> list[tuple[str, Row]]:
    """``stage`` of all tables at the same time; if one fails, the jobs of the
    others are cancelled."""
    tag = f"arrivals_mart-{uuid.uuid4().hex}"

    def tagged(contract: Contract) -> tuple[str, Row]:
        spark.sparkContext.addJobTag(tag)
        try:
            return stage(contract)
        finally:
            spark.sparkContext.removeJobTag(tag)

    # The writes do not depend on each other: the dimensions use the cores
    # that the fact's last tasks leave idle.
    with ThreadPoolExecutor(max_workers=len(MART)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(tagged), contract) for contract in MART]
        done, _ = wait(running, return_when=FIRST_EXCEPTION)
        failed = [f for f in running if f in done and f.exception()]
        if failed:
            spark.sparkContext.cancelJobsWithTag(tag)
            raise failed[0].exception()
    return [f.result() for f in running]


def run_pipeline(
    spark: SparkSession,
    inputs: Inputs,
    output: str,
    publish_views: bool = True,
    params: dict | None = None,
    full_report: bool = False,
    unique: Iterable[str] = (),
    reject: bool = False,
    manifest: bool = True,
) -> RunResult:
    """Stage all seven tables below ``output``, check them, then publish them
    together. ``output`` may be a template filled from ``params``.

    The report has a row per table: ``row_count``, ``null_keys`` and ``left_out``
    (see :func:`left_out`), counted while the tables are written.

    Raises :class:`~arrivals_mart.operators.quality.QualityError` (and
    publishes nothing) when a table is empty or has a null key, or when a
    table named in ``unique`` repeats a key. With ``reject``, rows without a key
    go to a rejects table beside each table instead, and the report counts them
    as ``rejected``; it is an error only if no other row is left.
    ``full_report`` adds duplicate keys and lost values of all tables
    (:func:`run_report`) to the report: two passes over the arrivals, and the
    keys of the written tables.

    ``manifest`` publishes the set as one file below ``output`` for readers of any
    application (``sinks.open_set``), ``publish_views`` as views of this session's catalog.
    """
    output = render_path(output, **(params or {}))
    # One pass over the arrivals for the codes of three dimensions, the number
    # of the fact's directories and what the dimensions leave out; the fact's
    # write is the other.
    counted = Observation("arrivals")
    codes_path = scratch_path(spark, "arrival_codes")
    seen = inputs.arrivals.observe(
        counted,
        fact_directories(inputs.arrivals).alias("directories"),
        F.count_if(as_int("i94visa").isNull()).alias("visa_type_dim"),
        F.count_if(valid_day_number("arrdate").isNull()).alias("time_dim"),
    )
    others = {
        "airports": F.count_if(F.col("local_code").isNull()),
        "demographics": F.count_if(F.col("stateCode").isNull()),
        "countries": F.count(F.lit(1)),
    }
    watched = {name: Observation(name) for name in others}
    counting = {n: getattr(inputs, n).observe(watched[n], c.alias("n")) for n, c in others.items()}
    try:
        arrival_codes(seen).write.parquet(codes_path)
        whole = dataclasses.replace(inputs, **counting)
        codes = Inputs(arrivals=spark.read.parquet(codes_path))
        tables = {n: build_table(n, codes if n in FROM_CODES else whole, keep_null=reject) for n in BUILDERS}
        metrics = counted.get
        directories = {IMMIG_FACT.name: metrics["directories"]}

        def stage(contract: Contract) -> tuple[str, Row]:
            return stage_table(tables[contract.name], contract, output, directories.get(contract.name), reject)

        staged = _write_all(spark, stage)
    finally:
        remove_path(spark, codes_path)
    paths = {c.name: path for c, (path, _) in zip(MART, staged, strict=True)}
    rows = {c.name: row for c, (_, row) in zip(MART, staged, strict=True)}
    seen_rows = {n: w.get.get("n", 0) for n, w in watched.items()}
    out = {n: metrics[n] for n in ("visa_type_dim", "time_dim")} | {
        "airport_dim": seen_rows["airports"],
        "demographics_dim": seen_rows["demographics"],
        # A code has the mean of one name at most.
        "country_temperature_dim": seen_rows["countries"] - rows["country_temperature_dim"].row_count,
    }
    report = [Row(**row.asDict(), left_out=out.get(name, 0)) for name, row in rows.items()]
    check_report(report)
    unique = set(unique)
    written = {c.name: read_table(spark, paths[c.name], c) for c in MART}
    if full_report:
        report = run_report(inputs, written).collect()  # a row per table
        require_unique(report, unique)
    elif unique:
        keys = {c.name: (written[c.name], c.key[0]) for c in MART if c.name in unique}
        require_unique(key_report(keys).collect(), unique)
    if publish_views:
        publish_set(spark, [(c, paths[c.name], c.name) for c in MART])
    name = publish_manifest(spark, output, paths).name if manifest else None
    return RunResult(paths=paths, report=report, manifest=name)
