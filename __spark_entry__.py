"""

Every query reads the benchmark tables of ``sf_dir`` (whole tables, no
subsets), derives the reference-shaped inputs from them
(``arrivals_mart.plans.driver``) and runs one mart operator on them. The
matching oracle is the same computation written as plain DuckDB SQL over the
same tables; column names agree pairwise.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.types import (  # noqa: E402
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from arrivals_mart.contracts import (  # noqa: E402
    AIRPORT_DIM,
    ARRIVALS_INPUT,
    AIRPORTS_INPUT,
    COUNTRIES_INPUT,
    COUNTRY_TEMPERATURE_DIM,
    DEMOGRAPHICS_INPUT,
    IMMIG_FACT,
    MART,
    TEMPERATURES_INPUT,
)
from arrivals_mart.functions.columns import char_date, day_number_range  # noqa: E402
from arrivals_mart.operators import (  # noqa: E402
    code_dimension_from_table,
    conform,
    contract_mismatches,
    group_means,
    key_duplicates,
    lookup_unmatched,
    quality_report,
)
from arrivals_mart.plans import (  # noqa: E402
    airport_dimension,
    arrivals_by_airport_month,
    arrivals_country_temperature,
    arrivals_state_population,
    build_candidates,
    build_fact,
    build_table,
    conversion_losses,
    country_dimension,
    demographics_dimension,
    labelled_arrivals,
    read_inputs,
    run_pipeline,
    run_report,
    stage_table,
    time_dimension,
    travel_mode_dimension,
    visa_dimension,
)
from arrivals_mart.plans import driver as D  # noqa: E402
from arrivals_mart.plans.tables import DEMOGRAPHIC_MEANS, fact_directories  # noqa: E402
from arrivals_mart.session import scratch_path  # noqa: E402
from arrivals_mart.sinks import (  # noqa: E402
    append_load,
    compact_loads,
    count_rejects,
    expire_versions,
    load_by_position,
    materialize,
    open_set,
    read_accepted,
    read_rejects,
    read_table,
    refresh_table,
    render_path,
    stage_path,
    write_bucketed,
    write_enforced,
    write_table,
)
from arrivals_mart.sources import (  # noqa: E402
    csv_losses,
    read_csv,
    read_parquet,
    read_parquet_conformed,
    register_view,
)
from arrivals_mart.streaming import STREAMED_FACT, load_fact_incrementally  # noqa: E402

# The corpus operators are an optional part: without them (or the pipeline over
# them) the other queries stand alone. Any other import error is raised.
try:
    from arrivals_mart.llm.queries import ORACLES as LLM_ORACLES  # noqa: E402
    from arrivals_mart.llm.queries import QUERIES as LLM_QUERIES  # noqa: E402
except ModuleNotFoundError as error:
    if not (error.name or "").startswith(("arrivals_mart.llm", "corpus_pipeline")):
        raise
    LLM_QUERIES, LLM_ORACLES = {}, {}

SMOKE_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: arrivals per airport and month on sf0.001."""
    return q_arrivals_by_port_month(spark, SMOKE_DIR)


# ------------------------------------------------------------- helpers ---


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return D.table(spark, sf_dir, name)


def _arrivals(spark, sf_dir):
    return D.arrivals_from_lineitem(_t(spark, sf_dir, "lineitem"))


def _airports(spark, sf_dir):
    return D.airports_from_supplier(_t(spark, sf_dir, "supplier"))


def _countries(spark, sf_dir):
    return D.countries_from_nation(_t(spark, sf_dir, "nation"))


def _temperatures(spark, sf_dir):
    return D.temperatures_from_customer(_t(spark, sf_dir, "customer"), _t(spark, sf_dir, "nation"))


def _demographics(spark, sf_dir):
    return D.demographics_from_orders(_t(spark, sf_dir, "orders"), _t(spark, sf_dir, "customer"))


def _order_dates(spark, sf_dir, bad: bool) -> DataFrame:
    orders = _t(spark, sf_dir, "orders")
    text = F.date_format(F.col("o_orderdate"), "yyyyMMdd")
    if bad:
        text = F.when(F.col("o_orderkey") % 10 == 0, F.lit("D/S")).otherwise(text)
    return orders.select("o_orderkey", text.alias("date_text")).select(
        "o_orderkey", "date_text", char_date("date_text").alias("parsed_date")
    )


# ------------------------------------------------------------- queries ---
#
# The questions read their dimensions as written tables (``materialize``),
# as they do over the published mart: each dimension is computed once, and
# its size check reads the small written table.


def q_conform_fact(spark, sf_dir):
    return build_fact(_arrivals(spark, sf_dir))


def q_parse_char_date(spark, sf_dir):
    return _order_dates(spark, sf_dir, bad=False)


def q_parse_char_date_bad(spark, sf_dir):
    return _order_dates(spark, sf_dir, bad=True)


def q_conversion_losses(spark, sf_dir):
    return conversion_losses(_arrivals(spark, sf_dir))


def q_null_fill_code(spark, sf_dir):
    return build_fact(_arrivals(spark, sf_dir)).select("cicid", "travel_mode_id")


def q_code_dim_two_labels(spark, sf_dir):
    return visa_dimension(_arrivals(spark, sf_dir))


def q_code_dim_null_zero(spark, sf_dir):
    return travel_mode_dimension(_arrivals(spark, sf_dir))


def q_date_dim(spark, sf_dir):
    return time_dimension(_arrivals(spark, sf_dir))


def q_reference_dim(spark, sf_dir):
    return airport_dimension(_airports(spark, sf_dir))


def q_group_means(spark, sf_dir):
    return group_means(_demographics(spark, sf_dir), "stateCode", DEMOGRAPHIC_MEANS, drop=("race", "count"))


def q_demographics_dim(spark, sf_dir):
    return demographics_dimension(_demographics(spark, sf_dir))


def q_lookup_means(spark, sf_dir):
    return country_dimension(_countries(spark, sf_dir), _temperatures(spark, sf_dir))


def q_lookup_unmatched(spark, sf_dir):
    return lookup_unmatched(_countries(spark, sf_dir), _temperatures(spark, sf_dir), "country", "Country")


def q_arrivals_by_port_month(spark, sf_dir):
    arrivals = _arrivals(spark, sf_dir)
    return arrivals_by_airport_month(
        build_fact(arrivals),
        materialize(time_dimension(arrivals), "time_dim"),
        materialize(airport_dimension(_airports(spark, sf_dir)), "airport_dim"),
    )


def _country_dim(spark, sf_dir):
    return materialize(country_dimension(_countries(spark, sf_dir), _temperatures(spark, sf_dir)), "country_dim")


def q_arrivals_country_mean(spark, sf_dir):
    return arrivals_country_temperature(build_fact(_arrivals(spark, sf_dir)), _country_dim(spark, sf_dir))


def q_arrivals_citizen_country_mean(spark, sf_dir):
    return arrivals_country_temperature(
        build_fact(_arrivals(spark, sf_dir)), _country_dim(spark, sf_dir), by="i94_citizen"
    )


def q_fact_key_duplicates(spark, sf_dir):
    return key_duplicates(build_fact(_arrivals(spark, sf_dir)), ["cicid"])


def q_key_repeats_across_loads(spark, sf_dir):
    """The fact added in two loads (even and odd arrival days): key values that
    repeat in a load or in one before it."""
    contract = replace(IMMIG_FACT, partition_by={})
    fact = build_fact(_arrivals(spark, sf_dir))
    odd = F.coalesce(F.pmod("i94_arrival_date", F.lit(2)), F.lit(0)) == 1
    root = scratch_path(spark, "fact_loads")
    loads = [append_load(spark, fact.where(part), root, contract, unique=False).repeats for part in (~odd, odd)]
    return reduce(
        DataFrame.unionByName, [r.select(F.lit(i).alias("load_no"), "*") for i, r in enumerate(loads, start=1)]
    )


def q_arrivals_state_mean(spark, sf_dir):
    return arrivals_state_population(
        build_fact(_arrivals(spark, sf_dir)),
        materialize(demographics_dimension(_demographics(spark, sf_dir)), "demographics_dim"),
    )


def q_labelled_arrivals(spark, sf_dir):
    arrivals = _arrivals(spark, sf_dir)
    return labelled_arrivals(
        build_fact(arrivals),
        materialize(visa_dimension(arrivals), "visa_type_dim"),
        materialize(travel_mode_dimension(arrivals), "travel_mode_dim"),
        materialize(time_dimension(arrivals), "time_dim"),
    )


def q_csv_semicolon_scan(spark, sf_dir):
    path = scratch_path(spark, "demographics_csv")
    (
        _demographics(spark, sf_dir)
        .write.option("sep", ";")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return read_csv(spark, path, DEMOGRAPHICS_INPUT, sep=";")


def q_csv_infer_scan(spark, sf_dir):
    path = scratch_path(spark, "airports_csv")
    (
        _airports(spark, sf_dir)
        .write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return airport_dimension(read_csv(spark, path, infer=True))


LINEITEM_SCHEMA = StructType(
    [
        StructField("l_orderkey", LongType()),
        StructField("l_partkey", LongType()),
        StructField("l_suppkey", LongType()),
        StructField("l_linenumber", IntegerType()),
        StructField("l_quantity", DoubleType()),
        StructField("l_extendedprice", DoubleType()),
        StructField("l_discount", DoubleType()),
        StructField("l_tax", DoubleType()),
        StructField("l_returnflag", StringType()),
        StructField("l_linestatus", StringType()),
        StructField("l_shipdate", TimestampNTZType()),
    ]
)


def q_csv_reordered_scan(spark, sf_dir):
    """Columns in another order than declared, and one more, matched by header."""
    path = scratch_path(spark, "countries_csv")
    countries = _countries(spark, sf_dir)
    countries.select("country", F.length("country").alias("note"), "country_code").write.option("header", True).csv(path)
    return read_csv(spark, path, COUNTRIES_INPUT, by_name=True)


def q_arrivals_typed_input(spark, sf_dir):
    """The fact from arrivals that store numbers as integers and a date as a number."""
    path = scratch_path(spark, "typed_arrivals")
    numbers = ("cicid", "i94mode", "i94visa", "i94cit", "dtaddto")
    stored = _arrivals(spark, sf_dir)
    stored.select(
        *[F.col(c).cast("bigint").alias(c) if c in numbers else F.col(c) for c in reversed(stored.columns)]
    ).write.parquet(path)
    return build_fact(conform(read_parquet(spark, path), ARRIVALS_INPUT))


def q_view_sql_scan(spark, sf_dir):
    """SQL text over a registered view."""
    register_view(_airports(spark, sf_dir), "airports_view")
    return spark.sql(
        "SELECT trim(local_code) AS airport_code, type AS airport_type, count(*) AS n "
        "FROM airports_view WHERE local_code IS NOT NULL GROUP BY trim(local_code), type"
    )


def q_parquet_glob_scan(spark, sf_dir):
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/lineite*.parquet", LINEITEM_SCHEMA)


def q_partitioned_write_read(spark, sf_dir):
    arrivals = _arrivals(spark, sf_dir)
    directories = arrivals.agg(fact_directories(arrivals)).first()[0]
    path = scratch_path(spark, "immig_fact")
    write_table(build_fact(arrivals), path, IMMIG_FACT, directories=directories)
    return read_table(spark, path, IMMIG_FACT)


def q_templated_run_paths(spark, sf_dir):
    """Input and output roots as templates: the countries are read below one and
    their table is staged below the other."""
    params = {"ds": "2016-04", "root": scratch_path(spark, "templated")}
    root = render_path("{root}/in/{ds}", **params)
    _countries(spark, sf_dir).write.option("header", True).csv(f"{root}/country_code.csv")
    temperatures = _temperatures(spark, sf_dir)
    temperatures.write.option("header", True).csv(f"{root}/GlobalLandTemperaturesByCity.csv")
    inputs = read_inputs(spark, "{root}/in/{ds}", params=params, only=("countries", "temperatures"))
    dim = build_table(COUNTRY_TEMPERATURE_DIM.name, inputs)
    path, _ = stage_table(dim, COUNTRY_TEMPERATURE_DIM, render_path("{root}/out/{ds}", **params))
    return read_table(spark, path, COUNTRY_TEMPERATURE_DIM)


def q_contract_check(spark, sf_dir):
    """Per table, as built (with the rows that have no key) and with its columns in
    reverse: columns that differ from the contract in name, order or type, and rows
    whose key is null against it."""
    tables = build_candidates(D.driver_inputs(spark, sf_dir))

    def checked(c, frame, columns):
        return tables[c.name].agg(
            F.lit(c.name).alias("table_name"),
            F.lit(frame).alias("frame"),
            F.lit(len(contract_mismatches(tables[c.name].select(*columns), c))).alias("mismatches"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(F.col(c.key[0]).isNull()).alias("null_keys"),
        )

    parts = [checked(c, "as built", c.columns) for c in MART]
    parts += [checked(c, "reversed", list(reversed(c.columns))) for c in MART]
    return reduce(DataFrame.unionByName, parts)


def q_rejected_rows(spark, sf_dir):
    """What contract-enforcing writes of the seven tables accept, and what they reject and why.

    The tables come with the rows that have no key, and the fact's key as text
    that is missing for one travel mode and no number for one age."""
    tables = build_candidates(D.driver_inputs(spark, sf_dir))
    key = F.col("cicid").cast("string")
    drifted = F.when(F.col("travel_mode_id") != 9, F.when(F.col("i94_age") == 50, F.concat(F.lit("no "), key)).otherwise(key))
    tables["immig_fact"] = tables["immig_fact"].withColumn("cicid", drifted)
    parts = []
    for c in MART:
        written = write_enforced(tables[c.name], scratch_path(spark, f"enforced_{c.name}"), c, partition_by={})
        rejects = count_rejects(read_rejects(spark, written, c))
        accepted = read_accepted(spark, written, c).agg(
            F.lit("accepted").alias("reason"), F.count(F.lit(1)).alias("rejected")
        )
        parts.append(rejects.unionByName(accepted).select(F.lit(c.name).alias("table_name"), "reason", F.col("rejected").alias("row_count")))
    return reduce(DataFrame.unionByName, parts)


def q_bucketed_arrivals_by_port_month(spark, sf_dir):
    """Question 1 over the fact in buckets of port and day: no exchange of the fact."""
    arrivals = _arrivals(spark, sf_dir)
    path = scratch_path(spark, "bucketed_fact")
    name = "bucketed_fact_" + path.rsplit("-", 1)[-1]
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    write_bucketed(build_fact(arrivals), name, path, IMMIG_FACT, buckets)
    return arrivals_by_airport_month(
        spark.table(name),
        materialize(time_dimension(arrivals), "time_dim"),
        materialize(airport_dimension(_airports(spark, sf_dir)), "airport_dim"),
    )


def q_arrivals_one_month(spark, sf_dir):
    """Question 1 for one month of the written fact, whose files are sorted by day."""
    arrivals = _arrivals(spark, sf_dir)
    path = write_table(build_fact(arrivals), scratch_path(spark, "fact_by_day"), IMMIG_FACT, partition_by={})
    return arrivals_by_airport_month(
        read_parquet(spark, path, IMMIG_FACT.schema),
        materialize(time_dimension(arrivals), "time_dim"),
        materialize(airport_dimension(_airports(spark, sf_dir)), "airport_dim"),
        year=1995,
        month=3,
    )


def q_publish_set_read(spark, sf_dir):
    """Rows per table as a reader resolves them from the newest manifest: of the run
    that is published, not of a later version that is staged only."""
    root = scratch_path(spark, "published")
    run_pipeline(spark, D.driver_inputs(spark, sf_dir), root, publish_views=False)
    airports = airport_dimension(_airports(spark, sf_dir))
    write_table(airports.where(F.lit(False)), stage_path(root, AIRPORT_DIM.name), AIRPORT_DIM)
    found = open_set(spark, root)
    counts = [df.agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("row_count")) for n, df in found.items()]
    return reduce(DataFrame.unionByName, counts)


def q_arrivals_mixed_footers(spark, sf_dir):
    """The fact from a folder whose files store ``cicid`` as INT, BIGINT and DOUBLE."""
    path = scratch_path(spark, "mixed_arrivals")
    stored = _arrivals(spark, sf_dir)
    for i, kind in enumerate(("int", "bigint", "double")):
        part = stored.where(F.pmod(F.col("cicid").cast("bigint"), F.lit(3)) == i)
        part.withColumn("cicid", F.col("cicid").cast(kind)).write.parquet(f"{path}/{kind}")
    return build_fact(read_parquet_conformed(spark, f"{path}/*/*.parquet", ARRIVALS_INPUT))


def q_csv_losses(spark, sf_dir):
    """Cells of the four CSV inputs that do not parse, per input and column."""
    root = scratch_path(spark, "csv_losses")
    text = lambda c, bad, word: F.when(bad, F.lit(word)).otherwise(F.col(c).cast("string"))
    files = {
        "airports": (
            _airports(spark, sf_dir).withColumn("elevation_ft", text("elevation_ft", F.col("elevation_ft") > 5000, "high")),
            AIRPORTS_INPUT, ",", True,
        ),
        "countries": (
            _countries(spark, sf_dir).withColumn("country_code", text("country_code", F.col("country_code") % 5 == 0, "C0")),
            COUNTRIES_INPUT, ",", True,
        ),
        "demographics": (
            _demographics(spark, sf_dir)
            .withColumn("medianAge", text("medianAge", F.col("medianAge") > 75, "old"))
            .withColumn("noOfVeterans", text("noOfVeterans", F.col("noOfVeterans").isNull(), "none")),
            DEMOGRAPHICS_INPUT, ";", False,
        ),
        "temperatures": (
            _temperatures(spark, sf_dir).withColumn(
                "AverageTemperature", text("AverageTemperature", F.col("City").endswith("1"), "n/a")
            ),
            TEMPERATURES_INPUT, ",", True,
        ),
    }
    parts = []
    for name, (df, schema, sep, by_name) in files.items():
        df.write.option("header", True).option("sep", sep).csv(f"{root}/{name}")
        lost = csv_losses(spark, f"{root}/{name}", schema, sep, by_name)
        parts.append(lost.select(F.lit(name).alias("input_name"), "column_name", "lost_values"))
    return reduce(DataFrame.unionByName, parts)


def q_positional_load(spark, sf_dir):
    """A catalog table filled twice by column position, under other names; the second load replaces the first."""
    path = scratch_path(spark, "positional")
    name = "airports_" + path.rsplit("-", 1)[-1]
    read_table(spark, write_table(airport_dimension(_airports(spark, sf_dir)).where(F.lit(False)), path, AIRPORT_DIM))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in AIRPORT_DIM.schema.fields)
    spark.sql(f"CREATE TABLE `{name}` ({columns}) USING parquet LOCATION '{path}'")
    renamed = airport_dimension(_airports(spark, sf_dir)).toDF(*[f"c{i}" for i in range(len(AIRPORT_DIM.columns))])
    for _ in range(2):
        load_by_position(renamed, name)
    return spark.table(name)


def q_label_table_dim(spark, sf_dir):
    """Citizenship codes labelled from a code list of any length, with a default for the codes it lacks."""
    labels = _countries(spark, sf_dir).where("country_code < 20")
    return code_dimension_from_table(
        _arrivals(spark, sf_dir), "i94cit", "country_code", "country", labels, "country_code", "country", "Not listed"
    )


def q_refresh_twice(spark, sf_dir):
    root = scratch_path(spark, "refresh")
    view = "airport_dim_" + root.rsplit("-", 1)[-1]
    for _ in range(2):
        refresh_table(spark, airport_dimension(_airports(spark, sf_dir)), root, AIRPORT_DIM, view=view)
    return spark.table(view)


def q_refresh_then_expire(spark, sf_dir):
    """Three versions, of which the newest stays."""
    root = scratch_path(spark, "expire")
    view = "airport_dim_" + root.rsplit("-", 1)[-1]
    for _ in range(3):
        refresh_table(spark, airport_dimension(_airports(spark, sf_dir)), root, AIRPORT_DIM, view=view)
    expire_versions(spark, root, view, keep=1)
    return spark.read.parquet(f"{root}/{view}/*")


def q_append_twice(spark, sf_dir):
    path = scratch_path(spark, "append")
    for _ in range(2):
        write_table(airport_dimension(_airports(spark, sf_dir)), path, AIRPORT_DIM, mode="append")
    return read_table(spark, path, AIRPORT_DIM)


def q_quality_report(spark, sf_dir):
    """Rows and null keys of the tables with the rows that have no key."""
    mart = build_candidates(D.driver_inputs(spark, sf_dir))
    return quality_report({c.name: (mart[c.name], c.key[0]) for c in MART})


def q_run_report(spark, sf_dir):
    """Rows, null and repeated keys, rows left out and lost values per table."""
    return run_report(D.driver_inputs(spark, sf_dir))


def q_key_duplicates(spark, sf_dir):
    return key_duplicates(_t(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_mart_row_counts(spark, sf_dir):
    """Rows per table of a full run, as counted while the tables were
    written (the run fails before publishing if a check fails)."""
    result = run_pipeline(
        spark, D.driver_inputs(spark, sf_dir), scratch_path(spark, "mart"), publish_views=False
    )
    return spark.createDataFrame(
        [(r.table_name, r.row_count) for r in result.report], "table_name string, row_count bigint"
    )


def q_stream_fact(spark, sf_dir):
    out = scratch_path(spark, "stream_fact")
    load_fact_incrementally(
        spark,
        f"{sf_dir.rstrip('/')}/lineite*.parquet",
        LINEITEM_SCHEMA,
        out,
        checkpoint=scratch_path(spark, "stream_fact_checkpoint"),
        prepare=D.arrivals_from_lineitem,
    )
    return read_table(spark, out, STREAMED_FACT).drop("load_batch")


def q_stream_compacted(spark, sf_dir):
    """The fact streamed in several loads, then rewritten as one."""
    source, out = scratch_path(spark, "stream_source"), scratch_path(spark, "stream_loads")
    _t(spark, sf_dir, "lineitem").repartition(2).write.parquet(source)
    load_fact_incrementally(
        spark,
        source,
        LINEITEM_SCHEMA,
        out,
        checkpoint=scratch_path(spark, "stream_loads_checkpoint"),
        prepare=D.arrivals_from_lineitem,
        max_files_per_trigger=1,
    )
    target = compact_loads(spark, out, scratch_path(spark, "stream_compacted"), STREAMED_FACT)
    return read_table(spark, target, STREAMED_FACT)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "conform_fact": q_conform_fact,
    "parse_char_date": q_parse_char_date,
    "parse_char_date_bad": q_parse_char_date_bad,
    "null_fill_code": q_null_fill_code,
    "conversion_losses": q_conversion_losses,
    "code_dim_two_labels": q_code_dim_two_labels,
    "code_dim_null_zero": q_code_dim_null_zero,
    "date_dim": q_date_dim,
    "reference_dim": q_reference_dim,
    "group_means": q_group_means,
    "demographics_dim": q_demographics_dim,
    "lookup_means": q_lookup_means,
    "lookup_unmatched": q_lookup_unmatched,
    "arrivals_by_port_month": q_arrivals_by_port_month,
    "arrivals_country_mean": q_arrivals_country_mean,
    "arrivals_citizen_country_mean": q_arrivals_citizen_country_mean,
    "arrivals_state_mean": q_arrivals_state_mean,
    "labelled_arrivals": q_labelled_arrivals,
    "csv_semicolon_scan": q_csv_semicolon_scan,
    "csv_infer_scan": q_csv_infer_scan,
    "csv_reordered_scan": q_csv_reordered_scan,
    "arrivals_typed_input": q_arrivals_typed_input,
    "view_sql_scan": q_view_sql_scan,
    "parquet_glob_scan": q_parquet_glob_scan,
    "partitioned_write_read": q_partitioned_write_read,
    "templated_run_paths": q_templated_run_paths,
    "contract_check": q_contract_check,
    "rejected_rows": q_rejected_rows,
    "bucketed_arrivals_by_port_month": q_bucketed_arrivals_by_port_month,
    "arrivals_one_month": q_arrivals_one_month,
    "publish_set_read": q_publish_set_read,
    "arrivals_mixed_footers": q_arrivals_mixed_footers,
    "csv_losses": q_csv_losses,
    "positional_load": q_positional_load,
    "label_table_dim": q_label_table_dim,
    "refresh_twice": q_refresh_twice,
    "refresh_then_expire": q_refresh_then_expire,
    "append_twice": q_append_twice,
    "quality_report": q_quality_report,
    "run_report": q_run_report,
    "key_duplicates": q_key_duplicates,
    "fact_key_duplicates": q_fact_key_duplicates,
    "key_repeats_across_loads": q_key_repeats_across_loads,
    "mart_row_counts": q_mart_row_counts,
    "stream_fact": q_stream_fact,
    "stream_compacted": q_stream_compacted,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return QUERIES | LLM_QUERIES


# -------------------------------------------------------------- oracles ---

_DAY_RANGE = day_number_range()
_DAY_NO = "CAST(date_diff('day', DATE '1960-01-01', CAST(l_shipdate AS DATE)) AS DOUBLE)"

ARRIVALS_SQL = f"""
arrivals AS (
  SELECT
    CAST(l_orderkey * 8 + l_linenumber AS DOUBLE) AS cicid,
    CAST(year(l_shipdate) AS DOUBLE) AS i94yr,
    CAST(month(l_shipdate) AS DOUBLE) AS i94mon,
    CAST(l_partkey % 25 AS DOUBLE) AS i94cit,
    CAST(l_suppkey % 25 AS DOUBLE) AS i94res,
    '  P' || CAST(l_suppkey AS VARCHAR) || ' ' AS i94port,
    {_DAY_NO} + l_discount AS arrdate,
    CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber = 6 THEN CAST(9 AS DOUBLE)
         ELSE CAST(l_linenumber - 1 AS DOUBLE) END AS i94mode,
    CASE WHEN l_partkey % 30 = 29 THEN NULL ELSE 'S' || CAST(l_partkey % 30 AS VARCHAR) END AS i94addr,
    ({_DAY_NO} + l_discount) + l_quantity AS depdate,
    l_quantity AS i94bir,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_linenumber % 4 AS DOUBLE) END AS i94visa,
    CAST(1 AS DOUBLE) AS "count",
    CASE WHEN l_orderkey % 10 = 0 THEN 'D/S' ELSE strftime(l_shipdate, '%Y%m%d') END AS dtadfile,
    l_returnflag AS visapost,
    l_linestatus AS occup,
    l_returnflag AS entdepa,
    l_linestatus AS entdepd,
    CASE WHEN l_linenumber = 1 THEN 'U' END AS entdepu,
    CASE WHEN l_linestatus = 'F' THEN 'M' END AS matflag,
    CAST(year(l_shipdate) AS DOUBLE) - l_quantity AS biryear,
    strftime(CAST(l_shipdate AS DATE) + 90, '%Y%m%d') AS dtaddto,
    CASE WHEN l_linenumber % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
    CAST(l_partkey AS VARCHAR) AS insnum,
    'A' || CAST(l_suppkey % 10 AS VARCHAR) AS airline,
    CAST(l_orderkey AS DOUBLE) * CAST(100000 AS DOUBLE) + l_partkey AS admnum,
    CAST(l_partkey % 1000 AS VARCHAR) AS fltno,
    CASE WHEN l_linenumber % 4 = 1 THEN 'B1' WHEN l_linenumber % 4 = 2 THEN 'B2' ELSE 'F1' END AS visatype
  FROM lineitem
)"""


def _int(x: str) -> str:
    """Spark's try_cast(double AS int) truncates; DuckDB's cast rounds."""
    return f"TRY_CAST(trunc({x}) AS INTEGER)"


# Fact column -> (source column, DuckDB conversion); travel mode before its fill.
FACT_SQL_COLUMNS: dict[str, tuple[str, str]] = {
    "cicid": ("cicid", _int("cicid")),
    "i94_port": ("i94port", "trim(i94port)"),
    "i94_citizen": ("i94cit", _int("i94cit")),
    "i94_resident": ("i94res", _int("i94res")),
    "i94_arrival_date": ("arrdate", _int("arrdate")),
    "travel_mode_id": ("i94mode", _int("i94mode")),
    "state_code": ("i94addr", "i94addr"),
    "i94_departure_date": ("depdate", _int("depdate")),
    "i94_age": ("i94bir", _int("i94bir")),
    "visa_category_id": ("i94visa", _int("i94visa")),
    "i94_date_added": ("dtadfile", "CAST(try_strptime(dtadfile, '%Y%m%d') AS DATE)"),
    "i94_date_admitted": ("dtaddto", "CAST(try_strptime(dtaddto, '%Y%m%d') AS DATE)"),
    "i94_occupation": ("occup", "occup"),
    "i94_arrival_flag": ("entdepa", "entdepa"),
    "i94_departure_flag": ("entdepd", "entdepd"),
    "i94_update_flag": ("entdepu", "entdepu"),
    "i94_match_flag": ("matflag", "matflag"),
    "i94_birth_year": ("biryear", _int("biryear")),
    "i94_gender": ("gender", "gender"),
    "i94_insnum": ("insnum", "insnum"),
    "i94_airline": ("airline", "airline"),
    "i94_admission_number": ("admnum", "admnum"),
    "i94_flight_number": ("fltno", "fltno"),
    "i94_visa_type": ("visatype", "visatype"),
    "i94_month": ("i94mon", _int("i94mon")),
}

FACT_SQL = (
    "\nfact AS (\n  SELECT\n    "
    + ",\n    ".join(
        f"{'coalesce(' + expr + ', 0)' if name == 'travel_mode_id' else expr} AS {name}"
        for name, (_, expr) in FACT_SQL_COLUMNS.items()
    )
    + "\n  FROM arrivals\n)"
)

FACT_COLUMNS = ", ".join(IMMIG_FACT.columns)

VISA_SQL = f"""
visa_type_dim AS (
  SELECT k AS visa_category_id,
         CASE k WHEN 1 THEN 'Business' WHEN 2 THEN 'Pleasure' ELSE 'Student' END AS visa_type
  FROM (SELECT DISTINCT {_int('i94visa')} AS k FROM arrivals) WHERE k IS NOT NULL
)"""

MODE_SQL = f"""
travel_mode_dim AS (
  SELECT k AS travel_mode_id,
         CASE k WHEN 1 THEN 'Air' WHEN 2 THEN 'Sea' WHEN 3 THEN 'Land' WHEN 9 THEN 'Not reported'
                ELSE 'Undefined' END AS travel_mode
  FROM (SELECT DISTINCT coalesce({_int('i94mode')}, 0) AS k FROM arrivals)
)"""

TIME_SQL = f"""
time_dim AS (
  SELECT k AS arrival_sas,
         DATE '1960-01-01' + k AS arrival_date,
         CAST(day(DATE '1960-01-01' + k) AS INTEGER) AS day,
         CAST(month(DATE '1960-01-01' + k) AS INTEGER) AS month,
         CAST(year(DATE '1960-01-01' + k) AS INTEGER) AS year,
         strftime(DATE '1960-01-01' + k, '%a') AS weekday
  FROM (SELECT DISTINCT {_int('arrdate')} AS k FROM arrivals)
  WHERE k BETWEEN {_DAY_RANGE[0]} AND {_DAY_RANGE[1]}
)"""

AIRPORTS_SQL = """
airports AS (
  SELECT
    'ID' || CAST(s_suppkey AS VARCHAR) AS ident,
    CASE WHEN s_suppkey % 3 = 0 THEN 'small_airport' WHEN s_suppkey % 3 = 1 THEN 'heliport'
         ELSE 'large_airport' END AS type,
    '  ' || s_name || ' ' AS name,
    TRY_CAST(trunc(s_acctbal) AS INTEGER) AS elevation_ft,
    'NA' AS continent,
    'N' || CAST(s_nationkey AS VARCHAR) AS iso_country,
    'N' || CAST(s_nationkey AS VARCHAR) || '-' || CAST(s_suppkey % 5 AS VARCHAR) AS iso_region,
    ' City ' || CAST(s_nationkey AS VARCHAR) AS municipality,
    'G' || CAST(s_suppkey AS VARCHAR) AS gps_code,
    CAST(NULL AS VARCHAR) AS iata_code,
    CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE ' P' || CAST(s_suppkey AS VARCHAR) || '  ' END AS local_code,
    CAST(s_nationkey AS VARCHAR) || ', ' || CAST(s_suppkey AS VARCHAR) AS coordinates
  FROM supplier
)"""

AIRPORT_DIM_SQL = """
airport_dim AS (
  SELECT DISTINCT
    trim(local_code) AS airport_code,
    trim(iata_code) AS iata_code,
    trim(name) AS airport_name,
    trim(type) AS airport_type,
    trim(iso_region) AS region,
    trim(iso_country) AS country_code,
    trim(municipality) AS municipality,
    trim(gps_code) AS gps_code,
    CAST(coordinates AS VARCHAR) AS coordinates
  FROM airports WHERE local_code IS NOT NULL
)"""

COUNTRIES_SQL = """
countries AS (SELECT CAST(n_nationkey AS INTEGER) AS country_code, n_name AS country FROM nation)"""

TEMPERATURES_SQL = """
temperatures AS (
  SELECT
    CAST(NULL AS DATE) AS dt,
    CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_acctbal END AS AverageTemperature,
    CAST(c_custkey % 7 AS DOUBLE) / 4 AS AverageTemperatureUncertainty,
    c_name AS City,
    CASE WHEN n_regionkey = 4 THEN lower(n_name) ELSE n_name END AS Country,
    CAST(NULL AS VARCHAR) AS Latitude,
    CAST(NULL AS VARCHAR) AS Longitude
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""

COUNTRY_DIM_SQL = """
country_dim AS (
  SELECT c.country_code AS country_code,
         t.Country AS country,
         t.avg_country_temperature AS avg_country_temperature,
         t.avg_country_temperature_uncertainty AS avg_country_temperature_uncertainty
  FROM countries c
  JOIN (SELECT Country,
               CAST(sum(CAST(AverageTemperature AS DECIMAL(28,6))) AS DOUBLE) / count(AverageTemperature)
                 AS avg_country_temperature,
               avg(AverageTemperatureUncertainty) AS avg_country_temperature_uncertainty
        FROM temperatures GROUP BY Country) t
    ON t.Country = c.country
)"""

DEMOGRAPHICS_SQL = """
demographics AS (
  SELECT
    c_name AS city,
    'STATE_' || CAST(c_nationkey AS VARCHAR) AS state,
    CAST(c_custkey % 60 AS DOUBLE) + 20.5 AS medianAge,
    CAST(c_custkey % 5000 AS INTEGER) AS malePopulation,
    CAST((c_custkey * 3) % 4001 AS INTEGER) AS femalePopulation,
    CAST(c_custkey % 5000 AS INTEGER) + CAST((c_custkey * 3) % 4001 AS INTEGER) AS totalPopulation,
    CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE CAST(c_custkey % 100 AS INTEGER) END AS noOfVeterans,
    CAST(c_nationkey * 10 AS INTEGER) AS foreignBorn,
    CAST(c_custkey % 5 AS DOUBLE) / 2 + 1.0 AS averageHouseHoldSize,
    CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE 'S' || CAST(c_nationkey AS VARCHAR) END AS stateCode,
    o_orderpriority AS race,
    CAST(o_orderkey % 1000 AS INTEGER) AS "count"
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""

GROUP_MEANS_SQL = """
group_means AS (
  SELECT stateCode,
         avg(medianAge) AS average_median_age,
         avg(malePopulation) AS average_male_population,
         avg(femalePopulation) AS average_female_population,
         avg(totalPopulation) AS average_total_population,
         avg(noOfVeterans) AS average_no_of_veterans,
         avg(foreignBorn) AS average_foreign_born,
         avg(averageHouseHoldSize) AS average_house_hold_size
  FROM (SELECT DISTINCT city, state, medianAge, malePopulation, femalePopulation, totalPopulation,
                        noOfVeterans, foreignBorn, averageHouseHoldSize, stateCode
        FROM demographics)
  GROUP BY stateCode
)"""

DEMOGRAPHICS_DIM_SQL = """
demographics_dim AS (SELECT * FROM group_means WHERE stateCode IS NOT NULL)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


MART_SQL = _with(
    ARRIVALS_SQL,
    FACT_SQL,
    VISA_SQL,
    MODE_SQL,
    TIME_SQL,
    AIRPORTS_SQL,
    AIRPORT_DIM_SQL,
    COUNTRIES_SQL,
    TEMPERATURES_SQL,
    COUNTRY_DIM_SQL,
    DEMOGRAPHICS_SQL,
    GROUP_MEANS_SQL,
    DEMOGRAPHICS_DIM_SQL,
)

_KEYS = {c.name: c.key[0] for c in MART}
# CTE of MART_SQL that holds each table.
_CTE = {"immig_fact": "fact", "country_temperature_dim": "country_dim"}
# Tables with the rows that have no key.
CANDIDATES_SQL = MART_SQL.rstrip() + f""",
visa_all AS (SELECT DISTINCT {_int('i94visa')} AS visa_category_id FROM arrivals),
time_all AS (
  SELECT DISTINCT CASE WHEN {_int('arrdate')} BETWEEN {_DAY_RANGE[0]} AND {_DAY_RANGE[1]} THEN {_int('arrdate')} END
    AS arrival_sas
  FROM arrivals
),
airport_all AS (
  SELECT DISTINCT trim(local_code) AS airport_code, trim(iata_code), trim(name), trim(type), trim(iso_region),
                  trim(iso_country), trim(municipality), trim(gps_code), coordinates
  FROM airports
)
"""
_ALL = _CTE | {
    "visa_type_dim": "visa_all",
    "time_dim": "time_all",
    "airport_dim": "airport_all",
    "demographics_dim": "group_means",
}
QUALITY_SQL = CANDIDATES_SQL + "\nUNION ALL\n".join(
    f"SELECT '{name}' AS table_name, '{key}' AS key_column, count(*) AS row_count, "
    f"count(*) FILTER (WHERE {key} IS NULL) AS null_keys FROM {_ALL.get(name, name)}"
    for name, key in _KEYS.items()
)
# Reversed, every position differs but the one in the middle.
_REVERSED = {"immig_fact": 24, "airport_dim": 8, "visa_type_dim": 2, "travel_mode_dim": 2, "time_dim": 6,
             "country_temperature_dim": 4, "demographics_dim": 8}
CONTRACT_SQL = CANDIDATES_SQL + "\nUNION ALL\n".join(
    f"SELECT '{name}' AS table_name, '{frame}' AS frame, CAST({n} AS INTEGER) AS mismatches, count(*) AS row_count, "
    f"count(*) FILTER (WHERE {key} IS NULL) AS null_keys FROM {_ALL.get(name, name)}"
    for name, key in _KEYS.items()
    for frame, n in (("as built", 0), ("reversed", _REVERSED[name]))
)
_REJECTED = {name: [(f"{key}: null", f"{key} IS NULL")] for name, key in _KEYS.items()} | {
    "immig_fact": [
        ("cicid: null", "travel_mode_id = 9"),
        ("cicid: not int", "travel_mode_id <> 9 AND i94_age = 50"),
    ]
}
REJECTED_SQL = CANDIDATES_SQL + "SELECT * FROM (\n" + "\nUNION ALL\n".join(
    f"SELECT '{name}' AS table_name, '{reason}' AS reason, count(*) AS row_count FROM {_ALL.get(name, name)} "
    f"WHERE {condition}"
    for name, rules in _REJECTED.items()
    for reason, condition in [*rules, ("accepted", " AND ".join(f"({c}) IS NOT TRUE" for _, c in rules))]
) + "\n) WHERE row_count > 0"

# Per input: its columns, and the conditions under which a cell is spoilt.
_SPOILT = {
    "airports": (AIRPORTS_INPUT, {"elevation_ft": "elevation_ft > 5000"}),
    "countries": (COUNTRIES_INPUT, {"country_code": "country_code % 5 = 0"}),
    "demographics": (DEMOGRAPHICS_INPUT, {"medianAge": "medianAge > 75", "noOfVeterans": "noOfVeterans IS NULL"}),
    "temperatures": (TEMPERATURES_INPUT, {"AverageTemperature": "City LIKE '%1'"}),
}
CSV_LOSSES_SQL = _with(AIRPORTS_SQL, COUNTRIES_SQL, DEMOGRAPHICS_SQL, TEMPERATURES_SQL) + "\nUNION ALL\n".join(
    f"SELECT '{name}' AS input_name, '{column}' AS column_name, "
    f"count(*) FILTER (WHERE {condition}) AS lost_values FROM {name}"
    for name, (schema, spoilt) in _SPOILT.items()
    for column, condition in [
        *((n, spoilt.get(n, "false")) for n in schema.names),
        ("*", " OR ".join(spoilt.values())),
    ]
)
COUNTS_SQL = MART_SQL + "\nUNION ALL\n".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count "
    f"FROM {_CTE.get(name, name)}"
    for name in _KEYS
)

LOSSES_SQL = (
    "WITH "
    + ARRIVALS_SQL
    + ",\nlost AS (SELECT "
    + ", ".join(
        f"count(*) FILTER (WHERE {src} IS NOT NULL AND ({expr}) IS NULL) AS {name}"
        for name, (src, expr) in FACT_SQL_COLUMNS.items()
    )
    + " FROM arrivals)\n"
    + "\nUNION ALL\n".join(
        f"SELECT '{name}' AS column_name, '{src}' AS source_column, {name} AS lost_values FROM lost"
        for name, (src, _) in FACT_SQL_COLUMNS.items()
    )
)

# Rows of each table's inputs that no row of it stands for.
_LEFT_OUT = {
    "visa_type_dim": f"SELECT count(*) FROM arrivals WHERE {_int('i94visa')} IS NULL",
    "time_dim": "SELECT count(*) FROM arrivals WHERE coalesce("
    f"{_int('arrdate')} NOT BETWEEN {_DAY_RANGE[0]} AND {_DAY_RANGE[1]}, true)",
    "airport_dim": "SELECT count(*) FROM airports WHERE local_code IS NULL",
    "demographics_dim": "SELECT count(*) FROM demographics WHERE stateCode IS NULL",
    "country_temperature_dim": "SELECT count(*) FROM countries c WHERE NOT EXISTS "
    "(SELECT 1 FROM temperatures t WHERE t.Country = c.country)",
}
_LOST = " + ".join(
    f"count(*) FILTER (WHERE {src} IS NOT NULL AND ({expr}) IS NULL)" for src, expr in FACT_SQL_COLUMNS.values()
)
REPORT_SQL = MART_SQL + "\nUNION ALL\n".join(
    f"SELECT '{name}' AS table_name, '{key}' AS key_column, count(*) AS row_count, "
    f"count(*) FILTER (WHERE {key} IS NULL) AS null_keys, "
    f"(SELECT count(*) FROM (SELECT {key} FROM {_CTE.get(name, name)} WHERE {key} IS NOT NULL "
    f"GROUP BY {key} HAVING count(*) > 1)) AS duplicate_keys, "
    f"({_LEFT_OUT.get(name, 'SELECT 0')}) AS left_out, "
    f"{f'(SELECT {_LOST} FROM arrivals)' if name == 'immig_fact' else '0'} AS lost_values "
    f"FROM {_CTE.get(name, name)}"
    for name, key in _KEYS.items()
)

PORT_MONTH_SQL = (
    _with(ARRIVALS_SQL, FACT_SQL, TIME_SQL, AIRPORTS_SQL, AIRPORT_DIM_SQL)
    + """
SELECT a.airport_code, a.airport_name, t.year, t.month, count(*) AS arrivals
FROM fact f
JOIN time_dim t ON f.i94_arrival_date = t.arrival_sas
JOIN airport_dim a ON f.i94_port = a.airport_code
{period}GROUP BY a.airport_code, a.airport_name, t.year, t.month"""
)

ORACLES: dict[str, str] = {
    "conform_fact": _with(ARRIVALS_SQL, FACT_SQL) + "SELECT * FROM fact",
    "parse_char_date": """
SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS date_text,
       CAST(try_strptime(strftime(o_orderdate, '%Y%m%d'), '%Y%m%d') AS DATE) AS parsed_date
FROM orders""",
    "parse_char_date_bad": """
SELECT o_orderkey, date_text, CAST(try_strptime(date_text, '%Y%m%d') AS DATE) AS parsed_date
FROM (SELECT o_orderkey,
             CASE WHEN o_orderkey % 10 = 0 THEN 'D/S' ELSE strftime(o_orderdate, '%Y%m%d') END AS date_text
      FROM orders)""",
    "null_fill_code": _with(ARRIVALS_SQL, FACT_SQL) + "SELECT cicid, travel_mode_id FROM fact",
    "conversion_losses": LOSSES_SQL,
    "code_dim_two_labels": _with(ARRIVALS_SQL, VISA_SQL) + "SELECT * FROM visa_type_dim",
    "code_dim_null_zero": _with(ARRIVALS_SQL, MODE_SQL) + "SELECT * FROM travel_mode_dim",
    "date_dim": _with(ARRIVALS_SQL, TIME_SQL) + "SELECT * FROM time_dim",
    "reference_dim": _with(AIRPORTS_SQL, AIRPORT_DIM_SQL) + "SELECT * FROM airport_dim",
    "group_means": _with(DEMOGRAPHICS_SQL, GROUP_MEANS_SQL) + "SELECT * FROM group_means",
    "demographics_dim": _with(DEMOGRAPHICS_SQL, GROUP_MEANS_SQL, DEMOGRAPHICS_DIM_SQL)
    + "SELECT * FROM demographics_dim",
    "lookup_means": _with(COUNTRIES_SQL, TEMPERATURES_SQL, COUNTRY_DIM_SQL) + "SELECT * FROM country_dim",
    "lookup_unmatched": _with(COUNTRIES_SQL, TEMPERATURES_SQL)
    + "SELECT c.* FROM countries c WHERE NOT EXISTS (SELECT 1 FROM temperatures t WHERE t.Country = c.country)",
    "arrivals_by_port_month": PORT_MONTH_SQL.format(period=""),
    "arrivals_country_mean": _with(ARRIVALS_SQL, FACT_SQL, COUNTRIES_SQL, TEMPERATURES_SQL, COUNTRY_DIM_SQL)
    + """
SELECT c.country_code, c.country, c.avg_country_temperature, count(*) AS arrivals
FROM fact f JOIN country_dim c ON f.i94_resident = c.country_code
GROUP BY c.country_code, c.country, c.avg_country_temperature""",
    "arrivals_citizen_country_mean": _with(
        ARRIVALS_SQL, FACT_SQL, COUNTRIES_SQL, TEMPERATURES_SQL, COUNTRY_DIM_SQL
    )
    + """
SELECT c.country_code, c.country, c.avg_country_temperature, count(*) AS arrivals
FROM fact f JOIN country_dim c ON f.i94_citizen = c.country_code
GROUP BY c.country_code, c.country, c.avg_country_temperature""",
    "fact_key_duplicates": _with(ARRIVALS_SQL, FACT_SQL)
    + "SELECT cicid, count(*) AS n FROM fact GROUP BY cicid HAVING count(*) > 1",
    "key_repeats_across_loads": _with(ARRIVALS_SQL, FACT_SQL)
    + """, loads AS (
  SELECT cicid, CASE WHEN coalesce(((i94_arrival_date % 2) + 2) % 2, 0) = 1 THEN 2 ELSE 1 END AS load_no FROM fact
), keys AS (SELECT load_no, cicid, count(*) AS n FROM loads WHERE cicid IS NOT NULL GROUP BY load_no, cicid)
SELECT k.load_no, k.cicid, k.n AS n_load, coalesce(e.n, 0) AS n_earlier
FROM keys k LEFT JOIN keys e ON e.cicid = k.cicid AND e.load_no < k.load_no
WHERE k.n > 1 OR e.n IS NOT NULL""",
    "arrivals_state_mean": _with(ARRIVALS_SQL, FACT_SQL, DEMOGRAPHICS_SQL, GROUP_MEANS_SQL, DEMOGRAPHICS_DIM_SQL)
    + """
SELECT f.state_code, count(*) AS arrivals, d.average_total_population,
       d.average_male_population, d.average_female_population
FROM fact f JOIN demographics_dim d ON f.state_code = d.stateCode
GROUP BY f.state_code, d.average_total_population, d.average_male_population, d.average_female_population""",
    "labelled_arrivals": _with(ARRIVALS_SQL, FACT_SQL, VISA_SQL, MODE_SQL, TIME_SQL)
    + """
SELECT f.cicid, f.i94_port, v.visa_type, m.travel_mode, f.i94_arrival_date, t.arrival_date, t.weekday
FROM fact f
LEFT JOIN visa_type_dim v ON f.visa_category_id = v.visa_category_id
LEFT JOIN travel_mode_dim m ON f.travel_mode_id = m.travel_mode_id
LEFT JOIN time_dim t ON f.i94_arrival_date = t.arrival_sas""",
    "csv_semicolon_scan": _with(DEMOGRAPHICS_SQL) + "SELECT * FROM demographics",
    "csv_infer_scan": _with(AIRPORTS_SQL, AIRPORT_DIM_SQL) + "SELECT * FROM airport_dim",
    "csv_reordered_scan": _with(COUNTRIES_SQL) + "SELECT * FROM countries",
    "arrivals_typed_input": _with(ARRIVALS_SQL, FACT_SQL) + "SELECT * FROM fact",
    "view_sql_scan": _with(AIRPORTS_SQL)
    + """
SELECT trim(local_code) AS airport_code, type AS airport_type, count(*) AS n
FROM airports WHERE local_code IS NOT NULL GROUP BY trim(local_code), type""",
    "parquet_glob_scan": "SELECT * FROM lineitem",
    "partitioned_write_read": _with(ARRIVALS_SQL, FACT_SQL)
    + f"SELECT {FACT_COLUMNS}, i94_port AS partition_port, i94_month FROM fact",
    "refresh_twice": _with(AIRPORTS_SQL, AIRPORT_DIM_SQL) + "SELECT * FROM airport_dim",
    "refresh_then_expire": _with(AIRPORTS_SQL, AIRPORT_DIM_SQL) + "SELECT * FROM airport_dim",
    "append_twice": _with(AIRPORTS_SQL, AIRPORT_DIM_SQL)
    + "SELECT * FROM airport_dim UNION ALL SELECT * FROM airport_dim",
    "templated_run_paths": _with(COUNTRIES_SQL, TEMPERATURES_SQL, COUNTRY_DIM_SQL) + "SELECT * FROM country_dim",
    "contract_check": CONTRACT_SQL,
    "rejected_rows": REJECTED_SQL,
    "bucketed_arrivals_by_port_month": PORT_MONTH_SQL.format(period=""),
    "arrivals_one_month": PORT_MONTH_SQL.format(period="WHERE t.year = 1995 AND t.month = 3\n"),
    "publish_set_read": COUNTS_SQL,
    "arrivals_mixed_footers": _with(ARRIVALS_SQL, FACT_SQL) + "SELECT * FROM fact",
    "csv_losses": CSV_LOSSES_SQL,
    "positional_load": _with(AIRPORTS_SQL, AIRPORT_DIM_SQL) + "SELECT * FROM airport_dim",
    "label_table_dim": _with(ARRIVALS_SQL, COUNTRIES_SQL)
    + f"""
SELECT a.k AS country_code, coalesce(c.country, 'Not listed') AS country
FROM (SELECT DISTINCT {_int('i94cit')} AS k FROM arrivals) a
LEFT JOIN countries c ON c.country_code = a.k AND c.country_code < 20
WHERE a.k IS NOT NULL""",
    "quality_report": QUALITY_SQL,
    "run_report": REPORT_SQL,
    "key_duplicates": """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "mart_row_counts": COUNTS_SQL,
    "stream_fact": _with(ARRIVALS_SQL, FACT_SQL)
    + f"SELECT {FACT_COLUMNS}, i94_port AS partition_port, i94_month FROM fact",
    "stream_compacted": _with(ARRIVALS_SQL, FACT_SQL)
    + f"SELECT {FACT_COLUMNS}, i94_port AS partition_port, i94_month, CAST(1 AS BIGINT) AS load_batch FROM fact",
}


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in ORACLES.items() if k in QUERIES} | LLM_ORACLES
