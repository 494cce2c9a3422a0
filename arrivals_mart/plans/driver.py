"""Reference-shaped inputs derived from the benchmark tables.

The benchmark data set has no arrival records, airports, demographics or
temperatures; these functions derive frames with exactly the raw input
schemas of ``contracts`` from its tables, one output row per input row (or
per join match), so every mart operator runs over whole tables and its work
grows with the scale factor. The derivations plant the edge cases the
operators must handle: padded codes, null codes next to code 0, states that are null or have no city,
fractional day numbers, unparsable character dates, null group keys, names that differ
only in case, and cities repeated once per race.

| input        | derived from           | notes                                     |
| ------------ | ---------------------- | ----------------------------------------- |
| arrivals     | lineitem               | port from supplier, day = ship date       |
| airports     | supplier               | code = supplier, some codes null          |
| countries    | nation                 | code and name                             |
| temperatures | customer, nation       | region 4 spells country names lower-case  |
| demographics | orders, customer       | one row per order: city x race            |
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from arrivals_mart.contracts import (
    AIRPORTS_INPUT,
    ARRIVALS_INPUT,
    COUNTRIES_INPUT,
    DEMOGRAPHICS_INPUT,
    TEMPERATURES_INPUT,
)
from arrivals_mart.sources.files import read_parquet

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def _conform(df: DataFrame, schema) -> DataFrame:
    return df.selectExpr(*[f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields])


# The derivations are Spark SQL expression lists: the JVM parses each list in
# one call, which keeps plan construction on the driver cheap.

_DAY_NO = "CAST(datediff(CAST(l_shipdate AS DATE), DATE'1960-01-01') AS DOUBLE)"

ARRIVALS_EXPRS = (
    "CAST(l_orderkey * 8 + l_linenumber AS DOUBLE) AS cicid",
    "CAST(year(l_shipdate) AS DOUBLE) AS i94yr",
    "CAST(month(l_shipdate) AS DOUBLE) AS i94mon",
    "CAST(l_partkey % 25 AS DOUBLE) AS i94cit",
    "CAST(l_suppkey % 25 AS DOUBLE) AS i94res",
    "concat('  P', CAST(l_suppkey AS STRING), ' ') AS i94port",
    f"{_DAY_NO} + l_discount AS arrdate",
    "CASE WHEN l_linenumber = 7 THEN CAST(NULL AS DOUBLE) WHEN l_linenumber = 6 THEN 9.0D"
    " ELSE CAST(l_linenumber - 1 AS DOUBLE) END AS i94mode",
    "CASE WHEN l_partkey % 30 = 29 THEN CAST(NULL AS STRING)"
    " ELSE concat('S', CAST(l_partkey % 30 AS STRING)) END AS i94addr",
    f"({_DAY_NO} + l_discount) + l_quantity AS depdate",
    "l_quantity AS i94bir",
    "CASE WHEN l_linenumber = 7 THEN CAST(NULL AS DOUBLE) ELSE CAST(l_linenumber % 4 AS DOUBLE) END AS i94visa",
    "1.0D AS count",
    "CASE WHEN l_orderkey % 10 = 0 THEN 'D/S' ELSE date_format(l_shipdate, 'yyyyMMdd') END AS dtadfile",
    "l_returnflag AS visapost",
    "l_linestatus AS occup",
    "l_returnflag AS entdepa",
    "l_linestatus AS entdepd",
    "CASE WHEN l_linenumber = 1 THEN 'U' END AS entdepu",
    "CASE WHEN l_linestatus = 'F' THEN 'M' END AS matflag",
    "CAST(year(l_shipdate) AS DOUBLE) - l_quantity AS biryear",
    "date_format(date_add(CAST(l_shipdate AS DATE), 90), 'yyyyMMdd') AS dtaddto",
    "CASE WHEN l_linenumber % 2 = 0 THEN 'F' ELSE 'M' END AS gender",
    "CAST(l_partkey AS STRING) AS insnum",
    "concat('A', CAST(l_suppkey % 10 AS STRING)) AS airline",
    "CAST(l_orderkey AS DOUBLE) * 100000.0D + l_partkey AS admnum",
    "CAST(l_partkey % 1000 AS STRING) AS fltno",
    "CASE WHEN l_linenumber % 4 = 1 THEN 'B1' WHEN l_linenumber % 4 = 2 THEN 'B2' ELSE 'F1' END AS visatype",
)

AIRPORTS_EXPRS = (
    "concat('ID', CAST(s_suppkey AS STRING)) AS ident",
    "CASE WHEN s_suppkey % 3 = 0 THEN 'small_airport' WHEN s_suppkey % 3 = 1 THEN 'heliport'"
    " ELSE 'large_airport' END AS type",
    "concat('  ', s_name, ' ') AS name",
    "try_cast(s_acctbal AS INT) AS elevation_ft",
    "'NA' AS continent",
    "concat('N', CAST(s_nationkey AS STRING)) AS iso_country",
    "concat('N', CAST(s_nationkey AS STRING), '-', CAST(s_suppkey % 5 AS STRING)) AS iso_region",
    "concat(' City ', CAST(s_nationkey AS STRING)) AS municipality",
    "concat('G', CAST(s_suppkey AS STRING)) AS gps_code",
    "CAST(NULL AS STRING) AS iata_code",
    "CASE WHEN s_suppkey % 7 = 0 THEN CAST(NULL AS STRING)"
    " ELSE concat(' P', CAST(s_suppkey AS STRING), '  ') END AS local_code",
    "concat(CAST(s_nationkey AS STRING), ', ', CAST(s_suppkey AS STRING)) AS coordinates",
)

TEMPERATURES_EXPRS = (
    "CAST(NULL AS DATE) AS dt",
    "CASE WHEN c_custkey % 10 = 0 THEN CAST(NULL AS DOUBLE) ELSE c_acctbal END AS AverageTemperature",
    "CAST(c_custkey % 7 AS DOUBLE) / 4 AS AverageTemperatureUncertainty",
    "c_name AS City",
    "CASE WHEN n_regionkey = 4 THEN lower(n_name) ELSE n_name END AS Country",
    "CAST(NULL AS STRING) AS Latitude",
    "CAST(NULL AS STRING) AS Longitude",
)

DEMOGRAPHICS_EXPRS = (
    "c_name AS city",
    "concat('STATE_', CAST(c_nationkey AS STRING)) AS state",
    "CAST(c_custkey % 60 AS DOUBLE) + 20.5D AS medianAge",
    "CAST(c_custkey % 5000 AS INT) AS malePopulation",
    "CAST((c_custkey * 3) % 4001 AS INT) AS femalePopulation",
    "CAST(c_custkey % 5000 AS INT) + CAST((c_custkey * 3) % 4001 AS INT) AS totalPopulation",
    "CASE WHEN c_custkey % 9 = 0 THEN CAST(NULL AS INT) ELSE CAST(c_custkey % 100 AS INT) END AS noOfVeterans",
    "CAST(c_nationkey * 10 AS INT) AS foreignBorn",
    "CAST(c_custkey % 5 AS DOUBLE) / 2 + 1.0D AS averageHouseHoldSize",
    "CASE WHEN c_custkey % 50 = 0 THEN CAST(NULL AS STRING)"
    " ELSE concat('S', CAST(c_nationkey AS STRING)) END AS stateCode",
    "o_orderpriority AS race",
    "CAST(o_orderkey % 1000 AS INT) AS count",
)


def arrivals_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """One arrival per line item (28 raw columns, numbers as DOUBLE)."""
    return _conform(lineitem.selectExpr(*ARRIVALS_EXPRS), ARRIVALS_INPUT)


def airports_from_supplier(supplier: DataFrame) -> DataFrame:
    """One airport per supplier; every seventh has no local code."""
    return _conform(supplier.selectExpr(*AIRPORTS_EXPRS), AIRPORTS_INPUT)


def countries_from_nation(nation: DataFrame) -> DataFrame:
    return _conform(
        nation.selectExpr("CAST(n_nationkey AS INT) AS country_code", "n_name AS country"), COUNTRIES_INPUT
    )


def temperatures_from_customer(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """One temperature reading per customer, in the customer's nation.

    Nations of region 4 spell their name in lower case and so match no code.
    """
    nations = nation.select("n_nationkey", "n_name", "n_regionkey")
    joined = customer.join(nations, customer["c_nationkey"] == nations["n_nationkey"])
    return _conform(joined.selectExpr(*TEMPERATURES_EXPRS), TEMPERATURES_INPUT)


def demographics_from_orders(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """One row per order: the ordering customer is the city, the order
    priority its race, so each city repeats once per race row."""
    joined = orders.join(customer, orders["o_custkey"] == customer["c_custkey"])
    return _conform(joined.selectExpr(*DEMOGRAPHICS_EXPRS), DEMOGRAPHICS_INPUT)


def driver_inputs(spark: SparkSession, sf_dir: str):
    """All five inputs of the run, derived from the tables in ``sf_dir``."""
    from arrivals_mart.plans.pipeline import Inputs

    t = lambda name: table(spark, sf_dir, name)
    return Inputs(
        arrivals=arrivals_from_lineitem(t("lineitem")),
        airports=airports_from_supplier(t("supplier")),
        demographics=demographics_from_orders(t("orders"), t("customer")),
        temperatures=temperatures_from_customer(t("customer"), t("nation")),
        countries=countries_from_nation(t("nation")),
    )
