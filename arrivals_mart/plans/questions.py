"""The three questions the mart answers, and the labelled fact, as star joins.

Each question first aggregates the fact on its foreign keys (partial
aggregation in the scan tasks, so even a port with a third of all arrivals
costs one row per task), and only the aggregated rows meet the dimensions.
The labelled fact keeps every row and streams it through broadcast joins.
Spark broadcasts a dimension within its byte threshold; past it the join is a
shuffle join that AQE can still re-plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivals_mart.functions.columns import period_days
from arrivals_mart.operators.joins import star_join


def _count(name: str = "arrivals"):
    return F.count(F.lit(1)).alias(name)


def arrivals_by_airport_month(
    fact: DataFrame,
    time_dim: DataFrame,
    airport_dim: DataFrame,
    airport_code: str | None = None,
    year: int | None = None,
    month: int | None = None,
) -> DataFrame:
    """Arrivals per airport (code and name), year and month.

    Joins port code to airport code and arrival day to the time dimension.
    An airport code listed under two names counts its arrivals under both.

    ``airport_code``, ``year`` and ``month`` narrow the answer to one
    airport and/or period. On the written fact the airport filter applies to
    the ``partition_port`` directories, so only that port's files are read. A
    year, or a month of one, is also a range of day numbers, which reaches the
    fact's scan: its files are sorted by day, so row groups outside the range
    are skipped. (The arrival date decides the month, not the record's month
    column; a month without a year filters the time dimension only.)
    """
    if airport_code is not None:
        port = "partition_port" if "partition_port" in fact.columns else "i94_port"
        fact = fact.where(F.col(port) == airport_code)
        airport_dim = airport_dim.where(F.col("airport_code") == airport_code)
    if year is not None:
        fact = fact.where(F.col("i94_arrival_date").between(*period_days(year, month)))
        time_dim = time_dim.where(F.col("year") == year)
    if month is not None:
        time_dim = time_dim.where(F.col("month") == month)
    per_day = fact.groupBy("i94_port", "i94_arrival_date").agg(_count())
    days = time_dim.select("arrival_sas", "year", "month")
    airports = airport_dim.select("airport_code", "airport_name")
    joined = per_day.join(days, per_day["i94_arrival_date"] == days["arrival_sas"]).join(
        airports, per_day["i94_port"] == airports["airport_code"]
    )
    return joined.groupBy("airport_code", "airport_name", "year", "month").agg(
        F.sum("arrivals").alias("arrivals")
    )


def arrivals_country_temperature(
    fact: DataFrame,
    country_dim: DataFrame,
    by: str = "i94_resident",
) -> DataFrame:
    """Arrivals per country of residence (or ``by="i94_citizen"``) with the
    country's mean temperature."""
    per_country = fact.groupBy(F.col(by).alias("country_code")).agg(_count())
    countries = country_dim.select("country_code", "country", "avg_country_temperature")
    return per_country.join(countries, "country_code").select(
        "country_code", "country", "avg_country_temperature", "arrivals"
    )


def arrivals_state_population(
    fact: DataFrame,
    demographics_dim: DataFrame,
) -> DataFrame:
    """Arrivals per state of address with the state's mean populations."""
    per_state = fact.groupBy(F.col("state_code").alias("stateCode")).agg(_count())
    states = demographics_dim.select(
        "stateCode",
        "average_total_population",
        "average_male_population",
        "average_female_population",
    )
    return per_state.join(states, "stateCode").select(
        F.col("stateCode").alias("state_code"),
        "arrivals",
        "average_total_population",
        "average_male_population",
        "average_female_population",
    )


def labelled_arrivals(
    fact: DataFrame,
    visa_dim: DataFrame,
    mode_dim: DataFrame,
    time_dim: DataFrame,
) -> DataFrame:
    """Every arrival with its visa type, travel mode, arrival date and
    weekday: the fact star-joined (left) to three dimensions. While these are
    within Spark's broadcast threshold the fact itself is never shuffled.
    Arrivals whose code is missing from a dimension keep null labels."""
    out = fact.select("cicid", "i94_port", "visa_category_id", "travel_mode_id", "i94_arrival_date")
    out = star_join(out, visa_dim, "visa_category_id", "visa_category_id", "left")
    out = out.drop(visa_dim["visa_category_id"])
    out = star_join(out, mode_dim, "travel_mode_id", "travel_mode_id", "left")
    out = out.drop(mode_dim["travel_mode_id"])
    days = time_dim.select("arrival_sas", "arrival_date", "weekday")
    out = star_join(out, days, "i94_arrival_date", "arrival_sas", "left")
    return out.select(
        "cicid", "i94_port", "visa_type", "travel_mode", "i94_arrival_date", "arrival_date", "weekday"
    )
