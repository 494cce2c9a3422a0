"""Table contracts: column names, order, types, keys and physical layout.

Each output table has one :class:`Contract`. ``schema`` lists the columns that
are stored in the data files, in their fixed order; ``required`` names those that
must not be null. ``partition_by`` maps a
directory column to the column it is copied from (the copy is made at write
time, so the original stays in the files).

Input schemas are declared too, so that no scan needs a schema-inference pass.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

INT = IntegerType()
DOUBLE = DoubleType()
STRING = StringType()
DATE = DateType()


def _schema(*columns: tuple[str, DataType]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in columns])


@dataclass(frozen=True)
class Contract:
    name: str
    schema: StructType
    key: tuple[str, ...]
    partition_by: dict[str, str] = field(default_factory=dict)
    #: Columns whose values must be there (the key's, in this mart).
    required: tuple[str, ...] = ()
    #: Order of the rows inside a file, so that row groups can be skipped.
    sort_by: tuple[str, ...] = ()
    #: Hash columns of the optional bucketed layout.
    bucket_by: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    def read_schema(self) -> StructType:
        """File columns followed by the partition columns, as read back."""
        extra = []
        for part, source in self.partition_by.items():
            if part not in self.columns:
                extra.append(StructField(part, self.source_type(source), True))
        return StructType(self.schema.fields + extra)

    def source_type(self, column: str) -> DataType:
        for f in self.schema.fields:
            if f.name == column:
                return f.dataType
        return _EXTRA_TYPES[column]


# Columns carried by a table only as a partition directory.
_EXTRA_TYPES: dict[str, DataType] = {"i94_month": INT, "load_batch": LongType()}


IMMIG_FACT = Contract(
    name="immig_fact",
    schema=_schema(
        ("cicid", INT),
        ("i94_port", STRING),
        ("i94_citizen", INT),
        ("i94_resident", INT),
        ("i94_arrival_date", INT),
        ("travel_mode_id", INT),
        ("state_code", STRING),
        ("i94_departure_date", INT),
        ("i94_age", INT),
        ("visa_category_id", INT),
        ("i94_date_added", DATE),
        ("i94_date_admitted", DATE),
        ("i94_occupation", STRING),
        ("i94_arrival_flag", STRING),
        ("i94_departure_flag", STRING),
        ("i94_update_flag", STRING),
        ("i94_match_flag", STRING),
        ("i94_birth_year", INT),
        ("i94_gender", STRING),
        ("i94_insnum", STRING),
        ("i94_airline", STRING),
        ("i94_admission_number", DOUBLE),
        ("i94_flight_number", STRING),
        ("i94_visa_type", STRING),
    ),
    key=("cicid",),
    partition_by={"partition_port": "i94_port", "i94_month": "i94_month"},
    required=("cicid",),
    sort_by=("i94_arrival_date",),
    bucket_by=("i94_port", "i94_arrival_date"),
)

VISA_TYPE_DIM = Contract(
    name="visa_type_dim",
    schema=_schema(("visa_category_id", INT), ("visa_type", STRING)),
    key=("visa_category_id",),
    required=("visa_category_id",),
)

TRAVEL_MODE_DIM = Contract(
    name="travel_mode_dim",
    schema=_schema(("travel_mode_id", INT), ("travel_mode", STRING)),
    key=("travel_mode_id",),
    required=("travel_mode_id",),
)

TIME_DIM = Contract(
    name="time_dim",
    schema=_schema(
        ("arrival_sas", INT),
        ("arrival_date", DATE),
        ("day", INT),
        ("month", INT),
        ("year", INT),
        ("weekday", STRING),
    ),
    key=("arrival_sas",),
    partition_by={"partition_month": "month"},
    required=("arrival_sas",),
)

AIRPORT_DIM = Contract(
    name="airport_dim",
    schema=_schema(
        ("airport_code", STRING),
        ("iata_code", STRING),
        ("airport_name", STRING),
        ("airport_type", STRING),
        ("region", STRING),
        ("country_code", STRING),
        ("municipality", STRING),
        ("gps_code", STRING),
        ("coordinates", STRING),
    ),
    key=("airport_code",),
    required=("airport_code",),
    bucket_by=("airport_code",),
)

DEMOGRAPHICS_DIM = Contract(
    name="demographics_dim",
    schema=_schema(
        ("stateCode", STRING),
        ("average_median_age", DOUBLE),
        ("average_male_population", DOUBLE),
        ("average_female_population", DOUBLE),
        ("average_total_population", DOUBLE),
        ("average_no_of_veterans", DOUBLE),
        ("average_foreign_born", DOUBLE),
        ("average_house_hold_size", DOUBLE),
    ),
    key=("stateCode",),
    required=("stateCode",),
)

COUNTRY_TEMPERATURE_DIM = Contract(
    name="country_temperature_dim",
    schema=_schema(
        ("country_code", INT),
        ("country", STRING),
        ("avg_country_temperature", DOUBLE),
        ("avg_country_temperature_uncertainty", DOUBLE),
    ),
    key=("country_code",),
    required=("country_code",),
)

# Load order of the run: fact, airports, then the five small dimensions.
MART: tuple[Contract, ...] = (
    IMMIG_FACT,
    AIRPORT_DIM,
    VISA_TYPE_DIM,
    TRAVEL_MODE_DIM,
    TIME_DIM,
    COUNTRY_TEMPERATURE_DIM,
    DEMOGRAPHICS_DIM,
)
BY_NAME: dict[str, Contract] = {c.name: c for c in MART}


# ---------------------------------------------------------------- inputs ---

# Arrival records as they land in Parquet: numbers as DOUBLE, character dates
# as STRING (the day-number columns count days since 1960-01-01).
ARRIVALS_INPUT = _schema(
    ("cicid", DOUBLE),
    ("i94yr", DOUBLE),
    ("i94mon", DOUBLE),
    ("i94cit", DOUBLE),
    ("i94res", DOUBLE),
    ("i94port", STRING),
    ("arrdate", DOUBLE),
    ("i94mode", DOUBLE),
    ("i94addr", STRING),
    ("depdate", DOUBLE),
    ("i94bir", DOUBLE),
    ("i94visa", DOUBLE),
    ("count", DOUBLE),
    ("dtadfile", STRING),
    ("visapost", STRING),
    ("occup", STRING),
    ("entdepa", STRING),
    ("entdepd", STRING),
    ("entdepu", STRING),
    ("matflag", STRING),
    ("biryear", DOUBLE),
    ("dtaddto", STRING),
    ("gender", STRING),
    ("insnum", STRING),
    ("airline", STRING),
    ("admnum", DOUBLE),
    ("fltno", STRING),
    ("visatype", STRING),
)

AIRPORTS_INPUT = _schema(
    ("ident", STRING),
    ("type", STRING),
    ("name", STRING),
    ("elevation_ft", INT),
    ("continent", STRING),
    ("iso_country", STRING),
    ("iso_region", STRING),
    ("municipality", STRING),
    ("gps_code", STRING),
    ("iata_code", STRING),
    ("local_code", STRING),
    ("coordinates", STRING),
)

DEMOGRAPHICS_INPUT = _schema(
    ("city", STRING),
    ("state", STRING),
    ("medianAge", DOUBLE),
    ("malePopulation", INT),
    ("femalePopulation", INT),
    ("totalPopulation", INT),
    ("noOfVeterans", INT),
    ("foreignBorn", INT),
    ("averageHouseHoldSize", DOUBLE),
    ("stateCode", STRING),
    ("race", STRING),
    ("count", INT),
)

TEMPERATURES_INPUT = _schema(
    ("dt", DATE),
    ("AverageTemperature", DOUBLE),
    ("AverageTemperatureUncertainty", DOUBLE),
    ("City", STRING),
    ("Country", STRING),
    ("Latitude", STRING),
    ("Longitude", STRING),
)

COUNTRIES_INPUT = _schema(("country_code", INT), ("country", STRING))
