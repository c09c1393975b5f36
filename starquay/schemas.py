"""Raw and warehouse schemas, name maps and keys: the single source of truth."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

_TYPES: dict[str, DataType] = {
    "bigint": LongType(),
    "int": IntegerType(),
    "float": FloatType(),
    "double": DoubleType(),
    "string": StringType(),
    "date": DateType(),
}


def columns(text: str) -> StructType:
    """``"a bigint, Some Name string"`` as a schema of nullable columns.

    Needs no running session, unlike a DDL string, and takes names with blanks.
    """
    pairs = (item.strip().rsplit(" ", 1) for item in text.split(","))
    return StructType([StructField(name.strip(), _TYPES[kind]) for name, kind in pairs])


# ---------------------------------------------------------------------------
# Raw column names, in file order.
# ---------------------------------------------------------------------------
RAW_ARRIVALS = columns(
    "cicid double, i94yr double, i94mon double, i94cit double, i94res double,"
    "i94port string, arrdate double, i94mode double, i94addr string, depdate double,"
    "i94bir double, i94visa double, count double, dtadfile string, visapost string,"
    "occup string, entdepa string, entdepd string, entdepu string, matflag string,"
    "biryear double, dtaddto string, gender string, insnum string, airline string,"
    "admnum double, fltno string, visatype string"
)
RAW_TEMPERATURE = columns(
    "dt string, AverageTemperature string, AverageTemperatureUncertainty string,"
    "City string, Country string, Latitude string, Longitude string"
)
RAW_DEMOGRAPHICS = columns(
    "City string, State string, Median Age string, Male Population string,"
    "Female Population string, Total Population string, Number of Veterans string,"
    "Foreign-born string, Average Household Size string, State Code string,"
    "Race string, Count string"
)

# Raw name -> warehouse name. Always applied by name: a rename by
# position silently swaps columns of one type when the select order changes.
FACT_NAMES = {
    "cicid": "cic_id",
    "i94yr": "year",
    "i94mon": "month",
    "i94port": "city_code",
    "i94addr": "state_code",
    "arrdate": "arrive_date",
    "depdate": "departure_date",
    "i94mode": "mode",
    "i94visa": "visa",
}
PERSONAL_NAMES = {
    "cicid": "cic_id",
    "i94cit": "citizen_country",
    "i94res": "residence_country",
    "biryear": "birth_year",
    "gender": "gender",
}
AIRLINE_NAMES = {
    "cicid": "cic_id",
    "airline": "airline",
    "admnum": "admin_num",
    "fltno": "flight_number",
    "visatype": "visa_type",
}
TEMPERATURE_NAMES = {
    "dt": "dt",
    "AverageTemperature": "avg_temp",
    "AverageTemperatureUncertainty": "avg_temp_uncertainty",
    "City": "city",
    "Country": "country",
}
POPULATION_NAMES = {
    "City": "city",
    "State": "state",
    "Male Population": "male_population",
    "Female Population": "female_population",
    "Number of Veterans": "num_veterans",
    "Foreign-born": "foreign_born",
    "Race": "race",
}
STATISTICS_NAMES = {
    "City": "city",
    "State": "state",
    "Median Age": "median_age",
    "Average Household Size": "avg_household_size",
}

# The country a temperature row must be of, the constant country of
# an arrival, the columns a demographic row must have, its key, the share of
# missing values above which a raw column is dropped.
COUNTRY = "United States"
REQUIRED_DEMOGRAPHICS = [
    "Male Population",
    "Female Population",
    "Foreign-born",
    "Average Household Size",
    "Number of Veterans",
]
DEMOGRAPHICS_KEY = ["City", "State", "State Code", "Race"]
TEMPERATURE_KEY = ["Country", "City", "dt"]
MISSING_SHARE = 0.9


@dataclass(frozen=True)
class Table:
    """One warehouse table: stored columns, and how a row of it is identified.

    ``natural_key`` orders rows, and identifies them where a table has one row per key.
    ``id_column`` is the dense surrogate key; the other columns of such a table are
    what tells its rows apart, in a full load and in a refresh. ``looked_up_by`` is what
    questions filter by: rows lie sorted by it in the files of a partition, and the files
    tell which values they hold, so that a scan skips the rest.
    """

    name: str
    schema: StructType
    natural_key: tuple[str, ...]
    id_column: str | None = None
    partition_by: str | None = None
    looked_up_by: str | None = None

    @property
    def identity(self) -> tuple[str, ...]:
        """The columns that make a row a new one."""
        if self.id_column is None:
            return self.natural_key
        return tuple(name for name in self.schema.names if name != self.id_column)


# Warehouse tables, their columns in order, and types. Surrogate
# keys are BIGINT: a 32-bit key runs out at the row counts this is meant for.
TABLES: dict[str, Table] = {
    table.name: table
    for table in (
        Table(
            "fact_immigration",
            columns(
                "cic_id bigint, year int, month int, city_code string, arrive_date date,"
                "departure_date date, mode int, visa int, immigration_id bigint,"
                "country string, state_code string"
            ),
            ("cic_id",),
            "immigration_id",
            "state_code",
            "city_code",
        ),
        Table(
            "dim_immigration_personal",
            columns(
                "cic_id bigint, citizen_country int, residence_country int,"
                "birth_year int, gender string, immi_personal_id bigint"
            ),
            ("cic_id",),
            "immi_personal_id",
        ),
        Table(
            "dim_immigration_airline",
            columns(
                "cic_id bigint, airline string, admin_num bigint, flight_number string,"
                "visa_type string, immi_airline_id bigint"
            ),
            ("cic_id",),
            "immi_airline_id",
        ),
        Table(
            "dim_temperature",
            columns(
                "dt date, avg_temp float, avg_temp_uncertainty float, city string,"
                "country string, year int, month int"
            ),
            ("country", "city", "dt"),
        ),
        Table(
            "dim_demog_population",
            columns(
                "city string, state string, male_population int, female_population int,"
                "num_veterans int, foreign_born int, race string, demog_pop_id bigint"
            ),
            ("city", "state", "race"),
            "demog_pop_id",
        ),
        Table(
            "dim_demog_statistics",
            columns(
                "city string, state string, median_age int, avg_household_size float,"
                "demog_stat_id bigint"
            ),
            ("city", "state"),
            "demog_stat_id",
        ),
        Table("country_code", columns("code string, country string"), ("code",)),
        Table("city_code", columns("code string, city string"), ("code",)),
        Table("state_code", columns("code string, state string"), ("code",)),
    )
}
