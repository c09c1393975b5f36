"""The nine warehouse tables: from raw frames to typed rows.

A builder of a table with a surrogate key gives its rows without the key, in raw
types and with repeats; ``with_key`` casts, drops repeats and adds the key in the
stated order. The split is what lets a full load and an append-only refresh share
the builders and the grain: the distinct typed row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starquay.functions.columns import cast_to_schema, convert, named
from starquay.operators import labels
from starquay.operators.cleaning import drop_sparse_columns, first_per_key
from starquay.operators.keys import dense_key
from starquay.schemas import (
    AIRLINE_NAMES,
    COUNTRY,
    DEMOGRAPHICS_KEY,
    FACT_NAMES,
    MISSING_SHARE,
    PERSONAL_NAMES,
    POPULATION_NAMES,
    REQUIRED_DEMOGRAPHICS,
    STATISTICS_NAMES,
    TABLES,
    TEMPERATURE_KEY,
    TEMPERATURE_NAMES,
)

# Every raw arrival column that a table is made of.
ARRIVAL_COLUMNS = sorted({*FACT_NAMES, *PERSONAL_NAMES, *AIRLINE_NAMES})


def pick(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """The columns of a name map, under their new names."""
    return df.select(*(named(old).alias(new) for old, new in names.items()))


# Every raw demographic and temperature column that a table is made of.
DEMOGRAPHIC_COLUMNS = {
    *POPULATION_NAMES, *STATISTICS_NAMES, *DEMOGRAPHICS_KEY, *REQUIRED_DEMOGRAPHICS,
}
TEMPERATURE_COLUMNS = {*TEMPERATURE_NAMES, *TEMPERATURE_KEY, "AverageTemperature"}


def needed(raw: DataFrame, names: set[str]) -> DataFrame:
    """The columns of ``raw`` that are in ``names``, in its order."""
    return raw.select(*(named(c) for c in raw.columns if c in names))


def clean_arrivals(
    raw: DataFrame, threshold: float = MISSING_SHARE, sparse: Sequence[str] | None = None
) -> DataFrame:
    """Without mostly missing columns, then without rows that hold no value. A column
    that a table needs stays, however sparse it is in one load."""
    return drop_sparse_columns(raw, threshold, ARRIVAL_COLUMNS, sparse).na.drop("all")


def fact_rows(arrivals: DataFrame) -> DataFrame:
    return pick(arrivals, FACT_NAMES).withColumn("country", F.lit(COUNTRY))


def personal_rows(arrivals: DataFrame) -> DataFrame:
    return pick(arrivals, PERSONAL_NAMES)


def airline_rows(arrivals: DataFrame) -> DataFrame:
    return pick(arrivals, AIRLINE_NAMES)


def clean_demographics(raw: DataFrame) -> DataFrame:
    """One complete row per city, state and race: the first by the columns that tables
    are made of. No other column is read."""
    complete = needed(raw, DEMOGRAPHIC_COLUMNS).na.drop("any", subset=REQUIRED_DEMOGRAPHICS)
    return first_per_key(complete, DEMOGRAPHICS_KEY)


def population_rows(demographics: DataFrame) -> DataFrame:
    return pick(demographics, POPULATION_NAMES)


def statistics_rows(demographics: DataFrame) -> DataFrame:
    """One row per city and its figures; city and state upper-cased."""
    upper = {"city": F.upper("city"), "state": F.upper("state")}
    return pick(demographics, STATISTICS_NAMES).withColumns(upper)


def typed(rows: DataFrame, table: str) -> DataFrame:
    """Rows without a key, cast to the columns of the table but its key."""
    id_column = TABLES[table].id_column
    schema = TABLES[table].schema
    return cast_to_schema(rows, type(schema)([f for f in schema if f.name != id_column]))


def with_key(rows: DataFrame, table: str) -> DataFrame:
    """Raw rows as the finished table: types, distinct typed rows, dense key.

    Typed rows are what a refresh compares, so both paths keep the same rows, and the
    order behind the key is total. Numbers in text sort as numbers.
    """
    spec = TABLES[table]
    keyed = dense_key(typed(rows, table).distinct(), spec.id_column, spec.natural_key)
    return keyed.select(*map(named, spec.schema.names))


def fact_immigration(arrivals: DataFrame) -> DataFrame:
    return with_key(fact_rows(arrivals), "fact_immigration")


def dim_immigration_personal(arrivals: DataFrame) -> DataFrame:
    return with_key(personal_rows(arrivals), "dim_immigration_personal")


def dim_immigration_airline(arrivals: DataFrame) -> DataFrame:
    return with_key(airline_rows(arrivals), "dim_immigration_airline")


def dim_demog_population(demographics: DataFrame) -> DataFrame:
    return with_key(population_rows(demographics), "dim_demog_population")


def dim_demog_statistics(demographics: DataFrame) -> DataFrame:
    return with_key(statistics_rows(demographics), "dim_demog_statistics")


def temperature_winners(raw: DataFrame, country: str = COUNTRY) -> DataFrame:
    """One measured raw row per city and day of one country: the one with the lowest
    temperature, then the first of the other needed columns in order."""
    measured = needed(raw, TEMPERATURE_COLUMNS).where(F.col("Country") == country).na.drop(
        "any", subset=["AverageTemperature"]
    )
    return first_per_key(measured, TEMPERATURE_KEY, temperature_order())


def temperature_order() -> list[Column]:
    return [F.col("AverageTemperature").try_cast("double").asc()]


def temperature_rows(winners: DataFrame) -> DataFrame:
    """The typed rows of the winners. The key columns are part of the output, so no further
    distinct is needed."""
    schema = TABLES["dim_temperature"].schema
    date = convert(F.col("dt"), winners.schema["dt"].dataType, schema["dt"].dataType)
    rows = pick(winners, TEMPERATURE_NAMES).withColumns(
        {
            "dt": date,
            "city": F.upper("city"),
            "country": F.upper("country"),
            "year": F.year(date),
            "month": F.month(date),
        }
    )
    return cast_to_schema(rows, schema)


def dim_temperature(raw: DataFrame, country: str = COUNTRY) -> DataFrame:
    return temperature_rows(temperature_winners(raw, country))


def code_tables(texts: DataFrame) -> dict[str, DataFrame]:
    """The three code tables out of label texts (file, text)."""
    return code_tables_of(labels.label_entries(texts))


def code_tables_of(entries: DataFrame) -> dict[str, DataFrame]:
    """The three code tables out of the entries of label texts."""
    return {
        "country_code": labels.country_codes(entries),
        "city_code": labels.city_codes(entries),
        "state_code": labels.state_codes(entries),
    }
