"""The questions asked of the warehouse. Each takes and returns frames.

Lookups carry no broadcast hint: Spark broadcasts a code list on its measured size
(``autoBroadcastJoinThreshold``, and again at run time under AQE), and falls back
to a sort-merge join, with skewed partitions split, when a list outgrows that.
Every top-k has a tie-break, so it repeats.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starquay.functions.columns import named
from starquay.schemas import TABLES, Table

# Rows of a top-k report or preview.
TOP = 10


def largest_cities(population: DataFrame, k: int = TOP) -> DataFrame:
    """Cities with the most inhabitants, and how many were born elsewhere."""
    total = F.col("male_population") + F.col("female_population")
    return (
        population.select("city", "foreign_born", total.alias("population"))
        .distinct()
        .orderBy(F.desc("population"), "city", "foreign_born")
        .limit(k)
    )


def visa_type_usage(airline: DataFrame, fact: DataFrame, k: int = TOP) -> DataFrame:
    """Visa types by the number of arrivals that have a visa category.

    Counts are taken per record id before the join, and multiplied after it. The
    result is that of joining first, but a record id that is repeated on both
    sides meets as one row per visa type and not as all pairs.
    """
    arrivals = fact.groupBy("cic_id").agg(F.count("visa").alias("arrivals"))
    members = airline.groupBy("cic_id", "visa_type").agg(F.count(F.lit(1)).alias("members"))
    return (
        members.join(arrivals, "cic_id")
        .groupBy("visa_type")
        .agg(F.sum(F.col("members") * F.col("arrivals")).alias("visa"))
        .orderBy(F.desc("visa"), "visa_type")
        .limit(k)
    )


def first_rows(df: DataFrame, table: Table, k: int = TOP) -> DataFrame:
    """The first rows of a table in a stated order.

    Where rows are numbered from 1 without gaps that is a filter, which reaches
    the scan and skips row groups; otherwise a top-k on the natural key.
    """
    if table.id_column:
        return df.where(F.col(table.id_column) <= k)
    rest = [c for c in df.columns if c not in table.natural_key]
    return df.orderBy(*table.natural_key, *map(named, rest)).limit(k)


def city_code_list(city_code: DataFrame, k: int = TOP) -> DataFrame:
    return first_rows(city_code.select("code", "city"), TABLES["city_code"], k)


def arrivals_with_city(
    fact: DataFrame, city_code: DataFrame, order_by: Sequence[str] = ("cic_id", "immigration_id"), k: int = TOP
) -> DataFrame:
    """Arrivals, each with the city of its port."""
    return (
        fact.join(city_code.withColumnsRenamed({"code": "city_code"}), "city_code")
        .select(*fact.columns, "city")
        .orderBy(*order_by)
        .limit(k)
    )


def warmest_records(
    temperature: DataFrame, order_by: Sequence[str] = ("country", "city", "dt"), k: int = TOP
) -> DataFrame:
    return temperature.orderBy(F.desc("avg_temp"), *order_by).limit(k)


def port_temperatures(temperature: DataFrame, city_code: DataFrame) -> DataFrame:
    """Temperatures of cities that are ports, coldest first, unknown ones at the top.

    Joined by name, so a city with two port codes comes twice. All other columns
    follow in the sort: the order asked for holds, and rows that share one
    temperature are still spread over many sort partitions.
    """
    rest = [c for c in temperature.columns if c != "avg_temp"]
    return (
        temperature.join(city_code, "city")
        .select(*temperature.columns, "code")
        .orderBy("avg_temp", "code", *rest)
    )


def mean_temperatures(temperature: DataFrame) -> DataFrame:
    return temperature.groupBy("city").agg(F.avg("avg_temp").alias("average_temp"))


def star_totals(temperature: DataFrame, city_code: DataFrame, fact: DataFrame) -> DataFrame:
    """(city_code, city, measurements, arrivals, pairs, average_temp): the three-table star
    of measurements and arrivals per port, with its number of pairs.

    Both sides are added up before they meet, so a busy port comes as one row of each.
    The mean of the measurements is that over the pairs, as each comes equally often.
    """
    measured = temperature.groupBy("city").agg(
        F.count(F.lit(1)).alias("measurements"), F.avg("avg_temp").alias("average_temp")
    )
    arrived = fact.groupBy("city_code").agg(F.count(F.lit(1)).alias("arrivals"))
    ports = city_code.select(F.col("code").alias("city_code"), "city")
    return (
        ports.join(measured, "city")
        .join(arrived, "city_code")
        .select(
            "city_code",
            "city",
            "measurements",
            "arrivals",
            (F.col("measurements") * F.col("arrivals")).alias("pairs"),
            "average_temp",
        )
    )


def temperature_at_arrival(
    temperature: DataFrame, city_code: DataFrame, fact: DataFrame
) -> DataFrame:
    """(avg_temp, city, country, arrivals): the temperatures measured in a city, beside
    the countries of its arrivals, and how often both come together.

    That count stands for the pairs of measurements and arrivals. Both sides are
    counted before they meet, so the work and the result are linear in them.
    """
    measured = temperature.groupBy("avg_temp", "city").agg(F.count(F.lit(1)).alias("measured"))
    arrived = fact.groupBy("city_code", "country").agg(F.count(F.lit(1)).alias("arrived"))
    ports = city_code.select(F.col("code").alias("city_code"), "city")
    by_city = ports.join(arrived, "city_code").groupBy("city", "country")
    counted = by_city.agg(F.sum("arrived").alias("arrived"))
    return measured.join(counted, "city").select(
        "avg_temp", "city", "country", (F.col("measured") * F.col("arrived")).alias("arrivals")
    )


def visa_at_port(fact: DataFrame, city_code: DataFrame, port: str = "AKR") -> DataFrame:
    """City and visa category of each arrival at one port. Spark infers the filter
    for the code list as well."""
    return (
        fact.where(F.col("city_code") == port)
        .join(city_code.withColumnsRenamed({"code": "city_code"}), "city_code")
        .select("city", "visa")
    )
