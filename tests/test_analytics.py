from collections import Counter

import pytest

from starquay.plans import analytics
from starquay.schemas import TABLES, columns


def frame(spark, schema, *rows):
    return spark.createDataFrame(rows, columns(schema))


def listed(df):
    return [tuple(row) for row in df.collect()]


@pytest.fixture(scope="module")
def codes(spark):
    return frame(
        spark,
        "code string, city string",
        ("AKR", "AKRON"),
        ("CAK", "AKRON"),
        ("NYC", "NEW YORK"),
        ("HOM", "HOMER"),
    )


@pytest.fixture(scope="module")
def temperature(spark):
    return frame(
        spark,
        "avg_temp double, city string",
        (1.5, "AKRON"),
        (None, "AKRON"),
        (9.0, "NEW YORK"),
        (3.0, "OSLO"),
    )


def arrivals(spark, **counts):
    rows = [(n, code, "US" if n % 2 else "CA") for code, many in counts.items() for n in range(many)]
    return spark.createDataFrame(rows, columns("cic_id bigint, city_code string, country string"))


def test_visa_types_count_each_pair(spark):
    members = [(1, "WT"), (1, "WT"), (1, "B2"), (2, "B1"), (3, "B1"), (None, "X")]
    airline = frame(spark, "cic_id bigint, visa_type string", *members)
    arrived = [(1, 2), (1, 1), (1, None), (2, None), (None, 1)]
    fact = frame(spark, "cic_id bigint, visa int", *arrived)
    assert listed(analytics.visa_type_usage(airline, fact)) == [("WT", 4), ("B2", 2), ("B1", 0)]


def test_a_heavy_record_id_is_counted_in_full(spark):
    heavy = spark.range(3000).selectExpr("cast(7 as bigint) cic_id", "'WT' visa_type", "1 visa")
    found = analytics.visa_type_usage(heavy.drop("visa"), heavy.drop("visa_type"))
    assert listed(found) == [("WT", 9_000_000)]


def test_largest_cities(spark):
    schema = "city string, foreign_born int, male_population int, female_population int"
    rows = [("A", 1, 10, 5), ("A", 1, 5, 10), ("B", 2, 9, 9), ("C", 3, None, 1)]
    people = frame(spark, schema, *rows)
    assert listed(analytics.largest_cities(people)) == [("B", 2, 18), ("A", 1, 15), ("C", 3, None)]
    assert len(listed(analytics.largest_cities(people, 1))) == 1


def test_port_temperatures_fan_out_coldest_first(codes, temperature):
    found = [(r.avg_temp, r.code) for r in analytics.port_temperatures(temperature, codes).collect()]
    assert found == [(None, "AKR"), (None, "CAK"), (1.5, "AKR"), (1.5, "CAK"), (9.0, "NYC")]


@pytest.mark.parametrize("many", [1, 2, 5000])
def test_temperature_at_arrival_counts_the_pairs(spark, codes, temperature, many):
    fact = arrivals(spark, AKR=many, CAK=1, NYC=3, XXX=2)
    found = analytics.temperature_at_arrival(temperature, codes, fact)
    assert found.columns == ["avg_temp", "city", "country", "arrivals"]
    joined = temperature.join(codes, "city").join(fact, fact.city_code == codes.code)
    pairs = Counter(listed(joined.select("avg_temp", "city", "country")))
    assert {tuple(row)[:3]: row.arrivals for row in found.collect()} == pairs
    # However many arrivals there are, a row per measurement and country.
    assert found.count() <= 2 * temperature.count()


def test_star_totals_count_the_pairs(spark, codes, temperature):
    fact = arrivals(spark, AKR=4, CAK=1, NYC=3, XXX=2)
    found = analytics.star_totals(temperature, codes, fact).orderBy("city_code")
    assert listed(found) == [
        ("AKR", "AKRON", 2, 4, 8, 1.5), ("CAK", "AKRON", 2, 1, 2, 1.5), ("NYC", "NEW YORK", 1, 3, 3, 9.0)
    ]


def test_arrivals_with_city(spark, codes):
    fact = arrivals(spark, AKR=2, XXX=3)
    found = analytics.arrivals_with_city(fact, codes, ["cic_id"])
    assert listed(found) == [(0, "AKR", "CA", "AKRON"), (1, "AKR", "US", "AKRON")]


def test_visa_at_port(spark, codes):
    fact = frame(spark, "city_code string, visa int", ("AKR", 1), ("NYC", 2))
    assert listed(analytics.visa_at_port(fact, codes)) == [("AKRON", 1)]


def test_means_and_warmest(spark, temperature):
    assert dict(listed(analytics.mean_temperatures(temperature))) == {"AKRON": 1.5, "NEW YORK": 9.0, "OSLO": 3.0}
    assert listed(analytics.warmest_records(temperature, ["city"], 2)) == [(9.0, "NEW YORK"), (3.0, "OSLO")]


def test_first_rows_by_key_or_number(spark, codes):
    assert [r.code for r in analytics.city_code_list(codes, 2).collect()] == ["AKR", "CAK"]
    table = TABLES["dim_demog_statistics"]
    rows = [(f"C{n}", "S", n, 1.0, n) for n in range(1, 30)]
    found = analytics.first_rows(spark.createDataFrame(rows, table.schema), table, 3)
    assert sorted(r.demog_stat_id for r in found.collect()) == [1, 2, 3]
