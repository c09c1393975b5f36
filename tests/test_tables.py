import datetime

import domain
import pytest

from starquay.plans import load, tables
from starquay.schemas import RAW_ARRIVALS, TABLES

DAY = datetime.date
US = "United States"


@pytest.fixture(scope="module")
def arrivals(spark):
    return load.stage_arrivals(domain.arrivals(spark))


def listed(df, *order):
    return [tuple(row) for row in df.orderBy(*order).collect()]


def test_cleaning_drops_empty_rows_and_sparse_columns(spark, arrivals):
    clean = tables.clean_arrivals(domain.arrivals(spark))
    assert not {"occup", "entdepu", "insnum"} & set(clean.columns)
    assert clean.count() == 11
    staged, done = arrivals
    assert (done.before_rows, done.after_rows) == (13, 11)
    assert {"occup", "entdepu", "insnum"} <= set(done.sparse)
    assert sorted(staged.columns) == tables.ARRIVAL_COLUMNS


def test_needed_columns_stay_however_sparse(spark):
    only = domain.frame(spark, RAW_ARRIVALS, [dict(cicid=1.0)])
    fact = tables.fact_immigration(tables.clean_arrivals(only))
    assert fact.schema == TABLES["fact_immigration"].schema
    assert fact.first().cic_id == 1


def test_fact(arrivals):
    fact = tables.fact_immigration(arrivals[0])
    assert fact.schema == TABLES["fact_immigration"].schema
    arrived, left = DAY(2016, 4, 30), DAY(2016, 5, 6)
    assert listed(fact, "cic_id") == [
        (1, 2016, 4, "NYC", arrived, left, 1, 2, 1, US, "NJ"),
        (2, 2016, 4, "NYC", DAY(1959, 12, 31), arrived, 1, None, 2, US, "NJ"),
        (9, 2016, 4, "???", None, left, 1, 2, 3, US, "99"),
        (10, 2016, 4, "AKR", arrived, None, 1, 1, 4, US, None),
    ]


def test_columns_are_not_swapped_by_their_order(spark, arrivals):
    shuffled = arrivals[0].select(*sorted(arrivals[0].columns, reverse=True))
    row = tables.fact_immigration(shuffled).where("cic_id = 1").first()
    assert (row.city_code, row.state_code, row.mode, row.visa) == ("NYC", "NJ", 1, 2)
    assert row.arrive_date <= row.departure_date


def test_personal(arrivals):
    found = tables.dim_immigration_personal(arrivals[0])
    assert found.schema == TABLES["dim_immigration_personal"].schema
    assert listed(found, "cic_id") == [
        (1, 582, 236, 1986, "F", 1),
        (2, 582, 236, 1986, None, 2),
        (9, 582, 236, 1986, "F", 3),
        (10, 582, 236, 1986, "F", 4),
    ]


def test_airline(arrivals):
    found = tables.dim_immigration_airline(arrivals[0])
    assert found.schema == TABLES["dim_immigration_airline"].schema
    assert listed(found, "cic_id")[2] == (9, "AA", 92478585633, "00012", "B2", 3)


def test_keys_sort_numbers_in_text_as_numbers(spark):
    text = spark.createDataFrame([("10", "x"), ("9", "y"), ("n", "z")], "cicid string, airline string")
    wide = text.selectExpr(
        "cicid", "airline", "cicid as admnum", "airline as fltno", "airline as visatype"
    )
    found = tables.dim_immigration_airline(wide).orderBy("immi_airline_id").collect()
    assert [row.cic_id for row in found] == [None, 9, 10]


def test_temperature(spark):
    found = tables.dim_temperature(domain.temperatures(spark))
    assert found.schema == TABLES["dim_temperature"].schema
    rows = [
        (r.dt, r.avg_temp, r.city, r.country, r.year, r.month)
        for r in found.orderBy("dt").collect()
    ]
    assert rows == [
        (None, None, "AKRON", "UNITED STATES", None, None),
        (DAY(1743, 11, 1), pytest.approx(3.2), "AKRON", "UNITED STATES", 1743, 11),
        (DAY(2013, 1, 1), -20.0, "AKRON", "UNITED STATES", 2013, 1),
        (DAY(2013, 3, 1), 20.5, "HOMER", "UNITED STATES", 2013, 3),
    ]


def test_demographics(spark):
    clean = tables.clean_demographics(domain.demographics(spark))
    assert clean.count() == 6
    people = tables.dim_demog_population(clean)
    assert people.schema == TABLES["dim_demog_population"].schema
    assert listed(people, "demog_pop_id")[:2] == [
        ("Akron", "Maryland", 7, 41862, 1562, 30908, "White", 1),
        ("Silver Spring", "Maryland", 40601, 41862, 1562, 30908, "Asian", 2),
    ]
    figures = tables.dim_demog_statistics(clean)
    assert figures.schema == TABLES["dim_demog_statistics"].schema
    assert [(r[0], r[1], r[2], round(r[3], 4), r[4]) for r in listed(figures, "demog_stat_id")] == [
        ("AKRON", "MARYLAND", None, 2.6, 1),
        ("SILVER SPRING", "MARYLAND", 33, 2.6, 2),
    ]


def test_code_tables(spark):
    found = tables.code_tables(domain.labels(spark))
    assert {name: df.schema for name, df in found.items()} == {
        name: TABLES[name].schema for name in ("country_code", "city_code", "state_code")
    }
    assert listed(found["city_code"], "code") == [
        ("AKR", "AKRON"),
        ("CAK", "AKRON"),
        ("NYC", "EASTPORT"),
    ]
