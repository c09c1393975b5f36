"""Every registered query against its SQL, and the shape of their plans."""

import os

import pytest
from compare import connect, differences

import __spark_entry__ as spark_entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLE = spark_entry.queries(), spark_entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_agrees_with_sql(spark, connection, name):
    assert differences(QUERIES[name](spark, SF_DIR), connection, ORACLE[name]) == []


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0


def plan(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


PLANNED = [
    "g2_visa_type_usage",
    "g6_name_join_sorted",
    "g8_three_way_star",
    "g8_temperature_at_arrival",
    "j1_dimension_to_fact",
    "c1_day_number_to_date",
    "d2_distinct_on_key",
    "t4_temperature_table",
    "l3_city_codes",
]


@pytest.mark.parametrize("name", PLANNED)
def test_no_python_and_no_cross_product(spark, name):
    found = plan(spark, name)
    for word in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "NestedLoopJoin"):
        assert word not in found


def test_filters_and_columns_reach_the_scan(spark):
    found = plan(spark, "f1_equality_filter")
    assert "EqualTo(event_type,purchase)" in found
    assert "ReadSchema: struct<event_id:bigint,event_type:string,value:double>" in found
    # The filter on the join key holds for the other side as well.
    assert "EqualTo(c_custkey,42)" in plan(spark, "j5_filter_on_join_key")


def test_top_k_does_not_sort_everything(spark):
    for name in ("g1_top_population", "g5_warmest", "o1_top_ten"):
        assert "TakeOrderedAndProject" in plan(spark, name)


def test_label_texts_are_parsed_without_a_shuffle(spark):
    assert "Exchange" not in plan(spark, "l1_customer_label_texts")
