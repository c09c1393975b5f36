import random

from pyspark.sql import functions as F

from starquay.operators import cleaning
from starquay.operators.keys import dense_key, unique_key

GAPS = [("a", None, 1.0), ("b", None, None), (None, None, float("nan")), ("d", "x", 2.0)]


def gaps(spark):
    return spark.createDataFrame(GAPS, "`Median Age` string, `a.b` string, c double")


def test_missing_profile(spark):
    found = [tuple(row) for row in cleaning.missing_profile(gaps(spark)).collect()]
    assert found == [("a.b", 3, 75.0), ("Median Age", 1, 25.0), ("c", 1, 25.0)]


def test_missing_profile_ascending(spark):
    found = cleaning.missing_profile(gaps(spark), ascending=True).collect()
    assert [row.column_name for row in found] == ["Median Age", "c", "a.b"]


def test_missing_profile_of_nothing(spark):
    assert cleaning.missing_profile(gaps(spark).where("false")).collect() == []


def test_drop_sparse_columns_is_strict_and_keeps(spark):
    assert cleaning.drop_sparse_columns(gaps(spark), 0.75).columns == gaps(spark).columns
    assert cleaning.drop_sparse_columns(gaps(spark), 0.7).columns == ["Median Age", "c"]
    assert "a.b" in cleaning.drop_sparse_columns(gaps(spark), 0.7, keep=["a.b"]).columns


def test_first_per_key_does_not_depend_on_partitions(spark):
    rng = random.Random(3)
    rows = [
        (rng.choice(["hot", "hot", "x", None]), rng.randint(0, 9), rng.randint(0, 99))
        for _ in range(600)
    ]
    expected = {}
    for key, a, b in rows:
        expected[key] = min(expected.get(key, (100, 100)), (a, b))
    for parts in (1, 7):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "k string, a int, b int").repartition(parts)
        once = cleaning.first_per_key(df, ["k"])
        assert {r.k: (r.a, r.b) for r in once.collect()} == expected
        twice = cleaning.first_per_key(once, ["k"])
        assert sorted(twice.collect(), key=str) == sorted(once.collect(), key=str)
        assert once.distinct().count() == once.count()


def test_first_per_key_by_stated_order(spark):
    df = spark.createDataFrame([("k", "9", 1), ("k", "10", 2)], "k string, t string, n int")
    number = F.col("t").try_cast("double").desc()
    assert cleaning.first_per_key(df, ["k"], [number]).first().n == 2


def test_hot_keys_are_cut_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    plan = cleaning.first_per_key(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("row_number(), 1, Partial")
    assert plan.index("Exchange hashpartitioning") < partial


def test_rows_before_and_after(spark):
    df = spark.range(10)
    found = cleaning.rows_before_and_after(df, F.col("id") > 6).first()
    assert tuple(found) == (10, 3, 7)


def keyed(df, order, **more):
    return {row[0]: row["key"] for row in dense_key(df, "key", order, **more).collect()}


def test_dense_key_repeats_and_has_no_gaps(spark):
    df = spark.range(5000).select(
        "id", ((F.col("id") * 7919) % 5003).alias("lead"), (F.col("id") % 3).alias("x")
    )
    rows = sorted(df.collect(), key=lambda r: (r.lead, r.id))
    expected = {row.id: n for n, row in enumerate(rows, 1)}
    assert keyed(df, ["lead"]) == expected
    assert keyed(df.repartition(13), ["lead"]) == expected


def test_dense_key_with_null_nan_and_a_hot_lead(spark):
    values = [None, float("nan"), 1.0, 1.0, 1.0, 1.0, -3.0]
    rows = [(i, values[i % 7]) for i in range(700)]
    df = spark.createDataFrame(rows, "id int, lead double")
    found = keyed(df, ["lead", "id"])
    assert sorted(found.values()) == list(range(1, 701))
    groups = [sorted(k for i, k in found.items() if i % 7 in g) for g in ([0], [6], [2, 3, 4, 5], [1])]
    assert groups == [
        list(range(1, 101)),
        list(range(101, 201)),
        list(range(201, 601)),
        list(range(601, 701)),
    ]


def test_a_hot_lead_is_split_over_partitions(spark):
    df = spark.range(20000).select(F.lit("same").alias("lead"), "id").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        plan = dense_key(df, "key", ["lead"])
        parts = len(plan.inputFiles())
        assert plan.agg(F.max("key")).first()[0] == 20000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert parts == 8


def test_dense_key_start_and_empty_input(spark):
    df = spark.range(3)
    assert keyed(df, ["id"], start=40) == {0: 41, 1: 42, 2: 43}
    assert keyed(df.where("id > 5"), ["id"]) == {}


def test_unique_key(spark):
    found = unique_key(spark.range(1000).repartition(5), "key")
    assert found.select("key").distinct().count() == 1000
