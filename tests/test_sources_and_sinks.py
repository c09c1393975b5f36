from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from starquay.schemas import RAW_DEMOGRAPHICS, TABLES, Table, columns
from starquay.sources import readers, sinks


def test_arrivals_fall_back_only_if_nothing_is_there(spark, tmp_path):
    kept = str(tmp_path / "kept")
    spark.range(3).write.parquet(kept)
    assert readers.read_arrivals(spark, f"{tmp_path}/no/*.x", fallback=kept).count() == 3
    absent = readers.read_arrivals(spark, f"{tmp_path}/no/*", "no.such.format", fallback=kept)
    assert absent.count() == 3
    with pytest.raises(AnalysisException):
        readers.read_arrivals(spark, f"{tmp_path}/no/*")
    (tmp_path / "broken.parquet").write_text("not parquet")
    with pytest.raises(Exception) as caught:
        readers.read_arrivals(spark, f"{tmp_path}/broken.parquet", fallback=kept).count()
    assert "PATH_NOT_FOUND" not in str(caught.value)


def test_arrivals_as_csv_have_declared_types(spark, tmp_path):
    (tmp_path / "a.csv").write_text("cicid,i94yr\n1.0,2016\nx,2017\n")
    found = readers.read_arrivals(spark, str(tmp_path / "*.csv"), "csv", schema=columns("cicid double, i94yr double"))
    assert [tuple(r) for r in found.collect()] == [(1.0, 2016.0), (None, 2017.0)]


def test_csv_columns_go_by_name(spark, tmp_path):
    schema = columns("a double, b string, c string")
    (tmp_path / "1.csv").write_text(",c,a,other\n0,see,1.5,x\n")
    found = readers.read_csv(spark, str(tmp_path), schema)
    assert found.dtypes == [("a", "double"), ("c", "string")]
    assert [tuple(r) for r in found.collect()] == [(1.5, "see")]
    (tmp_path / "2.csv").write_text(",a,c,other\n0,2.5,sea,x\n")
    with pytest.raises(Exception, match="header"):
        readers.read_csv(spark, str(tmp_path), schema).collect()


def test_semicolons_and_blanks_in_names(spark, tmp_path):
    head = ";".join(RAW_DEMOGRAPHICS.names)
    (tmp_path / "d.csv").write_text(head + "\nSilver Spring;Maryland;33.8;1;2;3;;5;2.6;MD;White;9\n")
    row = readers.read_csv(spark, str(tmp_path / "d.csv"), RAW_DEMOGRAPHICS, ";").first()
    assert row["Median Age"] == "33.8" and row["Number of Veterans"] is None


def test_inferred_types(spark, tmp_path):
    (tmp_path / "i.csv").write_text("a,b,c\n1,2.5,x\n")
    assert readers.read_csv_inferred(spark, str(tmp_path / "i.csv")).dtypes == [
        ("a", "int"),
        ("b", "double"),
        ("c", "string"),
    ]


def states(spark, rows):
    return spark.createDataFrame(rows, "n int, state_code string")


def test_partition_column_of_digits_stays_text(spark, tmp_path):
    df = states(spark, [(1, "99"), (2, "07"), (3, None)])
    sinks.write_table(df, str(tmp_path / "t"), partition_by="state_code")
    assert spark.read.parquet(str(tmp_path / "t")).schema["state_code"].dataType != df.schema["state_code"].dataType
    found = spark.read.schema(df.schema).parquet(str(tmp_path / "t"))
    assert sorted(map(tuple, found.collect())) == [(1, "99"), (2, "07"), (3, None)]


def test_reload_of_one_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(states(spark, [(1, "CA"), (2, "NJ")]), path, partition_by="state_code")
    sinks.write_table(
        states(spark, [(9, "NJ")]), path, partition_by="state_code", only_given_partitions=True
    )
    found = spark.read.schema("n int, state_code string").parquet(path)
    assert sorted(map(tuple, found.collect())) == [(1, "CA"), (9, "NJ")]
    sinks.write_table(states(spark, [(5, "AL")]), path, partition_by="state_code")
    assert spark.read.schema("n int, state_code string").parquet(path).count() == 1


def test_a_hot_partition_is_split_and_small_ones_are_not(spark, tmp_path):
    df = (
        spark.range(400000, numPartitions=8)
        .withColumn("text", F.sha2(F.col("id").cast("string"), 256))
        .withColumn(
            "state_code",
            F.when(F.col("id") % 3 == 0, "CA").otherwise(F.concat(F.lit("S"), F.col("id") % 40)),
        )
    )
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(2 << 20))
    try:
        sinks.write_table(df, str(tmp_path / "t"), partition_by="state_code")
    finally:
        spark.conf.set(setting, before)

    def files(state):
        return len(list(Path(tmp_path / "t" / f"state_code={state}").glob("*.parquet")))

    assert files("CA") > 2
    assert files("S1") <= 2
    assert spark.read.parquet(str(tmp_path / "t")).count() == 400000


CODES = Table("codes", columns("code string, label string, id bigint"), ("code",), "id")


def test_new_rows_compare_missing_keys(spark):
    old = spark.createDataFrame([("a", 1), (None, 2)], "code string, n int")
    new = spark.createDataFrame([("a", 5), (None, 6), ("b", 7), ("b", 8)], "code string, n int")
    assert sorted(r.n for r in sinks.new_rows(old, new, ["code"]).collect()) == [7, 8]
    only = old.where("code = 'a'")
    assert sorted(r.n for r in sinks.new_rows(only, new, ["code"]).collect()) == [6, 7, 8]


def test_new_rows_on_several_columns_with_one_source(spark):
    df = spark.createDataFrame([(1, None), (1, "x"), (2, "x")], "a int, b string")
    assert sinks.new_rows(df.where("a = 1"), df, ["a", "b"]).collect() == [(2, "x")]
    assert sinks.new_rows(df, df, ["a", "b"]).count() == 0


def test_append_goes_on_with_keys_and_adds_nothing_twice(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(TABLES, "codes", CODES)
    root = str(tmp_path)
    first = spark.createDataFrame([("a", "A", 1), ("b", "B", 2)], CODES.schema)
    sinks.write_table(first, f"{root}/codes")
    incoming = spark.createDataFrame(
        [("b", "new label"), ("d", "D"), ("c", "C"), (None, "?")], "code string, label string"
    )
    for _ in range(2):
        sinks.append_new_rows(spark, incoming.union(incoming), root, CODES)
        found = readers.read_table(spark, root, "codes").orderBy("id").collect()
        # A known code with another label is another row, as in a full load.
        assert [tuple(r) for r in found] == [
            ("a", "A", 1),
            ("b", "B", 2),
            (None, "?", 3),
            ("b", "new label", 4),
            ("c", "C", 5),
            ("d", "D", 6),
        ]


def test_append_to_a_table_that_is_not_there(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(TABLES, "codes", CODES)
    rows = spark.createDataFrame([("a", "A"), ("a", "A")], "code string, label string")
    sinks.append_new_rows(spark, rows, str(tmp_path), CODES)
    assert [tuple(r) for r in readers.read_table(spark, str(tmp_path), "codes").collect()] == [("a", "A", 1)]


def test_append_refuses_other_types(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(TABLES, "codes", CODES)
    rows = spark.createDataFrame([("a", 1)], "code string, label int")
    with pytest.raises(TypeError, match="codes: .*label"):
        sinks.append_new_rows(spark, rows, str(tmp_path), CODES)


def test_history_is_not_shuffled_whole(spark):
    history = spark.range(100_000).select(F.col("id").cast("string").alias("code"))
    asked = spark.createDataFrame([("7",), ("x",)], "code string")
    assert [r.code for r in sinks.new_rows(history, asked, ["code"]).collect()] == ["x"]


def test_csv_sample(spark, tmp_path):
    path = str(tmp_path / "s")
    sinks.write_csv_sample(spark.range(100).select(F.col("id").alias("a b")), path, 3, ["a b"])
    assert sorted(r[0] for r in readers.read_csv_inferred(spark, path).collect()) == [0, 1, 2]


def test_stored_tables_finds_what_is_there(spark, tmp_path):
    spark.createDataFrame([("a", "A")], TABLES["country_code"].schema).write.parquet(
        f"{tmp_path}/country_code"
    )
    assert list(readers.stored_tables(spark, str(tmp_path))) == ["country_code"]


def test_new_whole_rows_are_shuffled_once_for_both_joins(spark):
    rows = [(1, None), (1, None), (2, "b"), (3, "c"), (None, None)]
    incoming = spark.createDataFrame(rows, "k bigint, v string")
    stored = spark.createDataFrame([("b", 9, 2), ("x", 8, 3), (None, 7, None)], "v string, id int, k bigint")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        fresh = sinks.new_whole_rows(stored, incoming)
        assert sorted(map(str, fresh.collect())) == sorted(["Row(k=1, v=None)", "Row(k=3, v='c')"])
        plan = fresh._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert (plan.count("+- Exchange ") + plan.count(":- Exchange "), plan.count("ReusedExchange ")) == (2, 1), plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
