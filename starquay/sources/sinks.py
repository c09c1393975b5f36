"""Writers of tables, and names for SQL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starquay.functions.columns import named
from starquay.operators.keys import dense_key, largest_key
from starquay.schemas import TABLES, Table
from starquay.sources import versions
from starquay.sources.readers import read_table, stored_tables
from starquay.staging import stage

_KEY = "__key"


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: str | None = None,
    only_given_partitions: bool = False,
    looked_up_by: str | None = None,
) -> None:
    """Write Parquet, in one directory per value of ``partition_by`` if given.

    The rebalance hint brings the rows of a value together, so that a value does
    not get a file from every task, and lets AQE split a value that holds a large
    share of the rows over several tasks of the advisory size.
    ``only_given_partitions`` leaves the other partitions of the table in place.

    With ``looked_up_by`` the rows of a task are sorted by that column, which costs
    little, as rows are sorted by partition anyway; the ranges and Bloom filters in the files
    then let a filter on it skip row groups and pages.
    """
    if partition_by is not None:
        df = df.hint("rebalance", partition_by)
    if looked_up_by is not None:
        df = df.sortWithinPartitions(*map(named, filter(None, (partition_by, looked_up_by))))
    writer = df.write.mode(mode)
    if looked_up_by is not None:
        writer = writer.option(f"parquet.bloom.filter.enabled#{looked_up_by}", "true")
    if partition_by is None:
        writer.parquet(path)
        return
    writer = writer.partitionBy(partition_by)
    if mode == "overwrite" and only_given_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def new_rows(existing: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``incoming`` whose ``key`` does not occur in ``existing``.

    Keys are compared as structs, in which NULL equals NULL: a row without a key
    is new once, not on every load. The incoming keys, cut to one row each, are
    staged first. History is cut to them by a semi join, which AQE turns into a
    broadcast of the smaller side on its measured size, so history is scanned but
    not shuffled; only what it has in common with the incoming keys goes on.
    """
    keyed = incoming.withColumn(_KEY, F.struct(*map(named, key)))
    asked = stage(keyed.select(_KEY).distinct(), "asked_keys")
    history = existing.select(F.struct(*map(named, key)).alias(_KEY))
    known = history.join(asked, _KEY, "left_semi").distinct()
    fresh = stage(asked.join(known, _KEY, "left_anti"), "fresh_keys")
    return keyed.join(fresh, _KEY, "left_semi").drop(_KEY)


def new_whole_rows(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """The distinct rows of ``incoming`` that do not occur in ``existing``, compared by all
    columns of ``incoming``, NULL equal to NULL.

    As in ``new_rows``, history is cut to the incoming rows by a semi join. The row is its own
    key, so it is shuffled once for both joins, and nothing is joined back or staged.
    """
    row = F.struct(*map(named, incoming.columns)).alias(_KEY)
    asked = incoming.select(row).distinct()
    known = existing.select(row).join(asked, _KEY, "left_semi").distinct()
    return asked.join(known, _KEY, "left_anti").select(f"{_KEY}.*")


def write_segment(df: DataFrame, root: str, name: str, as_files: bool = False) -> list[str]:
    """Write rows of a table to a segment of its own, which no version names yet, and return
    its path under ``root``, or with ``as_files`` the paths of its files. A registered
    table is laid out as its entry says."""
    segment = versions.new_segment(name)
    table = TABLES.get(name)
    layout = {}
    if table is not None:
        layout = {key: c for key in ("partition_by", "looked_up_by") if (c := getattr(table, key)) in df.columns}
    write_table(df, f"{root}/{segment}", **layout)
    return versions.data_files(df.sparkSession, root, [segment]) if as_files else [segment]


def added_rows(
    spark: SparkSession, incoming: DataFrame, root: str, table: Table, base: versions.Version, order_by=None
) -> list[str]:
    """The paths of a stored table of ``base`` with what is new in ``incoming`` added, in a
    segment that is not published yet. For tables of which a row is all that identifies it.

    What is new is told by ``table.identity``: the whole row but its surrogate key. So a
    load and a refresh leave the rows of one load of both. A table that was never written
    is empty. Keys of new rows go on from the largest stored one. A second run with the
    same rows adds nothing.
    """
    given = incoming.schema
    expected = [f for f in table.schema if f.name != table.id_column]
    found = {f.name: f.dataType for f in given}
    wrong = [f.name for f in expected if found.get(f.name) != f.dataType]
    if wrong:
        raise TypeError(f"{table.name}: columns absent or of another type: {', '.join(wrong)}")
    is_new = table.name not in stored_tables(spark, root, [table.name], base)
    stored = spark.createDataFrame([], table.schema) if is_new else read_table(spark, root, table.name, base)
    paths = [] if is_new else list(base.tables.get(table.name, [table.name]))
    if table.id_column:
        last = largest_key(stored, table.id_column)
        fresh = new_whole_rows(stored, incoming.select(*map(named, table.identity)))
        # Numbering stages the rows, so asking for one below does not join again.
        fresh = dense_key(fresh, table.id_column, order_by or table.natural_key, start=last)
    else:
        fresh = new_rows(stored, incoming, list(table.identity))
    if not is_new and fresh.isEmpty():
        return paths
    fresh = fresh.select(*map(named, table.schema.names))
    return paths + write_segment(fresh, root, table.name)


def append_new_rows(
    spark: SparkSession, incoming: DataFrame, root: str, table: Table, order_by=None
) -> None:
    """Append-only refresh of one stored table, published by itself; see ``added_rows``."""
    base = versions.latest(spark, root)
    versions.publish(spark, root, base, {table.name: added_rows(spark, incoming, root, table, base, order_by)})


def key_of(columns: Sequence[Column | str]) -> Column:
    """Columns as one struct, in which NULL equals NULL."""
    return F.struct(*(named(c) if isinstance(c, str) else c for c in columns)).alias(_KEY)


def replaced_rows(
    spark: SparkSession,
    root: str,
    name: str,
    schema: StructType,
    paths: Sequence[str],
    key: Sequence[str],
    keys: DataFrame,
    rows: DataFrame,
) -> list[str]:
    """The files of a table with all rows of some keys replaced by ``rows``: copy on write.

    ``keys`` holds a struct as made by ``key_of``, once each. Only files that hold a row of
    such a key are written anew, without those rows; the others stay as they are, and
    keys that are new rewrite nothing. ``paths`` are those of the table under ``root``;
    what is returned is not published yet. The names of the files that are hit come to
    the driver, as those of all files do whenever a table is read.
    """
    held = versions.data_files(spark, root, paths)

    def read(given: list[str]) -> DataFrame:
        return spark.read.schema(schema).parquet(*(f"{root}/{path}" for path in given))

    hit: set[str] = set()
    if held:
        marked = read(held).select(key_of(key), F.col("_metadata.file_name").alias("file"))
        hit = {row.file for row in marked.join(keys, _KEY, "left_semi").select("file").distinct().collect()}
    rewritten = [path for path in held if path.rsplit("/", 1)[1] in hit]
    written = rows.select(*map(named, schema.names))
    if rewritten:
        old = read(rewritten).withColumn(_KEY, key_of(key))
        written = old.join(keys, _KEY, "left_anti").drop(_KEY).unionByName(written)
    untouched = [path for path in held if path not in rewritten]
    return untouched + write_segment(written, root, name, as_files=True)


def publish(tables: dict[str, DataFrame]) -> None:
    """Give each frame its name in SQL."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def publish_warehouse(spark: SparkSession, root: str) -> None:
    """Name the stored tables in SQL. The views read Parquet, so a query does not
    run the cleaning again."""
    at = versions.latest(spark, root)
    publish({name: read_table(spark, root, name, at) for name in TABLES})


def write_csv_sample(df: DataFrame, path: str, rows: int, order_by: list[str]) -> None:
    """The first ``rows`` rows in a stated order, as CSV with a header."""
    ordered = df.orderBy(*map(named, order_by)).limit(rows)
    ordered.write.mode("overwrite").csv(path, header=True)
