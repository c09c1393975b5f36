"""Checks of stored tables. Results go by table name."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starquay.schemas import TABLES
from starquay.sources import versions

EXPECTED = {name: table.schema for name, table in TABLES.items()}


class QualityError(ValueError):
    """A stored table is not as it should be."""


def _difference(found: StructType | None, expected: StructType) -> str:
    if found is None:
        return "absent"
    if found == expected:
        return ""
    return f"expected {expected.simpleString()}, found {found.simpleString()}"


def _differences(tables: Mapping[str, DataFrame], expected: Mapping[str, StructType]) -> dict[str, str]:
    return {
        name: _difference(tables[name].schema if name in tables else None, schema) for name, schema in expected.items()
    }


def schema_report(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    expected: Mapping[str, StructType] = EXPECTED,
) -> DataFrame:
    """(table_name, ok, detail) per expected table: names, order, types and
    nullability of its columns. Looks at metadata only."""
    rows = [(name, detail == "", detail) for name, detail in _differences(tables, expected).items()]
    return spark.createDataFrame(rows, "table_name string, ok boolean, detail string")


def file_schema_report(
    spark: SparkSession,
    root: str,
    names: Sequence[str] = tuple(TABLES),
    at: versions.Version | None = None,
    at_once: int = 16,
) -> DataFrame:
    """(table_name, file, ok, detail) per data file of the tables of a version.

    A table is read with the schema of one of its files, so a file with another type, or
    without a column, shows only when its footer is read. Each footer is read by a small job of
    its own, ``at_once`` at a time. The partition column is in the path and not in files.
    """
    at = at or versions.latest(spark, root)
    rows = []
    for name in names:
        table = TABLES[name]
        fields = [field for field in table.schema if field.name != table.partition_by]

        def judge(file: str, name: str = name, expected: StructType = StructType(fields)):
            detail = _difference(spark.read.parquet(file).schema, expected)
            return name, file, detail == "", detail

        files = versions.leaf_files(spark, versions.paths_of(spark, root, name, at))
        with ThreadPoolExecutor(max_workers=at_once) as pool:
            rows += pool.map(judge, files)
    return spark.createDataFrame(rows, "table_name string, file string, ok boolean, detail string")


def require_schemas(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    expected: Mapping[str, StructType] = EXPECTED,
) -> None:
    """Raise if a table is absent or differs; names every such table."""
    failed = [f"{name}: {detail}" for name, detail in _differences(tables, expected).items() if detail]
    if failed:
        raise QualityError("; ".join(failed))


def _union(frames) -> DataFrame:
    return reduce(DataFrame.unionAll, frames)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, records) of all tables in one job."""
    return _union(
        df.agg(F.count(F.lit(1)).alias("records")).select(
            F.lit(name).alias("table_name"), "records"
        )
        for name, df in tables.items()
    )


def require_rows(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Raise if a table is empty; else return the row counts. One job counts them all,
    one row per table."""
    found = [(row.table_name, row.records) for row in row_counts(tables).collect()]
    empty = sorted(name for name, records in found if not records)
    if empty:
        raise QualityError(f"empty tables: {', '.join(empty)}")
    return spark.createDataFrame(found, "table_name string, records bigint")


def schema_listing(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, position, column_name, type) of every column, positions from 1."""
    rows = [
        (name, position, field.name, field.dataType.simpleString())
        for name, df in tables.items()
        for position, field in enumerate(df.schema, 1)
    ]
    return spark.createDataFrame(
        rows, "table_name string, position int, column_name string, type string"
    )
