"""Readers of raw files and of stored tables."""

from __future__ import annotations

from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from starquay.functions.columns import named
from starquay.schemas import RAW_ARRIVALS, TABLES
from starquay.sources import versions

_PATH_MISSING = "PATH_NOT_FOUND"
_SOURCE_MISSING = "DATA_SOURCE_NOT_FOUND"
_NO_FILES = "UNABLE_TO_INFER_SCHEMA"


def _absent(error: Exception) -> bool:
    """True if the path, the format or the table does not exist; no other error counts."""
    if isinstance(error, versions.AbsentTable):
        return True
    if isinstance(error, AnalysisException):
        return error.getCondition() in (_PATH_MISSING, _SOURCE_MISSING)
    return isinstance(error, Py4JJavaError) and f"[{_SOURCE_MISSING}]" in str(error)


def read_arrivals(
    spark: SparkSession,
    path: str | list[str],
    format: str = "parquet",
    fallback: str | None = None,
    schema: StructType = RAW_ARRIVALS,
) -> DataFrame:
    """Arrival files under the glob ``path``; the Parquet directory ``fallback`` if
    the glob matches nothing or the format is not installed."""
    try:
        if format == "csv":
            return read_csv(spark, path, schema)
        return spark.read.format(format).load(path)
    except (AnalysisException, Py4JJavaError) as error:
        if fallback is None or not _absent(error):
            raise
    return spark.read.parquet(fallback)


def read_csv(
    spark: SparkSession, path: str | list[str], schema: StructType, separator: str = ","
) -> DataFrame:
    """The declared columns of CSV files with a header line, by name.

    A declared schema alone would be laid over the columns by position, whatever
    the header says. So the header of the first file gives the order, and Spark
    checks that of every file against it. No pass to infer types; a value that does
    not fit its type is NULL. Columns that are not declared are not parsed.
    """
    options = {"header": True, "sep": separator}
    declared = {field.name: field for field in schema}
    names = spark.read.csv(path, **options).columns
    layout = [declared.get(name, StructField(name, StringType())) for name in names]
    return (
        spark.read.schema(StructType(layout))
        .csv(path, enforceSchema=False, **options)
        .select(*(named(name) for name in declared if name in names))
    )


def read_csv_inferred(spark: SparkSession, path: str, separator: str = ",") -> DataFrame:
    """CSV with types found by an extra pass. For exploration, not for jobs."""
    return spark.read.csv(path, header=True, inferSchema=True, sep=separator)


def read_texts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, text): one row per file, so that many files are read in parallel."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("text")
    )


def read_text_splits(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, split, row, line): a row per line of text files of any length. Spark reads a
    long file in many tasks; ``split`` is the byte at which a task's part of it begins, and
    ``row`` rises with the lines of a part."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row"),
        F.col("value").alias("line"),
    )


def text_lines(texts: DataFrame, *keep: str) -> DataFrame:
    """Columns ``keep`` and (line_no, line) of each ``text``, line_no from 0. Every
    line of every text, whichever way lines end."""
    return texts.select(
        *keep, F.posexplode(F.split("text", "\r?\n")).alias("line_no", "line")
    )


def read_table(
    spark: SparkSession, root: str, name: str, at: versions.Version | None = None
) -> DataFrame:
    """A stored warehouse table with its expected columns, of the current version or the
    one given. The declared schema keeps a partition column of digits text."""
    return versions.read(spark, root, name, TABLES[name].schema, at)


def read_table_as_stored(
    spark: SparkSession, root: str, name: str, at: versions.Version | None = None
) -> DataFrame:
    """A stored table with the schema found in its files, for checks. A table
    without files has its expected schema and no rows."""
    partition = TABLES[name].partition_by
    try:
        found = versions.read(spark, root, name, at=at)
    except AnalysisException as error:
        if error.getCondition() != _NO_FILES:
            raise
        return read_table(spark, root, name, at)
    if not found.columns:
        return read_table(spark, root, name, at)
    if partition not in found.columns:
        return found
    # Directory names carry no type, so that of the partition column is declared.
    expected = TABLES[name].schema[partition]
    fields = [expected if field.name == partition else field for field in found.schema]
    return versions.read(spark, root, name, StructType(fields), at)


def stored_tables(
    spark: SparkSession,
    root: str,
    names: Iterable[str] = tuple(TABLES),
    at: versions.Version | None = None,
) -> dict[str, DataFrame]:
    """Reader per registered table that exists under ``root``, all of one version. Goes by
    the registry, so that a table that is absent shows."""
    at = at or versions.latest(spark, root)
    found = {}
    for name in names:
        try:
            found[name] = read_table_as_stored(spark, root, name, at)
        except (AnalysisException, versions.AbsentTable) as error:
            if not _absent(error):
                raise
    return found
