"""The ledger of raw files: which files of which input a warehouse was made of.

It is a table of the warehouse like the others, published in one version with the data
that came from the files. A refresh reads only files that it does not know; a file
whose size or time has changed counts as new.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from starquay.sources import versions

LEDGER = "load_ledger"
FILE_SCHEMA = StructType(
    [
        StructField("input", StringType()),
        StructField("path", StringType()),
        StructField("length", LongType()),
        StructField("modified", TimestampType()),
    ]
)
LEDGER_SCHEMA = StructType([*FILE_SCHEMA, StructField("batch", LongType())])


def list_files(spark: SparkSession, inputs: Mapping[str, str]) -> DataFrame:
    """(input, path, length, modified) of the files behind a path or glob per input. Names
    and sizes only: the contents are a column that is not read."""

    def listed(name: str, path: str) -> DataFrame:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        return found.select(F.lit(name).alias("input"), "path", "length", F.col("modificationTime").alias("modified"))

    frames = []
    for name, path in inputs.items():
        try:
            frames.append(listed(name, path))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return reduce(DataFrame.unionAll, frames, spark.createDataFrame([], FILE_SCHEMA))


def ledger(spark: SparkSession, root: str, at: versions.Version | None = None) -> DataFrame:
    """(input, path, length, modified, batch) of the files that are loaded already."""
    try:
        return versions.read(spark, root, LEDGER, LEDGER_SCHEMA, at)
    except versions.AbsentTable:
        return spark.createDataFrame([], LEDGER_SCHEMA)


def unseen(spark: SparkSession, root: str, listed: DataFrame) -> DataFrame:
    """The rows of ``listed`` that the ledger under ``root`` does not hold."""
    return listed.join(ledger(spark, root), FILE_SCHEMA.names, "left_anti")


def fingerprint(listed: DataFrame) -> str:
    """The same for the same files, in any order, and for no others."""
    told = F.xxhash64(*listed.columns)
    count, one, two = listed.agg(
        F.count(F.lit(1)), F.bit_xor(told), F.bit_xor(F.xxhash64(told, F.reverse("path")))
    ).first()
    return f"{count}-{(one or 0) & (1 << 64) - 1:016x}{(two or 0) & (1 << 64) - 1:016x}"
