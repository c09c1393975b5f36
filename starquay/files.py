"""Small files beside the data, through the file system that Spark itself uses."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Entry:
    name: str
    is_folder: bool


def _open(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    found, files = _open(spark, path)
    return files.exists(found)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file, or a folder and all in it, if it is there."""
    found, files = _open(spark, path)
    files.delete(found, True)


def listing(spark: SparkSession, folder: str) -> list[Entry]:
    """What is right in a folder, by name; nothing if it is not there."""
    found, files = _open(spark, folder)
    if not files.exists(found):
        return []
    entries = (Entry(s.getPath().getName(), s.isDirectory()) for s in files.listStatus(found))
    return sorted(entries, key=lambda entry: entry.name)


def read_text(spark: SparkSession, path: str) -> str:
    found, files = _open(spark, path)
    stream = files.open(found)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text_once(spark: SparkSession, path: str, text: str) -> None:
    """A new file, whole or not at all; FileExistsError if its name is taken."""
    target, files = _open(spark, path)
    part, _ = _open(spark, f"{path}.{uuid.uuid4().hex}.part")
    stream = files.create(part, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    if files.exists(target) or not files.rename(part, target):
        files.delete(part, False)
        raise FileExistsError(path)
