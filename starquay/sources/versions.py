"""Versions of a warehouse: which files make up each table.

Data files are written once, into folders of their own (segments), and never changed. A
version is a small JSON file that names the segments or files of every table, and the newest
version is current. So a load shows all at once when its version is written, and one
that fails shows nothing; readers of the version before go on undisturbed. Two
loads that start from one version cannot both publish.

A table that no version knows is the folder of its name, so plain folders of Parquet files
can be read, and become part of the first version.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from starquay import files

_VERSIONS = "_versions"
_SEGMENTS = "segments"
# Segments are partitions of one folder, which lets one scan read all of a table.
_SEGMENT = "segment"
_NAME = re.compile(r"(\d{8})\.json")


class AbsentTable(LookupError):
    """The warehouse has no table of that name."""


class PublishConflict(RuntimeError):
    """Another load has published since this one started."""


@dataclass(frozen=True)
class Version:
    """``tables``: paths under the root, by table. ``notes``: what loads remember."""

    number: int = 0
    tables: Mapping[str, Sequence[str]] = field(default_factory=dict)
    notes: Mapping[str, object] = field(default_factory=dict)


def _path(root: str, number: int) -> str:
    return f"{root}/{_VERSIONS}/{number:08}.json"


def _numbers(spark: SparkSession, root: str) -> list[int]:
    names = (_NAME.fullmatch(entry.name) for entry in files.listing(spark, f"{root}/{_VERSIONS}"))
    return [int(match.group(1)) for match in names if match]


def version(spark: SparkSession, root: str, number: int) -> Version:
    found = json.loads(files.read_text(spark, _path(root, number)))
    return Version(number, found["tables"], found["notes"])


def latest(spark: SparkSession, root: str) -> Version:
    """The current version; number 0 and no tables before the first."""
    numbers = _numbers(spark, root)
    return version(spark, root, max(numbers)) if numbers else Version()


def paths_of(spark: SparkSession, root: str, name: str, at: Version | None = None) -> list[str]:
    """Where the files of a table are; AbsentTable if there is none."""
    at = at or latest(spark, root)
    if name in at.tables:
        return [f"{root}/{path}" for path in at.tables[name]]
    if files.exists(spark, f"{root}/{name}"):
        return [f"{root}/{name}"]
    raise AbsentTable(f"{name}: absent from version {at.number} of {root}")


def read(
    spark: SparkSession, root: str, name: str, schema: StructType | None = None, at: Version | None = None
) -> DataFrame:
    """A table of a version. Without ``schema``, as its files say."""
    paths = paths_of(spark, root, name, at)
    reader = spark.read if schema is None else spark.read.schema(schema)
    base = f"{root}/{_SEGMENTS}/{name}"
    own = [path for path in paths if path.startswith(f"{base}/")]
    found = [reader.parquet(path) for path in paths if path not in own]
    if own:
        found.append(reader.option("basePath", base).parquet(*own).drop(_SEGMENT))
    if not found:
        return spark.createDataFrame([], schema or StructType())
    if schema is not None:
        found = [df.select(*(f"`{column}`" for column in schema.names)) for df in found]
    return reduce(DataFrame.unionByName, found)


def new_segment(name: str) -> str:
    """A path under the root that nothing else uses, for files of a table."""
    return f"{_SEGMENTS}/{name}/{_SEGMENT}=s{uuid.uuid4().hex}"


def data_files(spark: SparkSession, root: str, paths: Sequence[str]) -> list[str]:
    """Paths under the root with each segment replaced by the files right in it."""
    found = []
    for path in paths:
        if path.endswith(".parquet"):
            found.append(path)
            continue
        entries = files.listing(spark, f"{root}/{path}")
        found += [f"{path}/{e.name}" for e in entries if not e.is_folder and e.name.endswith(".parquet")]
    return found


def leaf_files(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The data files under some folders, at any depth. Names only are read."""
    if not paths:
        return []
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    return sorted(row.path for row in listed.where("path like '%.parquet'").select("path").collect())


def publish(
    spark: SparkSession,
    root: str,
    base: Version,
    tables: Mapping[str, Sequence[str]],
    notes: Mapping[str, object] | None = None,
) -> Version:
    """Make ``base`` with other files for ``tables``, and more ``notes``, the current version."""
    made = Version(
        base.number + 1,
        {**base.tables, **{name: list(paths) for name, paths in tables.items()}},
        {**base.notes, **(notes or {})},
    )
    text = json.dumps({"tables": made.tables, "notes": made.notes}, indent=1, sort_keys=True)
    try:
        files.write_text_once(spark, _path(root, made.number), text)
    except FileExistsError as error:
        raise PublishConflict(f"version {made.number} of {root} was published meanwhile") from error
    return made


def remove_old(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Remove all but the last ``keep`` versions, and the files that only they, or failed
    loads, made. Not while a load runs."""
    numbers = sorted(_numbers(spark, root))
    kept = [version(spark, root, number) for number in numbers[-keep:]]
    used = {path for one in kept for paths in one.tables.values() for path in paths}
    for number in numbers[:-keep]:
        files.delete(spark, _path(root, number))
    for entry in files.listing(spark, f"{root}/{_VERSIONS}"):
        if not _NAME.fullmatch(entry.name):
            files.delete(spark, f"{root}/{_VERSIONS}/{entry.name}")
    for table in files.listing(spark, f"{root}/{_SEGMENTS}"):
        for segment in files.listing(spark, f"{root}/{_SEGMENTS}/{table.name}"):
            path = f"{_SEGMENTS}/{table.name}/{segment.name}"
            if path in used:
                continue
            held = [file for file in used if file.startswith(f"{path}/")]
            if not held:
                files.delete(spark, f"{root}/{path}")
                continue
            for file in set(data_files(spark, root, [path])) - set(held):
                files.delete(spark, f"{root}/{file}")


@dataclass
class Progress:
    """Tables that a load has finished but not published yet, kept under the load's id, so that
    the same load, started again, does not write them again."""

    spark: SparkSession
    root: str
    load_id: str | None

    def _folder(self) -> str:
        return f"{self.root}/{_VERSIONS}/progress-{self.load_id}"

    def finished(self) -> dict[str, object]:
        if self.load_id is None:
            return {}
        names = [entry.name for entry in files.listing(self.spark, self._folder()) if entry.name.endswith(".json")]
        return {
            name.removesuffix(".json"): json.loads(files.read_text(self.spark, f"{self._folder()}/{name}"))
            for name in names
        }

    def finish(self, name: str, value: object) -> None:
        if self.load_id is not None:
            files.write_text_once(self.spark, f"{self._folder()}/{name}.json", json.dumps(value))

    def forget(self) -> None:
        if self.load_id is not None:
            files.delete(self.spark, self._folder())
