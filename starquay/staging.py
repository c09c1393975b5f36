"""Intermediate tables in the shared folder of the cluster.

Where a frame is read more than once, or where a value that depends on task order
was computed, the frame is written to Parquet once and read back. That cuts the
lineage, survives the loss of executors, and lets each reader prune columns.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from starquay.files import delete

_SETTING = "spark.checkpoint.dir"
_WAREHOUSE = "spark.sql.warehouse.dir"
_DEFAULT_WAREHOUSE = "spark-warehouse"
_written: ContextVar[list[str] | None] = ContextVar("staged", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, or set on the context; else one in the
    warehouse, which Spark shares between all machines. Without either, on several machines,
    an error: the warehouse is then a folder of the driver's disk, which executors
    do not see."""
    folder = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    warehouse = spark.conf.get(_WAREHOUSE).rstrip("/")
    local = spark.sparkContext.master.startswith("local")
    if not local and warehouse.startswith("file:") and warehouse.endswith(f"/{_DEFAULT_WAREHOUSE}"):
        raise ValueError(f"set {_SETTING} to a folder that all machines share")
    return f"{warehouse}/staging"


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/starquay/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return f"{_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, **options: int) -> DataFrame:
    """Write ``df`` to the shared folder now, with the ``options`` of a writer, and return a reader of it."""
    spark = df.sparkSession
    path = new_path(spark, label)
    written = _written.get()
    if written is not None:
        written.append(path)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Remove at the end what this thread staged inside the block, failed or not. Frames
    that read it must have been used by then."""
    mark = _written.set([])
    try:
        yield
    finally:
        for path in _written.get():
            delete(spark, path)
        _written.reset(mark)


def discard(spark: SparkSession) -> None:
    """Remove what this application staged. Frames that read it become invalid."""
    delete(spark, _folder(spark))
