"""Session settings for the jobs. Paths, credentials and masters are deployment
settings and stay out of the code."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

# AQE does the run-time work this library leans on: it turns joins into broadcast
# joins on measured sizes, splits skewed join and rebalance partitions, and merges
# small ones. UTC keeps dates and timestamps alike on every host.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def sized_for(
    input_bytes: int, partition_bytes: int = 256 << 20, max_partitions: int | None = None
) -> dict[str, str]:
    """Shuffle settings for a load of ``input_bytes``.

    The initial partition count is set so that one partition of a full shuffle of
    the input is about ``partition_bytes``, which fits in the memory of one task;
    AQE then merges what turns out to be smaller, up to that size. A shuffle keeps a
    record per map and reduce task; where those outgrow the driver, ``max_partitions``
    bounds the count, at the price of larger partitions, which spill.
    """
    partitions = max(200, -(-input_bytes // partition_bytes))
    if max_partitions is not None:
        partitions = min(partitions, max_partitions)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
    }


def build_session(
    app_name: str = "starquay",
    master: str | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def listed_bytes(frames: Iterable[DataFrame]) -> int:
    """Size of the files behind ``frames``, as the planner has listed them. What is no
    file and has no statistics counts as nothing."""
    total = 0
    for df in frames:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        total += size if size < 1 << 60 else 0
    return total


def size_shuffles(spark: SparkSession, input_bytes: int) -> None:
    """Apply ``sized_for`` to a running session."""
    for key, value in sized_for(input_bytes).items():
        spark.conf.set(key, value)
