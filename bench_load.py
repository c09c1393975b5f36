"""Time of the whole load on the given tables, repeated COPIES times with new keys.

Usage: python bench_load.py COPIES [COPIES ...]; reads BENCH_SF_DIR and BENCH_CPUS as
bench.py does. Prints one JSON line per number of copies. The raw files are made
before the clock starts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starquay.plans import load
from starquay.session import build_session
from starquay.staging import discard, new_path
from workload import standins

# Columns that make the copies of a raw frame distinct.
NUMBERS = {"arrivals": ["cicid"], "temperature": [], "demographics": [], "labels": []}
TEXTS = {
    "arrivals": [],
    "temperature": ["City"],
    "demographics": ["City"],
    "labels": ["file"],
}
STEP = 1_000_000_000


def repeated(spark: SparkSession, name: str, df: DataFrame, copies: int) -> DataFrame:
    """``copies`` of every row, as files; written before the load is timed."""
    copy = F.col("__copy")
    many = df.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    changed = {c: F.col(c) + copy * F.lit(float(STEP)) for c in NUMBERS[name]}
    changed |= {c: F.concat_ws(" ", F.col(c), copy) for c in TEXTS[name]}
    path = new_path(spark, f"raw-{name}")
    many.withColumns(changed).drop("__copy").repartition(32).write.parquet(path)
    return spark.read.parquet(path)


def main(arguments: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench-load",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": str(4 * int(cpus)),
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    for copies in map(int, arguments):
        once = standins.raw_frames(spark, sf_dir)
        raw = load.RawFrames(
            **{name: repeated(spark, name, getattr(once, name), copies) for name in NUMBERS}
        )
        rows = {name: getattr(raw, name).count() for name in NUMBERS}
        start = time.perf_counter()
        root = new_path(spark, "warehouse")
        load.full_load(raw, root)
        stored = {r.table_name: r.records for r in load.check(spark, root).collect()}
        seconds = round(time.perf_counter() - start, 2)
        discard(spark)
        print(
            json.dumps(
                {
                    "copies": copies,
                    "seconds": seconds,
                    "raw_rows": rows,
                    "raw_rows_per_second": round(sum(rows.values()) / seconds),
                    "stored_rows": stored,
                }
            ),
            flush=True,
        )
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
