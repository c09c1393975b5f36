"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starquay.functions.columns import named
from starquay.staging import stage

_ROW = "__row"
_PART = "__part"
_BEFORE = "__before"
# monotonically_increasing_id puts the partition number above bit 33.
_PART_BITS = 33


def unique_key(df: DataFrame, name: str) -> DataFrame:
    """A unique BIGINT per row, neither dense nor repeatable, at no cost."""
    return df.withColumn(name, F.monotonically_increasing_id())


def largest_key(df: DataFrame, name: str) -> int:
    """The largest key so far; 0 without rows."""
    return df.agg(F.max(named(name))).first()[0] or 0


def dense_key(
    df: DataFrame, name: str, order_by: Sequence[Column | str], start: int = 0
) -> DataFrame:
    """Add ``name`` = ``start`` + 1, 2, ... n in the order of ``order_by``.

    Equal to a global ``row_number`` without sorting the data in one partition:
    the rows are range-partitioned and sorted, each partition is numbered by
    itself, and the sizes of the partitions before it are added. All columns
    follow ``order_by`` in the sort, so for distinct rows the order is total, the
    key repeats on every run, and a value that holds a large share of the rows is
    split over many ranges by the columns behind it.

    The numbered rows are staged once, because their numbers must not be computed
    twice. The sizes are one row per partition, so they are safe to broadcast.
    """
    lead = [F.col(c) if isinstance(c, str) else c for c in order_by]
    order = [*lead, *map(named, df.columns)]
    numbered = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(_ROW, F.monotonically_increasing_id())
    )
    staged = stage(numbered, name)
    part = F.shiftright(_ROW, _PART_BITS)
    within = F.col(_ROW).bitwiseAND(F.lit((1 << _PART_BITS) - 1))
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        staged.groupBy(part.alias(_PART))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(_PART, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(_BEFORE))
    )
    return (
        staged.withColumn(_PART, part)
        .join(F.broadcast(offsets), _PART)
        .select(
            *map(named, df.columns),
            (F.col(_BEFORE) + within + F.lit(start + 1)).alias(name),
        )
    )
