"""Row and column cleaning: missing values, duplicates, before/after counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starquay.functions.columns import named, percent_of

_ROWS = "__rows"
_RANK = "__rank"


def missing_profile(df: DataFrame, ascending: bool = False) -> DataFrame:
    """(column_name, missing_count, missing_percentage) of the columns that have
    NULLs, most missing first unless ``ascending``.

    One aggregate over one scan. ``count(*) - count(column)`` rather than a sum of
    flags: Spark can take both counts from Parquet footers where aggregate
    push-down is on. NaN is a value.
    """
    rows = F.count(F.lit(1))
    totals = df.agg(
        rows.alias(_ROWS), *((rows - F.count(named(c))).alias(c) for c in df.columns)
    )
    counts = totals.unpivot([_ROWS], [named(c) for c in df.columns], "column_name", "missing_count")
    return missing_report(counts, _ROWS, ascending)


def missing_report(counts: DataFrame, rows: str, ascending: bool = False) -> DataFrame:
    """(column_name, missing_count, ``rows``) as a profile: columns that have NULLs, with their
    share, in order."""
    share = "missing_percentage"
    return (
        counts.where(F.col("missing_count") > 0)
        .select(
            "column_name",
            "missing_count",
            percent_of(F.col("missing_count"), F.col(rows)).alias(share),
        )
        .orderBy(F.asc(share) if ascending else F.desc(share), "column_name")
    )


def sparse_columns(df: DataFrame, threshold: float) -> DataFrame:
    """Names of the columns whose missing share is above ``threshold``."""
    return (
        missing_profile(df)
        .where(F.col("missing_percentage") > threshold * 100)
        .select("column_name")
    )


def drop_sparse_columns(
    df: DataFrame, threshold: float, keep: Sequence[str] = (), sparse: Sequence[str] | None = None
) -> DataFrame:
    """``df`` without the columns whose missing share is above ``threshold``.

    Runs the profile, and brings at most one name per column to the driver. With
    ``sparse``, an earlier decision, those columns go and nothing is run. Columns in
    ``keep`` stay, however sparse.
    """
    if sparse is None:
        sparse = [row.column_name for row in sparse_columns(df, threshold).collect()]
    return df.drop(*(name for name in sparse if name not in keep))


def first_per_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column] = ()
) -> DataFrame:
    """One row per key: the first by ``order_by``, then by all other columns in
    table order, so that the winner does not depend on how the data is split.

    Filtering ``row_number() = 1`` lets Spark keep one row per key and task
    *before* the shuffle (``WindowGroupLimit``), so a key that holds a large share
    of the rows arrives as one row per upstream task.
    """
    rest = [named(c).asc() for c in df.columns if c not in keys]
    order = [*order_by, *rest] or [F.lit(1)]
    ranks = Window.partitionBy(*map(named, keys)).orderBy(*order)
    return (
        df.withColumn(_RANK, F.row_number().over(ranks)).where(F.col(_RANK) == 1).drop(_RANK)
    )


def rows_before_and_after(df: DataFrame, keep: Column) -> DataFrame:
    """Row counts before and after the filter ``keep``, and the difference, in one
    pass over ``df``."""
    before, after = F.count(F.lit(1)), F.count_if(keep)
    return df.agg(
        before.alias("before_rows"),
        after.alias("after_rows"),
        (before - after).alias("difference"),
    )
