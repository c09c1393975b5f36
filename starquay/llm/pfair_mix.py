"""Mixing sources to target weights by Pfair scheduling.

Rows of a source form blocks. Block k of a source of weight w may be placed from slot
floor(k / w) and must be placed before slot ceil((k + 1) / w); among the released blocks the
earliest deadline goes first. With whole-number weights that add up to Q the schedule
repeats every Q slots, so one period, which does not depend on the data, is computed
by a fold over its Q slots, and a join puts every block into its slot. All of it is
DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starquay.staging import stage

BLOCK_ROWS = 16
PERIOD = 840
ALPHA = 0.7
# Rows of a source that are numbered together; sources are split into such buckets.
BUCKET_ROWS = 4096
_NONE = ""


def whole_weights(sizes: DataFrame, alpha: float = ALPHA, period: int = PERIOD) -> DataFrame:
    """(source, rows) -> (source, weight): whole numbers of at least 1, proportional to
    rows ** ``alpha``. One row per source, so the shares are summed on few rows."""
    share = F.pow(F.col("rows").cast("double"), F.lit(alpha))
    total = sizes.agg(F.sum(share)).first()[0] or 1.0
    return sizes.select(
        "source", F.greatest(F.round(share / total * period), F.lit(1)).cast("bigint").alias("weight")
    )


def period_slots(weights: DataFrame) -> DataFrame:
    """(source, weight) -> (source, nth, slot, weight, period): the place of the nth block of a
    source within one period.

    A fold over the slots keeps how many blocks each source has placed, and takes the
    released block of the earliest deadline, then of the first source by name. There is one
    row per source, bounded by their number, and the result has one row per slot.
    """
    plan = weights.agg(
        F.sort_array(F.collect_list(F.struct("source", "weight"))).alias("sources"),
        F.sum("weight").alias("period"),
    ).where("period > 0")
    # Deadline of block k: ceil((k + 1) * Q / c); released at slot t if floor(k * Q / c) <= t.
    fold = """
        aggregate(
          sequence(0L, period - 1L),
          named_struct('placed', transform(sources, s -> 0L), 'order', cast(array() as array<int>)),
          (acc, t) -> transform(
            array(array_min(transform(
              filter(sequence(0, size(sources) - 1), i ->
                acc.placed[i] < sources[i].weight
                and acc.placed[i] * period div sources[i].weight <= t),
              i -> named_struct(
                'due', ((acc.placed[i] + 1L) * period + sources[i].weight - 1L) div sources[i].weight,
                'i', i)))),
            best -> named_struct(
              'placed', transform(acc.placed, (n, i) -> if(i = best.i, n + 1L, n)),
              'order', concat(acc.order, array(best.i))))[0],
          acc -> acc.order)
    """
    slots = plan.select("sources", "period", F.posexplode(F.expr(fold)).alias("slot", "i"))
    nth = F.row_number().over(Window.partitionBy("source").orderBy("slot")) - 1
    return slots.select(
        F.expr("sources[i].source").alias("source"),
        F.expr("sources[i].weight").alias("weight"),
        F.col("slot").cast("bigint").alias("slot"),
        "period",
    ).withColumn("nth", nth.cast("bigint"))


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str, int] | DataFrame | None = None,
    block_rows: int = BLOCK_ROWS,
    period: int = PERIOD,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``docs`` with (mix_source, mix_block, mix_slot, mix_place, mix_weight, mix_period).

    ``mix_slot`` is the slot of the row's block in the schedule and ``mix_place`` the row's
    place in the block; ordering by both gives the mixture. While every source lasts, each
    has been given within one block of weight / period * slots; a source that has run out
    leaves its slots empty and the others keep theirs, so none is dropped or repeated.
    ``weights`` are whole numbers per source (a mapping, or a frame of source and weight);
    by default they follow rows ** 0.7, in units of a ``period``-th. Sources without a
    weight get 1. A null source is the source ''. Within a source rows come in a random
    but repeatable order, so equal rows lie anywhere, and each keeps its own place. An
    empty table gives no rows. Columns of ``docs`` whose names begin with mix_ are left out.

    Rows are numbered in hash buckets of about ``bucket_rows``, so a source with most of
    the rows is spread over as many tasks as it has buckets.
    """
    spark = docs.sparkSession
    names = [c for c in docs.columns if not c.startswith("mix_")]
    rows = docs.select(*[F.col(f"`{c}`") for c in names])
    source = F.coalesce(rows["source"].cast("string"), F.lit(_NONE))
    spot = F.xxhash64(*[rows[c] for c in names])
    rows = rows.withColumn("mix_source", source).withColumn("mix_spot", spot)
    sizes = stage(rows.groupBy("mix_source").agg(F.count(F.lit(1)).alias("rows")), "source_sizes")
    sizes = sizes.withColumnRenamed("mix_source", "source")
    if weights is None:
        given = whole_weights(sizes, period=period)
    else:
        if not isinstance(weights, DataFrame):
            pairs = [(s, int(w)) for s, w in weights.items()]
            weights = spark.createDataFrame(pairs, "source string, weight bigint")
        given = sizes.join(weights.where("weight > 0"), "source", "left").select(
            "source", F.coalesce("weight", F.lit(1)).cast("bigint").alias("weight")
        )
    slots = stage(period_slots(given), "slots")
    plan = sizes.select(
        F.col("source").alias("mix_source"),
        F.ceil(F.col("rows") / bucket_rows).cast("bigint").alias("mix_buckets"),
    )
    # One row per source; joined by size, like any small table.
    placed = rows.join(plan, "mix_source").withColumn("mix_bucket", F.expr("pmod(mix_spot, mix_buckets)"))
    counts = placed.groupBy("mix_source", "mix_bucket").agg(F.count(F.lit(1)).alias("mix_rows"))
    before = Window.partitionBy("mix_source").orderBy("mix_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage(
        counts.select(
            "mix_source", "mix_bucket", F.coalesce(F.sum("mix_rows").over(before), F.lit(0)).alias("mix_before")
        ),
        "offsets",
    )
    inside = Window.partitionBy("mix_source", "mix_bucket").orderBy(
        F.xxhash64("mix_spot", F.lit(1)), "mix_spot"
    )
    numbered = (
        placed.withColumn("mix_n", F.row_number().over(inside) - 1)
        .join(offsets, ["mix_source", "mix_bucket"])
        .withColumn("mix_n", F.col("mix_n") + F.col("mix_before"))
        .withColumn("mix_block", F.expr(f"mix_n div {block_rows}L"))
    )
    weight = given.select(F.col("source").alias("mix_source"), F.col("weight").alias("mix_weight"))
    cycle = numbered.join(weight, "mix_source").withColumn("mix_nth", F.expr("mix_block % mix_weight"))
    met = cycle.join(
        slots.select(
            F.col("source").alias("mix_source"), F.col("nth").alias("mix_nth"), F.col("slot").alias("mix_first"), F.col("period").alias("mix_period")
        ),
        ["mix_source", "mix_nth"],
    )
    slot: Column = F.expr("mix_block div mix_weight") * F.col("mix_period") + F.col("mix_first")
    return met.select(
        *[F.col(f"`{c}`") for c in names],
        "mix_source",
        "mix_block",
        slot.alias("mix_slot"),
        F.expr(f"mix_n % {block_rows}L").alias("mix_place"),
        "mix_weight",
        "mix_period",
    )
