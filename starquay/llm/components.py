"""Connected components of links too many for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starquay.staging import stage


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b"), F.col("a")))


def _to_smallest(near: DataFrame, keep_larger: bool) -> DataFrame:
    """Link the neighbours of each ``a`` to the smallest of ``a`` and its neighbours;
    only the larger neighbours, or all of them and ``a`` itself.

    The minimum combines on the map side and the join is a plain equality join, so
    AQE can split the neighbours of a hub.
    """
    least = near.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    met = near.join(least, "a")
    if keep_larger:
        linked = met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        linked = met.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b"))
        )
    return linked.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(a, b) bigints -> (node, component): the smallest node that links reach.

    Alternating steps link larger neighbours, then smaller ones, to the smallest
    neighbour until the links are stars. Each round is a table in the shared folder,
    so a lost executor costs no more than a round. Rounds grow with the logarithm of
    the longest path. Nodes in no link, and links with a null end, are left out; an
    empty input gives an empty result.
    """
    clean = links.select("a", "b").where("a <> b")
    state = stage(
        clean.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    seen = None
    while True:
        print_of = state.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))
        ).first()
        if print_of == seen or not print_of[0]:
            return state.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                state.select(F.col("b"), F.col("b")).distinct()
            )
        seen = print_of
        large = _to_smallest(_both_ways(state), keep_larger=True)
        state = stage(_to_smallest(large, keep_larger=False), "links")
