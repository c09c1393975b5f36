"""Approximate nearest neighbours by multiprobe p-stable hashing.

A table hashes a vector to the cell of a grid in a few random directions; Gaussian
directions keep Euclidean distances in expectation. A query visits its own cell and the
cells next to it, in the order in which they are likely to hold its neighbours, judged by
how near it lies to their borders. What its cells hold in any table is measured exactly.
A query that meets fewer rows than it asks for is compared with all rows of its dimension.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starquay.llm.words import mix
from starquay.staging import stage

TABLES = 6
HASHES = 6
PROBES = 150
WIDTH = 1.0  # of a cell, in median distances of a sample
SAMPLE = 512
CELL_ROWS = 20_000
GROUP_ROWS = 4000

_U = np.uint64


def probe_order(hashes: int, probes: int) -> list[tuple[int, ...]]:
    """Sets of moves by the expected sum of squared distances to the borders crossed.

    Move j of 2 * ``hashes`` crosses the jth nearest border; the expected square of its
    distance, in cells, follows from order statistics of uniform numbers. Moves j and
    2 * hashes - 1 - j cross both borders of one direction and do not go together.
    """
    m = hashes
    j = np.arange(1, 2 * m + 1)
    mirror = 2 * m + 1 - j
    near = j * (j + 1) / (4 * (m + 1) * (m + 2))
    far = 1 - mirror / (m + 1) + mirror * (mirror + 1) / (4 * (m + 1) * (m + 2))
    cost = np.where(j <= m, near, far)
    out: list[tuple[int, ...]] = [()]
    heap = [(cost[0], (0,))]
    while heap and len(out) < probes:
        total, moves = heapq.heappop(heap)
        if not any(2 * m - 1 - x in moves for x in moves):
            out.append(moves)
        last = moves[-1]
        if last + 1 < 2 * m:
            heapq.heappush(heap, (total - cost[last] + cost[last + 1], (*moves[:-1], last + 1)))
            heapq.heappush(heap, (total + cost[last + 1], (*moves, last + 1)))
    return out


class Grid:
    """The hash tables for vectors of one dimension."""

    def __init__(self, dimension: int, width: float, tables: int, hashes: int, seed: int = 5):
        rng = np.random.default_rng([seed, dimension])
        self.directions = rng.standard_normal((tables, hashes, dimension))
        self.shifts = rng.random((tables, hashes))
        self.width = width

    def cells(self, vectors: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
        """Cell of each vector, and its place inside, by direction."""
        spot = vectors @ self.directions[table].T / self.width + self.shifts[table]
        cell = np.floor(spot)
        return cell.astype(np.int64), spot - cell


def bucket_of(cells: np.ndarray, table: int, dimension: int) -> np.ndarray:
    key = mix(np.full(cells.shape[:-1], table * 100_003 + dimension, _U))
    for k in range(cells.shape[-1]):
        key = mix(key * _U(3) + cells[..., k].view(_U))
    return key.view(np.int64)


def _by_dimension(vectors: pa.Array):
    """(rows, matrix) for each dimension."""
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(float)
    for d in np.unique(sizes):
        at = np.flatnonzero(sizes == d)
        yield at, flat[offsets[at][:, None] + np.arange(d)]


def _closest(k: int):
    """Per table and group of buckets: the ``k`` nearest vectors each query meets there."""

    def search(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        asks = table.column("buckets").combine_chunks()
        asks = asks.chunk(0) if isinstance(asks, pa.ChunkedArray) else asks
        lists = table.column("vector").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        ids = table.column("rep").to_numpy()
        asking = table.column("asking").to_numpy()
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for at, matrix in _by_dimension(lists):
            held, queries = np.flatnonzero(~asking[at]), np.flatnonzero(asking[at])
            if not len(held) or not len(queries):
                continue
            spans = asks.take(pa.array(at[held])).flatten().to_numpy()
            order = np.argsort(spans, kind="stable")
            spans, held = spans[order], held[order]
            base, base_ids = matrix[held], ids[at[held]]
            squares = (base**2).sum(axis=1)
            for q in queries:
                wanted = np.sort(asks[int(at[q])].values.to_numpy())
                low, high = np.searchsorted(spans, wanted, "left"), np.searchsorted(spans, wanted, "right")
                hit = high > low
                if not hit.any():
                    continue
                near = np.concatenate([np.arange(a, b) for a, b in zip(low[hit], high[hit])])
                point = matrix[q]
                rough = squares[near] - 2 * (base[near] @ point)
                if len(near) > k:
                    # Rounding cannot put a true neighbour beyond this slack.
                    edge = np.partition(rough, k - 1)[k - 1]
                    near = near[rough <= edge + 1e-9 * (1 + abs(edge) + squares[near].max())]
                exact = np.sqrt(((base[near] - point) ** 2).sum(axis=1))
                best = np.lexsort((base_ids[near], exact))[:k]
                found.append((np.full(len(best), ids[at[q]]), base_ids[near][best], exact[best]))
        columns = [np.concatenate([f[i] for f in found]) if found else np.zeros(0) for i in range(3)]
        return pa.table(
            [pa.array(columns[0].astype(np.int64)), pa.array(columns[1].astype(np.int64)), pa.array(columns[2].astype(float))],
            ["query", "rep", "score"],
        )

    return search


_WIDTHS = "dimension int, width double"


def _widths(width: float):
    """The cell width of one dimension: ``width`` median distances of its sample."""

    def fit(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table.column("spot").to_pylist(), table.column("vector").to_pylist()))
        some = np.array([v for _, v in rows], float)
        apart = np.sqrt(((some[::2][:, None] - some[1::2][None]) ** 2).sum(axis=2)) if len(some) > 1 else np.zeros(0)
        cell = width * (float(np.median(apart[apart > 0])) if (apart > 0).any() else 1.0)
        return pa.table([pa.array([some.shape[1]], pa.int32()), pa.array([cell])], ["dimension", "width"])

    return fit


def nearest(
    vectors: DataFrame,
    k: int = 10,
    every: int = 100,
    tables: int = TABLES,
    hashes: int = HASHES,
    probes: int = PROBES,
    width: float = WIDTH,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """(vec_id, embedding) -> (query_id, rank, vec_id, score).

    Queries are the rows whose id is divisible by ``every``; each gets its ``k`` nearest rows
    that were found, nearest first, ties by the smaller id, itself left out; one that has met
    fewer than ``k`` gets the exact ``k`` nearest, or all there are. Vectors that are
    null, empty, zero, or hold a null or non-finite component take no part, nor do rows
    without an id; vectors of different dimensions never meet. Equal vectors are indexed once,
    with their k + 1 smallest ids, which are all that can be among the nearest. Only the
    width of a cell is fitted, on at most 512 vectors of a dimension; every row is indexed. A cell with
    more than ``cell_rows`` vectors is searched in parts. An empty table gives no rows.
    """
    value = F.col("embedding")
    usable = (
        F.col("vec_id").isNotNull()
        & value.isNotNull()
        & F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        & F.exists(value, lambda x: x != 0)
    )
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding").where(usable).distinct()
    first = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    points = stage(
        rows.withColumn("place", first)
        .where(F.col("place") <= k + 1)
        .groupBy("embedding")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .select(F.col("ids")[0].alias("rep"), "ids", F.col("embedding").alias("vector")),
        "points",
    )
    asked = (
        rows.where(F.col("vec_id") % every == 0)
        .join(points.select("rep", F.col("vector").alias("embedding")), "embedding")
        .select(F.col("vec_id").alias("query_id"), "rep")
    )
    asked = stage(asked, "queries")
    drawn = F.row_number().over(Window.partitionBy("dimension").orderBy("spot"))
    sample = (
        points.select(F.size("vector").alias("dimension"), F.xxhash64("rep").alias("spot"), "vector")
        .withColumn("place", drawn)
        .where(F.col("place") <= SAMPLE)
    )
    fitted = sample.groupBy("dimension").applyInArrow(_widths(width), _WIDTHS).collect()
    widths = {r.dimension: r.width for r in fitted}
    groups = max(1, -(-points.count() // GROUP_ROWS))
    order = probe_order(hashes, probes)
    kind = points.schema["vector"].dataType.simpleString()

    def index(batches):
        for batch in batches:
            for at, matrix in _by_dimension(batch.column(1)):
                grid = Grid(matrix.shape[1], widths[matrix.shape[1]], tables, hashes)
                for t in range(tables):
                    cells, _ = grid.cells(matrix, t)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(at)),
                            pa.array(np.full(len(at), t)),
                            pa.array(bucket_of(cells, t, matrix.shape[1])),
                            batch.column(1).take(pa.array(at)),
                        ],
                        ["rep", "table", "bucket", "vector"],
                    )

    def probe(batches):
        moves = np.full((len(order), max(map(len, order)) or 1), -1)
        for i, m in enumerate(order):
            moves[i, : len(m)] = m
        for batch in batches:
            for at, matrix in _by_dimension(batch.column(1)):
                grid = Grid(matrix.shape[1], widths[matrix.shape[1]], tables, hashes)
                for t in range(tables):
                    cells, inside = grid.cells(matrix, t)
                    for i in range(len(at)):
                        ways = np.argsort(np.concatenate([inside[i], 1 - inside[i]]), kind="stable")
                        step = np.zeros((len(order), hashes + 1), np.int64)
                        way = np.where(moves >= 0, ways[moves], 2 * hashes)
                        np.add.at(
                            step,
                            (np.arange(len(order))[:, None], np.where(way < 2 * hashes, way % hashes, hashes)),
                            np.where(way < hashes, -1, 1),
                        )
                        visited = bucket_of(cells[i] + step[:, :hashes], t, matrix.shape[1])
                        yield pa.RecordBatch.from_arrays(
                            [
                                batch.column(0).take(pa.array(np.full(len(order), at[i]))),
                                pa.array(np.full(len(order), t)),
                                pa.array(visited),
                            ],
                            ["rep", "table", "bucket"],
                        )

    held = points.select("rep", "vector").mapInArrow(
        index, f"rep bigint, table bigint, bucket bigint, vector {kind}"
    )
    counted = held.groupBy("table", "bucket").agg(F.count(F.lit(1)).alias("n"))
    large = stage(
        counted.where(F.col("n") > cell_rows).select(
            "table", "bucket", F.ceil(F.col("n") / cell_rows).cast("bigint").alias("parts")
        ),
        "large_cells",
    )
    # A cell's place: its hash, and for large cells the part of the vectors.
    parts = F.coalesce("parts", F.lit(1).cast("bigint"))
    place = F.pmod(F.xxhash64("bucket", "part"), F.lit(groups)).alias("place")
    spread = held.join(large, ["table", "bucket"], "left").withColumn("part", F.pmod(F.xxhash64("rep"), parts))
    there = spread.select("table", place, F.lit(False).alias("asking"), "rep", F.array("bucket").alias("buckets"), "vector")
    seeking = points.join(asked.select("rep").distinct(), "rep", "left_semi").select("rep", "vector")
    visits = (
        seeking.mapInArrow(probe, "rep bigint, table bigint, bucket bigint")
        .join(large, ["table", "bucket"], "left")
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)))
        .select("table", place, "rep", "bucket")
        .groupBy("table", "place", "rep")
        .agg(F.array_distinct(F.collect_list("bucket")).alias("buckets"))
        .join(seeking, "rep")
        .select("table", "place", F.lit(True).alias("asking"), "rep", "buckets", "vector")
    )
    met = there.union(visits).groupBy("table", "place").applyInArrow(
        _closest(k + 1), "query bigint, rep bigint, score double"
    )
    rank = F.row_number().over(Window.partitionBy("query").orderBy("score", "rep"))
    best = stage(met.distinct().withColumn("r", rank).where(F.col("r") <= k + 1), "met")
    counts = best.join(points.select("rep", F.size("ids").alias("n")), "rep").groupBy("query").agg(F.sum("n").alias("n"))
    enough = counts.where(F.col("n") > k).select(F.col("query").alias("rep"))
    short = stage(seeking.join(enough, "rep", "left_anti"), "short_queries")
    missed = short.count()
    if missed:
        # Blocks of such queries against blocks of all rows of their dimensions.
        sides = max(1, -(-missed // GROUP_ROWS))
        dimension = F.size("vector")
        asks = short.withColumn("dimension", dimension)
        alike = points.select("rep", "vector").withColumn("dimension", dimension).join(
            asks.select("dimension").distinct(), "dimension", "left_semi"
        )
        here, side = F.pmod(F.xxhash64("rep"), F.lit(groups)), F.pmod(F.xxhash64("rep", F.lit(1)), F.lit(sides))
        cell = F.array(F.lit(0).cast("bigint")).alias("buckets")

        def all_of(n: int) -> Column:
            return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))

        held_all = alike.select(
            all_of(sides).alias("table"), here.alias("place"), F.lit(False).alias("asking"), "rep", cell, "vector"
        )
        asks_all = asks.select(
            side.alias("table"), all_of(groups).alias("place"), F.lit(True).alias("asking"), "rep", cell, "vector"
        )
        exact = held_all.union(asks_all).groupBy("table", "place").applyInArrow(
            _closest(k + 1), "query bigint, rep bigint, score double"
        )
        exact = exact.withColumn("r", rank).where(F.col("r") <= k + 1)
        best = best.join(short.select(F.col("rep").alias("query")), "query", "left_anti").unionByName(exact)
    named = best.join(points.select("rep", F.explode("ids").alias("vec_id")), "rep").select(
        F.col("query").alias("rep"), "vec_id", "score"
    )
    final = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return (
        asked.join(named, "rep")
        .where(F.col("query_id") != F.col("vec_id"))
        .select("query_id", final.alias("rank"), "vec_id", "score")
        .where(F.col("rank") <= k)
    )
