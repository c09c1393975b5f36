"""Exact n-gram Jaccard self-join as a metric-space join.

1 - |x & y| / |x | y| is a metric on shingle sets, with radius r = 1 - threshold.

1. *Pivots.* Shingles are ordered by how often they occur. Two sets within r share one
   of the first n - ceil(threshold * n) + 1 shingles of each set of n. Each such shingle
   that several sets share elects one of them as pivot, by one order over all sets,
   so copies elect few pivots.
2. *Voronoi regions.* A pivot's region holds the sets that elected it. A set at the
   border of regions is replicated into each of them. Any two sets within r elected a
   pivot together, so no link is lost between regions.
3. *Triangle inequality.* Inside a region, sets within r of the pivot are linked to it.
   The rest lie in rings of width r around it, and two sets within r lie in the same or
   in neighbouring rings. Each ring, with the next one as its window, is a region of
   its own, joined in the same way.
4. *Recursion across tasks.* A region too large for one task is cut into its rings by
   Spark, with distances computed row by row; the ones that do not get smaller are cut
   into blocks, and every pair of blocks is a region.

Links inside one component are not listed beyond a tree, so copies form no pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starquay.llm.components import components
from starquay.llm.filters import bloom, maybe_in
from starquay.llm.words import SMALL_CHUNK_BYTES, chunks, list_array, mix, shingle_sets
from starquay.staging import stage

COUNTER_BITS = 20
_BLOCK = 1 << 14
# A region of at most this many sets and shingles is joined in one task.
REGION_SETS = 4000
REGION_SHINGLES = 4_000_000
_RING_LEVELS = 3
# Buckets of a set's image: 2^6, and 2^9 for sets of at least this many shingles.
_IMAGE_BITS = (6, 9)
_LONG_SET = 1000


def _usual(df: DataFrame, size: int, bits: int) -> np.ndarray:
    """How often shingles occur in ``df``: the count of each of 2^bits hash slots, as
    a fourth power root's step in a byte. Any order that all sets share keeps the
    join exact; counting all shingles puts those of common passages last."""
    slots, blocks = 1 << bits, (1 << bits) // _BLOCK

    def count(batches):
        held = np.zeros(slots, np.int64)
        for batch in batches:
            for i, j in chunks(batch.column(0)):
                value, _ = shingle_sets(batch.column(0)[i:j], size)
                held += np.bincount((value & np.uint64(slots - 1)).view(np.int64), minlength=slots)
        rows = [held[k * _BLOCK : (k + 1) * _BLOCK].tobytes() for k in range(blocks)]
        salt = int(mix(held[:1].view(np.uint64) + np.uint64(held.sum()))[0] % np.uint64(64))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.arange(blocks)),
                pa.array(np.full(blocks, salt, np.int64)),
                pa.array(rows, pa.binary()),
            ],
            ["block", "salt", "counts"],
        )

    def total(table: pa.Table) -> pa.Table:
        sums = np.zeros(_BLOCK, np.int64)
        for counts in table.column("counts"):
            sums += np.frombuffer(counts.as_py(), np.int64)
        return table.slice(0, 1).set_column(2, "counts", pa.array([sums.tobytes()], pa.binary()))

    schema = "block bigint, salt bigint, counts binary"
    once = df.select("text").mapInArrow(count, schema).groupBy("block", "salt")
    parts = once.applyInArrow(total, schema).groupBy("block").applyInArrow(total, schema)
    usual = np.zeros(slots, np.uint8)
    for block, _, counts in parts.collect():
        steps = np.log2(np.frombuffer(counts, np.int64) + 1.0) * 4
        usual[block * _BLOCK : (block + 1) * _BLOCK] = np.minimum(steps, 255).astype(np.uint8)
    return usual


def _image(bucket: np.ndarray) -> bytes:
    """Counts of a set's shingles by bucket, in one byte each, or four where they need it."""
    bits = _IMAGE_BITS[len(bucket) >= _LONG_SET]
    counts = np.bincount(bucket >> (_IMAGE_BITS[1] - bits), minlength=1 << bits)
    return counts.astype(np.uint8 if counts.max() < 256 else "<u4").tobytes()


def _counts(image: bytes) -> np.ndarray:
    return np.frombuffer(image, np.uint8 if len(image) in (64, 512) else "<u4").astype(np.int32)


def _prints(df: DataFrame, size: int, num: int, den: int, bits: int) -> DataFrame:
    """(doc_id, n, f1, f2, image, keys) of every row: size, fingerprint and bucket counts
    of its shingle set, and the set's first shingles in the common order."""
    usual = _usual(df, size, bits)
    schema = "doc_id bigint, n bigint, f1 bigint, f2 bigint, image binary, keys array<bigint>"

    def make(batches):
        for batch in batches:
            for i, j in chunks(batch.column(1), SMALL_CHUNK_BYTES):
                value, offsets = shingle_sets(batch.column(1)[i:j], size)
                n = np.diff(offsets)
                row = np.repeat(np.arange(j - i), n)
                order = np.lexsort((value, usual[value & np.uint64(len(usual) - 1)], row))
                place = np.arange(len(value)) - offsets[row]
                prefix = n - (num * n + den - 1) // den + 1
                kept = value[order][place < prefix[row]]
                sums = [np.concatenate([[np.uint64(0)], np.cumsum(mix(value + np.uint64(s)))]) for s in (1, 2)]
                ends = np.split((value >> np.uint64(64 - _IMAGE_BITS[1])).view(np.int64), offsets[1:-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[i:j],
                        pa.array(n),
                        *(pa.array((s[offsets[1:]] - s[offsets[:-1]]).view(np.int64)) for s in sums),
                        pa.array([_image(e) for e in ends], pa.binary()),
                        list_array(kept, np.concatenate([[0], np.cumsum(np.where(n > 0, prefix, 0))])),
                    ],
                    ["doc_id", "n", "f1", "f2", "image", "keys"],
                )

    rows = df.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return stage(rows.mapInArrow(make, schema), "prints")


def _sets_of(df: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """(rep, n, shingles) of the documents in ``ids``; a filter of fixed size keeps the
    other texts out of the shuffle."""
    wanted = bloom(ids)
    schema = "rep bigint, n bigint, shingles array<bigint>"

    def make(batches):
        for batch in batches:
            ids = batch.column(0).fill_null(-1).to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array(maybe_in(wanted, ids)))
            for i, j in chunks(batch.column(1), SMALL_CHUNK_BYTES):
                value, offsets = shingle_sets(batch.column(1)[i:j], size)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[i:j], pa.array(np.diff(offsets)), list_array(value, offsets)],
                    ["rep", "n", "shingles"],
                )

    rows = df.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.where("doc_id is not null").mapInArrow(make, schema).join(ids, "rep", "left_semi")


class _Region:
    """Sets of one region, joined by pivots and rings; ``label`` tells its components."""

    def __init__(self, offsets: np.ndarray, shingles: np.ndarray, num: int, den: int):
        self.n = np.diff(offsets)
        self.offsets, self.num, self.den = offsets, num, den
        names, self.code = np.unique(shingles, return_inverse=True)
        self.mark = np.zeros(len(names) + 1, bool)
        self.label = np.arange(len(self.n))

    def link(self, i: int, others: np.ndarray) -> None:
        old = np.unique(self.label[others])
        self.label[np.isin(self.label, old)] = self.label[i]

    def codes(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shingles of the sets of ``at``, one after another, and where each begins."""
        n = self.n[at]
        starts = np.concatenate([[0], np.cumsum(n)[:-1]])
        return self.code[np.arange(n.sum()) + np.repeat(self.offsets[at] - starts, n)], starts

    def rings(self, pivot: int, at: np.ndarray) -> np.ndarray:
        """Ring of each set of ``at`` around the pivot; 0 is within the radius."""
        own = self.code[self.offsets[pivot] : self.offsets[pivot + 1]]
        self.mark[own] = True
        codes, starts = self.codes(at)
        both = np.add.reduceat(self.mark[codes].astype(np.int32), starts).astype(np.int64)
        self.mark[own] = False
        either = self.n[at] + self.n[pivot] - both
        ring = -((-(either - both) * self.den) // ((self.den - self.num) * either)) - 1
        return np.maximum(ring, 0)

    def join(self) -> None:
        todo = [np.arange(len(self.n))]
        while todo:
            at = todo.pop()
            if len(at) < 2 or (self.label[at] == self.label[at[0]]).all():
                continue
            pivot, rest = int(at[0]), at[1:]
            ring = self.rings(pivot, rest)
            self.link(pivot, rest[ring == 0]) if (ring == 0).any() else None
            # Ring k with its window k + 1; the last ring is the window of the one before.
            parts = [rest[(ring == k) | (ring == k + 1)] for k in np.unique(ring)]
            parts = [p for k, p in zip(np.unique(ring), parts) if (ring == k + 1).any() or not (ring == k - 1).any()]
            if sum(map(len, parts)) <= 0.8 * len(at):
                todo += parts
            else:
                self.leaf(rest)

    def leaf(self, at: np.ndarray) -> None:
        """Join sets that pivots no longer part: each against those that share one of its
        first shingles, in the order of the region's own counts, unless they are in one
        component already."""
        codes, starts = self.codes(at)
        n = self.n[at]
        row = np.repeat(np.arange(len(at)), n)
        order = np.lexsort((codes, np.bincount(codes, minlength=len(self.mark))[codes], row))
        first = (np.arange(len(codes)) - starts[row]) < (n - (self.num * n + self.den - 1) // self.den + 1)[row]
        codes, row = codes[order][first], row[first]
        by_code = np.argsort(codes, kind="stable")
        held = row[by_code]
        low = np.searchsorted(codes[by_code], codes, "left")
        high = np.searchsorted(codes[by_code], codes, "right")
        begin = np.searchsorted(row, np.arange(len(at) + 1))
        for i in range(len(at)):
            spans = [held[a:b] for a, b in zip(low[begin[i] : begin[i + 1]], high[begin[i] : begin[i + 1]]) if b > a + 1]
            if not spans:
                continue
            near = np.unique(np.concatenate(spans))
            near = near[near > i]
            near = near[self.label[at[near]] != self.label[at[i]]]
            near = near[(n[near] * self.den >= self.num * n[i]) & (n[i] * self.den >= self.num * n[near])]
            if len(near):
                met = at[near][self.rings(int(at[i]), at[near]) == 0]
                if len(met):
                    self.link(int(at[i]), met)


def _with_partner(num: int, den: int):
    """Members of a region whose image is within the radius of another member's. Each group
    that such pairs connect is a region of its own, named by its members, so that a group
    found in several regions is moved once."""

    def make(table: pa.Table) -> pa.Table:
        n = table.column("n").to_numpy()
        order = np.argsort(n, kind="stable")
        n = n[order]
        counts = [_counts(x.as_py()) for x in table.column("image").take(pa.array(order))]
        coarse = np.stack([c.reshape(64, -1).sum(axis=1) for c in counts])
        long = np.array([len(c) > 64 for c in counts])
        fine = np.zeros((len(counts), 512), np.int32) if long.any() else None
        for i in np.flatnonzero(long):
            fine[i] = counts[i]
        group = np.arange(len(n))
        # Sizes that differ by more than the threshold cannot be within the radius.
        last = np.searchsorted(n * num, n * den, "right")
        for i in range(len(n)):
            at = np.arange(i + 1, last[i])
            for image, held in ((coarse, True), (fine, long[i])):
                if held and len(at):
                    asked = at if image is coarse else at[long[at]]
                    both = np.minimum(image[i], image[asked]).sum(axis=1)
                    far = asked[both * den < num * (n[i] + n[asked] - both)]
                    at = np.setdiff1d(at, far, assume_unique=True)
            if len(at):
                joined = np.unique(group[at])
                group[np.isin(group, joined)] = group[i]
        reps = table.column("rep").to_numpy()[order]
        group = np.unique(group, return_inverse=True)[1]
        name = np.zeros(len(n), np.uint64)
        np.add.at(name, group, mix(reps.view(np.uint64)))
        keep = np.bincount(group)[group] > 1
        return pa.table({"region": name[group][keep].view(np.int64), "rep": reps[keep], "n": n[keep]})

    return make


def _tree_links(num: int, den: int):
    def make(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        reps = table.column("rep").to_numpy()
        lists = table.column("shingles").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        sizes = lists.value_lengths().to_numpy()
        region = _Region(np.concatenate([[0], np.cumsum(sizes)]), lists.flatten().to_numpy(), num, den)
        region.join()
        _, first = np.unique(region.label, return_index=True)
        top = first[np.searchsorted(region.label[first], region.label)]
        linked = top != np.arange(len(reps))
        return pa.table({"a": reps[linked], "b": reps[top[linked]]})

    return make


def _cut_large(members: DataFrame, num: int, den: int, sets: int, shingles: int):
    """Regions that fit in one task, and links found while cutting ``members``, which
    holds regions that do not."""
    fitting, links = [], []
    level = 0
    while True:
        large = stage(_sizes(members).where(_too_large(sets, shingles)), "large_regions")
        fitting.append(members.join(large, "region", "left_anti"))
        if large.isEmpty():
            return fitting, links
        hot = members.join(large, "region")
        if level >= _RING_LEVELS:
            parts = F.ceil(
                F.greatest(F.col("sets") / (sets / 2.0), F.col("total") / (shingles / 2.0))
            ).cast("bigint")
            block = F.pmod(F.xxhash64("rep"), parts)
            pairs = F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)).alias("other")
            cut = hot.select("*", block.alias("block"), pairs).withColumn(
                "region",
                F.xxhash64("region", F.least("block", "other"), F.greatest("block", "other")),
            )
            fitting.append(cut.select("region", "rep", "n", "shingles"))
            return fitting, links
        pivots = hot.groupBy("region").agg(
            F.min_by(F.struct("rep", "n", "shingles"), F.xxhash64("rep", F.lit(level))).alias("p")
        )
        both = F.size(F.array_intersect("shingles", "p.shingles")).cast("bigint")
        ring = F.expr(f"((either - both) * {den} + {den - num} * either - 1) div ({den - num} * either) - 1")
        measured = stage(
            hot.join(pivots, "region")
            .withColumn("both", both)
            .withColumn("either", F.col("n") + F.col("p.n") - F.col("both"))
            .withColumn("ring", ring)
            .withColumn("core", F.col("both") * den >= F.col("either") * num)
            .select("region", "rep", "n", "shingles", "ring", "core", F.col("p.rep").alias("pivot")),
            "rings",
        )
        links.append(measured.where("core").select(F.col("rep").alias("a"), F.col("pivot").alias("b")))
        ring = F.greatest("ring", F.lit(1).cast("bigint"))
        # Region k holds rings k and k + 1. The core is linked already and only meets
        # the first ring.
        homes = F.when(F.col("core"), F.array(F.lit(0).cast("bigint"))).otherwise(F.array(ring - 1, ring))
        members = stage(
            measured.select(F.explode(homes).alias("home"), "*").select(
                F.xxhash64("region", "home", F.lit(level)).alias("region"), "rep", "n", "shingles"
            ),
            "regions",
        )
        level += 1


def _sizes(members: DataFrame) -> DataFrame:
    return members.groupBy("region").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("total"))


def _too_large(sets: int, shingles: int):
    return (F.col("sets") > sets) | (F.col("total") > shingles)


def jaccard_components(
    df: DataFrame,
    size: int = 3,
    threshold: tuple[int, int] = (9, 10),
    counter_bits: int = COUNTER_BITS,
    region_sets: int = REGION_SETS,
    region_shingles: int = REGION_SHINGLES,
) -> DataFrame:
    """(doc_id, text) -> (doc_id, n_shingles, component_id), one row per row of ``df``.

    Documents whose sets of ``size``-word shingles have at least the Jaccard similarity
    ``threshold`` (a fraction) are linked; ``component_id`` is the smallest doc_id that
    links reach. Null and empty texts have no shingle, no link, and their own id. Rows
    that repeat a doc_id count as versions of one document and share its component.
    A null doc_id keeps its row with a null component. An empty table gives no rows.
    ``counter_bits`` bounds what is broadcast: 2^counter_bits bytes.
    """
    num, den = threshold
    prints = _prints(df, size, num, den, counter_bits)
    known = prints.where("doc_id is not null and n > 0")
    first = F.min(F.struct("doc_id", "image", "keys"))
    reps = stage(
        known.groupBy("n", "f1", "f2")
        .agg(first.alias("r"))
        .select("n", "f1", "f2", F.col("r.doc_id").alias("rep"), "r.image", "r.keys"),
        "representatives",
    )
    keyed = reps.select("rep", F.explode("keys").alias("key"))
    elected = (
        keyed.groupBy("key")
        .agg(F.min("rep").alias("region"), F.max("rep").alias("last"))
        .where("region < last")
        .select("key", "region")
    )
    shared = keyed.join(elected, "key").select("rep", "region").distinct()
    homes = stage(shared.join(reps.select("rep", "n", "image"), "rep"), "homes")
    large = stage(_sizes(homes).where(_too_large(region_sets, region_shingles)), "large_regions")
    bounded = homes.join(large, "region", "left_anti").groupBy("region")
    near = stage(
        bounded.applyInArrow(_with_partner(num, den), "region bigint, rep bigint, n bigint").distinct().union(
            homes.join(large, "region", "left_semi").select("region", "rep", "n")
        ),
        "near",
    )
    # A document with several versions brings the set of each.
    sets = _sets_of(df, near.select("rep").distinct(), size)
    members = near.drop("n").join(sets, "rep").select("region", "rep", "n", "shingles")
    fitting, links = [members.join(large, "region", "left_anti")], []
    if not large.isEmpty():
        hot = stage(members.join(large, "region", "left_semi"), "regions")
        cut, links = _cut_large(hot, num, den, region_sets, region_shingles)
        fitting += cut
    for part in fitting:
        links.append(part.groupBy("region").applyInArrow(_tree_links(num, den), "a bigint, b bigint"))
    versions = known.join(reps.select("n", "f1", "f2", "rep"), ["n", "f1", "f2"]).select("doc_id", "rep")
    links.append(versions.where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    found = links[0]
    for more in links[1:]:
        found = found.union(more)
    labels = components(found).withColumnRenamed("node", "doc_id")
    return prints.join(labels, "doc_id", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"),
    )


def one_per_component(df: DataFrame, size: int, threshold: tuple[int, int]) -> DataFrame:
    """``df`` with one row of each component: that of the smallest doc_id, and of its rows, if
    it is repeated, the first by hash. Rows without a doc_id stay."""
    labels = jaccard_components(df, size, threshold)
    stay = labels.where("doc_id = component_id").select("doc_id").distinct()
    columns = [F.col(f"`{c}`") for c in df.columns]
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64(*columns)))
    first = df.join(stay, "doc_id", "left_semi").select(*columns, rank.alias("__rank"))
    return first.where("__rank = 1").select(*columns).union(df.where("doc_id is null"))
