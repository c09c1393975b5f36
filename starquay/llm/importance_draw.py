"""Importance resampling towards a target, over distinct lines.

Documents are drawn by how much likelier their hashed n-gram features are in a target set
than in all documents, with Gumbel noise from a hash of the id. Lines repeat far more often
than documents, and no word crosses a line, so the texts are cut at their newlines: the
features of each distinct line are counted once and multiplied by its occurrences, in the
totals as in the sum of a document. N-grams that cross a newline are what lines do not
hold; they are taken from the texts and added separately.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starquay.llm.words import chunks, raw_bytes, runs
from starquay.operators.keys import dense_key
from starquay.staging import stage

# A-Z, what a word is made of once they are folded, and the seed of the noise.
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SEED = 2024

_WORD_BYTE = np.ones(256, bool)
_WORD_BYTE[:128] = False
_WORD_BYTE[48:58] = True
_WORD_BYTE[97:123] = True

CHUNK_BYTES = 4 << 20


def _folded(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)


def _bucket(feature: Column, buckets: int) -> Column:
    return F.crc32(F.encode(feature, "UTF-8")) % buckets


def _lines(docs: DataFrame, key: list[str]) -> DataFrame:
    """Columns ``key`` and each line of the folded text that holds a word."""
    lines = docs.select(*key, F.explode(F.split(_folded(F.col("text")), "\n")).alias("line"))
    return lines.where(F.col("line").rlike(WORD))


def _line_key(line: Column) -> Column:
    return F.unhex(F.md5(line))


def _runs_of(size: int, buckets: int) -> Column:
    starts = F.when(F.size("words") >= size, F.sequence(F.lit(1), F.size("words") - (size - 1)))
    return F.transform(
        F.coalesce(starts, F.array().cast("array<int>")),
        lambda i: _bucket(F.array_join(F.slice("words", i, size), " "), buckets),
    )


def _segments(docs: DataFrame, order: int, buckets: int) -> DataFrame:
    """(line_key, occurrences, n_words, features) per distinct line; features are buckets."""
    distinct = _lines(docs, []).groupBy("line").agg(F.count(F.lit(1)).alias("occurrences"))
    words = distinct.select(
        _line_key(F.col("line")).alias("line_key"),
        "occurrences",
        F.regexp_extract_all("line", F.lit(WORD), F.lit(0)).alias("words"),
    )
    features = F.transform("words", lambda w: _bucket(w, buckets))
    for size in range(2, order + 1):
        features = F.concat(features, _runs_of(size, buckets))
    return words.select(
        "line_key", "occurrences", F.size("words").cast("bigint").alias("n_words"),
        features.cast("array<int>").alias("features"),
    )


def _crossing(docs: DataFrame, key: list[str], order: int) -> DataFrame:
    """Columns ``key`` and each n-gram of 2 to ``order`` words that crosses a newline."""

    def cross(batches):
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for first, last in chunks(texts, CHUNK_BYTES):
                data, offsets = raw_bytes(texts.slice(first, last - first))
                row, start, end = runs(_WORD_BYTE[data], offsets)
                line = np.cumsum(data == 10)[start] if len(start) else start
                at, found = [], []
                for size in range(2, order + 1):
                    held = len(start) - size + 1
                    if held <= 0:
                        continue
                    over = (row[:held] == row[size - 1 :]) & (line[:held] != line[size - 1 :])
                    for i in np.flatnonzero(over):
                        at.append(first + row[i])
                        spans = (data[start[j] : end[j]].tobytes() for j in range(i, i + size))
                        found.append(b" ".join(spans).decode())
                if at:
                    kept = [c.take(pa.array(at, pa.int64())) for c in batch.columns[:-1]]
                    yield pa.RecordBatch.from_arrays([*kept, pa.array(found, pa.string())], [*key, "feature"])

    fields = ", ".join(f"{name} {docs.schema[name].dataType.simpleString()}" for name in key)
    folded = docs.select(*key, _folded(F.col("text")).alias("text"))
    return folded.mapInArrow(cross, f"{fields}, feature string" if key else "feature string")


def _totals(segments: DataFrame, docs: DataFrame, order: int, buckets: int) -> DataFrame:
    """(bucket, n): how many features of all texts fall into a bucket."""
    counts = segments.select(F.explode("features").alias("bucket"), F.col("occurrences").alias("n"))
    if order > 1:
        crossing = _crossing(docs, [], order)
        counts = counts.union(crossing.select(_bucket(F.col("feature"), buckets).cast("int"), F.lit(1)))
    return counts.groupBy("bucket").agg(F.sum("n").cast("bigint").alias("n"))


def _gains(own: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """The gain of each bucket; at most ``buckets`` rows of counts come to the driver."""
    spark = own.sparkSession
    counts = (
        spark.range(buckets).select(F.col("id").cast("int").alias("bucket"))
        .join(own.select("bucket", F.col("n").alias("s")), "bucket", "left")
        .join(target.select("bucket", F.col("n").alias("t")), "bucket", "left")
        .na.fill(0, ["s", "t"])
    )
    all_s, all_t = counts.agg(F.sum("s"), F.sum("t")).first()
    in_target = (F.col("t") + 1).cast("double") * F.lit(float(all_s + buckets))
    in_all = (F.col("s") + 1).cast("double") * F.lit(float(all_t + buckets))
    share = in_target / in_all
    gains = counts.select("bucket", F.floor(F.lit(1000.0) * F.log(share)).alias("gain"))
    table = np.zeros(buckets, np.int64)
    for bucket, gain in gains.collect():
        table[bucket] = gain
    return table


def _weights(segments: DataFrame, gains: np.ndarray) -> DataFrame:
    """(line_key, n_words, n_features, weight) per distinct line."""

    def weigh(batches):
        for batch in batches:
            features = batch.column("features")
            size = features.value_lengths().to_numpy()
            sums = np.append(0, np.cumsum(gains[features.flatten().to_numpy()]))
            ends = np.cumsum(size)
            weight = sums[ends] - sums[ends - size]
            columns = [batch.column("line_key"), batch.column("n_words"), pa.array(size, pa.int64()), pa.array(weight)]
            yield pa.RecordBatch.from_arrays(columns, ["line_key", "n_words", "n_features", "weight"])

    schema = "line_key binary, n_words bigint, n_features bigint, weight bigint"
    return segments.select("line_key", "n_words", "features").mapInArrow(weigh, schema)


def _crossing_weights(docs: DataFrame, order: int, gains: np.ndarray) -> DataFrame:
    """(row_key, n_words, n_features, weight) of the n-grams that cross newlines."""
    buckets = len(gains)
    table = F.from_json(F.lit(str(gains.tolist())), "array<bigint>")
    crossing = _crossing(docs, ["row_key"], order)
    gain = F.get(table, _bucket(F.col("feature"), buckets).cast("int"))
    return crossing.select(
        "row_key", F.lit(0).cast("bigint").alias("n_words"), F.lit(1).cast("bigint").alias("n_features"),
        gain.alias("weight"),
    )


def importance_weights(docs: DataFrame, target: DataFrame, order: int = 1, buckets: int = 10_000) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every document: how many words and features
    it has, and the sum of its features' gains towards the texts of ``target``."""
    segments = stage(_segments(docs, order, buckets), "segments")
    aims = _segments(target, order, buckets)
    gains = _gains(_totals(segments, docs, order, buckets), _totals(aims, target, order, buckets), buckets)

    # Equal rows are one row that counts several times; others differ in this key.
    text = F.coalesce(F.concat(F.lit("t"), F.col("text")), F.lit("-"))
    row_key = F.unhex(F.md5(F.concat(F.to_json(F.struct("doc_id")), F.lit("\n"), text)))
    rows = docs.select("doc_id", "text", row_key.alias("row_key"))
    copies = rows.groupBy("row_key").agg(F.first("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"))
    entries = _lines(rows, ["row_key"]).select("row_key", _line_key(F.col("line")).alias("line_key"))
    parts = entries.join(_weights(segments, gains), "line_key").drop("line_key")
    if order > 1:
        parts = parts.union(_crossing_weights(rows, order, gains))
    sums = parts.groupBy("row_key").agg(*(F.sum(c).alias(c) for c in ("n_words", "n_features", "weight")))
    single = copies.join(sums, "row_key", "left").select(
        "doc_id", "copies",
        *(F.expr(f"coalesce({c}, 0) div copies").alias(c) for c in ("n_words", "n_features", "weight")),
    )
    return single.select(
        "doc_id", "n_words", "n_features", "weight", F.explode(F.sequence(F.lit(1), "copies")).alias("copy")
    ).drop("copy")


def draw(
    docs: DataFrame,
    target: DataFrame,
    order: int = 1,
    buckets: int = 10_000,
    min_words: int = 20,
    percent: int = 10,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; rank is NULL for those
    that are not drawn, and 1 for the highest score of ``percent`` of a hundred documents
    with at least ``min_words`` words. Ties go to the smaller doc_id.

    Features are the runs of 1 to ``order`` words; a null text has none. Rows that repeat a
    doc_id are documents of their own, and equal rows get ranks of their own. A null doc_id
    has noise as if it were empty and comes first in ties. No documents give no rows; without
    a target text all gains come from the documents alone. Other columns are not read.
    """
    weighed = importance_weights(docs, target, order, buckets)
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8)
    noise = F.lit(-1000.0) * F.log(-F.log((F.conv(digits, 16, 10).cast("bigint") + 0.5) / F.lit(4294967296.0)))
    scored = stage(weighed.withColumn("score", F.col("weight") + F.floor(noise)), "scored")
    eligible = scored.where(F.col("n_words") >= min_words)
    drawn = eligible.count() * percent // 100
    ranked = dense_key(eligible, "rank", [F.desc("score"), F.asc("doc_id")])
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    columns = ["doc_id", "n_features", "weight", "score"]
    others = scored.where(F.col("n_words") < min_words)
    return ranked.select(*columns, rank.alias("rank")).union(
        others.select(*columns, F.lit(None).cast(T.LongType()).alias("rank"))
    )
