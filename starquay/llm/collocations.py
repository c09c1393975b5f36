"""Phrase collocations: top-order marginalisation.

Each word leads one window: the word and the words after it in its piece, padded with
NULL at the end of the piece. Only these longest windows are counted and shuffled. A
shorter phrase begins as many windows as it occurs, so its count is the sum over the
windows that begin with it: Spark's ROLLUP over the lead columns gives the counts of all
shorter phrases, of single words and of all words at once, without a further explosion.

Tasks count the windows of a few megabytes of text by themselves and give them in order,
which is what makes the one large exchange small. It is by ranges of everything but the
last word, so the counts of windows and of their longest prefixes are complete inside a
task, which adds them up in one reading. There, windows and prefixes too rare to be candidates
lose their last word to padding, and the ROLLUP moves little more than words. Beginnings that
hold a large share of a sample are spread over ranges by the last word as well; the sample
decides where rows go, and no count.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starquay.llm.words import FOLD, chunks, raw_bytes, runs
from starquay.session import listed_bytes
from starquay.staging import stage

# What ends a piece, and what else ends a word.
_PIECE_END = np.zeros(256, bool)
_PIECE_END[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_GAP = _PIECE_END.copy()
_GAP[[ord(" "), ord("\t")]] = True

NO_LANG = "und"
_TAB = "\t"
CHUNK_BYTES = 3 << 20
BATCH_ROWS = 1 << 15
# Sampled documents that tell which beginnings are spread, and the share that makes one so.
SAMPLE = 1000
HOT_SHARE = 1 / 200
SPREAD = 64
# Bytes of text files behind one range, and the number of ranges from which on it grows.
RANGE_BYTES = 1 << 20
RANGES = 10_000
# Windows a task holds at a time; a range of more is added up in parts, none of them padded.
HELD_ROWS = 1 << 21


def _ranges(size: int) -> int:
    """Number of ranges: in proportion to the input, then with its square root, as the
    blocks of a shuffle are ranges times tasks."""
    n = max(1, size // RANGE_BYTES)
    return int(n if n <= RANGES else RANGES * (n / RANGES) ** 0.5)


def _counted(langs: pa.Array, texts: pa.Array, longest: int) -> pa.RecordBatch | None:
    """The distinct windows of a few texts with their counts, in order of their words."""
    data, offsets = raw_bytes(texts)
    data = FOLD[data]
    row, start, end = runs(~_GAP[data], offsets)
    if not len(start):
        return None
    # Words and gaps take turns, so every other value is a word.
    cuts = np.append(np.column_stack([start, end]).ravel(), end[-1])
    spans = pa.LargeStringArray.from_buffers(2 * len(start), pa.py_buffer(cuts), pa.py_buffer(data))
    encoded = spans.take(pa.array(np.arange(0, 2 * len(start), 2))).dictionary_encode()
    order = pc.sort_indices(encoded.dictionary).to_numpy()
    vocabulary = encoded.dictionary.take(pa.array(order)).cast(pa.string())
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(1, len(order) + 1)
    word = place[encoded.indices.to_numpy()]
    piece = np.cumsum(_PIECE_END[data])[start]
    lang = langs.dictionary_encode()

    key = lang.indices.to_numpy(zero_copy_only=False).astype(np.int64)[row]
    base, levels, n = len(vocabulary) + 1, [], len(word)
    for step in range(longest):
        value = np.zeros(n, np.int64)
        held = n - step
        if held > 0:
            same = (piece[step:] == piece[:held]) & (row[step:] == row[:held])
            value[:held] = np.where(same, word[step:], 0)
        key, spot = np.unique(key * base + value, return_inverse=True)
        levels.append(key)
        key = spot
    counts = np.bincount(key)
    columns, at = [], np.arange(len(counts))
    for known in reversed(levels):
        value, at = known[at] % base, known[at] // base
        columns.append(vocabulary.take(pa.array(value - 1, mask=value == 0)))
    last, *lead = columns
    lead = [pc.fill_null(word, "") for word in reversed(lead)]
    head = pc.binary_join_element_wise(lang.dictionary.take(pa.array(at)), *lead, _TAB)
    return pa.RecordBatch.from_arrays([head, last, pa.array(counts)], ["head", "last", "n"])


def lead_windows(docs: DataFrame, longest: int) -> DataFrame:
    """(head, last, n): windows by their lead word, counted inside tasks. ``head`` is the
    language and all words but the last, with tabs between, as one string takes less
    room in an exchange than a column per word; padding is an empty word, or a NULL ``last``."""

    def count(batches):
        for batch in batches:
            langs = pc.fill_null(batch.column(0).cast(pa.string()), NO_LANG)
            texts = batch.column(1)
            for first, last in chunks(texts, CHUNK_BYTES):
                part = _counted(langs.slice(first, last - first), texts.slice(first, last - first), longest)
                for i in range(0, part.num_rows if part else 0, BATCH_ROWS):
                    yield part.slice(i, BATCH_ROWS)
        batch = langs = texts = part = None
        pa.default_memory_pool().release_unused()

    return docs.select("lang", "text").mapInArrow(count, "head string, last string, n bigint")


def _apart(head: Column, longest: int) -> list[Column]:
    """The columns lang, w1 .. of a head; padding is NULL. Only a language may hold tabs."""
    if longest == 1:
        return [head.alias("lang")]
    words = F.substring_index(head, _TAB, 1 - longest)
    parts = F.split(words, _TAB)
    lang = F.substring(head, F.lit(1), F.length(head) - F.length(words) - 1)
    return [lang.alias("lang"), *(F.nullif(parts[i], F.lit("")).alias(f"w{i + 1}") for i in range(longest - 1))]


def _hot_heads(docs: DataFrame, longest: int) -> list[str]:
    """The heads of at least HOT_SHARE of the windows of a sample: at most 1 / HOT_SHARE."""
    few = docs.select("lang", "text").orderBy(F.rand(0)).limit(SAMPLE)
    seen = lead_windows(few, longest).groupBy("head").agg(F.count(F.lit(1)).alias("rows"))
    share = F.col("rows") / F.sum("rows").over(Window.partitionBy())
    return [row.head for row in seen.withColumn("share", share).where(F.col("share") >= HOT_SHARE).collect()]


def _added_up(batches: list[pa.RecordBatch]) -> pa.Table:
    """The distinct windows of a few batches with their sums."""
    found = pa.Table.from_batches(batches).group_by(["head", "last"], use_threads=False).aggregate([("n", "sum")])
    return found.select(["head", "last", "n_sum"]).rename_columns(["head", "last", "n"])


def _padded(windows: pa.Table, longest: int, min_count: int, hot: list[str]) -> list[pa.Table]:
    """The same windows, the last word of those too rare replaced by padding, and then of heads
    too rare, unless ``hot``, whose windows are in several ranges. Sums of all prefixes that
    are frequent, or not complete in a range, stay as they were."""
    often = pc.greater_equal(windows["n"], min_count)
    frequent = windows.filter(often)
    heads = windows.filter(pc.invert(often)).group_by("head", use_threads=False).aggregate([("n", "sum")])
    head, n = heads["head"], heads["n_sum"]
    rare = pc.and_not(pc.less(n, min_count), pc.is_in(head, pa.array(hot, pa.string())))
    rare = pc.and_not(rare, pc.is_in(head, pc.unique(frequent["head"])))
    if longest > 1:  # a head of a language alone has no word to lose
        head = pc.if_else(rare, pc.replace_substring_regex(head, "[^\t]*$", ""), head)
    rest = pa.table({"head": head, "last": pa.nulls(len(heads), pa.string()), "n": n})
    return [frequent, _added_up(rest.to_batches())] if len(rest) else [frequent]


def _reduced(longest: int, min_count: int, hot: list[str]):
    def reduce_range(batches):
        held, rows, whole = [], 0, True
        for batch in batches:
            if held and rows + batch.num_rows > HELD_ROWS:
                windows = _added_up(held)
                held, rows = windows.to_batches(), len(windows)
                if rows > HELD_ROWS // 2:
                    # What is rare in a part of a range need not be so in all of it.
                    yield from windows.to_batches(max_chunksize=BATCH_ROWS)
                    held, rows, whole = [], 0, False
            held.append(batch)
            rows += batch.num_rows
        if held:
            windows = _added_up(held)
            held, batch = [], None
            for part in _padded(windows, longest, min_count, hot) if whole else [windows]:
                yield from part.to_batches(max_chunksize=BATCH_ROWS)
        # Workers are kept for other tasks, and Arrow's memory with them.
        windows = part = None
        pa.default_memory_pool().release_unused()

    return reduce_range


def phrase_counts(docs: DataFrame, longest: int = 3, min_count: int = 10) -> DataFrame:
    """(lang, size, phrase, n): how often each phrase of up to ``longest`` words occurs, if
    at least ``min_count`` times; size 0 and a NULL phrase for the number of words of a
    language. A table in the shared folder."""
    lead = ["lang", *(f"w{i}" for i in range(1, longest)), "last"]
    windows = lead_windows(docs, longest)
    keys = ["head"]
    hot = _hot_heads(docs, longest)
    if hot:  # a constant column would hide from Spark that rows of a head are together
        windows = windows.withColumn("spread", F.when(F.col("head").isin(hot), F.abs(F.hash("last")) % SPREAD))
        keys.append("spread")
    windows = (
        windows.repartitionByRange(_ranges(listed_bytes([docs.select("text")])), *keys)
        .select("head", "last", "n")
        .mapInArrow(_reduced(longest, min_count, hot), "head string, last string, n bigint")
    )
    levels = (
        windows.select(*_apart(F.col("head"), longest), "last", "n")
        .rollup(*lead)
        .agg(F.grouping_id().alias("left_out"), F.sum("n").alias("n"))
    )
    # grouping_id has one bit per column that is left out.
    size = F.lit(longest) - F.bit_count("left_out")
    counts = levels.select("lang", size.alias("size"), *lead[1:], "n")
    # The row of a prefix whose last word is padding stands for no phrase of that size.
    complete = reduce(
        Column.__or__, [(F.col("size") == i) & F.col(lead[i]).isNotNull() for i in range(1, longest + 1)]
    )
    phrase = F.concat_ws(" ", *lead[1:])
    counted = counts.where((F.col("size") == 0) | (complete & (F.col("n") >= min_count))).select(
        "lang", "size", F.when(F.col("size") > 0, phrase).alias("phrase"), "n"
    )
    return stage(counted, "phrase_counts")


def _part(words: Column, first: Column, size: Column) -> Column:
    return F.array_join(F.slice(words, first, size), " ")


def collocations(
    docs: DataFrame,
    longest: int = 3,
    min_count: int = 10,
    absorbed: tuple[int, int] = (50, 100),
    top: int | None = 2000,
) -> DataFrame:
    """The phrases of 2 to ``longest`` words whose parts go together, best first per language.

    (lang, rank, phrase, a, l, r, n, score): a, l and r are the counts of the phrase, of its
    first part and of the rest at the cut with the lowest score, the first such cut of a
    tie; n is the number of words of the language; score = floor(1000000 a a / (l r)). A
    phrase inside a longer candidate that has at least ``absorbed`` of its count is left
    out. ``top`` is how many rows a language reports, None for all.

    A null text is empty, a null language ``und``. Repeated rows count as often as they
    occur. No documents, or no phrase that is frequent enough, give no rows. Other columns
    are not read.
    """
    counts = phrase_counts(docs, longest, min_count)
    known = counts.where("size > 0").select("lang", "phrase", "n")
    candidates = counts.where("size > 1").select(
        "lang", "size", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("words")
    )
    # What a longer candidate holds: the largest count among those that hold a phrase.
    inside = candidates.where("size > 2").select(
        "lang", "a", "words", "size", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("short")
    )
    inside = inside.select(
        "lang", "a", "words", "short", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("short") + 1)).alias("at")
    )
    held = inside.select("lang", "a", _part(F.col("words"), F.col("at"), F.col("short")).alias("phrase"))
    held = held.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))

    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "a", "k",
        _part(F.col("words"), F.lit(1), F.col("k")).alias("left"),
        _part(F.col("words"), F.col("k") + 1, F.col("size") - F.col("k")).alias("right"),
    )
    lefts = known.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    rights = known.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    # Counts of up to 16 digits: the products fit in 38.
    score = F.expr(
        "(1000000BD * cast(a as decimal(16, 0)) * cast(a as decimal(16, 0)))"
        " div (cast(l as decimal(16, 0)) * cast(r as decimal(16, 0)))"
    )
    scored = cuts.join(lefts, ["lang", "left"]).join(rights, ["lang", "right"]).withColumn("score", score)
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    best = scored.groupBy("lang", "phrase", "a").agg(lowest).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    kept = best.join(held, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * absorbed[1] < F.col("a") * absorbed[0])
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast(T.LongType()))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    totals = counts.where("size = 0").select("lang", "n")
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
