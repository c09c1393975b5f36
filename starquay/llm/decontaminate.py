"""Benchmark decontamination by templates.

Both sides are cut into tokens; numbers, units behind numbers and runs of names become typed
placeholders, so a question whose values were exchanged keeps its template. Windows of
template tokens meet in a hash join, whatever their values. What they have in common is
judged over the whole item: windows on neighbouring alignments together have to cover
enough of it, and of its words that are no placeholders, and the values behind the
placeholders are compared: in a copy or a re-parameterised question one value of the item
stands for one value of the document wherever it occurs.

Items that differ in their values only, and repeat them in the same places, are one
template class, which the item with the smallest id stands for, so a document meets a
class once and not each of its items.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starquay.llm.filters import bloom, maybe_in
from starquay.llm.words import FOLD, SMALL_CHUNK_BYTES, chunks, hashes, mix, raw_bytes, runs, windows
from starquay.staging import stage

WINDOW = 8
# Words of an item that are no placeholders: so many must be covered, or all it has. An item
# with fewer is found where its values are the same as well.
MIN_LITERALS = 5
MIN_RUN = 13
MIN_COVERAGE = 0.5
MIN_CONSISTENCY = 0.8
# Tokens that alignments may be apart and still be one: inserted or missing words.
DRIFT = 4

# Units of measure behind a number.
UNITS = (
    "m cm mm km g kg mg lb lbs oz l ml s sec min h hr hrs ms mph kph km/h ft in yd mi usd eur "
    "dollar dollars euro euros cent cents percent meter meters metre metres kilometer kilometers "
    "gram grams kilogram kilograms liter liters litre litres second seconds minute minutes hour "
    "hours day days week weeks month months year years mile miles inch inches foot feet pound pounds"
).split()

_U = np.uint64
_NUMBER, _UNIT, _NAME = (mix(np.array([k], _U))[0] for k in (11, 12, 13))
_PART = np.zeros(256, bool)  # bytes of a token: letters, digits, anything beyond ASCII
for _low, _high in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _PART[_low:_high] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?:;\n\"'()|"]] = True


def _hash_of(word: str) -> np.uint64:
    data = np.frombuffer(word.encode(), np.uint8)
    return hashes(data, np.array([0]), np.array([len(data)]))[0]


_UNIT_HASHES = np.sort(np.array([_hash_of(u) for u in UNITS], _U))


def _among(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
    return sorted_values[at] == values


def template(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, template token, value, is placeholder) of every token; names in a row are one.

    A number starts with a digit, and may hold . or , between digits. A unit follows a
    number. A name is a capital letter and a small one, and follows another token of its
    sentence without a sentence mark between; a first word is no name. A passage put into
    a sentence starts with a capital there, so windows that start at a name are also made
    with the word itself.
    """
    data, offsets = raw_bytes(texts)
    none = np.zeros(0, _U)
    if not len(data):
        return np.zeros(0, np.int64), none, none, np.zeros(0, bool)
    digit = _DIGIT[data]
    inside = np.zeros(len(data), bool)
    inside[1:-1] = ((data == 44) | (data == 46))[1:-1] & digit[:-2] & digit[2:]
    row, start, end = runs(_PART[data] | inside, offsets)
    folded = FOLD[data]
    # Small letters for the capitals of Latin-1, which share the first of two bytes.
    capital = np.zeros(len(data), bool)
    capital[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    folded[capital] += 32
    value = hashes(folded, start, end)
    number = digit[start]
    follows = np.zeros(len(start), bool)
    follows[1:] = row[1:] == row[:-1]
    after_number = np.zeros(len(start), bool)
    after_number[1:] = number[:-1]
    unit = follows & after_number & ~number & _among(_UNIT_HASHES, value)
    stops = np.concatenate([[0], np.cumsum(_STOP[data])])
    same = follows.copy()
    same[1:] &= stops[start[1:]] == stops[end[:-1]]
    at = [data[np.minimum(start + k, len(data) - 1)] for k in range(4)]
    wide = (at[0] == 0xC3) & (at[1] >= 0x80) & (at[1] <= 0x9E)
    next_one, after_next = np.where(wide, at[2], at[1]), np.where(wide, at[3], at[2])
    small = ((next_one >= 97) & (next_one <= 122)) | ((next_one == 0xC3) & (after_next >= 0x9F))
    capital = (((at[0] >= 65) & (at[0] <= 90)) | wide) & small & (end - start > 1 + wide)
    name = same & capital & ~number & ~unit
    token = np.where(number, _NUMBER, np.where(unit, _UNIT, np.where(name, _NAME, value)))
    # The value of several names in a row is made of all of them.
    more = np.zeros(len(start), bool)
    more[1:] = name[1:] & name[:-1] & same[1:]
    held = np.cumsum(~more) - 1
    if more.any():
        place = np.arange(len(start)) - np.flatnonzero(~more)[held]
        folded_values = np.zeros(held[-1] + 1, _U)
        np.add.at(folded_values, held, np.where(place > 0, mix(value + place.astype(_U)), value))
        value = np.where(name, folded_values[held], value)
    keep = ~more
    return row[keep], token[keep], value[keep], (number | unit | name)[keep]


def _windows_of(texts: pa.Array, sizes: list[int], known: np.ndarray | None, whole: int):
    """Rows, first token, hash and slot values of the windows of each size, and all tokens.

    A window without any literal token says nothing and is left out. Windows shorter than
    ``whole`` are only made of whole texts, unless ``known`` tells which hashes are asked for.
    """
    row, token, value, slot = tokens = template(texts)
    count = np.bincount(row, minlength=len(texts)) if len(row) else np.zeros(len(texts), np.int64)
    out = []
    named = np.flatnonzero(token == _NAME)
    slots_before = np.concatenate([[0], np.cumsum(slot)])
    for size in sizes:
        hashed, first = windows(token, row, size)
        again = np.flatnonzero(np.isin(first, named)) if known is not None else first[:0]
        if len(again):
            other, _ = windows(token, row, size, lead=value)
            hashed, first = (np.concatenate([x, y]) for x, y in ((hashed, other[again]), (first, first[again])))
        hashed = mix(hashed + _U(size))
        literals = size - (slots_before[first + size] - slots_before[first])
        keep = (literals > 0) & (
            maybe_in(known, hashed.view(np.int64)) if known is not None
            else np.ones(len(first), bool) if size >= whole else count[row[first]] == size
        )
        first, hashed = first[keep], hashed[keep]
        begin = np.concatenate([[0], np.cumsum(count)])[row[first]] if len(first) else first
        spread = (first[:, None] + np.arange(size)[None, :]) if len(first) else np.zeros((0, size), int)
        held = slot[spread]
        values = np.where(held, value[spread].view(np.int64), 0)
        kept = pa.ListArray.from_arrays(
            pa.array(np.arange(len(first) + 1, dtype=np.int32) * size), pa.array(values.ravel())
        )
        out.append((row[first], first - begin, hashed.view(np.int64), kept))
    return out, count, tokens


_COLUMNS = ["id", "at", "hash", "slots"]
_ITEM = "id bigint, class bigint, tokens bigint, literal_at array<int>, at array<bigint>, hash array<bigint>, slots array<array<bigint>>"


def _item_classes(items: DataFrame, window: int) -> DataFrame:
    """One row per template class: (id, n_items, tokens, literal_at, at, hash, slots) of its
    item with the smallest id; one shorter than a window is a window of its own."""

    def make(batches):
        for batch in batches:
            for i, j in chunks(batch.column(1)):
                ids = batch.column(0)[i:j].to_pylist()
                found, count, (row, token, value, slot) = _windows_of(
                    batch.column(1)[i:j], list(range(1, window + 1)), None, window
                )
                ends = np.cumsum(count)
                rows = []
                for k, item in enumerate(ids):
                    part = slice(ends[k] - count[k], ends[k])
                    # The template, and which slots hold the same value; the values themselves
                    # where too few words are left to tell a template.
                    _, first, same = np.unique(value[part], return_index=True, return_inverse=True)
                    literal = np.flatnonzero(~slot[part])
                    told = np.where(slot[part], first[same].astype(_U), _U(0))
                    if len(literal) < MIN_LITERALS:
                        told = value[part]
                    sign = np.zeros(1, _U)
                    for t, v in zip(token[part], told):
                        sign = mix(sign * _U(3) + mix(np.array([t], _U)) + v)
                    rows.append([item, int(sign.view(np.int64)[0]), int(count[k]), literal.tolist(), [], [], []])
                for at_row, at, hashed, slots in found:
                    for r, a, h, v in zip(at_row, at, hashed, slots.to_pylist()):
                        rows[r][4].append(int(a))
                        rows[r][5].append(int(h))
                        rows[r][6].append(v)
                names = [f.split()[0] for f in _ITEM.split(", ")]
                types = [pa.int64()] * 3 + [pa.list_(pa.int32())] + [pa.list_(pa.int64())] * 2 + [pa.list_(pa.list_(pa.int64()))]
                arrays = [pa.array([r[c] for r in rows], t) for c, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays(arrays, names)

    made = items.mapInArrow(make, _ITEM)
    held = F.struct("id", "tokens", "literal_at", "at", "hash", "slots")
    return made.groupBy("class").agg(F.min_by(held, "id").alias("first"), F.count(F.lit(1)).alias("n_items")).select(
        "first.*", "n_items"
    )


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    min_run: int = MIN_RUN,
    min_coverage: float = MIN_COVERAGE,
    min_consistency: float = MIN_CONSISTENCY,
    drift: int = DRIFT,
) -> DataFrame:
    """(doc_id, text), (item_id, text) -> (doc_id, item_id, n_windows, coverage, n_slots,
    consistency, reparameterised, n_items): one row per document and template class of items
    found in it, of which ``item_id`` is the smallest id and ``n_items`` the number of texts.

    An item is found where its matched windows, on alignments at most ``drift`` tokens apart
    from one to the next, span ``min_run`` tokens or ``min_coverage`` of its windows, cover
    MIN_LITERALS of its words that are no placeholders, or all, and at least
    ``min_consistency`` of its values each stand for one value of the document.
    ``reparameterised``: some value differs from those of ``item_id``. An item with fewer
    such words than MIN_LITERALS is found with its own values only. Items that are null,
    empty, or without an id are never found, nor are items without any such word, nor
    documents without an id. Repeated rows of a document give one row. Empty tables give no
    rows. The benchmark reaches the map tasks as a filter of fixed size; the join itself
    is exact and follows measured sizes.
    """
    items = (
        benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text")
        .where("item_id is not null and text is not null")
        .groupBy("text")
        .agg(F.min("item_id").alias("id"))
        .select("id", "text")
    )
    classes = stage(_item_classes(items, window), "item_classes")
    asked = classes.select("id", F.explode(F.arrays_zip("at", "hash", "slots")).alias("w")).select("id", "w.*")
    known = bloom(asked.select("hash"))
    sizes = [row[0] for row in classes.select(F.least("tokens", F.lit(window)).cast("int")).distinct().collect()]

    def make(batches):
        for batch in batches:
            for i, j in chunks(batch.column(1), SMALL_CHUNK_BYTES):
                ids = batch.column(0)[i:j]
                for row, at, hashed, slots in _windows_of(batch.column(1)[i:j], [n for n in sizes if n], known, window)[0]:
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(row)), pa.array(at), pa.array(hashed), slots], _COLUMNS
                    )

    found = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
        .where("doc_id is not null")
        .mapInArrow(make, "id bigint, at bigint, hash bigint, slots array<bigint>")
        .select(F.col("id").alias("doc_id"), F.col("at").alias("doc_at"), "hash", F.col("slots").alias("doc_slots"))
    )
    pairs = F.filter(F.arrays_zip("slots", "doc_slots"), lambda s: s["slots"] != 0)
    met = found.join(asked, "hash").select(
        "doc_id",
        F.col("id").alias("item_id"),
        (F.col("doc_at") - F.col("at")).alias("shift"),
        "at",
        pairs.alias("values"),
    )
    shifts = met.groupBy("doc_id", "item_id", "shift").agg(
        F.collect_set("at").alias("at"),
        F.array_distinct(F.flatten(F.collect_set("values"))).alias("values"),
    )
    along = Window.partitionBy("doc_id", "item_id").orderBy("shift")
    starts = F.coalesce(F.col("shift") - F.lag("shift").over(along) > drift, F.lit(True))
    aligned = (
        shifts.withColumn("starts", starts.cast("int"))
        .withColumn("alignment", F.sum("starts").over(along))
        .groupBy("doc_id", "item_id", "alignment")
        .agg(
            F.array_distinct(F.flatten(F.collect_list("at"))).alias("at"),
            F.array_distinct(F.flatten(F.collect_list("values"))).alias("values"),
        )
        .join(classes.select(F.col("id").alias("item_id"), "tokens", "literal_at", "n_items", F.size("at").alias("windows")), "item_id")
    )
    size = F.least("tokens", F.lit(window))
    covered = F.size(
        F.filter("literal_at", lambda p: F.exists("at", lambda a: (a <= p) & (p < a + size)))
    )
    left = F.size(F.array_distinct("values.slots"))
    right = F.size("values")
    judged = aligned.select(
        "doc_id",
        "item_id",
        "n_items",
        F.size("at").cast("bigint").alias("n_windows"),
        (F.size("at") / F.col("windows")).alias("coverage"),
        (F.size("at") + size - 1).alias("span"),
        covered.alias("covered"),
        F.size("literal_at").alias("literals"),
        left.alias("n_slots"),
        F.when(right == 0, 1.0).otherwise(left / right).alias("consistency"),
        F.exists("values", lambda v: v["slots"] != v["doc_slots"]).alias("reparameterised"),
    )
    strong = judged.where(
        (F.col("consistency") >= min_consistency)
        & ((F.col("span") >= min_run) | (F.col("coverage") >= min_coverage))
        & (F.col("covered") >= F.least("literals", F.lit(MIN_LITERALS)))
        & ((F.col("literals") >= MIN_LITERALS) | ~F.col("reparameterised"))
    )
    best = F.max_by(
        F.struct("n_windows", "coverage", "n_slots", "consistency", "reparameterised", "n_items"),
        F.struct("coverage", "consistency", ~F.col("reparameterised")),
    )
    return strong.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.*")


def clean_documents(docs: DataFrame, benchmark: DataFrame, **parameters) -> DataFrame:
    """``docs`` without the contaminated ones; rows without an id stay."""
    hits = contaminated(docs, benchmark, **parameters).select("doc_id").distinct()
    return docs.join(hits, "doc_id", "left_anti").select(*docs.columns)
