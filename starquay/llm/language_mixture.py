"""Language identification by inferring each document's mixture of languages.

Per language, n-grams of two and three bytes of a word and its borders give smoothed log
likelihoods. A document's n-grams are taken as draws from a mixture of the languages;
expectation-maximisation estimates the proportions, and languages leave the set, weakest
first, as long as that improves the likelihood penalised by the number of languages.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starquay.llm.words import chunks, mix, raw_bytes

FOLDS = 5
# Learned documents per language at most, picked by a hash of their id.
TRAINING_DOCS = 1500
TABLE_BITS = 15
ORDERS = (2, 3)
PENALTY = 3.0
ROUNDS = 25
UNDETERMINED = "und"

_U = np.uint64
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_FOLD = np.full(256, 32, np.uint8)  # all that is no letter is a space
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def _letters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Small letters and spaces; capitals of two-byte Latin letters become small ones."""
    data, offsets = raw_bytes(texts)
    data = _FOLD[data]
    upper = np.zeros(len(data), bool)
    upper[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    data[upper] += 32
    return data, offsets


def grams(texts: pa.Array, bits: int = TABLE_BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, slot, count) of the n-grams of every text, hashed into 2^bits slots an order."""
    data, offsets = _letters(texts)
    n = len(data)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    row = np.repeat(np.arange(len(texts)), np.diff(offsets))
    letter = data != 32
    # A word has a space before and behind, and n-grams do not go over two words.
    keys = []
    for place, order in enumerate(ORDERS):
        m = n - order + 1
        if m <= 0:
            break
        code = np.zeros(m, _U)
        use = (row[:m] == row[order - 1 :]) & (letter[:m] | letter[order - 1 :])
        for k in range(order):
            code = code * _U(257) + data[k : k + m]
            if 0 < k < order - 1:
                use &= letter[k : k + m]
        at = np.flatnonzero(use)
        slot = (mix(code[at] + _U(order)) >> _U(64 - bits)).view(np.int64) + (place << bits)
        keys.append((row[at] << 20) | slot)
    if not keys:
        return (np.zeros(0, np.int64),) * 3
    key, count = np.unique(np.concatenate(keys), return_counts=True)
    return key >> 20, key & ((1 << 20) - 1), count


@dataclass
class Model:
    """``logs`` (slots, languages): smoothed log likelihoods of n-grams."""

    languages: list[str]
    logs: np.ndarray


def has_letter(texts: pa.Array) -> np.ndarray:
    """Texts with a letter of any script. Bytes beyond ASCII are looked at as characters."""
    data, offsets = raw_bytes(texts)
    ascii_letters = np.concatenate([[0], np.cumsum(_LETTER[data] & (data < 128))])
    found = ascii_letters[offsets[1:]] > ascii_letters[offsets[:-1]]
    for k in np.flatnonzero(~found):
        text = texts[int(k)].as_py()
        found[k] = bool(text) and any(c.isalpha() for c in text)
    return found


def proportions(slot: np.ndarray, count: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of the languages in one document, and the set that was kept."""
    logs = model.logs[slot]
    held = np.exp(logs - logs.max(axis=1, keepdims=True))
    weight = count / len(ORDERS)  # n-grams of all orders cover the same letters
    total = weight.sum()

    def estimate(kept: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, float]:
        p = start / start.sum()
        part = held[:, kept]
        for _ in range(ROUNDS):
            joint = part * p
            share = joint / np.maximum(joint.sum(axis=1, keepdims=True), 1e-300)
            new = np.maximum((share * weight[:, None]).sum(axis=0) / total, 1e-12)
            new /= new.sum()
            if np.abs(new - p).max() < 1e-4:
                p = new
                break
            p = new
        return p, float((np.log(np.maximum(part @ p, 1e-300)) * weight).sum())

    kept = np.arange(held.shape[1])
    p, fit = estimate(kept, np.ones(len(kept)))
    cost = PENALTY * np.log(total + 1) / 2
    while len(kept) > 1:
        out = int(np.argmin(p))
        fewer = np.delete(kept, out)
        q, other = estimate(fewer, np.delete(p, out) + 1e-6)
        if other + cost < fit:
            break
        kept, p, fit = fewer, q, other
    full = np.zeros(held.shape[1])
    full[kept] = p
    return full, kept


def predict(texts: pa.Array, model: Model) -> tuple[list[str], np.ndarray, list[str]]:
    """Main language, its proportion, and the mixture as text, for every text."""
    row, slot, count = grams(texts)
    cut = np.searchsorted(row, np.arange(len(texts) + 1))
    known = has_letter(texts)
    names, scores, mixes = [], np.zeros(len(texts)), []
    for k in range(len(texts)):
        a, b = cut[k], cut[k + 1]
        if not known[k] or not model.languages:
            names.append(UNDETERMINED)
            mixes.append("")
            continue
        if a == b:
            p = np.full(len(model.languages), 1 / len(model.languages))
        else:
            p, _ = proportions(slot[a:b], count[a:b], model)
        best = int(np.argmax(p))
        names.append(model.languages[best])
        scores[k] = min(max(p[best], 0.0), 1.0)
        order = sorted(np.flatnonzero(p > 0), key=lambda i: (-p[i], i))
        mixes.append(",".join(f"{model.languages[i]}:{p[i]:.3f}" for i in order))
    return names, scores, mixes


def _held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def train(docs: DataFrame, limit: int = TRAINING_DOCS) -> Model:
    """N-gram tables of at most ``limit`` documents per language outside the held-out fold. What
    reaches the driver is one table of fixed size per language. Tasks add up their own
    documents first, and a language's tables are added in 64 parts and then as one."""
    known = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang")
    ).where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~_held_out())
    counts = {r.lang: r["count"] for r in known.groupBy("lang").count().collect()}
    rate = F.lit(1 << 30)
    for lang, n in counts.items():
        # A hash below this bound picks about ``limit`` documents, the same at every run.
        rate = F.when(F.col("lang") == lang, F.lit(min(1 << 30, int((1 << 30) * limit / n)))).otherwise(rate)
    sample = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < rate).select("text", "lang")
    slots = len(ORDERS) << TABLE_BITS

    def make(batches):
        tables: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), object)
            for i, j in chunks(batch.column(0)):
                row, slot, count = grams(batch.column(0)[i:j])
                for lang in set(langs[i:j]):
                    at = langs[i:j][row] == lang
                    table = tables.setdefault(lang, np.zeros(slots))
                    # A document counts once per n-gram and root, so long ones do not rule.
                    table += np.bincount(slot[at], np.sqrt(count[at]), slots)
        names = list(tables)
        salt = [int(mix(tables[n][:1].view(_U) + _U(int(tables[n].sum())))[0] % _U(64)) for n in names]
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(salt, pa.int64()), pa.array([tables[n].astype(np.float32).tobytes() for n in names], pa.binary())],
            ["lang", "salt", "counts"],
        )

    def total(table: pa.Table) -> pa.Table:
        sums = np.zeros(slots, np.float32)
        for counts in table.column("counts"):
            sums += np.frombuffer(counts.as_py(), np.float32)
        return table.slice(0, 1).set_column(2, "counts", pa.array([sums.tobytes()], pa.binary()))

    schema = "lang string, salt bigint, counts binary"
    parts = sample.mapInArrow(make, schema).groupBy("lang", "salt").applyInArrow(total, schema)
    rows = sorted(parts.groupBy("lang").applyInArrow(total, schema).collect(), key=lambda r: r.lang)
    logs = np.zeros((slots, len(rows)), np.float32)
    for k, r in enumerate(rows):
        table = np.frombuffer(r.counts, np.float32).reshape(len(ORDERS), -1) + 0.5
        logs[:, k] = np.log(table / table.sum(axis=1, keepdims=True)).ravel()
    return Model([r.lang for r in rows], logs)


def identify_languages(docs: DataFrame, limit: int = TRAINING_DOCS) -> DataFrame:
    """(doc_id, text, lang) -> (doc_id, held_out, lang_pred, score, mixture), one row per row.

    ``score`` is the proportion of ``lang_pred`` in the mixture. Null texts and texts without a
    letter get ``und`` and 0; so does everything if no language can be learned. ``lang`` is
    read for learning alone, from rows whose crc32(doc_id) mod 5 is not 0.
    """
    model = train(docs, limit)

    def make(batches):
        for batch in batches:
            for i, j in chunks(batch.column(1)):
                names, scores, mixes = predict(batch.column(1)[i:j], model)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[i:j], pa.array(names, pa.string()), pa.array(scores), pa.array(mixes, pa.string())],
                    ["doc_id", "lang_pred", "score", "mixture"],
                )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = rows.mapInArrow(make, "doc_id bigint, lang_pred string, score double, mixture string")
    return found.select("doc_id", _held_out().alias("held_out"), "lang_pred", "score", "mixture")
