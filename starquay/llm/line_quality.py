"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. A line's features and those of the lines before and after it
score its state, and weights between neighbouring states tie the lines together.
Forward-backward gives each line's probability of being good; their mean, weighted by the
lines' lengths, is mapped to a probability by a logistic curve fitted on the same
labelled documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starquay.llm.words import FOLD, SMALL_CHUNK_BYTES, chunks, hashes, raw_bytes, runs

# Labelled documents the model is fitted on at most; all documents are scored.
TRAINING_DOCS = 4000
THRESHOLD = 0.3
FOLDS = 5

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_PLAIN = np.zeros(256, bool)
_PLAIN[[ord(c) for c in ".,'-"]] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_END = np.zeros(256, bool)
_END[[ord(c) for c in ".!?:\""]] = True
N_FEATURES = 15


@dataclass
class Lines:
    """Features of the lines of a batch; ``offsets`` by text, ``size`` in bytes."""

    features: np.ndarray
    offsets: np.ndarray
    size: np.ndarray


def line_features(texts: pa.Array) -> Lines:
    """Lines are runs of bytes other than newlines; a text without any has none."""
    data, offsets = raw_bytes(texts)
    row, start, end = runs(data != 10, offsets)
    if not len(row):
        return Lines(np.zeros((0, N_FEATURES), np.float32), np.zeros(len(texts) + 1, np.int64), np.zeros(0))
    lines = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(texts)))])
    size = (end - start).astype(float)

    def share(table: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(table[data])])
        return (total[end] - total[start]) / size

    _, word_start, word_end = runs(~_SPACE[data], offsets)
    word_line = np.searchsorted(start, word_start, "right") - 1
    word_hash = hashes(FOLD[data], word_start, word_end)
    n_words = np.bincount(word_line, minlength=len(row)).astype(float)
    per_word = np.maximum(n_words, 1)
    chars = np.bincount(word_line, (word_end - word_start).astype(float), len(row))
    again = np.zeros(len(word_hash))
    again[1:] = (word_hash[1:] == word_hash[:-1]) & (word_line[1:] == word_line[:-1])
    order = np.lexsort((word_hash, word_line))
    h, w = word_hash[order], word_line[order]
    new = np.ones(len(h))
    new[1:] = (h[1:] != h[:-1]) | (w[1:] != w[:-1])
    line_hash = hashes(data, start, end)
    order = np.lexsort((np.arange(len(row)), line_hash, row))
    repeated = np.zeros(len(row))
    repeated[order[1:]] = (line_hash[order][1:] == line_hash[order][:-1]) & (row[order][1:] == row[order][:-1])
    symbol = ~(_SPACE | _LETTER | _DIGIT | _PLAIN)
    own = np.stack(
        [
            np.log1p(size) / 8,
            np.log1p(n_words) / 6,
            share(_UPPER),
            share(_DIGIT),
            np.minimum(share(symbol) * 5, 2),
            share(_PLAIN) * 5,
            np.minimum(chars / per_word / 10, 3),
            np.bincount(word_line, again, len(row)) / per_word,
            np.bincount(w, new, len(row)) / per_word,
            _END[data[end - 1]].astype(float),
            repeated,
            _UPPER[data[start]].astype(float),
            (n_words < 3).astype(float),
            np.minimum(np.bincount(word_line, word_end - word_start == 1, len(row)) / per_word * 2, 2),
            np.ones(len(row)),
        ],
        axis=1,
    ).astype(np.float32)
    return Lines(own, lines, size)


def _with_neighbours(features: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Features of the line before and after beside a line's own; zeros at the ends."""
    before, after = np.zeros_like(features), np.zeros_like(features)
    if len(features):
        before[1:], after[:-1] = features[:-1], features[1:]
        held = offsets[:-1][np.diff(offsets) > 0]
        before[held] = 0
        after[offsets[1:][np.diff(offsets) > 0] - 1] = 0
    return np.concatenate([features, before, after], axis=1)


@dataclass
class Field:
    """``weights``: of the state "good" against "bad"; ``steps``: log weights between states."""

    weights: np.ndarray
    steps: np.ndarray
    slope: float = 1.0
    shift: float = 0.0


def _marginals(score: np.ndarray, offsets: np.ndarray, steps: np.ndarray):
    """Forward-backward for all texts at once: P(good) of each line, and the expected
    counts of the four steps of each text. Texts are sorted by length, so step t works on
    a prefix of them; messages are scaled, so long texts neither over- nor underflow."""
    n = np.diff(offsets)
    order = np.argsort(-n, kind="stable")
    first, n = offsets[:-1][order], n[order]
    emit = np.stack([1 / (1 + np.exp(np.clip(score, -50, 50))), 1 / (1 + np.exp(np.clip(-score, -50, 50)))], 1)
    move = np.exp(steps)
    forward = np.empty_like(emit)
    longest = int(n[0]) if len(n) else 0
    for t in range(longest):
        at = first[: np.searchsorted(-n, -t, "left")] + t
        now = emit[at] if t == 0 else (forward[at - 1] @ move) * emit[at]
        forward[at] = now / now.sum(axis=1, keepdims=True)
    backward = np.ones_like(emit)
    pairs = np.zeros((2, 2))
    weight = np.repeat(1 / np.maximum(np.diff(offsets), 1), np.diff(offsets))
    for t in range(longest - 1, 0, -1):
        at = first[: np.searchsorted(-n, -t, "left")] + t
        below = backward[at] * emit[at]
        joint = forward[at - 1][:, :, None] * move[None] * below[:, None, :]
        joint /= joint.sum(axis=(1, 2), keepdims=True)
        pairs += (joint * weight[at][:, None, None]).sum(axis=0)
        message = below @ move.T
        backward[at - 1] = message / message.sum(axis=1, keepdims=True)
    both = forward * backward
    return both[:, 1] / np.maximum(both.sum(axis=1), 1e-300), pairs


def _aggregate(good: np.ndarray, lines: Lines) -> np.ndarray:
    """Length-weighted mean per text; one half without lines."""
    row = np.repeat(np.arange(len(lines.offsets) - 1), np.diff(lines.offsets))
    total = np.bincount(row, lines.size, len(lines.offsets) - 1)
    held = np.bincount(row, good * lines.size, len(lines.offsets) - 1)
    return np.where(total > 0, held / np.maximum(total, 1), 0.5)


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def fit(lines: Lines, label: np.ndarray, rounds: int = 120, rate: float = 0.15, decay: float = 1e-3) -> Field:
    """Maximum likelihood by Adam. Every line carries its document's label and every
    document has the same weight, so a long one does not outweigh the others."""
    x = _with_neighbours(lines.features, lines.offsets).astype(float)
    counts = np.diff(lines.offsets)
    row = np.repeat(np.arange(len(counts)), counts)
    y = label[row].astype(float)
    weight = 1 / np.maximum(counts, 1)[row]
    docs = max(int((counts > 0).sum()), 1)
    inner = np.ones(len(row), bool)
    inner[lines.offsets[:-1][counts > 0]] = False
    seen = np.zeros((2, 2))
    for a in (0, 1):
        seen[a, a] = weight[inner & (y == a)].sum()
    theta = np.zeros(x.shape[1] + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for k in range(1, rounds + 1):
        w, steps = theta[:-4], theta[-4:].reshape(2, 2)
        good, pairs = _marginals(x @ w, lines.offsets, steps)
        slope = np.concatenate([x.T @ ((y - good) * weight), (seen - pairs).ravel()]) / docs - decay * theta
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        theta = theta + rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    field = Field(theta[:-4], theta[-4:].reshape(2, 2))
    good, _ = _marginals(x @ field.weights, lines.offsets, field.steps)
    z = _logit(_aggregate(good, lines))
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton steps of the logistic curve, with a weak prior
        p = 1 / (1 + np.exp(-(a * z + b)))
        s = p * (1 - p)
        grad = np.array([((label - p) * z).sum() - (a - 1), (label - p).sum() - b])
        hess = np.array([[(s * z * z).sum() + 1, (s * z).sum()], [(s * z).sum(), s.sum() + 1]])
        step = np.linalg.solve(hess, grad)
        a, b = a + np.clip(step[0], -1, 1), b + np.clip(step[1], -1, 1)
    field.slope, field.shift = max(float(a), 1e-3), float(b)
    return field


def score_texts(texts: pa.Array, field: Field) -> np.ndarray:
    lines = line_features(texts)
    x = _with_neighbours(lines.features, lines.offsets)
    good, _ = _marginals(x @ field.weights, lines.offsets, field.steps)
    z = _logit(_aggregate(good, lines))
    return 1 / (1 + np.exp(-(field.slope * z + field.shift)))


def _held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, limit: int = TRAINING_DOCS) -> Field:
    """The field fitted on at most ``limit`` labelled documents outside the held-out fold,
    picked by a hash of their id. Their line features, not their texts, reach the driver."""
    known = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~_held_out())
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
    )
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(known), "doc_id")

    def make(batches):
        for batch in batches:
            for i, j in chunks(batch.column(0)):
                lines = line_features(batch.column(0)[i:j])
                cut = lines.offsets
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lines.features[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary()),
                        pa.array([lines.size[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary()),
                        batch.column(1)[i:j],
                        batch.column(2)[i:j],
                    ],
                    ["features", "size", "quality", "doc_id"],
                )

    schema = "features binary, size binary, quality int, doc_id bigint"
    # Several rows of one id are versions of one document; the sample keeps its bound.
    got = rows.select("text", "quality", "doc_id").mapInArrow(make, schema).dropDuplicates(["doc_id"]).collect()
    got.sort(key=lambda r: r.doc_id)
    features = [np.frombuffer(r.features, np.float32).reshape(-1, N_FEATURES) for r in got]
    lines = Lines(
        np.concatenate([np.zeros((0, N_FEATURES), np.float32), *features]),
        np.concatenate([[0], np.cumsum([len(f) for f in features])]).astype(np.int64),
        np.concatenate([np.zeros(0), *(np.frombuffer(r.size, float) for r in got)]),
    )
    return fit(lines, np.array([r.quality for r in got], float))


def score_quality(
    docs: DataFrame, labels: DataFrame, limit: int = TRAINING_DOCS, threshold: float = THRESHOLD, keep: bool = False
) -> DataFrame:
    """(doc_id, text), (doc_id, quality) -> (doc_id, held_out, score, predicted), one row per row.

    ``score`` is the probability of quality 1 and ``predicted`` is 1 from ``threshold`` on.
    Only labelled rows whose crc32(doc_id) mod 5 is not 0 are learned from. Null and empty
    texts have no lines and get the score of even odds; a null id is not held out. Without
    any label all scores follow from the prior alone. With ``keep``, the columns of ``docs``
    come first; columns of these names in it are replaced.
    """
    field = train(docs, labels, limit)
    names = [c for c in docs.columns if c not in ("held_out", "score", "predicted")]
    given = docs.select(*[F.col(f"`{c}`") for c in names]) if keep else docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text"
    )

    def make(batches):
        for batch in batches:
            texts = batch.column(batch.schema.names.index("text"))
            for i, j in chunks(texts, SMALL_CHUNK_BYTES):
                part = batch.slice(i, j - i)
                held = part.columns if keep else [part.column(0)]
                labels = part.schema.names if keep else ["doc_id"]
                yield pa.RecordBatch.from_arrays(
                    [*held, pa.array(score_texts(texts[i:j], field))], [*labels, "score"]
                )

    held = given.schema.fields if keep else given.schema.fields[:1]
    schema = T.StructType([*held, T.StructField("score", T.DoubleType())])
    scored = given.mapInArrow(make, schema)
    kept = names if keep else ["doc_id"]
    return scored.select(
        *[F.col(f"`{c}`") for c in kept],
        _held_out().alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
