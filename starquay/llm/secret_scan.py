"""Secret scan: fixed patterns, and a character convolutional network over candidates.

Candidates are all runs of token characters long enough for a pattern, and the matches that
fail a length. The network reads every candidate, a long one in overlapping windows, with 24
bytes on either side, and six numbers on it. Windows overlap and their layer is local, so the
convolutions are those of the text, taken once per byte, and a window adds what is other at
its borders. It is trained on labelled findings; without any, on those that the patterns make: values that
match are findings, once with their keyword blanked out and once in the surroundings of
another candidate, so that a key is known without a keyword. Runs that are words or
numbers, or that recur in several surroundings, are no findings. All others, above all bare
keys, have no label and teach nothing.
The threshold keeps a stated recall on a calibration part. What the network finds is
added to what the patterns find, which always stays.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starquay.llm.words import SMALL_CHUNK_BYTES, chunks, hashes, mix, raw_bytes, runs
from starquay.staging import stage

# The patterns of the base findings. The third is a run of small hex digits.
ASSIGN = re.compile(
    rb"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 6, 20, 24
KINDS = ("assign", "access", "hex", "model")

CONTEXT = 24
BODY = 48
STRIDE = 24  # of the windows over a longer candidate
MIN_CANDIDATE = 6
TRAINING_CANDIDATES = 6000
# Runs without a label that a chunk of texts offers to the training.
OFFERED = 256
SHORTEST = 16
NAME_PLACES = 3
MIN_RECALL = 0.99
GATE_RECALL = 0.999

_TOKEN = np.zeros(256, bool)
_TOKEN[[ord(c) for c in "+/_=.-"]] = True
for _low, _high in ((48, 58), (65, 91), (97, 123)):
    _TOKEN[_low:_high] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True

# Classes of bytes as the network sees them: single ASCII characters, and all others.
_CLASSES = 98
_CLASS = np.full(256, 97, np.int64)
_CLASS[32:127] = np.arange(1, 96)
_CLASS[[9, 10, 13]] = 96


_WIDTH = CONTEXT + BODY + CONTEXT
_KERNEL = 5
_NUMBERS = 6


@dataclass
class Network:
    """``embed`` (classes, e); ``conv`` (5 * e, filters); ``out`` over the maxima of the body
    and of both contexts, the numbers and a constant. ``pairs``: how surprising one class of
    bytes is after another in words and numbers. ``gate``, ``least``: weights of the numbers
    alone, and what findings have by them at least; they tell nothing apart in a scan."""

    embed: np.ndarray
    conv: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    pairs: np.ndarray
    gate: np.ndarray
    least: float = np.inf
    threshold: float = 1.1
    slope: float = 1.0
    shift: float = 0.0


def _kinds(data: np.ndarray) -> np.ndarray:
    """1 small letter, 2 capital, 3 digit, 4 any other token character, 0 the rest."""
    return _KIND[data]


_KIND = np.zeros(256, np.int8)
_KIND[_TOKEN] = 4
_KIND[97:123], _KIND[65:91], _KIND[48:58] = 1, 2, 3


def _before(mask: np.ndarray) -> np.ndarray:
    """How many are set before each place, and in all."""
    sums = np.zeros(len(mask) + 1, np.int32 if len(mask) < 1 << 31 else np.int64)
    np.cumsum(mask, dtype=sums.dtype, out=sums[1:])
    return sums


class _Sums:
    """Counts over any range of some bytes: of digits, capitals, symbols, changes between them,
    and of how surprising each byte is after the one before."""

    def __init__(self, data: np.ndarray, pairs: np.ndarray | None):
        kind = _kinds(data)
        change = np.zeros(len(data), bool)
        change[1:] = kind[1:] != kind[:-1]
        # A capital before small letters is how words begin.
        change[1:] &= ~((kind[1:] == 1) & (kind[:-1] == 2))
        self.of = [_before(mask) for mask in (kind == 3, kind == 2, kind == 4, change)]
        self.surprise = np.zeros(len(data) + 1)
        if pairs is not None and len(data):
            classes = _CLASS[data]
            self.surprise[2:] = pairs[classes[:-1], classes[1:]]
            np.cumsum(self.surprise, out=self.surprise)

    def numbers(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        size = (end - start).astype(float)
        digits, capitals, symbols, _ = (c[end] - c[start] for c in self.of)
        inner = np.minimum(start + 1, end)
        changes = self.of[3][end] - self.of[3][inner]
        surprise = self.surprise[end] - self.surprise[inner]
        parts = [np.log(size) * 0.5 - 1, digits / size, capitals / size, symbols / size, changes / size, surprise / size]
        return np.stack(parts, 1)


def _windows(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(candidate, start, end) of the windows over each candidate."""
    size = end - start
    count = 1 + np.maximum(0, -(-(size - BODY) // STRIDE))
    of = np.repeat(np.arange(len(start)), count)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    high = np.minimum(start[of] + nth * STRIDE + BODY, end[of])
    low = np.maximum(high - BODY, start[of])
    return of, low, high


def _inputs(data: np.ndarray, low: np.ndarray, high: np.ndarray, start: np.ndarray, end: np.ndarray, blank=None):
    """Classes (n, width) of windows and what surrounds them. ``low``, ``high`` bound the text;
    bytes from ``blank`` up to the window are not shown."""
    at = np.arange(BODY)[None, :]
    body = start[:, None] + at
    valid = body < end[:, None]
    side = np.arange(CONTEXT)[None, :]
    left, right = start[:, None] - CONTEXT + side, end[:, None] + side
    seen = left >= low[:, None]
    if blank is not None:
        seen &= left < blank[:, None]
    spots = np.concatenate([left, body, right], axis=1)
    inside = np.concatenate([seen, valid, right < high[:, None]], axis=1)
    return np.where(inside, _CLASS[data[np.clip(spots, 0, len(data) - 1)]], 0)


def _forward(net: Network, classes: np.ndarray, numbers: np.ndarray):
    shown = net.embed[classes]
    padded = np.pad(shown, ((0, 0), (_KERNEL // 2, _KERNEL // 2), (0, 0)))
    patches = np.concatenate([padded[:, k : k + _WIDTH] for k in range(_KERNEL)], axis=2)
    act = np.maximum(patches @ net.conv + net.bias, 0)
    cuts = ((0, CONTEXT), (CONTEXT, CONTEXT + BODY), (CONTEXT + BODY, _WIDTH))
    tops = [act[:, a:b].argmax(axis=1) + a for a, b in cuts]
    pooled = [np.take_along_axis(act, t[:, None, :], 1)[:, 0] for t in tops]
    features = np.concatenate([*pooled, numbers, np.ones((len(numbers), 1))], axis=1)
    return features, tops, patches, act


def probability(net: Network, classes: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Calibrated probability of each candidate."""
    out = np.zeros(len(numbers))
    for i in range(0, len(numbers), 512):
        features, *_ = _forward(net, classes[i : i + 512], numbers[i : i + 512])
        out[i : i + 512] = features @ net.out
    return 1 / (1 + np.exp(-np.clip(net.slope * out + net.shift, -50, 50)))


# Bytes of text that are convolved at once, and what a window needs beyond its body.
BLOCK = 1 << 13
_BESIDE = CONTEXT + _KERNEL // 2


def _tops(wide: dict[int, np.ndarray], first: np.ndarray, size: int | np.ndarray) -> np.ndarray:
    """Maxima of the rows [first, first + size); ``wide`` holds those of all ranges of 1, 2, 4 ..
    rows."""
    if isinstance(size, int):
        power = 1 << (size.bit_length() - 1)
        return np.maximum(wide[power].take(first, 0), wide[power].take(first + size - power, 0))
    out = np.empty((len(first), wide[1].shape[1]), wide[1].dtype)
    power = np.frexp(size)[1] - 1
    for p in np.flatnonzero(np.bincount(power)).tolist():
        at = np.flatnonzero(power == p)
        out[at] = np.maximum(wide[1 << p].take(first[at], 0), wide[1 << p].take(first[at] + size[at] - (1 << p), 0))
    return out


def logits(net: Network, found: Found, row: np.ndarray, low: np.ndarray, high: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """What ``_forward`` gives for the windows [low, high) of texts, at least ``_KERNEL`` bytes
    each, times ``net.out``.

    A window's classes are those of the text up to its borders, and nothing beyond them and
    between a short body and what follows it. Away from these its convolutions are those of the
    text. Near them a place lacks one or two of its neighbours, on either side.
    """
    out = np.empty(len(row))
    body = high - low
    # Less room than a kernel between the body and what follows: as they stand.
    odd = np.flatnonzero((body > BODY - _KERNEL + 1) & (body < BODY))
    for i in range(0, len(odd), 512):
        part = odd[i : i + 512]
        classes = _inputs(found.data, found.offsets[row[part]], found.offsets[row[part] + 1], low[part], high[part])
        out[part] = _forward(net, classes, numbers[part])[0] @ net.out
    # All texts with nothing between them, so their ends need no care.
    sizes = np.diff(found.offsets)
    classes = np.zeros(len(found.data) + (len(sizes) + 1) * _BESIDE, np.uint8)
    classes[np.arange(len(found.data)) + np.repeat(np.arange(1, len(sizes) + 1) * _BESIDE, sizes)] = _CLASS[found.data]
    filters = len(net.bias)
    table = (net.embed @ net.conv.reshape(_KERNEL, -1, filters)).astype(np.float32)
    bias = net.bias.astype(np.float32)
    # By the byte two before, one before, and so on.
    a, b, c, d, e = table[0], table[1], bias + table[2], table[3], table[4]
    rest = np.concatenate([numbers, np.ones((len(numbers), 1))], axis=1) @ net.out[3 * filters :]
    weight = net.out[: 3 * filters].astype(np.float32)
    start = low + (row + 1) * _BESIDE
    whole = np.flatnonzero((body <= BODY - _KERNEL + 1) | (body == BODY))
    whole = whole[np.argsort(start[whole], kind="stable")]
    cuts = np.searchsorted(start[whole], np.arange(0, len(classes) + BLOCK, BLOCK))
    length = BLOCK + 2 * _BESIDE + BODY
    shown = np.empty(length, np.intp)
    part = np.empty((length - _KERNEL + 1, filters), np.float32)
    wide = {p: np.zeros((length - p + 1, filters), np.float32) for p in (1, 2, 4, 8, 16, 32)}
    act = wide[1]  # its ends, which lack neighbours, are in no window

    def summed(*parts: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        (of, to), *more = parts
        total = of.take(to, 0)
        for of, to in more:
            total += of.take(to, 0)
        return total

    for n in np.flatnonzero(np.diff(cuts)):
        at = whole[cuts[n] : cuts[n + 1]]
        begin = n * BLOCK - _BESIDE
        there = classes[max(begin, 0) : begin + length]
        shown[:] = 0
        shown[max(-begin, 0) : max(-begin, 0) + len(there)] = there
        inside = act[2:-2]
        np.take(c, shown[2:-2], 0, inside, "clip")
        for of, to in ((d, shown[3:-1]), (e, shown[4:]), (b, shown[1:-3]), (a, shown[:-4])):
            np.take(of, to, 0, part, "clip")
            inside += part
        for p in (1, 2, 4, 8, 16):
            np.maximum(wide[p][:-p], wide[p][p:], wide[2 * p])

        def opening(i: np.ndarray) -> np.ndarray:
            """The better of a place with nothing before it and of the next."""
            one, two, three, four = (shown[i + k] for k in range(4))
            here = summed((c, one), (d, two), (e, three))
            return np.maximum(here, summed((c, two), (d, three), (e, four), (b, one)), out=here)

        def closing(i: np.ndarray) -> np.ndarray:
            """The better of a place with nothing after it and of the one before."""
            one, two, three, four = (shown[i - k] for k in range(4))
            here = summed((c, one), (b, two), (a, three))
            return np.maximum(here, summed((c, two), (b, three), (a, four), (d, one)), out=here)

        s, size = start[at] - begin, body[at]
        end = s + size
        left = np.maximum(_tops(wide, s - CONTEXT + 2, CONTEXT - 2), opening(s - CONTEXT))
        short = np.flatnonzero(size < BODY)
        inner = _tops(wide, s, np.where(size < BODY, size - 2, size))
        # After a short body its first two places have nothing before them.
        right = _tops(wide, np.where(size < BODY, end + 2, end), CONTEXT - 4)
        right = np.maximum(right, closing(end + CONTEXT - 1))
        long = np.flatnonzero(size == BODY)
        right[long] = np.maximum(right[long], _tops(wide, end[long] + CONTEXT - 4, 2))
        f = end[short]
        right[short] = np.maximum(right[short], opening(f))
        # The end of a short body, and the room behind it, which sees two bytes on either side.
        one, two, after, second = shown[f - 1], shown[f - 2], shown[f], shown[f + 1]
        for room in (closing(f - 1), bias + a[two] + b[one], bias + a[one], bias + e[after], bias + d[after] + e[second]):
            inner[short] = np.maximum(inner[short], room)
        empty = short[size[short] <= BODY - _KERNEL]
        inner[empty] = np.maximum(inner[empty], bias)
        out[at] = np.maximum(np.concatenate([left, inner, right], axis=1), 0) @ weight + rest[at]
    return out


def _surprise(classes: np.ndarray) -> np.ndarray:
    """How surprising each class is after another inside the bodies of ``classes``, in nats,
    with one unseen count for each."""
    body = classes[:, CONTEXT : CONTEXT + BODY]
    counts = np.ones((_CLASSES, _CLASSES)) * 0.05
    one, two = body[:, :-1].ravel(), body[:, 1:].ravel()
    held = (one > 0) & (two > 0)
    np.add.at(counts, (one[held], two[held]), 1)
    return -np.log(counts / counts.sum(axis=1, keepdims=True))


def _numbers_of(classes: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """The numbers of windows, from their bodies."""
    body = classes[:, CONTEXT : CONTEXT + BODY]
    size = np.maximum((body > 0).sum(axis=1), 1)
    start = np.arange(len(body)) * BODY
    return _Sums(_BYTE[body].ravel(), pairs).numbers(start, start + size)


_BYTE = np.zeros(_CLASSES, np.uint8)
_BYTE[1:96] = np.arange(32, 127)
_BYTE[96], _BYTE[97] = 10, 200


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression with a constant, by Newton steps."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ ((p - y) * weight) + 1e-2 * w
        curve = (x * (p * (1 - p) * weight)[:, None]).T @ x + 1e-2 * np.eye(len(w))
        w = w - np.linalg.solve(curve, slope)
    return w


def _gate(net: Network, numbers: np.ndarray) -> np.ndarray:
    return numbers @ net.gate[:-1] + net.gate[-1]


def _elsewhere(classes: np.ndarray, label: np.ndarray, rng) -> np.ndarray:
    """The findings of ``classes`` in the surroundings of others that are none; every other one
    is cut to a random part of at least SHORTEST characters, and some stand inside a path."""
    bare = classes[label == 1].copy()
    other = classes[rng.choice(np.flatnonzero(label == 0), len(bare))]
    sides = np.r_[0:CONTEXT, CONTEXT + BODY : _WIDTH]
    bare[:, sides] = other[:, sides]
    body = bare[:, CONTEXT : CONTEXT + BODY]
    size = (body > 0).sum(axis=1)
    part = rng.integers(np.minimum(SHORTEST, size), size + 1)
    body[(np.arange(BODY) >= part[:, None]) & (rng.random(len(bare)) < 0.5)[:, None]] = 0
    words = other[rng.permutation(len(other))][:, CONTEXT : CONTEXT + BODY]
    for k in np.flatnonzero(rng.random(len(bare)) < 0.3):
        key, word, next_word = (row[row > 0] for row in (body[k], words[k], words[k - 1]))
        symbol = [_CLASS[rng.choice(np.frombuffer(b"-._/=", np.uint8))]]
        whole = np.concatenate([word[-rng.integers(1, 20) :], symbol, key[: max(SHORTEST, 28)], symbol, next_word])[:BODY]
        body[k] = 0
        body[k, : len(whole)] = whole
    return bare


def _compounds(classes: np.ndarray, label: np.ndarray, rng) -> np.ndarray:
    """Two runs that are no findings, with a small number and symbols between, as in names of
    files, hosts and versions: as many as there are runs, in the surroundings of the first."""
    found = classes[label == 0].copy()
    body = found[:, CONTEXT : CONTEXT + BODY]
    other = body[rng.permutation(len(body))]
    size = (body > 0).sum(axis=1)
    symbols = _CLASS[np.frombuffer(b"-._/", np.uint8)]
    for k in range(len(body)):
        number = _CLASS[rng.integers(48, 58, rng.integers(1, 5))]
        between = np.concatenate([rng.choice(symbols, rng.integers(0, 2)), number, rng.choice(symbols, rng.integers(0, 2))])
        whole = np.concatenate([body[k, : size[k]], between, other[k][other[k] > 0]])[:BODY]
        body[k] = 0
        body[k, : len(whole)] = whole
    return found


def fit(classes: np.ndarray, label: np.ndarray, min_recall: float = MIN_RECALL, seed: int = 11) -> Network:
    """Adam on the log loss of four fifths; the rest calibrates a logistic curve and the
    thresholds. Findings count as they are and in other surroundings, and the recall is that of
    the latter; runs that are none count as they are and joined by small numbers. Without
    both labels the network never fires."""
    rng = np.random.default_rng(seed)
    embed, filters = 8, 16
    net = Network(
        rng.normal(0, 0.3, (_CLASSES, embed)),
        rng.normal(0, 0.2, (_KERNEL * embed, filters)),
        np.zeros(filters),
        np.zeros(3 * filters + _NUMBERS + 1),
        np.zeros((_CLASSES, _CLASSES)),
        np.zeros(_NUMBERS + 1),
    )
    if len(label) < 20 or label.min() == label.max():
        return net
    net.embed[0] = 0
    held = rng.random(len(label)) < 0.2
    if not (label[held].any() and not label[held].all() and label[~held].any() and not label[~held].all()):
        held = np.arange(len(label)) % 5 == 0
    net.pairs = _surprise(classes[~held & (label == 0)])
    sets = []
    for part in (~held, held):
        bare, joined = (make(classes[part], label[part], rng) for make in (_elsewhere, _compounds))
        x = np.concatenate([classes[part], joined, bare])
        y = np.concatenate([label[part], np.zeros(len(joined)), np.ones(len(bare))])
        sets.append((x, _numbers_of(x, net.pairs), y, len(bare)))
    (classes, numbers, label, _), calibration = sets
    balance = np.where(label == 1, 0.5 / max(label.mean(), 1e-6), 0.5 / max(1 - label.mean(), 1e-6))
    net.gate = _logistic(numbers, label, balance)
    state = {k: [np.zeros_like(getattr(net, k))] * 2 for k in ("embed", "conv", "bias", "out")}
    for step in range(1, 401):
        pick = rng.choice(len(label), min(128, len(label)), replace=False)
        c, x, y = classes[pick], numbers[pick], label[pick]
        features, tops, patches, act = _forward(net, c, x)
        p = 1 / (1 + np.exp(-np.clip(features @ net.out, -50, 50)))
        error = (p - y) * np.minimum(balance[pick], 20) / len(pick)
        grads = {"out": features.T @ error + 1e-4 * net.out}
        back = np.zeros_like(act)
        for part, top in enumerate(tops):
            flow = error[:, None] * net.out[None, part * filters : (part + 1) * filters]
            np.put_along_axis(back, top[:, None, :], flow[:, None, :], 1)
        back *= act > 0
        grads["conv"] = np.tensordot(patches, back, ((0, 1), (0, 1)))
        grads["bias"] = back.sum(axis=(0, 1))
        into = back @ net.conv.T
        seen = np.zeros((len(pick), _WIDTH + _KERNEL - 1, embed))
        for k in range(_KERNEL):
            seen[:, k : k + _WIDTH] += into[:, :, k * embed : (k + 1) * embed]
        seen = seen[:, _KERNEL // 2 : _KERNEL // 2 + _WIDTH]
        grads["embed"] = np.zeros_like(net.embed)
        np.add.at(grads["embed"], c, seen)
        grads["embed"][0] = 0
        for k, g in grads.items():
            m = 0.9 * state[k][0] + 0.1 * g
            v = 0.99 * state[k][1] + 0.01 * g * g
            state[k] = [m, v]
            setattr(net, k, getattr(net, k) - 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8))
    classes, numbers, y, bare = calibration
    parts = np.array_split(np.arange(len(y)), max(1, len(y) // 512))
    z = np.concatenate([_forward(net, classes[i], numbers[i])[0] @ net.out for i in parts])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(net.slope * z + net.shift, -50, 50)))
        net.slope += np.clip(((y - p) * z).mean() * 2 - 0.01 * (net.slope - 1), -0.5, 0.5)
        net.shift += np.clip((y - p).mean() * 2, -0.5, 0.5)
    odds = net.slope * z + net.shift
    # The largest threshold that keeps the recall; where no other run comes near it, the one
    # halfway to them in log odds.
    good = np.sort(odds[len(y) - bare :])
    kept = good[int((1 - min_recall) * len(good))]
    most = odds[y == 0].max()
    net.threshold = 1 / (1 + np.exp(-np.clip(min(kept, (kept + most) / 2), -40, 40))) - 1e-12
    passed = np.sort(_gate(net, numbers[y == 1]))
    net.least = passed[int((1 - GATE_RECALL) * len(passed))] - 1.0
    return net


def base_findings(text: bytes) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """((start, kind, end) of the matches that pass, (start, end) of the failing ones of the
    first two kinds), in bytes."""
    passed, failed = [], []
    if b"=" in text or b":" in text:
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= ASSIGN_LENGTH:
                passed.append((m.start(), 0, m.end()))
            else:
                failed.append(m.span())
    if b"AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= ACCESS_LENGTH:
                passed.append((m.start(), 1, m.end()))
            else:
                failed.append(m.span())
    return passed, failed


_HEX_BYTE = np.zeros(256, bool)
_HEX_BYTE[[ord(c) for c in "0123456789abcdef"]] = True


@dataclass
class Found:
    """Base findings by row, and candidates (row, start, end), in bytes of ``data``. ``outside``:
    characters of a candidate outside the base findings. ``values``: (row, blank, start, end) of
    the values that base findings hold."""

    data: np.ndarray
    offsets: np.ndarray
    base: list[list[tuple[int, int, int]]]
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    outside: np.ndarray
    values: np.ndarray


def find(texts: pa.Array) -> Found:
    data, offsets = raw_bytes(texts)
    whole = data.tobytes()
    base: list[list[tuple[int, int, int]]] = []
    failed: list[tuple[int, int, int]] = []
    for k in range(len(texts)):
        passed, missed = base_findings(whole[offsets[k] : offsets[k + 1]])
        base.append([(a + offsets[k], kind, b + offsets[k]) for a, kind, b in passed])
        failed += [(k, a + offsets[k], b + offsets[k]) for a, b in missed]
    # Maximal runs of hex digits, all texts at once.
    row, start, end = runs(_HEX_BYTE[data], offsets)
    long = end - start >= HEX_LENGTH
    for k, a, b in zip(row[long].tolist(), start[long].tolist(), end[long].tolist()):
        base[k].append((a, 2, b))
    covered = np.zeros(len(data) + 1, np.int32)
    values = []
    for k, spans in enumerate(base):
        spans.sort()
        for a, kind, b in spans:
            covered[a] += 1
            covered[b] -= 1
            match = ASSIGN.match(whole, a, b) if kind == 0 else None
            values.append((k, a, match.start(2) if match else a, b))
    covered = _before(np.cumsum(covered, dtype=covered.dtype, out=covered)[:-1] > 0)
    row, start, end = runs(_TOKEN[data], offsets)
    wide = end - start >= MIN_CANDIDATE
    row, start, end = row[wide], start[wide], end[wide]
    if failed:
        more = np.array(failed, np.int64)
        row, start, end = (np.concatenate([x, more[:, i]]) for i, x in enumerate((row, start, end)))
    outside = end - start - (covered[end] - covered[start])
    return Found(data, offsets, base, row, start, end, outside, np.array(values, np.int64).reshape(-1, 4))


def ordinary(sums: _Sums, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """True for words, with or without a first capital, in parts or not, for what is all
    capitals, and for numbers: runs that are surely no key."""
    digits, capitals, symbols, _ = (c[end] - c[start] for c in sums.of)
    first = sums.of[1][np.minimum(start + 1, end)] - sums.of[1][start]
    small = end - start - digits - capitals - symbols
    words = (digits == 0) & ((capitals <= first + symbols) | (small == 0))
    return words | (capitals + small == 0)


def _labelled(docs: DataFrame, everything: bool) -> DataFrame:
    """(doc_id, start, end, label, classes, body) of windows: 1 for values that the patterns
    find, 0 for OFFERED words and numbers of each chunk, picked by hash, and NULL for as many of
    the other runs, or with ``everything`` all of them. ``body`` tells equal runs. Positions
    are code points."""

    def make(batches):
        for batch in batches:
            for i, j in chunks(batch.column(1)):
                found = find(batch.column(1)[i:j])
                if not len(found.row):
                    continue
                sums = _Sums(found.data, None)
                plain = ordinary(sums, found.start, found.end) & (found.outside == found.end - found.start)
                none = np.flatnonzero(plain)
                # Other words in every chunk, and each of them once.
                told = mix(hashes(found.data, found.start[none], found.end[none]) + np.uint64(len(found.data)))
                none = none[np.unique(told, return_index=True)[1][:OFFERED]]
                others = np.flatnonzero((found.outside == found.end - found.start) & ~plain)
                if not everything:  # the same runs in every chunk
                    told = hashes(found.data, found.start[others], found.end[others])
                    others = others[np.argsort(told, kind="stable")[:OFFERED]]
                parts = [found.values, *(np.stack([found.row[k], found.start[k], found.start[k], found.end[k]], 1) for k in (none, others))]
                row, blank, start, end = np.concatenate(parts).T
                same = hashes(found.data, start, end).view(np.int64)
                label = np.repeat(np.array([1.0, 0.0, np.nan]), [len(p) for p in parts])
                of, low, high = _windows(start, end)
                texts = found.offsets[row[of]], found.offsets[row[of] + 1]
                classes = _inputs(found.data, *texts, low, high, np.where(low == start[of], blank[of], low))
                lead = _before((found.data & 0xC0) != 0x80)
                first = lead[found.offsets[row[of]]]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[i:j].take(pa.array(row[of])),
                        pa.array(lead[low] - first, pa.int64()),
                        pa.array(lead[high] - first, pa.int64()),
                        pa.array(label[of], mask=np.isnan(label[of])).cast(pa.int32()),
                        pa.array([c.astype(np.uint8).tobytes() for c in classes], pa.binary()),
                        pa.array(same[of]),
                    ],
                    ["doc_id", "start", "end", "label", "classes", "body"],
                )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(make, "doc_id bigint, start bigint, end bigint, label int, classes binary, body bigint")


def train(docs: DataFrame, findings: DataFrame | None = None, limit: int = TRAINING_CANDIDATES) -> Network:
    """The network fitted on at most ``limit`` windows, half of either label, picked by
    a hash of their bytes. ``findings`` (doc_id, start, end, label), in code points, gives
    the labels of the candidates it overlaps."""
    offered = stage(_labelled(docs, everything=False).select("label", "classes", "body"), "offered")
    # A run that recurs in several surroundings is a name: of a host, a file, a product.
    names = (
        offered.where("label is null").groupBy("body")
        .agg(F.count_distinct("classes").alias("places"), F.min("classes").alias("classes"))
        .where(F.col("places") >= NAME_PLACES)
    )
    seen = offered.where("label is not null").select("label", "classes")
    seen = seen.unionByName(names.select(F.lit(0).alias("label"), "classes"))
    if findings is not None:
        told = findings.select(
            "doc_id", F.col("start").alias("from"), F.col("end").alias("to"), F.col("label").alias("told")
        )
        meets = (F.col("from") < F.col("end")) & (F.col("to") > F.col("start"))
        looked_at = docs.join(told.select("doc_id").distinct(), "doc_id", "left_semi")
        given = (
            _labelled(looked_at, everything=True).join(told, "doc_id")
            .groupBy("doc_id", "start", "end", "label", "classes")
            .agg(F.max(F.when(meets, F.col("told"))).alias("told"))
            .where("told is not null").select(F.col("told").cast("int").alias("label"), "classes")
        )
        seen = seen.unionByName(given)
    # Copies of a finding count once; what is a finding anywhere is one.
    distinct = stage(seen.groupBy("classes").agg(F.max("label").alias("label")), "labelled")
    order, half = F.xxhash64("classes"), limit // 2
    rows = []
    for label, count in distinct.groupBy("label").count().orderBy("label").collect():
        # Hashes are even, so the first ones are below a bound, which spares each task a list.
        bound = int((min(1.0, 4 * half / count) - 0.5) * 2**64) - (4 * half >= count)
        some = distinct.where((F.col("label") == label) & (order <= bound))
        rows += some.orderBy(order, "classes").limit(half).collect()
    classes = np.array([np.frombuffer(r.classes, np.uint8) for r in rows], np.int64).reshape(-1, _WIDTH)
    return fit(classes, np.array([r.label for r in rows], float))


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, kind, b in spans)


def scan(texts: pa.Array, net: Network) -> tuple[list[list[tuple[int, int, int]]], list[list[tuple[int, int, int]]]]:
    """Base and all spans (start, kind, end) by row, in code points. A candidate inside base
    spans adds nothing; one that goes beyond them is judged as a whole."""
    found = find(texts)
    lead = _before((found.data & 0xC0) != 0x80)
    first = lead[found.offsets]
    base = [[(int(lead[a] - first[k]), kind, int(lead[b] - first[k])) for a, kind, b in s] for k, s in enumerate(found.base)]
    spans = [list(s) for s in base]
    asked = np.flatnonzero(found.outside > 0)
    if len(asked) and net.threshold <= 1:
        row, start, end = found.row[asked], found.start[asked], found.end[asked]
        of, low, high = _windows(start, end)
        odds = net.slope * logits(net, found, row[of], low, high, _Sums(found.data, net.pairs).numbers(low, high)) + net.shift
        hit = np.zeros(len(asked), bool)
        hit[of[1 / (1 + np.exp(-np.clip(odds, -50, 50))) >= net.threshold]] = True
        for k, a, b in sorted(set(zip(row[hit].tolist(), start[hit].tolist(), end[hit].tolist()))):
            spans[k].append((int(lead[a] - first[k]), 3, int(lead[b] - first[k])))
    return base, [sorted(s) for s in spans]


def find_secrets(
    docs: DataFrame,
    findings: DataFrame | None = None,
    limit: int = TRAINING_CANDIDATES,
    learned: DataFrame | None = None,
) -> DataFrame:
    """(doc_id, text) -> (doc_id, n_assign, n_access, n_hex, base_sha256, spans), one row per row.

    Null and empty texts have no findings; the digest is then that of the empty string.
    Positions are code points. Base findings of different kinds may overlap; a kind's own
    do not. An empty table gives no rows. The network learns from ``learned``, documents that
    were looked through for ``findings``, or else from ``docs``.
    """
    net = train(docs if learned is None else learned, findings, limit)

    def make(batches):
        for batch in batches:
            for i, j in chunks(batch.column(1), SMALL_CHUNK_BYTES):
                base, spans = scan(batch.column(1)[i:j], net)
                counts = [[sum(kind == k for _, kind, _ in s) for s in base] for k in range(3)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[i:j],
                        *(pa.array(c, pa.int64()) for c in counts),
                        pa.array([hashlib.sha256(_joined(s).encode()).hexdigest() for s in base]),
                        pa.array([_joined(s) for s in spans], pa.string()),
                    ],
                    ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
                )

    schema = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(make, schema)


def mask_secrets(docs: DataFrame, mask: str = "[secret]", limit: int = TRAINING_CANDIDATES) -> DataFrame:
    """``docs`` with every finding in ``text`` replaced by ``mask``; overlapping findings
    become one mask. ``n_chars``, if there is one, follows; texts without findings, and all
    other columns, stay as they are."""
    net = train(docs, None, limit)
    at = docs.columns.index("text")
    sized = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def masked(text: str | None, spans: list[tuple[int, int, int]]) -> str | None:
        parts, done = [], 0
        for a, _, b in spans:
            if a >= done:
                parts += [text[done:a], mask]
            done = max(done, b)
        return "".join([*parts, text[done:]]) if spans else text

    def make(batches):
        for batch in batches:
            texts = batch.column(at)
            for i, j in chunks(texts, SMALL_CHUNK_BYTES):
                _, spans = scan(texts[i:j], net)
                columns = batch.slice(i, j - i).columns
                if any(spans):
                    new = [masked(t, s) for t, s in zip(texts[i:j].to_pylist(), spans)]
                    columns[at] = pa.array(new, texts.type)
                    if sized is not None:
                        old = columns[sized].to_pylist()
                        sizes = [len(t) if s else n for t, s, n in zip(new, spans, old)]
                        columns[sized] = pa.array(sizes, columns[sized].type)
                yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(make, T.StructType(docs.schema.fields))
