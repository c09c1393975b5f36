"""Words of a batch of texts as numpy arrays.

Words are maximal runs of bytes other than space, tab, newline, vertical tab, form
feed and carriage return; A-Z are folded to a-z. All of a chunk of texts is cut and
hashed at once: a word's 64-bit hash is a difference of prefix sums of a polynomial
in an odd base modulo 2^64, so it depends on the word's bytes alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
# For what keeps many numbers per byte and whose result does not depend on the cut.
SMALL_CHUNK_BYTES = 1 << 18

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over all bits."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=_U))
_powers: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(n, base, _U)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=_U)
    return _powers


@dataclass
class Words:
    """``row``: index of the text; ``start``, ``end``: bytes in ``data``."""

    data: np.ndarray
    offsets: np.ndarray
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` bytes; a longer text is a range of its own."""
    sizes = np.nan_to_num(
        pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(float)
    )
    first, held = 0, 0.0
    for i, size in enumerate(sizes):
        if i > first and held + size > limit:
            yield first, i
            first, held = i, 0.0
        held += size
    if first < len(texts):
        yield first, len(texts)


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and the offset of each; null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[
        texts.offset : texts.offset + len(texts) + 1
    ]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of the maximal runs of ``mask`` that stay in one text."""
    if not len(mask):
        return (np.zeros(0, np.int64),) * 3
    border = np.zeros(len(mask) + 1, bool)
    border[offsets] = True
    before = np.empty_like(mask)
    before[0], before[1:] = False, mask[:-1]
    start = np.flatnonzero(mask & (~before | border[:-1]))
    after = np.empty_like(mask)
    after[-1], after[:-1] = False, mask[1:]
    end = np.flatnonzero(mask & (~after | border[1:])) + 1
    return np.searchsorted(offsets, start, "right") - 1, start, end


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each range of ``data``."""
    power, inverse = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, _U)
    held = sums[1:]
    np.take(_BYTE, data, out=held, mode="clip")
    held *= power[: len(data)]
    np.cumsum(held, out=held)
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(_U))


def words(texts: pa.Array) -> Words:
    data, offsets = raw_bytes(texts)
    data = FOLD[data]
    row, start, end = runs(~_SPACE[data], offsets)
    return Words(data, offsets, row, start, end, hashes(data, start, end))


def windows(
    values: np.ndarray, row: np.ndarray, size: int, lead: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every window of ``size`` values of one row, and the first's index. ``lead``
    replaces the first value of each window."""
    n = len(values) - size + 1
    if n <= 0:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    total = np.zeros(n, _U)
    for i in range(size):
        total = mix(total * _U(3) + (values if i or lead is None else lead)[i : i + n])
    first = np.flatnonzero(row[:n] == row[size - 1 :])
    return total[first], first


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, text after text, and the offsets.

    A text with fewer than ``size`` words has its whole sequence as one shingle;
    one without words has none.
    """
    found = words(texts)
    count = np.bincount(found.row, minlength=len(texts))
    value, first = windows(found.hash, found.row, size)
    row = found.row[first]
    begin = np.concatenate([[0], np.cumsum(count)])
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        whole = np.zeros(len(short), _U)
        for i in range(size - 1):
            has = count[short] > i
            at = np.minimum(begin[short] + i, len(found.hash) - 1)
            whole = np.where(has, mix(whole * _U(3) + found.hash[at]), whole)
        value, row = np.concatenate([value, mix(whole + _U(1))]), np.concatenate([row, short])
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    value, row = value[new], row[new]
    return value, np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(texts)))])


def list_array(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Arrow lists of bigints."""
    return pa.ListArray.from_arrays(
        pa.array(offsets.astype(np.int32)), pa.array(values.view(np.int64))
    )
