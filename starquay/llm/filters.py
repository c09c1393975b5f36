"""A one-probe Bloom filter of fixed size over a column of bigints.

It tells map tasks which rows cannot meet any row of another table, so that only
the rest is shuffled to an exact join. Its size is a parameter and does not grow
with the data; a filter that is too small lets more rows through and loses none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starquay.llm.words import mix

BITS = 23


def _spot(values: np.ndarray, bits: int) -> np.ndarray:
    return mix(values.view(np.uint64)) >> np.uint64(64 - bits)


def bloom(values: DataFrame, bits: int = BITS) -> np.ndarray:
    """The filter over the only column of ``values``, as 2^bits / 64 words. Tasks or
    their own rows first; at most that many words come to the driver."""

    def mark(batches):
        table = np.zeros(1 << (bits - 6), np.uint64)
        for batch in batches:
            spot = _spot(batch.column(0).drop_null().to_numpy(zero_copy_only=False), bits)
            np.bitwise_or.at(table, spot >> np.uint64(6), np.uint64(1) << (spot & np.uint64(63)))
        word = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays(
            [pa.array(word), pa.array(table[word].view(np.int64))], ["word", "value"]
        )

    marked = values.mapInArrow(mark, "word bigint, value bigint")
    table = np.zeros(1 << (bits - 6), np.int64)
    for word, value in marked.groupBy("word").agg(F.bit_or("value")).collect():
        table[word] = value
    return table


def maybe_in(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """False where a value is surely not among those that made ``table``."""
    bits = len(table).bit_length() - 1 + 6
    spot = _spot(values, bits)
    return (table.view(np.uint64)[spot >> np.uint64(6)] >> (spot & np.uint64(63))) & np.uint64(1) == 1
