"""A filter of fixed greatest size for 64-bit keys, to leave rows out before a shuffle.

One bit per key hash. A key that was put in is always found; others are found at times, at most
all of them. So the filter never changes a result, and what is sent to the tasks has a bound
(``MAX_BITS``) whatever the number of keys: with more keys it only lets more rows through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.text import mix

MAX_BITS = 1 << 27  # 16 MB
_BITS_PER_KEY = 32


def _places(keys: np.ndarray, bits: int) -> np.ndarray:
    return (mix(keys.view(np.uint64)) >> np.uint64(64 - (bits.bit_length() - 1))).astype(np.int64)


def keys_of(digests: list[bytes]) -> np.ndarray:
    """64-bit keys of binary values."""
    return np.array([int.from_bytes(d[:8], "little") for d in digests], np.uint64)


class Filter:
    def __init__(self, broadcast, bits: int):
        self.broadcast, self.bits = broadcast, bits

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Whether each 64-bit key may have been put in."""
        if self.broadcast is None:
            return np.zeros(len(keys), bool)
        places = _places(keys, self.bits)
        table = self.broadcast.value
        return (table[places >> 3] >> (places & 7).astype(np.uint8)) & np.uint8(1) == 1


def build(keys: DataFrame, column: str, n_keys: int | None = None) -> Filter:
    """Filter over a bigint or binary column; the bits of all tasks are united by ``bit_or``."""
    n = keys.count() if n_keys is None else n_keys
    if not n:
        return Filter(None, 8)
    bits = 1 << 16
    while bits < min(MAX_BITS, n * _BITS_PER_KEY):
        bits *= 2

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(bits >> 3, np.uint8)
        for batch in batches:
            values = batch.column(0).drop_null()
            binary = pa.types.is_binary(values.type)
            values = keys_of(values.to_pylist()) if binary else values.to_numpy(zero_copy_only=False)
            places = _places(values, bits)
            np.bitwise_or.at(table, places >> 3, np.left_shift(np.uint8(1), (places & 7).astype(np.uint8)))
        words = table.view(np.int64)
        used = np.flatnonzero(words)
        for at in range(0, len(used), 100_000):
            part = used[at : at + 100_000]
            yield pa.record_batch([pa.array(part, pa.int64()), pa.array(words[part])], names=["word", "bits"])

    found = (
        keys.select(column).mapInArrow(work, "word bigint, bits bigint")
        .groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    )
    table = np.zeros(bits >> 6, np.int64)
    table[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return Filter(keys.sparkSession.sparkContext.broadcast(table.view(np.uint8)), bits)
