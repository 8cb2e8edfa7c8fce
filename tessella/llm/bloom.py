"""Bloom filters of fixed size: a checked bound for what is broadcast.

A filter has a set number of bits, whatever the keys; more keys only let more
rows through to the exact join that follows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import mix

BITS = 23  # 2**23 bits are 1 MB
HASHES = 3


def _places(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    """Bit numbers of 64-bit keys, one array a hash function."""
    return [mix(keys.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019 * (k + 1) % 2**64)) >> np.uint64(64 - bits) for k in range(HASHES)]


def build(keys: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """The filter of a column of longs. At most 2**bits / 32 words reach the driver."""

    def set_bits(frames):
        words = np.zeros(1 << (bits - 5), np.int64)
        for frame in frames:
            for at in _places(frame[column].to_numpy(np.int64), bits):
                np.bitwise_or.at(words, (at >> np.uint64(5)).astype(np.int64), np.int64(1) << (at & np.uint64(31)).astype(np.int64))
        full = np.flatnonzero(words)
        import pandas as pd

        yield pd.DataFrame({"word": full, "bits": words[full]})

    found = keys.select(column).mapInPandas(set_bits, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    words = np.zeros(1 << (bits - 5), np.uint32)
    words[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).astype(np.uint32)
    return words


def may_have(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    bits = int(len(words)).bit_length() + 4
    out = np.ones(len(keys), bool)
    for at in _places(keys, bits):
        out &= (words[(at >> np.uint64(5)).astype(np.int64)] >> (at & np.uint64(31)).astype(np.uint32)) & np.uint32(1) != 0
    return out
