"""Helpers the corpus operators share: words, word hashes, tables written between jobs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.session import scratch_dir

# A word is a run of characters other than space and U+0009 to U+000D.
GAP = r"[ \t-\r]+"
WORD = r"[^ \t-\r]+"


def word_count(text: str | Column) -> Column:
    """Words of a text as a long; a null text has none."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("long")


def word_array(text: str | Column) -> Column:
    """Words of a text in order; a null text has none."""
    column = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.coalesce(column, F.lit("")), GAP), "")


def written(frame: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back.

    Later jobs start from the files, so a lost executor costs no recomputation
    of what went before.
    """
    spark = frame.sparkSession
    path = scratch_dir(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


# --- word hashes over Arrow buffers -------------------------------------------------

_SEED = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _SEED.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
# Multiplier of the polynomial and its inverse modulo 2**64; any odd number would do.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_IS_GAP = np.zeros(256, dtype=bool)
_IS_GAP[[0x20, *range(0x09, 0x0E)]] = True


def _powers(base: np.uint64, count: int) -> np.ndarray:
    out = np.full(count, base, dtype=np.uint64)
    if count:
        out[0] = 1
    return np.multiply.accumulate(out)


class _PowerTable:
    """Powers of the multiplier and of its inverse, grown to the longest run seen."""

    def __init__(self) -> None:
        self.up = self.down = np.empty(0, dtype=np.uint64)

    def __reduce__(self):
        return type(self), ()  # tasks grow their own

    def reach(self, count: int) -> None:
        if count > len(self.up):
            size = 1 << int(count - 1).bit_length()
            self.up, self.down = _powers(_BASE, size), _powers(_INVERSE, size)


_POWERS = _PowerTable()
_BLOCK = 1 << 20


def mix(values: np.ndarray) -> np.ndarray:
    """Finalizer that spreads all bits of 64-bit values."""
    values = values ^ (values >> np.uint64(30))
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def word_hashes(text: bytes | None, lower: bool = False) -> np.ndarray:
    """64-bit hash of each word of a UTF-8 text, in order.

    `lower` maps A-Z to a-z first. The hash of a word depends on its bytes alone.
    """
    if not text:
        return np.empty(0, dtype=np.uint64)
    data = np.frombuffer(text, dtype=np.uint8)
    gap = _IS_GAP[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], gap, [True])).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    if lower:
        upper = (data >= 65) & (data <= 90)
        data = data + upper.astype(np.uint8) * np.uint8(32)
    _POWERS.reach(len(data) + 1)
    sums = np.empty(len(data) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[data] * _POWERS.up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _POWERS.down[starts] + (ends - starts).astype(np.uint64))


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of each run of `size` words, given the hashes of the words."""
    if len(words) < size:
        return np.empty(0, dtype=np.uint64)
    _POWERS.reach(len(words) + 1)
    sums = np.empty(len(words) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(words * _POWERS.up[: len(words)], out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * _POWERS.down[: len(words) - size + 1])


def text_bytes(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of each text of an Arrow column, null for null."""
    return column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()
