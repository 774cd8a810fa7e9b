"""A table of bounded size that tells which hashes were marked, and how early.

The table has `2 ** bits` bytes whatever the number of hashes, so it may be sent to every
task. Hashes that share a slot share the smallest of their marks: a lookup can report a mark for a
hash that has none, and never misses one that has. Who uses it checks what it lets through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EMPTY = 255
SEGMENT_BITS = 18


def slot_table(marks: DataFrame, bits: int) -> np.ndarray:
    """Smallest mark (0 to 254) of each slot, of rows `hash` (long) and `mark` (integer).

    Tasks build segments of the table; the driver receives at most `2 ** bits` bytes.
    """
    slots = marks.select(F.shiftrightunsigned("hash", 64 - bits).alias("slot"), "mark")
    least = slots.groupBy("slot").agg(F.min("mark").alias("mark"))
    width = min(bits, SEGMENT_BITS)
    parts = (
        least.withColumn("segment", F.shiftright("slot", width))
        .groupBy("segment")
        .applyInArrow(_segment(width), "segment long, bytes binary")
        .collect()
    )
    table = np.full(1 << bits, EMPTY, dtype=np.uint8)
    for part in parts:
        begin = part["segment"] << width
        table[begin : begin + (1 << width)] = np.frombuffer(part["bytes"], dtype=np.uint8)
    return table


def marks_of(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Mark of each hash, `EMPTY` for none."""
    bits = len(table).bit_length() - 1
    return table[(hashes >> np.uint64(64 - bits)).astype(np.int64)]


def _segment(width: int):
    def build(rows: pa.Table) -> pa.Table:
        slots = rows.column("slot").to_numpy() & ((1 << width) - 1)
        out = np.full(1 << width, EMPTY, dtype=np.uint8)
        out[slots] = rows.column("mark").to_numpy()
        return pa.table({"segment": rows.column("segment").slice(0, 1), "bytes": pa.array([out.tobytes()], pa.binary())})

    return build
