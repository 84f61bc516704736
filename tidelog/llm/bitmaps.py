"""Bitmaps of hashes, of a fixed size: what tasks are told of a set that may be of any size.

A bitmap never misses an element and seldom holds another, so it may only spare
work that an exact step behind it would throw away.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import arrow_schema, bounded_batches, ddl

#: Bits of a bitmap (16 MB), and of a slice of it, which one task makes.
BITS = 1 << 27
SLICE_BITS = 1 << 19

_SLICES = {"slice": "int", "bits": "binary"}


def bitmap(hashes: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """The bitmap of a column of 64-bit hashes, put together from its slices."""
    spark = bounded_batches(hashes.sparkSession)
    width = min(SLICE_BITS, bits)
    place = F.pmod(F.col(column), F.lit(bits))
    rows = hashes.select((place / width).cast("int").alias("slice"), (place % width).cast("int").alias("bit")).distinct()

    def pack(batches):
        number, own = None, np.zeros(width // 8, dtype=np.uint8)

        def done():
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int32()), pa.array([own.tobytes()], pa.binary())], schema=arrow_schema(_SLICES)
            )

        for batch in batches:
            slices, places = (np.asarray(c) for c in batch.columns)
            for s in np.unique(slices).tolist():
                if s != number:
                    if number is not None:
                        yield done()
                    number, own = s, np.zeros(width // 8, dtype=np.uint8)
                at = places[slices == s]
                np.bitwise_or.at(own, at >> 3, (1 << (at & 7)).astype(np.uint8))
        if number is not None:
            yield done()

    out = np.zeros(bits // 8, dtype=np.uint8)
    made = rows.repartition("slice").sortWithinPartitions("slice").mapInArrow(pack, ddl(_SLICES)).toArrow()
    # One row a slice: together as large as the bitmap.
    for s, own in zip(*(c.to_pylist() for c in made.columns)):
        out[s * width // 8 : (s + 1) * width // 8] |= np.frombuffer(own, dtype=np.uint8)
    return out


def holds(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes (signed 64-bit) may be in the bitmap's set."""
    at = hashes % np.int64(len(bits) * 8)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
