"""Sums over the keys of items, where neither keys nor items fit one task.

Items (texts, words) hold keys (words, n-grams), and each key has values that
are known only after all items have been counted. Rows of (item, key) would be
many times the input, so items are taken in blocks: a block has one row for
each of its distinct keys, with the items that hold it as packed numbers. Key
rows meet the keys' values in a join on the key and go back to their block,
where sums are plain array arithmetic. A key that is in every block is a row a
block, which joins and sums split and combine like any others.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import bounded_batches

def packed(items: np.ndarray, keys: np.ndarray, n_keys: int, count_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(item, key) occurrences as ends of each key's list, and the lists: item and count in one number.

    A count that is too large for its ``count_bits`` is several entries.
    """
    pairs, counts = np.unique(keys.astype(np.int64) << 32 | items, return_counts=True)
    most = (1 << count_bits) - 1
    if len(counts) and counts.max() > most:
        pieces = -(-counts // most)
        pairs = np.repeat(pairs, pieces)
        last = np.cumsum(pieces) - 1
        split = np.full(len(pairs), most, dtype=np.int64)
        split[last] = counts - (pieces - 1) * most
        counts = split
    ends = np.searchsorted(pairs, np.arange(1, n_keys + 1, dtype=np.int64) << 32)
    entries = ((pairs & 0xFFFFFFFF) << count_bits | counts).astype(np.uint32)
    return ends, entries


def lists(ends: np.ndarray, entries: np.ndarray) -> pa.Array:
    """Packed lists as binary values."""
    offsets = np.concatenate([[0], ends * 4]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(entries)])


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All entries of a column of packed lists, and the length of each list."""
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = memoryview(data)[int(offsets[0]) : int(offsets[-1])] if data is not None else b""
    return np.frombuffer(raw, dtype=np.uint32), np.diff(offsets) // 4


def sums_by_item(
    rows: DataFrame, given: list[str], values: Callable[..., list[np.ndarray]], n_values: int, count_bits: int
) -> DataFrame:
    """Rows (block, n_items, items, entries and ``given``) as one row a block: items, and a list of sums for each value.

    ``values`` makes the values of key rows from the given columns. ``items`` is
    the block's own row, set where ``entries`` is null, and passes as it is; a
    sum is over all key rows of the block, value times count, for as many items
    as ``n_items`` says. Rows of a block are streamed.
    """
    bounded_batches(rows.sparkSession)
    names = [f"sums_{i}" for i in range(n_values)]
    schema = pa.schema([("items", pa.binary()), *((v, pa.list_(pa.float64())) for v in names)])
    columns = ["block", "n_items", "items", "entries", *given]

    def task(batches):
        block, items, sums = None, None, None

        def result():
            made = [pa.array([items], pa.binary()), *(pa.array([s], pa.list_(pa.float64())) for s in sums)]
            return pa.RecordBatch.from_arrays(made, schema=schema)

        for batch in batches:
            blocks = np.asarray(batch.column(0))
            cuts = [0, *(np.flatnonzero(blocks[1:] != blocks[:-1]) + 1).tolist(), len(blocks)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if block != blocks[a]:
                    if block is not None:
                        yield result()
                    # The block's own row sorts first.
                    block, items = blocks[a], part.column(2)[0].as_py()
                    sums = [np.zeros(part.column(1)[0].as_py()) for _ in names]
                    part = part.slice(1)
                entries, lengths = flat(part.column(3))
                at, counts = entries >> count_bits, (entries & (1 << count_bits) - 1).astype(np.float64)
                for s, column in zip(sums, values(*(np.asarray(c) for c in part.columns[4:]))):
                    s += np.bincount(at, np.repeat(column, lengths) * counts, len(s))
        if block is not None:
            yield result()

    together = rows.select(*columns).repartition("block").sortWithinPartitions("block", F.col("entries").isNotNull())
    kinds = ", ".join(f"{v} array<double>" for v in names)
    return together.mapInArrow(task, f"items binary, {kinds}")
