"""Harmonic packing of token sequences.

A piece of length in (C/(k+1), C/k] belongs to class k, and a sequence of that
class takes exactly k pieces, whatever their exact lengths. Classes never look
at one another and neither do workers, so each task packs its own documents in
one pass with at most one open sequence a class.

As documents may be cut, each one is cut so that its pieces fill their classes
well: whole sequences first, then the largest C//m not above the rest, down to
a tail that is so short that its class wastes little.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tidelog.llm.common import arrow_schema, bounded_batches, ddl
from tidelog.llm.tokens import shipped, words_of

CAPACITY = 1024
END_ID = 0
#: A rest is left whole once its class wastes no more than this share of a sequence.
WASTE = 1 / 32

#: Sequence numbers of a task start at its partition number times this.
TASK_SEQUENCES = 1 << 40

PIECES = {
    "doc_id": "long",
    "start": "long",
    "length": "long",
    "ids_crc32": "long",
    "doc_tokens": "long",
    "sequence_id": "long",
    "offset": "long",
}


def cuts(n: int, capacity: int, waste: float = WASTE) -> list[int]:
    """Lengths of the pieces of ``n`` tokens, in order."""
    pieces = [capacity] * (n // capacity)
    rest = n % capacity
    while rest:
        fits = capacity // rest
        take = rest if capacity - fits * rest <= waste * capacity else capacity // -(-capacity // rest)
        pieces.append(take)
        rest -= take
    return pieces


class Packer:
    """Open sequences of one task; a piece is (doc_id, ids, start, length, doc_tokens)."""

    def __init__(self, capacity: int, first: int):
        self.capacity, self.sequence = capacity, first
        self.open: dict[int, list[tuple]] = {}
        self.done: list[tuple] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        total, start = len(ids) // 4, 0
        for length in cuts(total, self.capacity):
            size = self.capacity // length
            pieces = self.open.setdefault(size, [])
            pieces.append((doc_id, ids[4 * start : 4 * (start + length)], start, length, total))
            start += length
            if len(pieces) == size:
                self.close(self.open.pop(size))

    def close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, ids, start, length, total in pieces:
            self.done.append((doc_id, start, length, zlib.crc32(ids), total, self.sequence, offset, ids))
            offset += length
        self.sequence += 1

    def finish(self) -> None:
        """What is still open, class by class, cut into full sequences and a last one."""
        room, pieces = self.capacity, []
        for size in sorted(self.open):
            for doc_id, ids, start, length, total in self.open[size]:
                while length:
                    take = min(length, room)
                    pieces.append((doc_id, ids[: 4 * take], start, take, total))
                    ids, start, length, room = ids[4 * take :], start + take, length - take, room - take
                    if not room:
                        self.close(pieces)
                        room, pieces = self.capacity, []
        if pieces:
            self.close(pieces)
        self.open.clear()


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = True
) -> DataFrame:
    """Pieces of all documents with their places in sequences of at most ``capacity`` tokens.

    ``tokenizer`` is the path of a tokenizers file. Each document is its ids
    and ``end_id``; a null or empty text is the end alone. Every id lies in one
    piece; repeated rows and null ids are documents of their own. With
    ``with_ids`` the piece's ids follow as little-endian 32-bit numbers. Other
    columns are not carried. A sequence's numbers follow from the partition
    and its rows, so a task that runs again gives the same.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    spark = bounded_batches(docs.sparkSession)
    source = shipped(spark, tokenizer)
    columns = PIECES | ({"ids": "binary"} if with_ids else {})
    schema, end = arrow_schema(columns), end_id.to_bytes(4, "little")

    def task(batches):
        words = words_of(source)
        packer = Packer(capacity, TaskContext.get().partitionId() * TASK_SEQUENCES)

        def batch():
            rows, packer.done = packer.done, []
            made = [[r[i] for r in rows] for i in range(len(schema))]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(made, schema)], schema=schema)

        for rows in batches:
            for doc_id, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                packer.add(doc_id, words.text(text) + end)
            yield batch()
        packer.finish()
        yield batch()

    return docs.select("doc_id", "text").mapInArrow(task, ddl(columns))
