"""Token ids in ORC files.

One row a document in ascending order of ids: the document's place, its number
of tokens and its ids. ORC gives what such files need: integer run-length
encoding of the ids, an index with least and greatest doc_id every few thousand
rows, Bloom filters on doc_id for look-ups, and stripes that are read in
parallel. ``part`` and ``part_start`` are a document's place; a part's total is
found from two integer columns without reading ids.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.llm.common import arrow_schema, bounded_batches, ddl
from tidelog.llm.tokens import shipped, words_of

END_ID = 1

STORED = {"doc_id": "long", "part": "int", "part_start": "long", "n_tokens": "long", "ids": "array<int>"}

ORC_OPTIONS = {
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
    "orc.row.index.stride": "2000",
    "orc.stripe.size": str(16 << 20),
    "compression": "zstd",
}


def encoded(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """``docs`` in ascending doc_id order as the rows of the files.

    ``tokenizer`` is the path of a tokenizers file. Each document is its ids
    and ``end_id``; a null or empty text is the end alone. A null doc_id comes
    first; rows of one doc_id follow by the hash of their text, and a repeated
    row is a document of its own.
    """
    spark = bounded_batches(docs.sparkSession)
    source = shipped(spark, tokenizer)
    schema, end = arrow_schema(STORED), end_id.to_bytes(4, "little")

    def task(batches):
        words, part, start = words_of(source), TaskContext.get().partitionId(), 0
        for rows in batches:
            ids = [words.text(t) + end for t in rows.column(1).to_pylist()]
            ends = np.cumsum([0] + [len(i) // 4 for i in ids], dtype=np.int64)
            values = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))
            columns = [
                rows.column(0),
                pa.array(np.full(len(ids), part, dtype=np.int32)),
                pa.array(start + ends[:-1]),
                pa.array(np.diff(ends)),
                pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values),
            ]
            start += int(ends[-1])
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    order = [F.col("doc_id"), F.xxhash64("text")]
    rows = docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order)
    return rows.mapInArrow(task, ddl(STORED))


def write_token_files(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID) -> None:
    """Write all documents; an empty table leaves files without rows."""
    encoded(docs, tokenizer, end_id).write.options(**ORC_OPTIONS).orc(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, part, part_start, n_tokens, ids; a filter on doc_id skips stripes by index and Bloom filter."""
    return spark.read.schema(ddl(STORED)).orc(path)


def part_starts(stored: DataFrame) -> DataFrame:
    """part and base, the ids in all parts before it; a row a file reaches the window."""
    totals = stored.groupBy("part").agg(F.max(F.col("part_start") + F.col("n_tokens")).alias("part_tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("part_tokens").over(before), F.lit(0)).alias("base"))


def stored_digest(stored: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of the stored ids."""
    columns = {"doc_id": "long", "part": "int", "part_start": "long", "n_tokens": "long", "ids_crc32": "long"}
    schema = arrow_schema(columns)
    bounded_batches(stored.sparkSession)

    def task(batches):
        for rows in batches:
            lists = rows.column(4)
            ends = np.asarray(lists.offsets)
            raw = memoryview(np.ascontiguousarray(np.asarray(lists.values), dtype="<i4")).cast("B")
            sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            n_tokens = pa.array(np.diff(ends).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), rows.column(2), n_tokens, pa.array(sums, pa.int64())], schema=schema
            )

    digests = stored.select(*STORED).mapInArrow(task, ddl(columns))
    return digests.join(part_starts(stored), "part").select(
        "doc_id", (F.col("base") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32"
    )
