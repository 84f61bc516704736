"""Rows cut into chunks of an exact size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidelog.model import DEFAULT_MAX_ROWS
from tidelog.session import broadcast_if_small, stage

_BITS = 33  # monotonically_increasing_id keeps the row number of a partition in its low 33 bits


def row_chunks(
    df: DataFrame,
    table: Sequence[str],
    order: Sequence[str],
    max_rows: int = DEFAULT_MAX_ROWS,
    partitions: int | None = None,
) -> DataFrame:
    """Add ``row_no`` and ``chunk_id`` (both from 0): exactly ``max_rows`` rows a chunk, the last one short.

    Rows are range-partitioned by table and order, so a hot table spreads over
    many tasks. The numbered partitions are staged once; the row counts of the
    partitions, a small table, then give every row its place.
    """
    size = max_rows if max_rows > 0 else DEFAULT_MAX_ROWS
    keys = [*table, *order]
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    placed = stage(
        ranged.sortWithinPartitions(*keys)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_id", _BITS))
        .withColumn("_idx", F.col("_id").bitwiseAND(F.lit((1 << _BITS) - 1)))
        .drop("_id"),
        "chunks",
    )
    parts = placed.groupBy(*table, "_part").agg(F.count("*").alias("_rows"), F.min("_idx").alias("_first"))
    before = W.partitionBy(*table).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = parts.select(
        *table, "_part", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_offset")
    )
    # At most one row per partition and table start.
    offsets, _ = broadcast_if_small(offsets)
    rows, starts = placed.alias("r"), offsets.alias("o")
    same = F.lit(True)
    for c in (*table, "_part"):
        same = same & F.col(f"r.{c}").eqNullSafe(F.col(f"o.{c}"))
    return (
        rows.join(starts, same)
        .select(*(F.col(f"r.`{c}`") for c in df.columns), (F.col("r._idx") + F.col("o._offset")).alias("row_no"))
        .withColumn("chunk_id", F.expr(f"row_no div {size}"))
    )


def chunk_totals(chunks: DataFrame, table: Sequence[str]) -> DataFrame:
    """Rows per chunk."""
    return chunks.groupBy(*table, "chunk_id").agg(F.count("*").alias("n_rows"))


def batch_write_stats(totals: DataFrame, table: Sequence[str] = ()) -> DataFrame:
    """Batches written, rows written and the mean batch size."""
    return totals.groupBy(*table).agg(
        F.count("*").alias("batches_written"),
        F.sum("n_rows").alias("rows_written"),
        (F.sum("n_rows").cast("double") / F.count("*")).alias("average_batch_size"),
    )
