"""Backfill of one table in key ranges, with a ledger: it can stop anywhere and goes on with what is left.

The log position is saved before the first row is read and never again, so that
the log takes over from there however often the backfill is started anew. Key
ranges are planned once. Every step copies some of them in one job, each into a
folder of its own that a repeat replaces, and only then adds them to the ledger
as written. When all are, the ledger gets its complete mark; the saved position
stays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.model import Position, TableSpec
from tidelog.operators.positions import last_position, load_high_water, save_high_water
from tidelog.operators.transactions import SLICE_BYTES
from tidelog.plans.sync import catch_up_rows
from tidelog.sinks.targets import read_or_none
from tidelog.sources.tables import backfill_scan, snapshot_scan

LEDGER_SCHEMA = "chunk_id bigint, lo bigint, hi bigint, status string, n_rows bigint"
PLANNED, WRITTEN, COMPLETE = "planned", "written", "complete"
CHUNK = "_chunk"
# Rows of a chunk, chunks of one job, and chunks of a table at most.
CHUNK_ROWS = 1_000_000
STEP_CHUNKS = 32
MOST_CHUNKS = 10_000


class Ledger:
    """The rows of a ledger table; appended only, one row at least a chunk and status."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self) -> DataFrame:
        found = read_or_none(self.spark, self.path, self.spark.createDataFrame([], LEDGER_SCHEMA).schema)
        return self.spark.createDataFrame([], LEDGER_SCHEMA) if found is None else found

    def add(self, rows: list[tuple]) -> None:
        self.spark.createDataFrame(rows, LEDGER_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def chunks(self) -> list[tuple[int, int | None, int | None]]:
        """Planned ranges by number; as many as ``MOST_CHUNKS`` at most."""
        planned = self.read().where(F.col("status") == PLANNED).select("chunk_id", "lo", "hi").distinct()
        return [tuple(r) for r in planned.orderBy("chunk_id").collect()]

    def written(self) -> set[int]:
        return {r[0] for r in self.read().where(F.col("status") == WRITTEN).select("chunk_id").distinct().collect()}

    def is_complete(self) -> bool:
        return not self.read().where(F.col("status") == COMPLETE).isEmpty()


def plan_chunks(rows: DataFrame, key: str, chunk_rows: int = CHUNK_ROWS) -> list[tuple[int, int | None, int | None]]:
    """Ranges ``[lo, hi)`` of about ``chunk_rows`` rows; the first and the last are open, null keys go with the first."""
    n = rows.count()
    cuts = min(MOST_CHUNKS, -(-n // max(1, chunk_rows)))
    if cuts < 2:
        return [(0, None, None)]
    shares = [i / cuts for i in range(1, cuts)]
    found = rows.agg(F.percentile_approx(F.col(f"`{key}`").cast("bigint"), shares, 100 * cuts)).first()[0]
    edges = sorted(set(found or []))
    lows, highs = [None, *edges], [*edges, None]
    return [(i, lo, hi) for i, (lo, hi) in enumerate(zip(lows, highs, strict=True))]


def _inside(key: str, lo: int | None, hi: int | None) -> Column:
    column, inside = F.col(f"`{key}`"), F.lit(True)
    if lo is not None:
        inside = column >= lo
    if hi is not None:
        below = column < hi
        inside = inside & (below if lo is not None else below | column.isNull())
    return inside


def _write_step(rows: DataFrame, key: str, step: list[tuple], target: str) -> list[tuple]:
    """Copies some chunks in one job; their ledger rows."""
    wanted, number = F.lit(False), F.lit(None).cast("bigint")
    for chunk_id, lo, hi in step:
        wanted = wanted | _inside(key, lo, hi)
        number = F.when(_inside(key, lo, hi), F.lit(chunk_id)).otherwise(number)
    # The predicate is on the key alone, so that the scan skips what other steps copy.
    placed = rows.where(wanted).withColumn(CHUNK, number.cast("bigint"))
    writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(CHUNK).parquet(target)
    ids = [chunk_id for chunk_id, _, _ in step]
    back = read_or_none(rows.sparkSession, target, placed.schema)
    counts = {} if back is None else dict(
        back.where(F.col(CHUNK).isin(ids)).groupBy(CHUNK).agg(F.count(F.lit(1))).collect()
    )
    return [(chunk_id, lo, hi, WRITTEN, counts.get(chunk_id, 0)) for chunk_id, lo, hi in step]


def restartable_backfill(
    rows: DataFrame,
    log: DataFrame,
    key: str,
    target: str,
    ledger_path: str,
    state: str,
    where: str | Column | None = None,
    chunk_rows: int = CHUNK_ROWS,
    step_chunks: int = STEP_CHUNKS,
    saved_at_s: int = 0,
    after_step: Callable[[int], None] | None = None,
) -> Position | None:
    """Copies ``rows`` to ``target`` as far as the ledger says it is not yet done; the position to hand over from.

    ``key`` is a whole-number column of few equal values. ``after_step`` gets the
    number of steps done in this call; what it raises ends the call, and the next
    one goes on.
    """
    spark = rows.sparkSession
    start = load_high_water(spark, state)
    if start is None:
        start = last_position(log)
        if start is not None:
            save_high_water(spark, state, start, saved_at_s)
    ledger, wanted = Ledger(spark, ledger_path), backfill_scan(rows, where)
    if ledger.is_complete():
        return start
    chunks = ledger.chunks()
    if not chunks:
        chunks = plan_chunks(wanted, key, chunk_rows)
        ledger.add([(*c, PLANNED, None) for c in chunks])
    done = ledger.written()
    left = [c for c in chunks if c[0] not in done]
    for number, at in enumerate(range(0, len(left), step_chunks)):
        ledger.add(_write_step(wanted, key, left[at : at + step_chunks], target))
        if after_step is not None:
            after_step(number + 1)
    total = ledger.read().where(F.col("status") == WRITTEN).dropDuplicates(["chunk_id"]).agg(F.sum("n_rows")).first()[0]
    ledger.add([(-1, None, None, COMPLETE, total or 0)])
    return start


def backfilled(spark: SparkSession, rows: DataFrame, target: str, ledger_path: str) -> DataFrame:
    """The copied rows of a complete backfill, with the columns of ``rows``; an unfinished one is an error."""
    if not Ledger(spark, ledger_path).is_complete():
        raise RuntimeError("the backfill is not complete")
    found = read_or_none(spark, target, T.StructType([*rows.schema.fields, T.StructField(CHUNK, T.LongType())]))
    return backfill_scan(rows).limit(0) if found is None else found.select(*rows.columns)


def follow_backfill(
    spark: SparkSession,
    rows: DataFrame,
    log: DataFrame,
    spec: TableSpec,
    target: str,
    ledger_path: str,
    state: str,
    snapshot_ts: Column,
    stop: Position,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """A complete backfill as SNAPSHOT rows, and the log from the saved position up to ``stop``."""
    copied = backfilled(spark, rows, target, ledger_path)
    typed = copied.select(*(F.col(f"`{c.name}`").cast(c.spark_type).alias(c.name) for c in spec.columns))
    snapshot = snapshot_scan(typed, spec.database, spec.table, spec.key, snapshot_ts)
    return snapshot.unionByName(catch_up_rows(log, spec, load_high_water(spark, state), stop, slice_bytes=slice_bytes))
