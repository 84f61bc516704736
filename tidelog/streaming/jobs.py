"""Running modes: until cancelled, or until the landed log is drained."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager, nullcontext

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidelog.model import CDC_TIMESTAMP, COMMIT, INSERT_ID, Position
from tidelog.operators.images import after_images, explode_row_images, route_event_kind, row_events
from tidelog.operators.number_sets import SPANS, events_of_numbers, subtract_spans
from tidelog.operators.positions import catch_up_range, executed_gtids, resume_filter
from tidelog.operators.rows import generic_change_rows
from tidelog.operators.transactions import gtid_transaction
from tidelog.session import broadcast_if_small, free_shuffles, stage
from tidelog.sinks.targets import delete_folders, read_or_none
from tidelog.streaming.gate import commit_gate_stream, gate_keys, rows_of_keys
from tidelog.streaming.live import counting_sink
from tidelog.streaming.sinks import BatchWriter, batch_folder


def change_row_stream(
    log: DataFrame,
    start: Position | None = None,
    stop: Position | None = None,
    gate: tuple[str, str] | None = None,
) -> DataFrame:
    """Change rows of all tables from a streamed log, between two positions.

    ``gate`` is ``(delay, bound)``: hold rows back until their COMMIT is seen.
    """
    ranged = catch_up_range(log, start, stop) if stop is not None else resume_filter(log, start)
    events = gtid_transaction(route_event_kind(ranged))
    rows = commit_gate_stream(events, *gate) if gate else row_events(events)
    return generic_change_rows(explode_row_images(after_images(rows)))


def gated_keys(log: DataFrame, gate: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Keys of the events of a streamed log that ``gate`` lets through; ``change_rows_sink`` is their sink."""
    return gate(gate_keys(gtid_transaction(route_event_kind(log))))


def change_rows_sink(path: str, read_log: Callable[[], DataFrame], deliver: BatchWriter, extra: Sequence[str] = ()) -> BatchWriter:
    """Change rows of the events whose keys a micro-batch brings, with the gate's ``extra`` columns, go to ``deliver``.

    ``read_log`` reads the log that the stream reads; the images come from there.
    The keys of a micro-batch are kept in its folder while it is worked on.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, here = batch.sparkSession, batch_folder(path, "keys", batch_id)
        batch.write.mode("overwrite").parquet(here)
        keys = spark.read.schema(batch.schema).parquet(here)
        rows = rows_of_keys(keys, gtid_transaction(route_event_kind(read_log())))
        deliver(generic_change_rows(explode_row_images(after_images(rows)), extra), batch_id)
        delete_folders(spark, [here])

    return write


def leftovers(log: DataFrame, released: DataFrame) -> DataFrame:
    """Change rows of the log that are not among ``released``, with ``committed`` as the whole log has it.

    The streamed gate is bound by time: rows whose COMMIT came later than the
    bound, rows that were late themselves and rows still held when a drain ends
    are not released by it. This batch form settles them, over the same range of
    the log; its committed rows belong into the target as well. Which rows those
    are is found by their ids alone; only their own events' images are shuffled.
    """
    events = gtid_transaction(route_event_kind(log))
    # Ids are made of the event and the image's number, so an event's own place stands for its images.
    numbered = after_images(row_events(events)).withColumn("rows", F.transform("rows", lambda image: F.array().cast("array<string>")))
    ids = generic_change_rows(explode_row_images(numbered), ["binlog_file", "log_pos"]).select(INSERT_ID, "binlog_file", "log_pos")
    left = stage(ids.join(released.select(INSERT_ID).distinct(), INSERT_ID, "left_anti"), "left-ids")
    free_shuffles(log.sparkSession)
    at, _ = broadcast_if_small(left.select("binlog_file", "log_pos").distinct())
    missing, _ = broadcast_if_small(left.select(INSERT_ID).distinct())
    # A null id equals no other, and is left over.
    rows = row_events(events).alias("e").join(at.alias("at"), _same("e", "at", "binlog_file", "log_pos"), "left_semi")
    of = rows.select("txn_id").distinct()
    commits = events.where(F.col("op") == COMMIT).select("txn_id").join(of, "txn_id", "left_semi").distinct()
    rows = rows.join(commits.withColumn("committed", F.lit(True)), "txn_id", "left")
    rows = rows.withColumn("committed", F.coalesce("committed", F.lit(False)))
    changes = generic_change_rows(explode_row_images(after_images(rows)), ["committed"])
    found = changes.alias("c").join(missing.alias("m"), _same("c", "m", INSERT_ID), "left_semi")
    return found.select(INSERT_ID, *(c for c in changes.columns if c != INSERT_ID))


def _same(left: str, right: str, *names: str) -> Column:
    """Columns are equal, or null on both sides."""
    equal = F.lit(True)
    for name in names:
        equal = equal & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return equal


def start_continuous(
    rows: DataFrame, write: BatchWriter, checkpoint: str, max_delay_s: float = 2.0, figures: tuple[str, str] | None = None
) -> StreamingQuery:
    """Run until stopped; a micro-batch starts at least every ``max_delay_s`` seconds.

    ``figures`` are a folder and the name of the run: the job then keeps its own
    metrics there (``live.counting_sink``), for streams of change rows.
    """
    if figures is not None:
        write = counting_sink(write, *figures)
    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=f"{int(max_delay_s * 1000)} milliseconds")
        .start()
    )


def run_once(rows: DataFrame, write: BatchWriter, checkpoint: str, state: bool = False) -> StreamingQuery:
    """Drain what has landed, then end. With an old checkpoint it goes on where that one stopped.

    ``state`` says that the stream itself keeps state; it then runs with ``STATE_SETTINGS``.
    Files of a micro-batch's shuffles go with the next one, not with the run.
    """

    def write_and_free(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        free_shuffles(batch.sparkSession)

    job = rows.writeStream.foreachBatch(write_and_free).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    with state_settings(rows.sparkSession) if state else nullcontext():
        query = job.start()
    query.awaitTermination()
    return query


# State lies on the executors' disks, not in their heaps, and only the versions that a restart can ask for stay.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.minBatchesToRetain": "2",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    # Changes are kept until a snapshot holds them, so those come often.
    "spark.sql.streaming.stateStore.minDeltasForSnapshot": "2",
    "spark.sql.streaming.stateStore.maintenanceInterval": "10s",
}
# Parts of the state a core; each is loaded and written in every micro-batch, however few rows it has.
STATE_PARTS_PER_CORE = 2


@contextmanager
def state_settings(spark: SparkSession) -> Iterator[None]:
    """Settings of a stream that is started within; it keeps them, the session does not.

    A restart on an old checkpoint keeps the number of parts and the kind of store it began with.
    """
    parts = str(STATE_PARTS_PER_CORE * spark.sparkContext.defaultParallelism)
    settings = STATE_SETTINGS | {"spark.sql.shuffle.partitions": parts}
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


METRICS = "change_rows"


def with_metrics(rows: DataFrame) -> DataFrame:
    """Count the rows of each micro-batch as they pass, at no further job."""
    return rows.observe(
        METRICS, F.count(F.lit(1)).alias("rows_processed"), F.max(CDC_TIMESTAMP).alias("last_event_time")
    )


def record_progress(spark: SparkSession, query: StreamingQuery, path: str) -> None:
    """Add the batches that the query remembers to a metrics table; call it at least every hundred batches.

    A batch that is recorded twice counts once, by its query and number.
    """
    batches = [json.loads(p.json) for p in query.recentProgress]
    rows = [
        (
            b["id"],
            b["batchId"],
            b["observedMetrics"][METRICS]["rows_processed"],
            b["observedMetrics"][METRICS].get("last_event_time"),
            b["durationMs"].get("triggerExecution", 0),
        )
        for b in batches
        if METRICS in b.get("observedMetrics", {})
    ]
    if rows:
        spark.createDataFrame(rows, PROGRESS_SCHEMA).coalesce(1).write.mode("append").parquet(path)


PROGRESS_SCHEMA = "query_id string, batch_id bigint, rows_processed bigint, last_event_time string, took_ms bigint"


def recorded_totals(spark: SparkSession, path: str) -> DataFrame:
    """Batches, rows, mean batch size, time per batch and rate over all recorded batches, as one row."""
    once = spark.read.schema(PROGRESS_SCHEMA).parquet(path).groupBy("query_id", "batch_id").agg(
        *(F.max(c).alias(c) for c in ("rows_processed", "last_event_time", "took_ms"))
    )
    rows, took = F.coalesce(F.sum("rows_processed"), F.lit(0)), F.coalesce(F.sum("took_ms"), F.lit(0))
    return once.agg(
        F.count("*").alias("total_batches_written"),
        rows.alias("rows_processed"),
        F.coalesce(F.avg("rows_processed"), F.lit(0.0)).alias("average_batch_size"),
        F.coalesce(F.avg("took_ms"), F.lit(0.0)).alias("write_latency_ms"),
        F.when(took > 0, rows * 1000 / took).otherwise(F.lit(0.0)).alias("rows_per_second"),
        F.max("last_event_time").alias("last_row_time"),
    )


def progress_totals(query: StreamingQuery) -> dict:
    """Rows, batches and rates over the newest batches, those a query still remembers.

    Totals from the start are those of ``record_progress`` and ``recorded_totals``.
    """
    batches = [json.loads(p.json) for p in query.recentProgress]
    seen = [b["observedMetrics"][METRICS] for b in batches if METRICS in b.get("observedMetrics", {})]
    took = sum(b["durationMs"].get("triggerExecution", 0) for b in batches) / 1000
    rows = sum(m["rows_processed"] for m in seen)
    return {
        "batches_written": len(seen),
        "rows_processed": rows,
        "rows_per_second": rows / took if took > 0 else 0.0,
        "last_event_time": max((m["last_event_time"] for m in seen if m.get("last_event_time")), default=None),
    }


def once_to_set(
    log: DataFrame, executed: DataFrame, stop: DataFrame, deliver: BatchWriter, checkpoint: str, state: str, run: str
) -> DataFrame:
    """Drains a streamed log to a set of transaction numbers; what of the set is still missing, as intervals.

    ``executed`` and ``stop`` are (source_uuid, lo, hi). Only events whose number
    is in ``stop`` and not in ``executed`` go to ``deliver``, whatever holes the
    sets have. The numbers of each micro-batch are kept under ``state``, so that
    a further run on the same checkpoint, when more log has landed, goes on. The
    run is through when nothing is missing: the executed set with what was
    delivered then contains the stop set.
    """
    spark = log.sparkSession
    wanted = stage(subtract_spans(stop, executed), "wanted")

    def write(batch: DataFrame, batch_id: int) -> None:
        events = events_of_numbers(batch, wanted)
        deliver(events, batch_id)
        executed_gtids(events).write.mode("overwrite").parquet(batch_folder(state, run, batch_id))

    run_once(log, write, checkpoint)
    seen = read_or_none(spark, state, T.StructType.fromDDL(SPANS))
    return wanted if seen is None else subtract_spans(wanted, seen.select("source_uuid", "lo", "hi"))
