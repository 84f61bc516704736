"""Metrics that a running job keeps by itself, exact after any number of batches, repeats and restarts.

A sink that counts writes the figures of each micro-batch into a folder named by
run and batch, after the rows themselves; a repeated batch replaces its figures.
The totals are the sum of these folders, so nothing is lost that a query no
longer remembers and nothing counts twice.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.model import CDC_DATABASE, CDC_TABLE, CDC_TIMESTAMP, LATENCY_WEIGHT
from tidelog.operators.metrics import latency_ema
from tidelog.sinks.targets import read_or_none
from tidelog.streaming.sinks import BatchWriter, batch_folder

FIGURES = "table_name string, n_rows bigint, last_event_time timestamp, took_ms double"


def batch_figures(rows: DataFrame, took_ms: float) -> DataFrame:
    """Rows and newest event time of each table; one row without a table holds the time the batch took."""
    named = F.concat_ws(".", F.col(CDC_DATABASE), F.col(CDC_TABLE))
    tables = rows.groupBy(named.alias("table_name")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.max(CDC_TIMESTAMP).alias("last_event_time")
    )
    whole = rows.sparkSession.createDataFrame([(None, 0, None, float(took_ms))], FIGURES)
    return tables.withColumn("took_ms", F.lit(None).cast("double")).unionByName(whole)


def counting_sink(
    write: BatchWriter, path: str, run: str, written: Callable[[SparkSession, int], DataFrame] | None = None
) -> BatchWriter:
    """``write``, and the figures of each batch of change rows under ``path``.

    ``written`` reads back what the sink has kept of a batch, for sinks that
    leave rows out; without it the batch's own rows are counted, which reads the
    three columns needed once more. ``run`` goes with the checkpoint.
    """

    def counted(batch: DataFrame, batch_id: int) -> None:
        start = time.monotonic()
        write(batch, batch_id)
        took = (time.monotonic() - start) * 1000
        rows = batch if written is None else written(batch.sparkSession, batch_id)
        batch_figures(rows, took).coalesce(1).write.mode("overwrite").parquet(batch_folder(path, run, batch_id))

    return counted


def read_figures(spark: SparkSession, path: str) -> DataFrame:
    full = T.StructType.fromDDL(f"{FIGURES}, run string, batch_id bigint")
    found = read_or_none(spark, path, full)
    return spark.createDataFrame([], full) if found is None else found


def live_totals(figures: DataFrame, now: Column) -> DataFrame:
    """One row: rows, batches with rows, mean batch size, newest event and its lag in seconds at ``now``."""
    per_batch = figures.groupBy("run", "batch_id").agg(F.sum("n_rows").alias("n"), F.max("last_event_time").alias("t"))
    some = per_batch.where(F.col("n") > 0)
    last = F.max("t")
    return some.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_written"),
        F.count(F.lit(1)).alias("batches_written"),
        F.coalesce(F.avg("n"), F.lit(0.0)).alias("average_batch_size"),
        last.alias("last_event_time"),
        (F.unix_timestamp(now) - F.unix_timestamp(last)).alias("lag_s"),
    )


def live_tables(figures: DataFrame, now: Column) -> DataFrame:
    """The same for each table."""
    last = F.max("last_event_time")
    return figures.where(F.col("table_name").isNotNull()).groupBy("table_name").agg(
        F.sum("n_rows").alias("rows_written"),
        F.count(F.lit(1)).alias("batches_written"),
        last.alias("last_event_time"),
        (F.unix_timestamp(now) - F.unix_timestamp(last)).alias("lag_s"),
    )


def live_latency(figures: DataFrame, weight: float = LATENCY_WEIGHT) -> DataFrame:
    """Each batch's write time and the moving average after it, run by run."""
    took = figures.where(F.col("took_ms").isNotNull()).select("run", "batch_id", "took_ms")
    return latency_ema(took, ["run"], "batch_id", "took_ms", weight)


def live_snapshot(figures: DataFrame, now: Column) -> DataFrame:
    """Totals with the tables as a map: one row, as ``metrics_snapshot`` gives it for a log."""
    tables = live_tables(figures, now)
    entry = F.struct(F.col("table_name").alias("key"), F.struct(*tables.columns).alias("value"))
    by_table = tables.agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("table_metrics"))
    return live_totals(figures, now).crossJoin(F.broadcast(by_table))  # one row each
