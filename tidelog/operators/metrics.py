"""Totals, rates and running figures of a replication run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.model import LATENCY_WEIGHT
from tidelog.operators.ordered import Running, running, slice_of

# Values per slice of a whole-number sequence.
SLICE_WIDTH = 1_000_000
# Rows per block of the latency average, and how often blocks are gathered into blocks.
EMA_BLOCK = 256
EMA_LEVELS = 2


def position_text(binlog_file: Column, log_pos: Column) -> Column:
    """The file name where there is one, else the offset."""
    return F.when(F.length(binlog_file) > 0, binlog_file).otherwise(log_pos.cast("string"))


def _per_file(row_events: DataFrame) -> DataFrame:
    """Totals per table and log file: only numbers to add up, which keeps it a hash aggregation."""
    named = row_events.withColumn("table_name", F.concat_ws(".", "source_db", "source_table"))
    return named.groupBy("table_name", "binlog_file").agg(
        F.count("*").alias("_events"),
        F.sum(F.size("rows")).alias("_rows"),
        F.max("event_ts_s").alias("_ts"),
        F.max("log_pos").alias("_pos"),
    )


def _roll_up(per_file: DataFrame, keys: list[str]) -> DataFrame:
    text = position_text(F.col("binlog_file"), F.col("_pos"))
    return per_file.groupBy(*keys).agg(
        F.coalesce(F.sum("_events"), F.lit(0)).alias("events_processed"),
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows_processed"),
        F.timestamp_seconds(F.max("_ts")).alias("last_event_time"),
        F.max_by(text, F.struct("binlog_file", "_pos")).alias("current_position"),
    )


def global_totals(row_events: DataFrame) -> DataFrame:
    return _roll_up(_per_file(row_events), [])


def table_totals(row_events: DataFrame) -> DataFrame:
    return _roll_up(_per_file(row_events), ["table_name"])


def throughput_rates(totals: DataFrame, elapsed_s: Column) -> DataFrame:
    """Events and rows per second since the start; 0 when no time has passed."""

    def rate(total: str) -> Column:
        return F.when(elapsed_s > 0, F.col(total) / elapsed_s).otherwise(F.lit(0.0))

    return totals.withColumns(
        {"events_per_second": rate("events_processed"), "rows_per_second": rate("rows_processed")}
    )


def error_stats(errors: DataFrame) -> DataFrame:
    """Errors seen, the last one and its time, and how many of them were write errors.

    ``errors`` has ``seq`` (unique), ``error_time``, ``message``, ``is_write_error``.
    """
    last = F.struct("error_time", "seq")
    return errors.agg(
        F.count("*").alias("error_count"),
        F.max_by("message", last).alias("last_error"),
        F.max("error_time").alias("last_error_time"),
        F.count_if("is_write_error").alias("write_errors"),
    )


def metrics_snapshot(row_events: DataFrame, parts: Sequence[DataFrame], elapsed_s: Column) -> DataFrame:
    """All figures as one row, the tables as a map.

    ``parts`` are one-row tables such as transaction, batch and error figures.
    The map has one entry per source table.
    """
    per_file = _per_file(row_events)
    tables = _roll_up(per_file, ["table_name"])
    entry = F.struct(*tables.columns)
    by_table = tables.agg(
        F.map_from_entries(
            F.array_sort(F.collect_list(F.struct(F.col("table_name").alias("key"), entry.alias("value"))))
        ).alias("table_metrics")
    )
    snapshot = throughput_rates(_roll_up(per_file, []), elapsed_s)
    for part in (*parts, by_table):
        snapshot = snapshot.crossJoin(F.broadcast(part))  # one row each
    return snapshot


def scan_throughput(scanned: DataFrame, table: Sequence[str], scanned_at_s: str) -> DataFrame:
    """Rows, seconds and rows per second of each table's scan."""
    seconds = F.max(scanned_at_s) - F.min(scanned_at_s)
    return scanned.groupBy(*table).agg(
        F.count("*").alias("records"),
        seconds.alias("duration_s"),
        F.when(seconds > 0, F.count("*") / seconds).otherwise(F.lit(0.0)).alias("records_per_second"),
    )


def replication_lag(row_events: DataFrame, now_s: int) -> DataFrame:
    """Seconds between ``now_s`` and each table's last event."""
    return row_events.groupBy("source_db", "source_table").agg(
        (F.lit(now_s).cast("bigint") - F.max("event_ts_s")).alias("replication_lag_seconds")
    )


def running_avg_batch(
    batches: DataFrame, group: Sequence[str], seq: str, size: str, slice_width: int = SLICE_WIDTH
) -> DataFrame:
    """Mean batch size after each batch; ``seq`` numbers the batches of a group."""
    sliced = batches.withColumn("_slice", slice_of(seq, slice_width))
    out = running(
        sliced,
        group,
        [["_slice"]],
        [seq],
        [Running("batches_so_far", "sum", F.lit(1).cast("bigint")), Running("_rows", "sum", F.col(size))],
    )
    return out.withColumn("average_batch_size", F.col("_rows").cast("double") / F.col("batches_so_far")).drop(
        "_slice", "_rows"
    )


def latency_ema(
    writes: DataFrame,
    group: Sequence[str],
    seq: str,
    latency: str,
    weight: float = LATENCY_WEIGHT,
    slice_width: int = SLICE_WIDTH,
) -> DataFrame:
    """``weight * x + (1 - weight) * previous`` after each write; the first non-zero sample seeds it.

    A row takes the value before it to ``a * value + t``, and so does a block of
    rows. Rows are numbered and cut into blocks, each block's ``a`` and ``t`` are
    folded in order, blocks are gathered into larger blocks the same way, and
    every block starts from the fold of all before it. No task holds more than
    a block, and as nothing is divided, any weight up to 1 is exact.
    """
    if not 0 < weight <= 1:
        raise ValueError("weight must lie above 0 and not above 1")
    keys = list(group)
    numbered = running(
        writes.withColumn("_slice", slice_of(seq, slice_width)),
        keys,
        [["_slice"]],
        [seq],
        [
            Running("_n", "sum", F.lit(1).cast("bigint")),
            Running("_seen", "max", F.col(latency) != 0, exclusive=True),
        ],
    )
    share = F.when(F.coalesce(F.col("_seen"), F.lit(False)), F.lit(weight)).otherwise(F.lit(1.0))
    rows = numbered.select(
        *keys,
        (F.col("_n") - 1).alias("_at"),
        (F.lit(1.0) - share).alias("_a"),
        (share * F.col(latency)).alias("_t"),
        F.struct(*(F.col(f"`{c}`") for c in writes.columns)).alias("_row"),
    )
    done = _folded(rows, keys, EMA_LEVELS)
    return done.select("_row.*", (F.col("_a") * F.col("_before") + F.col("_t")).alias("latency_ema"))


def _folded(rows: DataFrame, keys: list[str], levels: int) -> DataFrame:
    """Add ``_before``, the value that ``(_at, _a, _t)`` rows start from, to ``rows``."""
    block = F.expr(f"_at div {EMA_BLOCK}") if levels else F.lit(0).cast("bigint")
    body = [c for c in rows.columns if c not in keys]
    blocks = (
        rows.withColumn("_block", block)
        .groupBy(*keys, "_block")
        .agg(F.array_sort(F.collect_list(F.struct("_at", *(c for c in body if c != "_at")))).alias("_rows"))
    )
    if levels:
        both = F.aggregate(
            "_rows",
            F.struct(F.lit(1.0).alias("a"), F.lit(0.0).alias("t")),
            lambda s, r: F.struct((s["a"] * r["_a"]).alias("a"), (s["t"] * r["_a"] + r["_t"]).alias("t")),
        )
        totals = blocks.select(*keys, F.col("_block").alias("_at"), both["a"].alias("_a"), both["t"].alias("_t"))
        starts = _folded(totals, keys, levels - 1).select(*keys, F.col("_at").alias("_block"), F.col("_before").alias("_start"))
        blocks = blocks.join(starts, [*keys, "_block"])
    else:
        blocks = blocks.withColumn("_start", F.lit(0.0))
    path = F.aggregate(
        "_rows",
        F.array("_start"),
        lambda s, r: F.concat(s, F.array(F.element_at(s, -1) * r["_a"] + r["_t"])),
    )
    paired = blocks.select(*keys, F.explode(F.arrays_zip("_rows", path.alias("_path"))).alias("_p"))
    return paired.where(F.col("_p._rows").isNotNull()).select(
        *keys, *(F.col(f"_p._rows.{c}").alias(c) for c in body), F.col("_p._path").alias("_before")
    )
