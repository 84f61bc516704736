"""Registered queries: totals, running figures, chunks and checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.identifiers import insert_id
from tidelog.model import INSERT_ID
from tidelog.operators.chunks import batch_write_stats, chunk_totals, row_chunks
from tidelog.operators.images import after_images, explode_row_images, route_event_kind, row_events
from tidelog.operators.metrics import (
    error_stats,
    global_totals,
    latency_ema,
    metrics_snapshot,
    replication_lag,
    running_avg_batch,
    scan_throughput,
    table_totals,
    throughput_rates,
)
from tidelog.operators.transactions import gtid_transaction, txn_totals
from tidelog.operators.verify import duplicate_report, reconcile
from tidelog.operators.write_errors import retryable_batches
from tidelog.plans.oracle import LOG, ROW_COUNT, TX, events, images, with_
from tidelog.plans.registry import query
from tidelog.plans.row_queries import PER_TXN, all_images, assigned, log_events
from tidelog.sources import derived as d

EV = with_(LOG, events())
EV_IMAGES = with_(LOG, events(), images("ev"))
START_S = d.FIRST_EVENT_S - 60

TOTALS = f"""count(*) AS events_processed, CAST(sum({ROW_COUNT}) AS BIGINT) AS rows_processed,
  make_timestamp(max(event_ts_s) * 1000000) AS last_event_time, max(binlog_file) AS current_position
  FROM ev WHERE op IN ('INSERT', 'UPDATE', 'DELETE')"""


def data_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return after_images(row_events(log_events(spark, sf_dir)))


def elapsed():
    """Seconds between the start of the run and the last event."""
    return (F.unix_timestamp("last_event_time") - F.lit(START_S)).cast("double")


@query("global_totals", EV + f"SELECT {TOTALS}")
def totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return global_totals(data_events(spark, sf_dir))


@query("table_totals", EV + f"SELECT source_db || '.' || source_table AS table_name, {TOTALS} GROUP BY 1")
def totals_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_totals(data_events(spark, sf_dir))


RATES = f"""events_processed / CAST(epoch(last_event_time) - {START_S} AS DOUBLE) AS events_per_second,
  rows_processed / CAST(epoch(last_event_time) - {START_S} AS DOUBLE) AS rows_per_second"""


@query(
    "throughput_rates",
    EV
    + f"""SELECT *, {RATES} FROM (SELECT source_db || '.' || source_table AS table_name, {TOTALS} GROUP BY 1)""",
)
def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return throughput_rates(table_totals(data_events(spark, sf_dir)), elapsed())


def numbered_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = all_images(spark, sf_dir).select("source_table", "binlog_file", "log_pos", "image_idx")
    return row_chunks(rows, ["source_table"], ["binlog_file", "log_pos", "image_idx"])


CHUNKS = """, numbered AS (SELECT source_table, binlog_file, log_pos, image_idx,
    row_number() OVER (PARTITION BY source_table ORDER BY binlog_file, log_pos, image_idx) - 1 AS row_no FROM img),
  chunk AS (SELECT source_table, row_no // 1000 AS chunk_id, count(*) AS n_rows FROM numbered GROUP BY 1, 2)
"""


@query("row_chunks", EV_IMAGES + CHUNKS + "SELECT *, row_no // 1000 AS chunk_id FROM numbered")
def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered_chunks(spark, sf_dir)


@query("chunk_totals", EV_IMAGES + CHUNKS + "SELECT * FROM chunk")
def totals_of_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_totals(numbered_chunks(spark, sf_dir), ["source_table"])


@query(
    "batch_write_stats",
    EV_IMAGES
    + CHUNKS
    + """SELECT source_table, count(*) AS batches_written, CAST(sum(n_rows) AS BIGINT) AS rows_written,
    sum(n_rows) / CAST(count(*) AS DOUBLE) AS average_batch_size FROM chunk GROUP BY 1""",
)
def write_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_write_stats(chunk_totals(numbered_chunks(spark, sf_dir), ["source_table"]), ["source_table"])


MESSAGES = """msgs AS (SELECT event_id, ts, CASE user_id % 4 WHEN 0 THEN 'Rate Limit exceeded'
    WHEN 1 THEN 'invalid table name' WHEN 2 THEN 'service unavailable' ELSE 'permission denied' END AS message,
    NOT (user_id % 4 IN (0, 2) OR event_type IN ('click', 'view')) AS is_write_error FROM events)"""
ERRORS = """count(*) AS error_count, arg_max(message, (ts, event_id)) AS last_error, max(ts) AS last_error_time,
  count(*) FILTER (is_write_error) AS write_errors FROM msgs"""


def errors_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return error_stats(
        retryable_batches(d.write_errors(spark, sf_dir)).select(
            F.col("event_id").alias("seq"),
            F.col("failed_at").alias("error_time"),
            "message",
            (~F.col("retryable")).alias("is_write_error"),
        )
    )


@query("error_stats", with_(MESSAGES) + f"SELECT {ERRORS}")
def error_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return errors_seen(spark, sf_dir)


@query(
    "metrics_snapshot",
    with_(LOG, events(), TX, MESSAGES)
    + PER_TXN
    + f""", tt AS (SELECT source_db || '.' || source_table AS table_name, {TOTALS} GROUP BY 1)
    SELECT g.*, {RATES}, t.*, e.*, (SELECT '{{' || string_agg('"' || table_name || '":{{"table_name":"' || table_name
      || '","events_processed":' || events_processed || ',"rows_processed":' || rows_processed || ',"last_event_time":"'
      || strftime(last_event_time, '%Y-%m-%dT%H:%M:%S.000Z') || '","current_position":"' || current_position || '"}}',
      ',' ORDER BY table_name) || '}}' FROM tt) AS table_metrics
    FROM (SELECT {TOTALS}) g, (SELECT count(*) FILTER (done) AS committed_transactions,
      count(*) FILTER (NOT done) AS open_transactions,
      CAST(coalesce(sum(n_events) FILTER (NOT done), 0) AS BIGINT) AS buffered_events FROM per) t,
      (SELECT {ERRORS}) e""",
)
def snapshot_of_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [txn_totals(assigned(spark, sf_dir)), errors_seen(spark, sf_dir)]
    out = metrics_snapshot(data_events(spark, sf_dir), parts, elapsed())
    return out.withColumn("table_metrics", F.to_json("table_metrics"))


@query(
    "scan_throughput",
    EV_IMAGES
    + """SELECT *, CASE WHEN duration_s > 0 THEN records / CAST(duration_s AS DOUBLE) ELSE 0.0 END AS records_per_second
    FROM (SELECT source_table, count(*) AS records, max(event_ts_s) - min(event_ts_s) AS duration_s FROM img GROUP BY 1)""",
)
def scanned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_throughput(all_images(spark, sf_dir), ["source_table"], "event_ts_s")


@query(
    "replication_lag",
    EV
    + """SELECT source_db, source_table, 1800000000 - max(event_ts_s) AS replication_lag_seconds FROM ev
    WHERE op IN ('INSERT', 'UPDATE', 'DELETE') GROUP BY 1, 2""",
)
def lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replication_lag(data_events(spark, sf_dir), 1_800_000_000)


def source_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key and amount in cents of the source rows."""

    def side(name: str, as_table: str, key: str, amount: str) -> DataFrame:
        cents = F.round(F.col(amount) * 100).cast("bigint")
        return d.table(spark, sf_dir, name).select(
            F.lit(as_table).alias("table_name"), F.col(key).alias("key"), cents.alias("cents")
        )

    orders = side("orders", "orders", "o_orderkey", "o_totalprice")
    return orders.unionByName(side("lineitem", "order_lines", "l_orderkey", "l_extendedprice"))


@query(
    "reconcile",
    EV_IMAGES
    + """, s AS (SELECT 'orders' AS table_name, count(*) AS n,
        sum(o_orderkey * 31 + CAST(round(o_totalprice * 100) AS BIGINT)) AS c FROM orders
      UNION ALL SELECT 'order_lines', count(*), sum(l_orderkey * 31 + CAST(round(l_extendedprice * 100) AS BIGINT))
      FROM lineitem),
    t AS (SELECT source_table AS table_name, count(*) AS n, sum(CAST(image[1] AS BIGINT) * 31 + CASE source_table
        WHEN 'orders' THEN CAST(round(CAST(image[4] AS DOUBLE) * 100) AS BIGINT)
        WHEN 'order_lines' THEN CAST(round(CAST(image[6] AS DOUBLE) * 100) AS BIGINT) ELSE 0 END) AS c
      FROM img WHERE op = 'INSERT' GROUP BY 1)
    SELECT table_name, coalesce(s.n, 0) AS source_rows, coalesce(t.n, 0) AS target_rows,
      coalesce(s.n, 0) = coalesce(t.n, 0) AND s.c IS NOT DISTINCT FROM t.c AS is_equal FROM s FULL JOIN t USING (table_name)""",
)
def reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source rows against the inserts of the log: lines agree, orders do not, audit has no source."""
    amount = F.when(F.col("source_table") == "orders", F.col("image")[3]).when(
        F.col("source_table") == "order_lines", F.col("image")[5]
    )
    target = (
        all_images(spark, sf_dir)
        .where(F.col("op") == "INSERT")
        .select(
            F.col("source_table").alias("table_name"),
            F.col("image")[0].cast("bigint").alias("key"),
            F.coalesce(F.round(amount.cast("double") * 100).cast("bigint"), F.lit(0)).alias("cents"),
        )
    )
    checksum = F.col("key") * 31 + F.col("cents")
    return reconcile(source_keys(spark, sf_dir), target, ["table_name"], checksum)


@query(
    "duplicate_report",
    EV_IMAGES
    + """SELECT '(' || binlog_file || ', ' || log_pos || '):' || gtid_uuid || ':' || gtid_no || ':' || image_idx
      AS _insert_id, CAST(2 AS BIGINT) AS copies FROM img WHERE binlog_file > 'mysql-bin.000000000001'""",
)
def duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    twice = gtid_transaction(route_event_kind(d.redelivered(d.landed_log(spark, sf_dir))))
    rows = explode_row_images(after_images(row_events(twice)))
    ids = rows.select(
        insert_id(F.col("binlog_file"), F.col("log_pos"), F.col("txn_id"), F.col("image_idx")).alias(INSERT_ID)
    )
    return duplicate_report(ids, [INSERT_ID])


@query(
    "running_avg_batch",
    """SELECT user_id, event_id, count(*) OVER w AS batches_so_far,
      sum(CAST(floor(value) AS BIGINT) + 1) OVER w / CAST(count(*) OVER w AS DOUBLE) AS average_batch_size
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)""",
)
def running_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches = d.table(spark, sf_dir, "events").select(
        "user_id", "event_id", (F.floor("value").cast("bigint") + 1).alias("n_rows")
    )
    return running_avg_batch(batches, ["user_id"], "event_id", "n_rows", slice_width=1000).drop("n_rows")


@query(
    "latency_ema",
    """WITH s AS (SELECT user_id, event_id, list(CASE WHEN event_id % 3 = 0 THEN 0.0 ELSE value / 7 END) OVER w AS l
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))"""
    + " UNION ALL ".join(
        f"""SELECT CAST({w} AS DOUBLE) AS weight, user_id, event_id, list_reduce(l,
      lambda a, x: CASE WHEN a = 0 THEN x ELSE CAST({w} AS DOUBLE) * x + (1 - CAST({w} AS DOUBLE)) * a END) AS latency_ema FROM s"""
        for w in ("0.001", "0.1", "0.9")
    ),
)
def smoothed_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third write reports no latency; a slow, the usual and a fast average."""
    writes = d.table(spark, sf_dir, "events").select(
        "user_id", "event_id", F.when(F.col("event_id") % 3 == 0, F.lit(0.0)).otherwise(F.col("value") / 7).alias("ms")
    )
    out = [
        latency_ema(writes, ["user_id"], "event_id", "ms", weight, slice_width=1000).withColumn("weight", F.lit(weight))
        for weight in (0.001, 0.1, 0.9)
    ]
    return reduce(DataFrame.unionByName, out).select(
        "weight", "user_id", "event_id", "latency_ema"
    )
