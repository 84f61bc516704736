"""Registered queries: what a run left undone or a target has wrong."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.gtid import explode_gtid_sets
from tidelog.model import CDC_OPERATION, CHANGE_LOG_SCHEMA, CHANGE_ROW_SCHEMA, ROW_OPS, SNAPSHOT
from tidelog.operators import positions as pos
from tidelog.operators import state
from tidelog.operators.continuity import file_number, log_gaps
from tidelog.operators.images import after_images, explode_row_images, named_columns, route_event_kind, row_events
from tidelog.operators.number_sets import subtract_spans
from tidelog.operators.rows import generic_change_rows
from tidelog.operators.transactions import gtid_transaction
from tidelog.plans.backfill import follow_backfill, restartable_backfill
from tidelog.plans.oracle import INSERT_ID as INSERT_ID_SQL
from tidelog.plans.oracle import LOG, META, ORDER_ROWS, ROW_COUNT, SNAPSHOT_ORDERS, START, TX, events, images, with_
from tidelog.plans.registry import query
from tidelog.plans.scan_queries import START_POSITION, snapshot_at
from tidelog.plans.sink_queries import BOUND, DELAY, GTID_TX, IN_BOUND
from tidelog.plans.sync import sync_once
from tidelog.session import new_path
from tidelog.sinks import targets
from tidelog.sources import derived as d
from tidelog.sources.change_log import read_change_log, stream_change_log
from tidelog.streaming import jobs, retries, sinks, typed
from tidelog.streaming.gate import force_flush_stream
from tidelog.streaming.live import counting_sink, live_tables, read_figures

# Orders that the source has changed and lost behind the log's back: every 1009th and every 1013th.
CHANGED_EVERY, LOST_EVERY = 1009, 1013


def source_of_today(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders as the committed log leaves them, apart from some that were altered without a log event."""
    k, price = F.col("o_orderkey"), F.col("o_totalprice").cast("decimal(18,2)")
    committed = k % 11 != 0
    doubled = F.when(committed & (k % 5 == 3), (F.col("o_totalprice") * 2).cast("decimal(18,2)")).otherwise(price)
    altered = F.when(k % CHANGED_EVERY == 0, doubled + 1).otherwise(doubled).cast("decimal(18,2)")
    left = d.table(spark, sf_dir, "orders").where(~(committed & (k % 5 == 4)) & (k % LOST_EVERY != 0))
    return left.withColumn("o_totalprice", altered).select(*d.ORDERS.column_names)


@query(
    "reconcile_target",
    with_(
        f"""live AS (SELECT o_orderkey FROM orders WHERE NOT (o_orderkey % 11 <> 0 AND o_orderkey % 5 = 4)),
        bad AS (SELECT o_orderkey, CASE WHEN o_orderkey % {LOST_EVERY} = 0 THEN 'extra' ELSE 'changed' END AS verdict
          FROM live WHERE o_orderkey % {LOST_EVERY} = 0 OR o_orderkey % {CHANGED_EVERY} = 0)"""
    )
    + """SELECT o_orderkey // 64 * 64 AS range_lo, o_orderkey // 64 * 64 + 63 AS range_hi, o_orderkey, verdict FROM bad""",
)
def reconciled_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot and log are written and read back; the source has changed and lost rows since."""
    log = d.landed_log(spark, sf_dir)
    target, saved = new_path(spark, "target"), new_path(spark, "state")
    orders = d.table(spark, sf_dir, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))
    sync_once([(d.ORDERS, orders)], log, snapshot_at(), None, pos.last_position(log), target, saved, slice_bytes=d.SLICE_BYTES)
    now = state.current_state(targets.read_target(spark, target, d.ORDERS), d.ORDERS.key)
    values = [c for c in d.ORDERS.column_names if c != "o_orderkey"]
    return state.differing_rows(source_of_today(spark, sf_dir), now, "o_orderkey", values, leaf_keys=64, fanout=16)


# What a run has executed and is to reach, with holes in both.
EXECUTED = f"{d.UUIDS[0]}:100-300:900-950,{d.UUIDS[1]}:1-10:700-1600"
STOP_SET = f"{d.UUIDS[0]}:1-600:800-2000,{d.UUIDS[1]}:1-1500"
WANTED_SQL = f"""wanted AS (SELECT '{d.UUIDS[0]}' AS source_uuid, n AS gtid_no FROM range(1, 2001) AS t(n)
    WHERE n NOT BETWEEN 601 AND 799 AND n NOT BETWEEN 100 AND 300 AND n NOT BETWEEN 900 AND 950
  UNION ALL SELECT '{d.UUIDS[1]}', n FROM range(1, 1501) AS t(n) WHERE n NOT BETWEEN 1 AND 10 AND n NOT BETWEEN 700 AND 1600)"""


def number_set(spark: SparkSession, text: str) -> DataFrame:
    return explode_gtid_sets(spark.createDataFrame([(text,)], "s string"), "s", [])


def landing(spark: SparkSession, sf_dir: str):
    """A folder that the log lands in step by step: calls back after each step, then the next one lands."""
    log, folder = d.landed_log(spark, sf_dir), new_path(spark, "landing")

    def each(run) -> None:
        for first, last in d.step_bounds(log):
            d.land_step(log, folder, first, last)
            run()

    return folder, each


@query(
    "once_to_set",
    with_(LOG, events(), WANTED_SQL)
    + f""", seen AS (SELECT gtid_uuid, gtid_no, CAST(coalesce(sum({ROW_COUNT}) FILTER (op IN ('INSERT', 'UPDATE', 'DELETE')), 0)
        AS BIGINT) AS n_rows FROM ev GROUP BY ALL),
      held AS (SELECT DISTINCT gtid_uuid, gtid_no FROM log)
    SELECT w.source_uuid, w.gtid_no, coalesce(n_rows, 0) AS n_rows, h.gtid_no IS NOT NULL AS delivered
    FROM wanted w LEFT JOIN held h ON h.gtid_uuid = w.source_uuid AND h.gtid_no = w.gtid_no
      LEFT JOIN seen s ON s.gtid_uuid = w.source_uuid AND s.gtid_no = w.gtid_no""",
)
def drained_to_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log lands in three steps and is drained after each; every number of the set, and whether it came."""
    folder, each = landing(spark, sf_dir)
    path, checkpoint, saved = (new_path(spark, label) for label in ("events", "checkpoint", "numbers"))
    executed, stop = number_set(spark, EXECUTED), number_set(spark, STOP_SET)
    missing = []

    def run() -> None:
        log = stream_change_log(spark, folder)
        missing.append(jobs.once_to_set(log, executed, stop, sinks.append_sink(path, "a"), checkpoint, saved, "a"))

    each(run)
    numbers = F.explode(F.sequence("lo", "hi")).alias("gtid_no")
    gone = missing[-1].select("source_uuid", numbers)
    wanted = subtract_spans(stop, executed).select("source_uuid", numbers)
    came = sinks.read_batches(spark, path, CHANGE_LOG_SCHEMA)
    n_rows = F.sum(F.when(F.col("op").isin(*ROW_OPS), F.size("rows")).otherwise(0)).cast("bigint")
    counted = after_images(route_event_kind(came)).groupBy(F.col("gtid_uuid").alias("source_uuid"), "gtid_no").agg(n_rows.alias("n_rows"))
    states = wanted.join(gone.withColumn("delivered", F.lit(False)), ["source_uuid", "gtid_no"], "left")
    return states.join(counted, ["source_uuid", "gtid_no"], "left").select(
        "source_uuid", "gtid_no", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce("delivered", F.lit(True)).alias("delivered")
    )


LOST = "((file_no % 5 = 2) OR gtid_no BETWEEN 40 AND 60 OR gtid_no % 1000 = 77)"
LEFT_LOG = f"left_log AS (SELECT * FROM (SELECT *, CAST(right(binlog_file, 12) AS BIGINT) AS file_no FROM log) WHERE NOT {LOST})"


@query(
    "log_gaps",
    with_(LOG, LEFT_LOG)
    + """, f AS (SELECT 'mysql-bin' AS name, file_no AS n FROM left_log GROUP BY ALL),
      g AS (SELECT gtid_uuid AS name, gtid_no AS n FROM left_log GROUP BY ALL),
      b AS (SELECT 'file' AS kind, name, n, lag(n) OVER (PARTITION BY name ORDER BY n) AS before FROM f
        UNION ALL SELECT 'number', name, n, lag(n) OVER (PARTITION BY name ORDER BY n) FROM g)
    SELECT kind, name, before + 1 AS first_missing, n - 1 AS last_missing FROM b WHERE n > before + 1""",
)
def gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log that has lost files and single transactions."""
    log = d.landed_log(spark, sf_dir).withColumn("file_no", file_number())
    return log_gaps(log.where(f"NOT {LOST}"))


CAPACITY = 120


def forced_sql(steps: int) -> str:
    """Step by step, the open transactions and those that must make room."""
    out, gone = [], "FALSE"
    for s in range(1, steps + 1):
        out.append(f"o{s} AS (SELECT txn_id, count(*) AS n FROM open_rows WHERE step <= {s} AND NOT ({gone}) GROUP BY 1)")
        out.append(
            f"""f{s} AS (SELECT txn_id, {s} AS step FROM (SELECT txn_id, sum(n) OVER () AS t, coalesce(sum(n) OVER (
              ORDER BY n, txn_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM o{s}) WHERE t - b >= {CAPACITY})"""
        )
        gone += f" OR txn_id IN (SELECT txn_id FROM f{s})"
    union = " UNION ALL ".join(f"SELECT * FROM f{s}" for s in range(1, steps + 1))
    return ",".join(out) + f", forced AS ({union})"


@query(
    "capacity_gate",
    with_(
        LOG,
        events(),
        """files AS (SELECT max(CAST(right(binlog_file, 12) AS BIGINT) % 1000000000) AS last FROM log),
        stepped AS (SELECT *, gtid_uuid || ':' || gtid_no AS txn_id, CAST(right(binlog_file, 12) AS BIGINT) % 1000000000 AS f,
          bool_or(op = 'COMMIT') OVER (PARTITION BY gtid_uuid, gtid_no) AS closed FROM ev),
        all_rows AS (SELECT *, CASE WHEN f <= last // 3 THEN 1 WHEN f <= last * 2 // 3 THEN 2 ELSE 3 END AS step
          FROM stepped, files WHERE op IN ('INSERT', 'UPDATE', 'DELETE')),
        open_rows AS (SELECT * FROM all_rows WHERE NOT closed)""",
        forced_sql(3),
    )
    + """SELECT binlog_file, log_pos, a.txn_id, CASE WHEN closed THEN 'committed' WHEN forced.step IS NULL THEN 'held'
      ELSE 'forced' END AS state FROM all_rows a LEFT JOIN forced ON forced.txn_id = a.txn_id""",
)
def gated_by_capacity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three micro-batches of one step each; open transactions are held as far as the capacity goes."""
    folder, each = landing(spark, sf_dir)
    path, gate, checkpoint = (new_path(spark, label) for label in ("stream", "gate", "checkpoint"))
    sink = sinks.capacity_gate_sink(gate, "a", sinks.append_sink(path, "a"), CAPACITY)
    runs = []

    def run() -> None:
        stream = gtid_transaction(route_event_kind(stream_change_log(spark, folder)))
        runs.append(jobs.run_once(stream, sink, checkpoint))

    each(run)
    shape = gtid_transaction(route_event_kind(d.landed_log(spark, sf_dir))).schema
    out = sinks.read_batches(spark, path, T.StructType([*shape.fields, T.StructField("committed", T.BooleanType())]))
    last = out.agg(F.max("batch_id")).first()[0]
    state_ = F.when(F.col("committed"), F.lit("committed")).otherwise(F.lit("forced"))
    held = sinks.held_events(spark, gate, "a", last, shape).withColumn("state", F.lit("held"))
    columns = ("binlog_file", "log_pos", "txn_id", "state")
    return out.withColumn("state", state_).select(*columns).unionByName(held.select(*columns))


BATCH_ROWS = 300


@query(
    "exact_batches",
    with_(LOG, events(), images("ev"))
    + f"""SELECT source_table, row_no // {BATCH_ROWS} AS chunk_id, count(*) AS n_rows,
      min(binlog_file || ':' || log_pos) AS first_event FROM (SELECT *, row_number() OVER (
        PARTITION BY source_table ORDER BY binlog_file, log_pos, image_idx) - 1 AS row_no FROM img) GROUP BY 1, 2""",
)
def exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three micro-batches of one step each, written in batches of exactly 300 rows a table."""
    folder, each = landing(spark, sf_dir)
    path, checkpoint = new_path(spark, "batches"), new_path(spark, "checkpoint")
    table, order = ["source_table"], ["binlog_file", "log_pos", "image_idx"]
    sink = sinks.exact_batch_sink(path, "a", table, order, BATCH_ROWS)
    seen = []

    def write(batch: DataFrame, batch_id: int) -> None:
        seen.append(batch_id)
        sink(batch, batch_id)

    def run() -> None:
        rows = explode_row_images(after_images(row_events(route_event_kind(stream_change_log(spark, folder)))))
        jobs.run_once(rows.select(*table, *order), write, checkpoint)

    each(run)
    schema = T.StructType.fromDDL("source_table string, binlog_file string, log_pos bigint, image_idx int")
    rows = sinks.full_batches(spark, path, "a", schema).select(*schema.fieldNames(), "chunk_id")
    rows = rows.unionByName(sinks.flush_rest(spark, path, "a", max(seen), table, schema))
    first = F.min(F.concat("binlog_file", F.lit(":"), F.col("log_pos").cast("string")))
    return rows.groupBy(*table, "chunk_id").agg(F.count(F.lit(1)).alias("n_rows"), first.alias("first_event"))


class Stopped(Exception):
    """What ends a backfill half-way in the query below."""


@query(
    "restartable_backfill",
    with_(LOG, events(), TX, images("tx"))
    + f"""SELECT *, 'copied' AS origin FROM ({SNAPSHOT_ORDERS})
    UNION ALL SELECT *, 'log' AS origin FROM (SELECT {ORDER_ROWS} AND committed AND {START})""",
)
def backfilled_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backfill that stops after two steps and after one more, then ends, then hands over to the log."""
    log, orders = d.landed_log(spark, sf_dir), d.table(spark, sf_dir, "orders")
    target, ledger, saved = (new_path(spark, label) for label in ("raw", "ledger", "state"))
    rows = orders.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)")).select(*d.ORDERS.column_names)
    size = max(1, rows.count() // 20)

    def stop_after(steps: int):
        def after_step(n: int) -> None:
            if n == steps:
                raise Stopped

        return after_step

    for then, steps in ((log.where(pos.up_to(START_POSITION)), 2), (log, 1), (log, None)):
        try:
            restartable_backfill(
                rows, then, "o_orderkey", target, ledger, saved, chunk_rows=size, step_chunks=3,
                after_step=stop_after(steps) if steps else None,
            )
        except Stopped:
            continue
    out = follow_backfill(
        spark, rows, log, d.ORDERS, target, ledger, saved, snapshot_at(), pos.last_position(log), d.SLICE_BYTES
    )
    return out.withColumn("origin", F.when(F.col(CDC_OPERATION) == SNAPSHOT, F.lit("copied")).otherwise(F.lit("log")))


@query(
    "live_metrics",
    with_(LOG, events(), images("ev"))
    + """, s AS (SELECT *, CAST(right(binlog_file, 12) AS BIGINT) % 1000000000 AS f,
        (SELECT max(CAST(right(binlog_file, 12) AS BIGINT) % 1000000000) FROM log) AS last FROM img)
    SELECT source_db || '.' || source_table AS table_name, count(*) AS rows_written,
      count(DISTINCT CASE WHEN f <= last // 3 THEN 1 WHEN f <= last * 2 // 3 THEN 2 ELSE 3 END) AS batches_written,
      make_timestamp(max(event_ts_s) * 1000000) AS last_event_time, 1800000000 - max(event_ts_s) AS lag_s FROM s GROUP BY 1""",
)
def live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures that the sink itself keeps: three runs on one checkpoint, and a batch that is written twice."""
    folder, each = landing(spark, sf_dir)
    path, figures, checkpoint = (new_path(spark, label) for label in ("stream", "figures", "checkpoint"))

    def twice(batch: DataFrame, batch_id: int) -> None:
        # Figures are those of the rows written, so that the log is not taken apart again to count them.
        sink = counting_sink(sinks.append_sink(path, "a"), figures, "a", sinks.appended(path, "a", batch.schema))
        for _ in range(2 if batch_id == 1 else 1):
            sink(batch, batch_id)

    each(lambda: jobs.run_once(jobs.change_row_stream(stream_change_log(spark, folder)), twice, checkpoint))
    return live_tables(read_figures(spark, figures), F.timestamp_seconds(F.lit(1_800_000_000)))


# Seconds at which the rounds run: the first tries, then each retry when it is due.
ROUND_TIMES = (0.0, 1.0, 3.0, 3.5)
DONE_AFTER = "CAST(image[1] AS BIGINT) % 7"


@query(
    "retry_rounds",
    with_(LOG, events(), images("ev"))
    + f"""SELECT binlog_file, log_pos, image_idx, CAST(CASE WHEN need = 6 THEN 0 ELSE least(need, 2) END AS INTEGER) AS attempt,
      CASE WHEN need = 6 THEN 'ignored' WHEN need <= 2 THEN 'written' ELSE 'quarantine' END AS outcome,
      CAST(CASE WHEN need = 6 THEN 0 ELSE least(need, 2) END AS INTEGER) AS round FROM (
        SELECT *, {DONE_AFTER} AS need FROM img WHERE source_table = 'orders')""",
)
def retried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose write fails in passing some times: what becomes of each, when, and in which round."""
    key = ["binlog_file", "log_pos", "image_idx"]
    rows = explode_row_images(after_images(row_events(route_event_kind(d.landed_log(spark, sf_dir)))))
    rows = rows.where(F.col("source_table") == "orders").select(*key, "image")
    path, shape = new_path(spark, "rounds"), rows.schema
    needed = F.col("image")[0].cast("bigint") % 7

    def error(reason: str) -> Column:
        return F.array(F.struct(F.lit(reason).alias("reason"), F.lit("said the target").alias("message")))

    def attempt(given: DataFrame) -> DataFrame:
        none = F.array().cast("array<struct<reason:string,message:string>>")
        errors = F.when(needed == 6, error("duplicate")).when(needed > F.col("attempt"), error("backendError")).otherwise(none)
        return sinks.row_outcomes(given, d.ORDERS, named_columns(d.ORDERS.columns, strict=False), F.col("attempt"), errors)

    for number, now_s in enumerate(ROUND_TIMES):
        # The second round runs twice, as after a crash.
        for _ in range(2 if number == 1 else 1):
            retries.run_round(spark, path, number, attempt, key, now_s, rows if number == 0 else None, shape)
    kept = T.StructType([*shape.fields, T.StructField("attempt", T.IntegerType()), T.StructField("outcome", T.StringType())])
    return retries.last_outcomes(retries.read_rounds(spark, path, kept), key)


AUDIT = d.TableSpec(d.DATABASE, "audit", (d.ColumnSpec("order_no", "bigint", True), d.ColumnSpec("note", "string")), ("order_no",))
# Orders with a customer key too narrow for some, so that there are misfits.
NARROW_ORDERS = d.TableSpec(
    d.DATABASE, "orders", tuple(c._replace(spark_type="tinyint") if c.name == "o_custkey" else c for c in d.ORDERS.columns), d.ORDERS.key
)


@query(
    "typed_stream_targets",
    with_(LOG, events(), GTID_TX, images("tx"))
    + f"""SELECT source_table AS table_name, {INSERT_ID_SQL} AS _insert_id, CAST(image[1] AS BIGINT) AS key_1,
      CASE WHEN source_table = 'order_lines' THEN CAST(image[2] AS BIGINT) END AS key_2,
      CASE source_table WHEN 'orders' THEN CAST(image[4] AS DOUBLE) WHEN 'order_lines' THEN CAST(image[6] AS DOUBLE) END AS amount,
      CASE WHEN source_table = 'audit' THEN image[2] WHEN source_table = 'orders' AND TRY_CAST(image[2] AS BIGINT) > 127
        THEN 'value does not fit o_custkey' END AS note,
      coalesce(source_table = 'orders' AND TRY_CAST(image[2] AS BIGINT) > 127, FALSE) AS aside FROM img""",
)
def typed_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tables of different columns out of one stream, and the rows that do not fit."""
    folder, each = landing(spark, sf_dir)
    path, checkpoint = new_path(spark, "typed"), new_path(spark, "checkpoint")
    specs = [NARROW_ORDERS, d.ORDER_LINES, AUDIT]
    sink = typed.typed_sink(path, "a", specs)
    each(lambda: jobs.run_once(jobs.change_row_stream(stream_change_log(spark, folder)), sink, checkpoint))

    def side(rows: DataFrame, name: Column, key_1: str, key_2: Column, amount: Column, note: Column, aside: bool) -> DataFrame:
        return rows.select(
            name.alias("table_name"), "_insert_id", F.expr(key_1).cast("bigint").alias("key_1"), key_2.cast("bigint").alias("key_2"),
            amount.cast("double").alias("amount"), note.cast("string").alias("note"), F.lit(aside).alias("aside"),
        )

    orders, lines, audit = (typed.read_typed(spark, path, s) for s in specs)
    none, named = F.lit(None), [F.lit(s.table) for s in specs]
    bad = typed.read_quarantine(spark, path)
    return (
        side(orders, named[0], "o_orderkey", none, F.col("o_totalprice"), none, False)
        .unionByName(side(lines, named[1], "l_orderkey", F.col("line_no"), F.col("l_extendedprice"), none, False))
        .unionByName(side(audit, named[2], "order_no", none, none, F.col("note"), False))
        .unionByName(side(bad, F.col("_cdc_table"), "image[0]", none, F.col("image")[3], F.array_join("_reasons", "; "), True))
    )


# One micro-batch a step. A batch's watermark is the lesser of both sides' newest events less the delay; a row that
# is older on arrival is dropped, one that has waited for the bound is given up.
FORCED_PARTS = f"""files AS (SELECT max(CAST(right(binlog_file, 12) AS BIGINT) % 1000000000) AS last FROM log),
numbered AS (SELECT *, CAST(right(binlog_file, 12) AS BIGINT) % 1000000000 AS f FROM tx),
stepped AS (SELECT *, CASE WHEN f <= last // 3 THEN 1 WHEN f <= last * 2 // 3 THEN 2 ELSE 3 END AS step FROM numbered, files),
newest AS (SELECT step, max(event_ts_s) FILTER (op IN ('INSERT', 'UPDATE', 'DELETE')) AS r,
  max(event_ts_s) FILTER (op = 'COMMIT') AS c FROM stepped GROUP BY step),
marks AS (SELECT step + 1 AS step, least(max(r) OVER (ORDER BY step), max(c) OVER (ORDER BY step)) - 600 AS w FROM newest),
dated AS (SELECT s.*, coalesce(m.w, 0) AS w, (SELECT max(w) FROM marks) AS w_end FROM stepped s LEFT JOIN marks m USING (step))"""


@query(
    "force_flush",
    with_(LOG, events(), GTID_TX, FORCED_PARTS, images("dated"))
    + f"""SELECT * EXCLUDE (in_bound) REPLACE (CASE WHEN origin = 'stream' THEN in_bound ELSE committed END AS committed) FROM (
      SELECT {META}, array_to_string(image, '|') AS image, {INSERT_ID_SQL} AS _insert_id, committed,
        coalesce({IN_BOUND}, FALSE) AS in_bound, CASE WHEN event_ts_s > w AND (coalesce({IN_BOUND}, FALSE)
        OR event_ts_s <= w_end - 300) THEN 'stream' ELSE 'batch' END AS origin FROM img)""",
)
def flushed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the stream releases or gives up, and what it drops or still holds, settled by the batch form; with origins."""
    folder, each = landing(spark, sf_dir)
    path, checkpoint, kept = (new_path(spark, label) for label in ("stream", "checkpoint", "keys"))

    def run() -> None:
        keys = jobs.gated_keys(stream_change_log(spark, folder), lambda events: force_flush_stream(events, DELAY, BOUND))
        sink = jobs.change_rows_sink(kept, lambda: read_change_log(spark, folder), sinks.append_sink(path, "a"), ["committed"])
        jobs.run_once(keys, sink, checkpoint, state=True)

    each(run)
    shape = T.StructType([*CHANGE_ROW_SCHEMA.fields, T.StructField("committed", T.BooleanType())])
    out = sinks.read_batches(spark, path, shape).select(*shape.fieldNames())
    rest = jobs.leftovers(d.landed_log(spark, sf_dir), out).select(*shape.fieldNames())
    both = out.withColumn("origin", F.lit("stream")).unionByName(rest.withColumn("origin", F.lit("batch")))
    return both.withColumn("image", F.array_join("image", "|"))
