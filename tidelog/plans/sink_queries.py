"""Registered queries: targets and streams, written and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.identifiers import event_time
from tidelog.model import CDC_TIMESTAMP, CHANGE_ROW_SCHEMA, INSERT_ID
from tidelog.operators import positions as pos
from tidelog.operators.images import after_images, explode_row_images, named_columns, route_event_kind, row_events
from tidelog.operators.rows import generic_change_rows
from tidelog.operators.transactions import commit_gate, gtid_transaction
from tidelog.plans.oracle import (
    INSERT_ID as INSERT_ID_SQL,
)
from tidelog.plans.oracle import (
    LAST_XID,
    LOG,
    META,
    ORDER_COLUMNS,
    ORDER_ROWS,
    SNAPSHOT_ORDERS,
    START,
    TX,
    events,
    images,
    with_,
)
from tidelog.plans.registry import query
from tidelog.plans.row_queries import assigned
from tidelog.plans.scan_queries import START_POSITION, snapshot_at
from tidelog.plans.sync import backfill, catch_up_rows, sync_once
from tidelog.session import new_path
from tidelog.sinks import targets
from tidelog.sources import derived as d
from tidelog.sources.change_log import read_change_log, stream_change_log
from tidelog.sources.tables import snapshot_scan
from tidelog.streaming import jobs, sinks
from tidelog.streaming.gate import commit_gate_stream, stream_dedup
from tidelog.streaming.live import read_figures

TXN_IMAGES = with_(LOG, events(), TX, images("tx"))
GTID_TX = """tx AS (SELECT *, gtid_uuid || ':' || gtid_no AS txn_id, event_ts_s AS ts, bool_or(op = 'COMMIT') OVER (
    PARTITION BY gtid_uuid, gtid_no) AS committed, max(CASE WHEN op = 'COMMIT' THEN event_ts_s END) OVER (
    PARTITION BY gtid_uuid, gtid_no) AS commit_ts_s FROM ev)"""
GTID_IMAGES = with_(LOG, events(), GTID_TX, images("tx"))
ROWS = f"SELECT {META}, array_to_string(image, '|') AS image, {INSERT_ID_SQL} AS _insert_id FROM img"
DELAY, BOUND = "10 minutes", "5 minutes"


def flat(rows: DataFrame) -> DataFrame:
    return rows.select(*CHANGE_ROW_SCHEMA.fieldNames()).withColumn("image", F.array_join("image", "|"))


def committed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generic_change_rows(commit_gate(assigned(spark, sf_dir)))


@query("append_change_rows", TXN_IMAGES + ROWS + " WHERE committed")
def appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "target")
    targets.append_change_rows(committed_rows(spark, sf_dir), path)
    return flat(targets.read_targets(spark, path))


@query("read_target", TXN_IMAGES + f"SELECT {ORDER_ROWS} AND committed")
def one_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "target")
    targets.append_change_rows(committed_rows(spark, sf_dir), path)
    return targets.read_target(spark, path, d.ORDERS)


@query("idempotent_append", TXN_IMAGES + f"SELECT {ORDER_ROWS} AND committed")
def appended_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files behind the first arrive twice, and the whole batch is then written again."""
    path = new_path(spark, "target")
    log = d.redelivered(d.landed_log(spark, sf_dir))
    rows = targets.add_time_partition(
        catch_up_rows(log, d.ORDERS, None, pos.last_position(log), slice_bytes=d.SLICE_BYTES),
        "_cdc_timestamp",
        "day",
    )
    # The log's own times bound those of its rows; the gate need not run to find them.
    times = log.agg(*(targets.period_text(event_time(f("event_ts_s")), "day") for f in (F.min, F.max))).first()
    for _ in range(2):
        targets.idempotent_append(
            rows, path, partition=["_cdc_period"], prune="_cdc_period", bounds=tuple(times), single=True
        )
    return spark.read.parquet(path).drop("_cdc_period")


@query("ensure_target", SNAPSHOT_ORDERS)
def created(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second call finds the table and leaves it as it is."""
    database = f"tidelog_{uuid.uuid4().hex}"
    location = new_path(spark, "database")
    for _ in range(2):
        name = targets.ensure_target(spark, database, d.ORDERS, location)
    rows = d.table(spark, sf_dir, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))
    targets.append_to_table(snapshot_scan(rows, d.DATABASE, "orders", d.ORDERS.key, snapshot_at()), name)
    return spark.table(name)


def write_by_month(spark: SparkSession, sf_dir: str) -> str:
    path = new_path(spark, "periods")
    targets.write_time_partitioned(d.table(spark, sf_dir, "lineitem"), path, "l_shipdate", "month")
    return path


BY_MONTH = """SELECT strftime(date_trunc('month', l_shipdate), '%Y-%m-%d') AS period, count(*) AS n_rows,
  CAST(sum(l_quantity) AS BIGINT) AS quantity FROM lineitem"""


def by_month(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.col("_cdc_period").cast("string").alias("period")).agg(
        F.count("*").alias("n_rows"), F.sum("l_quantity").cast("bigint").alias("quantity")
    )


@query("time_partitioned_target", BY_MONTH + " GROUP BY 1")
def partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_month(spark.read.parquet(write_by_month(spark, sf_dir)))


@query("expire_partitions", BY_MONTH + " WHERE l_shipdate >= TIMESTAMP '1998-03-01 00:00:00' GROUP BY 1")
def expired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders up to 1997 are deleted; of the rest, what expired by March 1998 is not read."""
    path = write_by_month(spark, sf_dir)
    targets.expire_partitions(spark, path, "_cdc_period", "1998-01-01")
    now = F.lit("2000-03-20 00:00:00").cast("timestamp")
    return by_month(targets.retained(spark.read.parquet(path), "_cdc_period", "month", now, 720 * 86_400))


@query("raw_backfill_append", "SELECT * FROM lineitem")
def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "raw")
    targets.raw_append(d.table(spark, sf_dir, "lineitem"), path)
    return spark.read.parquet(path)


# Orders with a narrower customer key, and errors that the sink reports.
NARROW = d.TableSpec(
    d.DATABASE,
    "orders",
    tuple(c._replace(spark_type="tinyint", required=True) if c.name == "o_custkey" else c for c in d.ORDERS.columns),
)


def with_outcomes(rows: DataFrame) -> DataFrame:
    key, status = F.col("image")[0].cast("bigint"), F.col("image")[2]
    reported = F.when(
        status == "P", F.array(F.struct(F.lit("backendError").alias("reason"), F.lit("try again").alias("message")))
    ).when(
        key % 3 == 0,
        F.array(F.struct(F.lit(None).cast("string").alias("reason"), F.lit("duplicate row").alias("message"))),
    )
    none = F.array().cast("array<struct<reason:string,message:string>>")
    ours = rows.where((F.col("source_db") == NARROW.database) & (F.col("source_table") == NARROW.table))
    tried = (F.col("log_pos") % 5).cast("int")
    return sinks.row_outcomes(ours, NARROW, named_columns(NARROW.columns, strict=False), tried, F.coalesce(reported, none))


OUTCOMES = f"""SELECT binlog_file, log_pos, image_idx, CAST(image[1] AS BIGINT) AS o_orderkey, n_errors, attempt,
    least(2.0 ** attempt, 30.0) AS retry_delay_s,
    CASE WHEN n_errors = 0 THEN 'written' WHEN s = 'dup' THEN 'ignored'
      WHEN s = 'again' AND attempt < 2 THEN 'retry' ELSE 'quarantine' END AS outcome
  FROM (SELECT *, CAST(log_pos % 5 AS INTEGER) AS attempt,
    CASE WHEN image[3] = 'P' THEN 'again' WHEN CAST(image[1] AS BIGINT) % 3 = 0 THEN 'dup' ELSE '' END AS s,
    CASE WHEN CAST(image[2] AS BIGINT) > 127 THEN 1 ELSE 0 END + CASE WHEN s <> '' THEN 1 ELSE 0 END AS n_errors
    FROM img WHERE source_table = 'orders')"""
OUTCOME_COLUMNS = (
    "binlog_file", "log_pos", "image_idx", "o_orderkey", "n_errors", "attempt", "retry_delay_s", "outcome",
)


@query(
    "quarantine_append",
    with_(LOG, events(), images("ev")) + f"SELECT * FROM ({OUTCOMES}) WHERE outcome = 'quarantine'",
)
def quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good and bad rows in one write; only the folder of the bad ones is read."""
    path = new_path(spark, "outcomes")
    rows = explode_row_images(after_images(row_events(route_event_kind(d.landed_log(spark, sf_dir)))))
    sinks.outcome_sink(path, "batch")(with_outcomes(rows), 0)
    found = spark.read.parquet(sinks.batch_folder(path, "batch", 0)).where(F.col("outcome") == sinks.QUARANTINE)
    return found.withColumn("n_errors", F.size("errors")).select(*OUTCOME_COLUMNS)


def steps(spark: SparkSession, sf_dir: str, most_files: int | None = None) -> DataFrame:
    folder = d.landed_steps(spark, sf_dir, most_files)
    return stream_change_log(spark, folder, max_files=d.files_per_step(spark, sf_dir, most_files))


def drained(spark: SparkSession, rows: DataFrame, schema: T.StructType | None = None, state: bool = False) -> DataFrame:
    """Run a stream until it is drained and read its output."""
    path = new_path(spark, "stream")
    jobs.run_once(rows, sinks.append_sink(path, "a"), new_path(spark, "checkpoint"), state)
    return sinks.read_batches(spark, path, schema or rows.schema)


IN_BOUND = "commit_ts_s BETWEEN event_ts_s AND event_ts_s + 300"


@query(
    "commit_gate",
    GTID_IMAGES
    + ROWS.replace(" FROM img", f", CASE WHEN {IN_BOUND} THEN 'stream' ELSE 'batch' END AS origin FROM img WHERE committed"),
)
def gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Released by the stream, and what its bounds left out settled by the batch form, each row with its origin."""
    path, folder = new_path(spark, "stream"), d.landed_steps(spark, sf_dir, d.GATE_FILES_PER_STEP)
    keys = jobs.gated_keys(steps(spark, sf_dir, d.GATE_FILES_PER_STEP), lambda events: commit_gate_stream(events, DELAY, BOUND))
    sink = jobs.change_rows_sink(new_path(spark, "keys"), lambda: read_change_log(spark, folder), sinks.append_sink(path, "a"))
    jobs.run_once(keys, sink, new_path(spark, "checkpoint"), state=True)
    released = sinks.read_batches(spark, path, CHANGE_ROW_SCHEMA)
    rest = jobs.leftovers(d.landed_log(spark, sf_dir), released).where("committed")
    return flat(released).withColumn("origin", F.lit("stream")).unionByName(flat(rest).withColumn("origin", F.lit("batch")))


@query("commit_gate_by_position", TXN_IMAGES + ROWS + " WHERE committed")
def gated_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate for a log whose events carry no transaction numbers."""
    path = new_path(spark, "stream")
    keep = sinks.append_sink(path, "a")

    def deliver(released: DataFrame, batch_id: int) -> None:
        keep(generic_change_rows(explode_row_images(after_images(released))), batch_id)

    gate = sinks.position_gate_sink(new_path(spark, "gate"), "a", deliver, d.SLICE_BYTES)
    plain = steps(spark, sf_dir).drop("gtid_uuid", "gtid_no")
    jobs.run_once(route_event_kind(plain), gate, new_path(spark, "checkpoint"))
    return flat(sinks.read_batches(spark, path, CHANGE_ROW_SCHEMA))


@query("stream_dedup", GTID_IMAGES + ROWS)
def deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every step of the log arrives a second time; the window is wider than a step."""
    log = d.landed_log(spark, sf_dir)
    path = new_path(spark, "twice")
    steps, files = d.step_shape(log)
    for first, last in d.step_bounds(log, steps):
        for _ in range(2):
            d.land_step(log, path, first, last, files)
    rows = jobs.change_row_stream(stream_change_log(spark, path, max_files=files))
    return flat(drained(spark, stream_dedup(rows, "_cdc_timestamp", "2 days", INSERT_ID), state=True))


@query("continuous_mode", GTID_IMAGES + ROWS.replace(" FROM img", ", count(*) OVER () AS rows_counted FROM img"))
def continuous(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "stream")
    rows = jobs.change_row_stream(steps(spark, sf_dir))
    sink, figures = sinks.idempotent_sink(path, "a", CDC_TIMESTAMP), new_path(spark, "figures")
    running = jobs.start_continuous(rows, sink, new_path(spark, "checkpoint"), 0.1, (figures, "a"))
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    written = flat(sinks.read_batches(spark, path, rows.schema))
    # The job's own count goes beside the rows, which are all of the run.
    counted = read_figures(spark, figures).agg(F.sum("n_rows").alias("rows_counted"))
    return written.crossJoin(F.broadcast(counted))  # one row


@query(
    "once_mode",
    with_(LOG, LAST_XID, events(), GTID_TX, images("tx"))
    + f"""{ROWS}, stop WHERE {START} AND (binlog_file < stop_file OR (binlog_file = stop_file AND log_pos <= stop_pos))""",
)
def once(spark: SparkSession, sf_dir: str) -> DataFrame:
    stop = pos.last_position(d.landed_log(spark, sf_dir).where(F.col("kind") == "XID"))
    return flat(drained(spark, jobs.change_row_stream(steps(spark, sf_dir), START_POSITION, stop)))


@query("resume", GTID_IMAGES + ROWS)
def resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs on one checkpoint, more log landing in between, then a full replay under a new one."""
    log = d.landed_log(spark, sf_dir)
    landed, path, checkpoint = (new_path(spark, label) for label in ("resume", "stream", "checkpoint"))

    def run(name: str, at: str) -> DataFrame:
        rows = jobs.change_row_stream(stream_change_log(spark, landed, max_files=d.MOST_FILES_PER_STEP))
        jobs.run_once(rows, sinks.idempotent_sink(path, name, CDC_TIMESTAMP), at)
        return rows

    # Files land in log order, so that a micro-batch of a bounded number of them has rows of a few days.
    bounds = d.step_bounds(log, max(2, d.step_shape(log)[0]))
    half = -(-len(bounds) // 2)
    for part in (bounds[:half], bounds[half:]):
        for first, last in part:
            d.land_step(log, landed, first, last)
        run("a", checkpoint)
    rows = run("b", new_path(spark, "checkpoint"))
    return flat(sinks.read_batches(spark, path, rows.schema))


@query("partial_failure_split", with_(LOG, events(), images("ev")) + OUTCOMES)
def split(spark: SparkSession, sf_dir: str) -> DataFrame:
    events_ = route_event_kind(steps(spark, sf_dir))
    rows = with_outcomes(explode_row_images(after_images(row_events(events_))))
    path = new_path(spark, "stream")
    jobs.run_once(rows, sinks.outcome_sink(path, "a"), new_path(spark, "checkpoint"))
    found = sinks.read_batches(spark, path, rows.schema)
    return found.withColumn("n_errors", F.size("errors")).select(*OUTCOME_COLUMNS)


@query("row_emitter", with_(LOG, events(), images("ev")) + "SELECT source_table, count(*) AS n_rows FROM img GROUP BY 1")
def emitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A consumer of the caller's own that keeps counts per table and batch."""
    path = new_path(spark, "emitted")

    def emit(batch: DataFrame, batch_id: int) -> None:
        counts = batch.groupBy("source_table").agg(F.count("*").alias("n"))
        counts.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    rows = explode_row_images(after_images(row_events(route_event_kind(steps(spark, sf_dir)))))
    jobs.run_once(rows, sinks.row_emitter(emit), new_path(spark, "checkpoint"))
    return spark.read.parquet(path).groupBy("source_table").agg(F.sum("n").alias("n_rows"))


@query(
    "on_flush",
    TXN_IMAGES
    + f"""SELECT {META}, {ORDER_COLUMNS}, {INSERT_ID_SQL} AS _insert_id FROM img
    WHERE source_table = 'orders' AND committed AND op = 'UPDATE'""",
)
def on_flush(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A step of the caller's own on the released rows: keep the updates."""
    log = d.landed_log(spark, sf_dir)
    return catch_up_rows(
        log,
        d.ORDERS,
        None,
        pos.last_position(log),
        slice_bytes=d.SLICE_BYTES,
        transform=lambda rows: rows.where(F.col("op") == "UPDATE"),
    )


@query(
    "sync_once",
    with_(LOG, f"behind AS (SELECT * FROM log WHERE {START})", events("behind"), TX, images("tx"))
    + f"""{SNAPSHOT_ORDERS} UNION ALL SELECT {ORDER_ROWS} AND committed""",
)
def synced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and customers go into one target in one write; the orders are read back."""
    log = d.landed_log(spark, sf_dir)
    target, state = new_path(spark, "target"), new_path(spark, "state")
    orders = d.table(spark, sf_dir, "orders").withColumns(
        {"o_totalprice": F.col("o_totalprice").cast("decimal(18,2)")}
    )
    tables = [(d.ORDERS, orders), (d.CUSTOMERS, d.table(spark, sf_dir, "customer"))]
    stop = pos.last_position(log)
    reached = sync_once(tables, log, snapshot_at(), START_POSITION, stop, target, state, slice_bytes=d.SLICE_BYTES)
    if pos.load_high_water(spark, state) != reached:
        raise RuntimeError("the point to go on from was not saved")
    return targets.read_target(spark, target, d.ORDERS)


# Inside a transaction that never commits, and inside one that does so later.
STOPS = (pos.Position("mysql-bin.000000000001", 88_000_404), pos.Position("mysql-bin.000000000002", 20_000_404))


@query("sync_in_steps", TXN_IMAGES + f"SELECT {ORDER_ROWS} AND committed")
def synced_in_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs whose stops lie inside transactions give what one run gives, row for row."""
    log = d.landed_log(spark, sf_dir)
    target, state = new_path(spark, "target"), new_path(spark, "state")
    orders = [(d.ORDERS, d.table(spark, sf_dir, "orders"))]
    for stop in (*STOPS, pos.last_position(log)):
        sync_once(orders, log, None, pos.load_high_water(spark, state), stop, target, state, slice_bytes=d.SLICE_BYTES)
    return targets.read_target(spark, target, d.ORDERS)


@query(
    "backfill_handoff",
    with_(LOG)
    + """SELECT c_custkey, c_name, c_acctbal, binlog_file, log_pos FROM customer,
    (SELECT binlog_file, log_pos FROM log ORDER BY binlog_file DESC, log_pos DESC LIMIT 1) WHERE c_acctbal > 0""",
)
def backfilled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the backfill beside the position from which the log takes over."""
    target, state = new_path(spark, "raw"), new_path(spark, "state")
    rows = d.table(spark, sf_dir, "customer")
    backfill(spark, rows, d.landed_log(spark, sf_dir), target, state, "c_acctbal > 0")
    start = pos.load_high_water(spark, state)
    return spark.read.parquet(target).select(
        "c_custkey",
        "c_name",
        "c_acctbal",
        F.lit(start.binlog_file).alias("binlog_file"),
        F.lit(start.log_pos).cast("bigint").alias("log_pos"),
    )
