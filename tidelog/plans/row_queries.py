"""Registered queries: projections, types, transactions and errors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.identifiers import bytes_to_text, event_time, insert_id, route_key, route_splits
from tidelog.functions.mysql_types import infer_type, map_type, spark_type
from tidelog.model import INSERT_ID
from tidelog.operators.images import (
    after_images,
    explode_row_images,
    log_order,
    marker_events,
    missing_required,
    named_columns,
    route_event_kind,
    row_events,
)
from tidelog.operators.rows import cdc_metadata, generic_change_rows, rename_drop, typed_change_rows
from tidelog.operators.schema import derive_schema
from tidelog.operators.transactions import (
    assign_transaction,
    commit_gate,
    flush_pending,
    open_transaction_gauge,
    open_transactions_topk,
    txn_lifecycle,
    txn_totals,
)
from tidelog.operators.write_errors import batch_outcome, classify_rows, retry_order, retry_schedule, retryable_batches
from tidelog.plans.oracle import EVENT_TIME, INSERT_ID as INSERT_ID_SQL
from tidelog.plans.oracle import LINE_COLUMNS, LOG, META, ORDER_ROWS, TX, events, images, with_
from tidelog.plans.registry import query
from tidelog.plans.scan_queries import CATALOG_SQL
from tidelog.sources import derived as d


def log_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route_event_kind(d.landed_log(spark, sf_dir))


def assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_transaction(log_events(spark, sf_dir), d.SLICE_BYTES)


def all_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_row_images(after_images(row_events(log_events(spark, sf_dir))))


EV = with_(LOG, events())
EV_IMAGES = with_(LOG, events(), images("ev"))
TXN = with_(LOG, events(), TX)
TXN_IMAGES = with_(LOG, events(), TX, images("tx"))


@query("event_kind_route", EV + "SELECT binlog_file, log_pos, kind, op FROM ev")
def event_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_events(spark, sf_dir).select("binlog_file", "log_pos", "kind", "op")


@query("txn_markers", EV + "SELECT binlog_file, log_pos, op FROM ev WHERE op IN ('BEGIN', 'COMMIT')")
def markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marker_events(log_events(spark, sf_dir)).select("binlog_file", "log_pos", "op")


@query(
    "explode_row_images",
    EV
    + """SELECT binlog_file, log_pos, op, image_idx, array_to_string(image, '|') AS image
    FROM (SELECT *, unnest(imgs) AS image, CAST(generate_subscripts(imgs, 1) - 1 AS INTEGER) AS image_idx FROM ev
      WHERE op IN ('INSERT', 'UPDATE', 'DELETE'))""",
)
def exploded(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = explode_row_images(row_events(log_events(spark, sf_dir)))
    return rows.select("binlog_file", "log_pos", "op", "image_idx", F.array_join("image", "|").alias("image"))


@query(
    "after_image",
    EV_IMAGES + "SELECT binlog_file, log_pos, op, image_idx, array_to_string(image, '|') AS image FROM img",
)
def after(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = all_images(spark, sf_dir)
    return rows.select("binlog_file", "log_pos", "op", "image_idx", F.array_join("image", "|").alias("image"))


@query(
    "ordinal_to_name",
    EV_IMAGES + f"SELECT {LINE_COLUMNS} FROM img WHERE source_table = 'order_lines'",
)
def ordinal_to_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = all_images(spark, sf_dir).where(F.col("source_table") == d.ORDER_LINES.table)
    return rows.select(*named_columns(d.ORDER_LINES.columns))


@query("event_time", EV + f"SELECT binlog_file, log_pos, {EVENT_TIME} AS event_time FROM ev")
def event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = log_events(spark, sf_dir)
    return rows.select("binlog_file", "log_pos", event_time(F.col("event_ts_s")).alias("event_time"))


@query(
    "cdc_metadata",
    EV_IMAGES
    + f"""SELECT {EVENT_TIME} AS _cdc_timestamp, op AS _cdc_operation, source_db AS _cdc_database,
    image[3] AS _cdc_table, CAST(image[1] AS BIGINT) AS o_orderkey FROM img WHERE source_table = 'orders'""",
)
def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source column that bears the name of a metadata column wins over it."""
    rows = all_images(spark, sf_dir).where(F.col("source_table") == "orders")
    return rows.select(
        *cdc_metadata(
            event_time(F.col("event_ts_s")), F.col("op"), F.col("source_db"), F.col("source_table"), ["_cdc_table"]
        ),
        F.col("image")[2].alias("_cdc_table"),
        F.col("image")[0].cast("bigint").alias("o_orderkey"),
    )


@query("insert_id", TXN_IMAGES + f"SELECT {INSERT_ID_SQL} AS _insert_id, source_table FROM img")
def insert_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flush_pending(assigned(spark, sf_dir))
    return rows.select(
        insert_id(F.col("binlog_file"), F.col("log_pos"), F.col("txn_id"), F.col("image_idx")).alias(INSERT_ID),
        "source_table",
    )


@query("bytes_to_text", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def bytes_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = d.table(spark, sf_dir, "customer")
    raw = rows.select(
        "c_custkey", F.encode("c_name", "UTF-8").alias("c_name"), F.encode("c_mktsegment", "UTF-8").alias("c_mktsegment")
    )
    return bytes_to_text(raw)


@query(
    "route_key",
    EV_IMAGES
    + """SELECT source_db || '_' || source_table AS route_key,
    len(string_split(source_db || '_' || source_table, '_')) = 2 AS route_ok, count(*) AS n_rows
    FROM img GROUP BY 1, 2""",
)
def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = all_images(spark, sf_dir).select(route_key(F.col("source_db"), F.col("source_table")).alias("route_key"))
    return keyed.withColumn("route_ok", route_splits(F.col("route_key"))).groupBy("route_key", "route_ok").agg(
        F.count("*").alias("n_rows")
    )


@query(
    "rename_drop",
    """SELECT c_custkey AS "customerId", c_name AS name, c_nationkey, c_mktsegment FROM customer""",
)
def renamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = d.table(spark, sf_dir, "customer")
    return rename_drop(rows, {"c_custkey": "customerId", "c_name": "name"}, ["c_acctbal"])


@query("log_order", EV_IMAGES + "SELECT binlog_file, log_pos, image_idx, op FROM img ORDER BY 1, 2, 3")
def ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_order(all_images(spark, sf_dir)).select("binlog_file", "log_pos", "image_idx", "op")


# Expected target type per derived catalog type.
_TYPE_SQL = """CASE column_type WHEN 'int(11)' THEN 'INTEGER' WHEN 'bigint unsigned' THEN 'INTEGER'
  WHEN 'tinyint(1)' THEN 'BOOLEAN' WHEN 'TINYINT(4)' THEN 'INTEGER' WHEN 'decimal(12,2)' THEN 'NUMERIC'
  WHEN 'decimal(50,10)' THEN 'NUMERIC' WHEN ' Double ' THEN 'FLOAT' WHEN 'datetime(6)' THEN 'TIMESTAMP'
  WHEN 'date' THEN 'DATE' WHEN 'time' THEN 'TIME' WHEN 'year' THEN 'INTEGER' WHEN 'json' THEN 'JSON'
  WHEN 'varbinary(16)' THEN 'BYTES' ELSE 'STRING' END"""
_SPARK_SQL = """CASE column_type WHEN 'int(11)' THEN 'bigint' WHEN 'bigint unsigned' THEN 'decimal(20,0)'
  WHEN 'tinyint(1)' THEN 'boolean' WHEN 'TINYINT(4)' THEN 'bigint' WHEN 'decimal(12,2)' THEN 'decimal(12,2)'
  WHEN ' Double ' THEN 'double' WHEN 'datetime(6)' THEN 'timestamp' WHEN 'date' THEN 'date' WHEN 'year' THEN 'bigint'
  WHEN 'varbinary(16)' THEN 'binary' ELSE 'string' END"""


@query(
    "map_type",
    CATALOG_SQL
    + f"""SELECT table_name, ordinal_position, column_type, {_TYPE_SQL} AS target_type, {_SPARK_SQL} AS spark_type
    FROM catalog""",
)
def mapped_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("column_type")
    return d.column_catalog(spark, sf_dir).select(
        "table_name",
        "ordinal_position",
        "column_type",
        map_type(kind).alias("target_type"),
        spark_type(kind, F.col("numeric_precision"), F.col("numeric_scale")).alias("spark_type"),
    )


@query(
    "infer_type",
    """SELECT event_id, column_name, CASE column_name WHEN 'value' THEN 'FLOAT' WHEN 'user_id' THEN 'INTEGER'
      WHEN 'is_error' THEN 'BOOLEAN' WHEN 'k' THEN 'INTEGER' ELSE 'STRING' END AS inferred_type
    FROM events, (VALUES ('value'), ('user_id'), ('is_error'), ('k'), ('props'), ('event_type'), ('missing')) AS c(column_name)""",
)
def inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = F.create_map(
        F.lit("value"), F.col("value").cast("decimal(18,2)").cast("string"),
        F.lit("user_id"), F.col("user_id").cast("string"),
        F.lit("is_error"), (F.col("event_type") == "error").cast("string"),
        F.lit("k"), F.get_json_object("props", "$.k"),
        F.lit("props"), F.col("props"),
        F.lit("event_type"), F.col("event_type"),
        F.lit("missing"), F.lit("null"),
    )
    rows = d.table(spark, sf_dir, "events").select("event_id", F.explode(values).alias("column_name", "json_value"))
    return rows.select("event_id", "column_name", infer_type(F.col("json_value")).alias("inferred_type"))


@query(
    "derive_schema",
    CATALOG_SQL
    + f"""SELECT table_name, ordinal_position + 4 AS ordinal, column_name, {_TYPE_SQL} AS target_type,
      is_nullable = 'NO' AS required FROM catalog
    UNION ALL SELECT table_name, i, n, t, false FROM (SELECT DISTINCT table_name FROM catalog),
      (VALUES (1, '_cdc_timestamp', 'TIMESTAMP'), (2, '_cdc_operation', 'STRING'), (3, '_cdc_database', 'STRING'),
        (4, '_cdc_table', 'STRING')) AS m(i, n, t)""",
)
def derived_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_schema(d.column_catalog(spark, sf_dir)).drop("table_schema")


@query(
    "not_null_check",
    EV_IMAGES
    + """SELECT log_pos, binlog_file, image_idx, 'o_custkey' AS missing FROM img
    WHERE source_table = 'orders' AND CAST(image[2] AS BIGINT) > 127""",
)
def not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``o_custkey`` as a required one-byte column: larger keys do not fit and are missing."""
    narrow = tuple(
        c._replace(spark_type="tinyint", required=True) if c.name == "o_custkey" else c for c in d.ORDERS.columns
    )
    rows = all_images(spark, sf_dir).where(F.col("source_table") == "orders")
    typed = rows.select("log_pos", "binlog_file", "image_idx", *named_columns(narrow, strict=False))
    found = typed.withColumn("missing", F.array_join(missing_required(narrow), ","))
    return found.where(F.col("missing") != "").select("log_pos", "binlog_file", "image_idx", "missing")


@query(
    "assign_transaction",
    TXN
    + """SELECT binlog_file, log_pos, op, coalesce(txn_id, '') AS txn_id, coalesce(committed, false) AS committed FROM tx""",
)
def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that were delivered twice count once."""
    twice = route_event_kind(d.redelivered(d.landed_log(spark, sf_dir)))
    return assign_transaction(twice, d.SLICE_BYTES).select(
        "binlog_file",
        "log_pos",
        "op",
        F.coalesce("txn_id", F.lit("")).alias("txn_id"),
        F.coalesce("committed", F.lit(False)).alias("committed"),
    )


@query(
    "open_transaction_gauge",
    TXN
    + """, sized AS (SELECT *, CASE WHEN op = 'BEGIN' OR prev_op = 'BEGIN' THEN txn_id END AS own,
      sum(CASE WHEN op IN ('INSERT', 'UPDATE', 'DELETE') THEN 1 ELSE 0 END) OVER (
        PARTITION BY binlog_file, txn_id ORDER BY log_pos) AS n FROM tx)
    SELECT binlog_file, log_pos, op,
      CAST(sum(CASE WHEN op = 'BEGIN' THEN 1 WHEN op = 'COMMIT' AND own IS NOT NULL THEN -1 ELSE 0 END) OVER w AS BIGINT)
        AS open_transactions,
      CAST(sum(CASE WHEN own IS NULL OR op = 'BEGIN' THEN 0 WHEN op = 'COMMIT' THEN -n ELSE 1 END) OVER w AS BIGINT)
        AS pending_row_events
    FROM sized WINDOW w AS (ORDER BY binlog_file, log_pos)""",
)
def gauge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return open_transaction_gauge(log_events(spark, sf_dir), d.SLICE_BYTES)


PER_TXN = """, per AS (SELECT txn_id, count(*) FILTER (op IN ('INSERT', 'UPDATE', 'DELETE')) AS n_events,
  bool_or(op = 'COMMIT' OR coalesce(committed, false)) AS done FROM tx WHERE txn_id IS NOT NULL GROUP BY 1)
"""


@query(
    "txn_totals",
    TXN
    + PER_TXN
    + """SELECT count(*) FILTER (done) AS committed_transactions, count(*) FILTER (NOT done) AS open_transactions,
    CAST(coalesce(sum(n_events) FILTER (NOT done), 0) AS BIGINT) AS buffered_events FROM per""",
)
def totals_of_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return txn_totals(assigned(spark, sf_dir))


@query(
    "open_transactions_topk",
    TXN
    + PER_TXN
    + """SELECT txn_id, n_events, (SELECT coalesce(sum(n_events), 0) >= 1000 FROM per WHERE NOT done) AS over_capacity
    FROM per WHERE NOT done ORDER BY n_events, txn_id LIMIT 50""",
)
def smallest_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    return open_transactions_topk(assigned(spark, sf_dir), 50)


@query("commit_gate_batch", TXN_IMAGES + f"SELECT {ORDER_ROWS} AND committed")
def committed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_change_rows(commit_gate(assigned(spark, sf_dir)), d.ORDERS)


@query(
    "flush_pending",
    TXN_IMAGES
    + f"""SELECT {META}, array_to_string(image, '|') AS image, committed, {INSERT_ID_SQL} AS _insert_id FROM img""",
)
def pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = generic_change_rows(flush_pending(assigned(spark, sf_dir)), ["committed"])
    return rows.withColumn("image", F.array_join("image", "|"))


# A log that names its transactions badly: the same number in every file, none
# for one table, and every thirteenth COMMIT under a number of its own.
_SLOT = "(log_pos - 4) // 100000"


@query(
    "txn_lifecycle",
    EV
    + f""", named AS (SELECT binlog_file, log_pos, op, source_table,
      CASE WHEN source_table = 'audit' THEN NULL WHEN op = 'COMMIT' AND {_SLOT} % 13 = 0 THEN 'own_' || log_pos
        ELSE 'tx_' || ({_SLOT}) END AS given FROM ev),
    ids AS (SELECT *, coalesce(given, 'single_' || binlog_file || ':' || log_pos) AS txn_id FROM named),
    near AS (SELECT *, lag(op) OVER w AS before,
      first_value(CASE WHEN op IN ('BEGIN', 'COMMIT') THEN op END IGNORE NULLS) OVER (PARTITION BY txn_id
        ORDER BY binlog_file, log_pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS after
      FROM ids WINDOW w AS (PARTITION BY txn_id ORDER BY binlog_file, log_pos))
    SELECT binlog_file, log_pos, op, txn_id, CASE WHEN given IS NULL THEN 'committed' WHEN op = 'BEGIN' THEN 'begin'
      WHEN op = 'COMMIT' AND (before IS NULL OR before = 'COMMIT') THEN 'orphan_commit' WHEN op = 'COMMIT' THEN 'commit'
      WHEN after = 'COMMIT' THEN 'committed' WHEN after = 'BEGIN' THEN 'discarded' ELSE 'open' END AS status FROM near""",
)
def lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    slot = F.expr("(log_pos - 4) div 100000")
    given = (
        F.when(F.col("source_table") == "audit", F.lit(None).cast("string"))
        .when((F.col("op") == "COMMIT") & (slot % 13 == 0), F.concat(F.lit("own_"), F.col("log_pos").cast("string")))
        .otherwise(F.concat(F.lit("tx_"), slot.cast("string")))
    )
    named = log_events(spark, sf_dir).select("binlog_file", "log_pos", "op", given.alias("txn_id"))
    return txn_lifecycle(named, d.SLICE_BYTES)


# The class of each derived row error, by event type.
ERRORS_SQL = """fails AS (SELECT event_id, event_id // 100 AS batch_id, event_id % 100 AS row_index, event_type, user_id,
    CAST(event_id % 6 AS INTEGER) AS attempt, ts AS failed_at,
    CASE WHEN event_id % 100 >= 97 THEN 'permanent' WHEN event_type IN ('view', 'purchase') THEN 'ignored'
      WHEN event_type IN ('click', 'signup') THEN 'retry' ELSE 'permanent' END AS outcome FROM events)"""


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_rows(d.write_errors(spark, sf_dir), F.lit(d.ERROR_BATCH_ROWS))


@query("classify_row_error", with_(ERRORS_SQL) + "SELECT batch_id, row_index, outcome FROM fails")
def row_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classified(spark, sf_dir).select("batch_id", "row_index", "outcome")


@query(
    "batch_outcome",
    with_(ERRORS_SQL)
    + """SELECT *, CASE WHEN permanent_rows > 0 THEN 'failed' WHEN retry_rows = 0 THEN 'done' ELSE 'retry' END AS verdict
    FROM (SELECT batch_id, count(*) FILTER (outcome = 'retry') AS retry_rows,
      count(*) FILTER (outcome = 'ignored') AS ignored_rows, count(*) FILTER (outcome = 'permanent') AS permanent_rows
      FROM fails GROUP BY 1)""",
)
def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_outcome(classified(spark, sf_dir))


@query(
    "retry_order",
    with_(ERRORS_SQL) + "SELECT batch_id, row_index, event_id FROM fails WHERE outcome = 'retry' ORDER BY 1, 2",
)
def rows_to_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retry_order(classified(spark, sf_dir)).select("batch_id", "row_index", "event_id")


@query(
    "retry_schedule",
    with_(ERRORS_SQL)
    + """SELECT event_id, attempt, least(CAST(2 ** attempt AS DOUBLE), 10.0) AS delay_s,
    failed_at + to_seconds(CAST(least(2 ** attempt, 10) AS INTEGER)) AS next_attempt_at, attempt + 1 >= 3 AS exhausted
    FROM fails""",
)
def schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = retry_schedule(d.write_errors(spark, sf_dir), "attempt", "failed_at", max_s=10)
    return planned.select("event_id", "attempt", "delay_s", "next_attempt_at", "exhausted")


@query(
    "batch_retryable",
    with_(ERRORS_SQL)
    + """SELECT event_id, user_id % 4 IN (0, 2) OR event_type IN ('click', 'view') AS retryable FROM fails""",
)
def retryable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retryable_batches(d.write_errors(spark, sf_dir)).select("event_id", "retryable")
