"""Registered queries: sources, positions and the flagship job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.model import Position
from tidelog.operators import positions as pos
from tidelog.operators.images import after_images, explode_row_images, route_event_kind, row_events
from tidelog.functions.gtid import explode_gtid_sets
from tidelog.operators.transactions import assign_transaction
from tidelog.plans.oracle import (
    LAST_XID,
    LOG,
    ORDER_ROWS,
    SNAPSHOT_ORDERS,
    SNAPSHOT_TIME,
    START,
    TX,
    events,
    images,
    with_,
)
from tidelog.plans.registry import query
from tidelog.plans.sync import snapshot_plus_catch_up
from tidelog.session import new_path
from tidelog.sources import derived as d
from tidelog.sources.catalog import column_catalog_scan
from tidelog.sources.change_log import select_log_tables
from tidelog.sources.tables import backfill_scan, pk_ordered_scan, snapshot_scan

START_POSITION = Position("mysql-bin.000000000001", 5_000_000)


def snapshot_at() -> Column:
    return F.lit("2024-06-01 00:00:00").cast("timestamp")


@query(
    "snapshot_scan",
    f"""SELECT {SNAPSHOT_TIME} AS _cdc_timestamp, 'SNAPSHOT' AS _cdc_operation, 'shop' AS _cdc_database,
    'customer' AS _cdc_table, c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
    'snapshot:shop.customer:' || c_custkey AS _insert_id, 'mysql-bin.000000000001' AS start_file,
    CAST(5000000 AS BIGINT) AS start_pos FROM customer""",
)
def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = d.table(spark, sf_dir, "customer")
    out = snapshot_scan(rows, d.DATABASE, "customer", ["c_custkey"], snapshot_at(), START_POSITION)
    return out.withColumn("start_pos", F.col("start_pos").cast("bigint"))


@query("backfill_scan", "SELECT * FROM lineitem")
def backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backfill_scan(d.table(spark, sf_dir, "lineitem"))


@query(
    "filtered_backfill",
    "SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01 00:00:00' AND l_quantity < 25",
)
def filtered_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backfill_scan(
        d.table(spark, sf_dir, "lineitem"), "l_shipdate >= timestamp_ntz '1998-01-01 00:00:00' AND l_quantity < 25"
    )


@query("pk_ordered_scan", "SELECT * FROM orders ORDER BY o_orderkey")
def pk_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pk_ordered_scan(d.table(spark, sf_dir, "orders"), ["o_orderkey"])


@query(
    "change_log_scan",
    with_(LOG)
    + """SELECT binlog_file, log_pos, event_ts_s, kind, coalesce(query, '') AS query,
    coalesce(source_table, '') AS source_table, gtid_uuid, gtid_no, coalesce(len(imgs), 0) AS n_images FROM log""",
)
def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.landed_log(spark, sf_dir).select(
        "binlog_file",
        "log_pos",
        "event_ts_s",
        "kind",
        F.coalesce("query", F.lit("")).alias("query"),
        F.coalesce("source_table", F.lit("")).alias("source_table"),
        "gtid_uuid",
        "gtid_no",
        F.when(F.col("rows").isNull(), 0).otherwise(F.size("rows")).cast("bigint").alias("n_images"),
    )


CATALOG_SQL = f"""WITH kinds AS (SELECT * FROM (VALUES {", ".join(
    f"({i}, '{t}', '{c.replace("'", "''")}', {n if n is not None else 'NULL'}, {s if s is not None else 'NULL'})"
    for i, (t, c, n, s) in enumerate(d.CATALOG_TYPES))}) AS v(i, data_type, column_type, prec, scale)),
catalog AS (SELECT 'shop' AS table_schema, 't' || (p_partkey // 20) AS table_name,
  CAST(p_partkey % 20 + 1 AS INTEGER) AS ordinal_position,
  replace(p_name, ' ', '-') || '_' || (p_partkey % 20 + 1) AS column_name, data_type, column_type,
  CASE WHEN p_size % 2 = 0 THEN 'NO' ELSE 'YES' END AS is_nullable, prec, scale
  FROM part JOIN kinds ON i = p_partkey % {len(d.CATALOG_TYPES)})
"""


@query(
    "column_catalog_scan",
    CATALOG_SQL
    + """SELECT table_schema, table_name, ordinal_position, column_name, data_type, column_type, is_nullable,
    CAST(CASE WHEN data_type = 'varchar' THEN 255 ELSE 0 END AS BIGINT) AS character_maximum_length,
    CAST(coalesce(prec, 0) AS BIGINT) AS numeric_precision, CAST(coalesce(scale, 0) AS BIGINT) AS numeric_scale
    FROM catalog""",
)
def catalog_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = column_catalog_scan(d.column_catalog(spark, sf_dir), d.DATABASE)
    return found.drop("column_default").fillna(0)


@query(
    "high_water_scan",
    with_(LOG)
    + """SELECT CAST(1 AS BIGINT) AS save_no, binlog_file, log_pos, CAST(1717200000 AS BIGINT) AS saved_at_s
    FROM log ORDER BY binlog_file DESC, log_pos DESC LIMIT 1""",
)
def high_water_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An early point is saved first; the newest one must be found."""
    log = d.landed_log(spark, sf_dir)
    path = new_path(spark, "high-water")
    if pos.load_high_water(spark, path) is not None:
        raise RuntimeError("a first run has no saved position")
    pos.save_high_water(spark, path, START_POSITION, 1717100000)
    pos.save_high_water(spark, path, pos.last_position(log), 1717200000)
    return pos.high_water_scan(spark, path)


@query(
    "high_water_save",
    with_(LOG, events(), TX)
    + """SELECT CAST(0 AS BIGINT) AS save_no, binlog_file, log_pos, CAST(1717200000 AS BIGINT) AS saved_at_s
    FROM tx WHERE committed ORDER BY binlog_file DESC, log_pos DESC LIMIT 1""",
)
def high_water_save(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last released row event is the point to go on from."""
    released = assign_transaction(route_event_kind(d.landed_log(spark, sf_dir)), d.SLICE_BYTES).where("committed")
    path = new_path(spark, "high-water")
    pos.save_high_water(spark, path, pos.last_position(released), 1717200000)
    return pos.high_water_scan(spark, path)


@query(
    "resume_filter",
    with_(LOG) + f"SELECT binlog_file, log_pos, kind, gtid_no FROM log WHERE {START}",
)
def resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = d.landed_log(spark, sf_dir)
    path = new_path(spark, "high-water")
    pos.save_high_water(spark, path, START_POSITION, 0)
    start = pos.starting_position(log, pos.load_high_water(spark, path))
    return pos.resume_filter(log, start).select("binlog_file", "log_pos", "kind", "gtid_no")


@query(
    "resume_log",
    with_(LOG) + f"SELECT binlog_file, log_pos, kind, gtid_no FROM log WHERE {START}",
)
def resume_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log has lost its first numbers and the reader has executed none of them: the position decides."""
    log = d.landed_log(spark, sf_dir)
    kept = log.where(F.col("gtid_no") > 2)
    out = pos.resume_log(kept, executed_intervals(spark, sf_dir).withColumn("lo", F.lit(3)), START_POSITION)
    return out.select("binlog_file", "log_pos", "kind", "gtid_no")


@query(
    "catch_up_range",
    with_(LOG)
    + f""", {LAST_XID} SELECT binlog_file, log_pos, kind, gtid_no FROM log, stop
    WHERE {START} AND (binlog_file < stop_file OR (binlog_file = stop_file AND log_pos <= stop_pos))""",
)
def catch_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = d.landed_log(spark, sf_dir)
    stop = pos.last_position(log.where(F.col("kind") == "XID"))
    return pos.catch_up_range(log, START_POSITION, stop).select("binlog_file", "log_pos", "kind", "gtid_no")



def executed_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a reader has executed that came to the start point."""
    log = d.landed_log(spark, sf_dir)
    return pos.executed_gtids(log.where(~pos.after(START_POSITION)))


@query(
    "gtid_resume_filter",
    with_(LOG)
    + f""", done AS (SELECT DISTINCT gtid_uuid AS done_uuid, gtid_no AS done_no FROM log WHERE NOT {START})
    SELECT binlog_file, log_pos, kind, gtid_uuid, gtid_no FROM log
    LEFT JOIN done ON done_uuid = gtid_uuid AND done_no = gtid_no WHERE done_no IS NULL""",
)
def gtid_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = d.landed_log(spark, sf_dir)
    out = pos.gtid_resume_filter(log, executed_intervals(spark, sf_dir))
    return out.select("binlog_file", "log_pos", "kind", "gtid_uuid", "gtid_no")


GTID_SETS_SQL = f"""texts AS (SELECT o_orderkey AS set_id, o_orderkey // 2 + 1 AS n FROM orders),
spans AS (SELECT set_id, '{d.UUIDS[0]}' AS source_uuid, n AS lo, n + 4 AS hi FROM texts
  UNION ALL SELECT set_id, '{d.UUIDS[0]}', n + 5, n + 5 FROM texts
  UNION ALL SELECT set_id, '{d.UUIDS[0]}', n + 3, n + 8 FROM texts
  UNION ALL SELECT set_id, '{d.UUIDS[1]}', CASE WHEN set_id % 7 = 0 THEN n + 1000000000 ELSE n END,
    CASE WHEN set_id % 7 = 0 THEN n + 1000000000 ELSE n END FROM texts)"""


@query(
    "gtid_intervals",
    with_(GTID_SETS_SQL)
    + """SELECT set_id, source_uuid, min(lo) AS lo, max(hi) AS hi FROM (
      SELECT *, sum(CASE WHEN lo > reach + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY set_id, source_uuid ORDER BY lo, hi) AS g
      FROM (SELECT *, max(hi) OVER (PARTITION BY set_id, source_uuid ORDER BY lo, hi
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM spans)) GROUP BY set_id, source_uuid, g""",
)
def gtid_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_gtid_sets(d.gtid_texts(spark, sf_dir), "gtid_set", ["set_id"], merged=True)


@query(
    "gtid_contains",
    with_(LOG, GTID_SETS_SQL)
    + """, nums AS (SELECT DISTINCT gtid_uuid, gtid_no FROM log),
    held AS (SELECT gtid_uuid, min(gtid_no) AS lo, max(gtid_no) AS hi FROM (
      SELECT *, gtid_no - row_number() OVER (PARTITION BY gtid_uuid ORDER BY gtid_no) AS g FROM nums)
      GROUP BY gtid_uuid, g)
    SELECT set_id, bool_and(EXISTS (SELECT 1 FROM held h WHERE h.gtid_uuid = s.source_uuid AND h.lo <= s.lo
      AND h.hi >= s.hi)) AS contained FROM spans s GROUP BY set_id""",
)
def gtid_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    executed = pos.executed_gtids(d.landed_log(spark, sf_dir))
    asked = explode_gtid_sets(d.gtid_texts(spark, sf_dir), "gtid_set", ["set_id"], merged=True)
    return pos.gtid_contains(executed, asked, "set_id")


@query(
    "table_selection",
    with_(LOG, events(), images("ev"))
    + """SELECT binlog_file, log_pos, source_db, source_table, image_idx, image[1] AS first_value FROM img
    WHERE source_table IN ('orders', 'audit')""",
)
def table_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = select_log_tables(d.landed_log(spark, sf_dir), [(d.DATABASE, "orders"), (d.DATABASE, "audit")])
    rows = explode_row_images(after_images(row_events(route_event_kind(chosen))))
    return rows.select(
        "binlog_file", "log_pos", "source_db", "source_table", "image_idx", F.col("image")[0].alias("first_value")
    )


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot of the orders and every committed change behind the start point."""
    log = d.redelivered(d.landed_log(spark, sf_dir))
    return snapshot_plus_catch_up(
        d.table(spark, sf_dir, "orders"),
        log,
        d.ORDERS,
        snapshot_at(),
        START_POSITION,
        pos.last_position(log),
        slice_bytes=d.SLICE_BYTES,
    )


query(
    "snapshot_plus_catch_up",
    with_(LOG, f"behind AS (SELECT * FROM log WHERE {START})", events("behind"), TX, images("tx"))
    + f"{SNAPSHOT_ORDERS} UNION ALL SELECT {ORDER_ROWS} AND committed",
)(flagship)
