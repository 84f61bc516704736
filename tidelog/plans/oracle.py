"""Common parts of the check SQL: the derived change log and its transactions."""

from __future__ import annotations

from tidelog.sources.derived import LINE_ORDER, UUIDS

_ORDER_IMAGE = """[CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderstatus,
  CAST(CAST({price} AS DECIMAL(18,2)) AS VARCHAR), strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), o_orderpriority]"""
_BEFORE = _ORDER_IMAGE.format(price="o_totalprice")
_AFTER = _ORDER_IMAGE.format(price="o_totalprice * 2")
_LINE_IMAGE = """[CAST(l_orderkey AS VARCHAR), CAST(place + 1 AS VARCHAR), CAST(l_partkey AS VARCHAR),
  CAST(l_suppkey AS VARCHAR), CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR),
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR), CAST(CAST(l_discount AS DECIMAL(18,2)) AS VARCHAR),
  CAST(CAST(l_tax AS DECIMAL(18,2)) AS VARCHAR), l_returnflag, l_linestatus,
  strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')]"""
_NONE = "CAST(NULL AS VARCHAR[][])"

# The log: one row per event, with images as nested lists.
LOG = f"""
places AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {", ".join(LINE_ORDER)}) - 1 AS place FROM lineitem),
line_ev AS (
  SELECT l_orderkey AS k, place // 10 AS event_no, list({_LINE_IMAGE} ORDER BY place) AS imgs
  FROM places GROUP BY 1, 2),
begins AS (
  SELECT o_orderkey AS k, CAST(0 AS BIGINT) AS series FROM orders
  UNION ALL SELECT k, event_no // 500 FROM line_ev WHERE event_no >= 500 AND event_no % 500 = 0),
raw AS (
  SELECT o_orderkey AS k, 0 AS series, 50 AS off, 'QUERY' AS kind,
         CASE WHEN o_orderkey % 97 = 0 THEN 'CREATE TABLE t' ELSE 'commit' END AS query,
         CAST(NULL AS VARCHAR) AS tab, {_NONE} AS imgs FROM orders WHERE o_orderkey % 97 <= 1
  UNION ALL SELECT k, series, 100, 'QUERY', CASE WHEN k % 10 = 0 THEN 'START TRANSACTION' ELSE 'BEGIN' END, NULL, NULL
  FROM begins
  UNION ALL SELECT o_orderkey, 0, 200, 'WRITE_ROWS', NULL, 'orders', CAST([] AS VARCHAR[][])
  FROM orders WHERE o_orderkey % 89 = 0
  UNION ALL SELECT o_orderkey, 0, 300,
    CASE o_orderkey % 5 WHEN 3 THEN 'UPDATE_ROWS' WHEN 4 THEN 'DELETE_ROWS' ELSE 'WRITE_ROWS' END, NULL, 'orders',
    CASE WHEN o_orderkey % 25 = 3 THEN [{_BEFORE}, {_AFTER}, {_BEFORE}]
         WHEN o_orderkey % 5 = 3 THEN [{_BEFORE}, {_AFTER}] ELSE [{_BEFORE}] END FROM orders
  UNION ALL SELECT k, event_no // 500, 600 + event_no % 500, 'WRITE_ROWS', NULL, 'order_lines', imgs FROM line_ev
  UNION ALL SELECT k, series, 90000, CASE k % 2 WHEN 0 THEN 'QUERY' ELSE 'XID' END,
    CASE k % 2 WHEN 0 THEN 'COMMIT' END, NULL, NULL FROM begins WHERE k % 11 <> 0
  UNION ALL SELECT o_orderkey, 0, 92000, 'WRITE_ROWS', NULL, 'audit', [[CAST(o_orderkey AS VARCHAR), 'note']]
  FROM orders WHERE o_orderkey % 53 = 0
  UNION ALL SELECT o_orderkey, 0, 95000, 'ROTATE', NULL, NULL, NULL FROM orders WHERE o_orderkey % 1000 = 999),
log AS (
  SELECT 'mysql-bin.' || lpad(CAST(series * 1000000000 + k // 1000 + 1 AS VARCHAR), 12, '0') AS binlog_file,
         CAST(4 + (k % 1000) * 100000 + off AS BIGINT) AS log_pos, CAST(1704067200 + k - CASE WHEN k % 97 = 5
           AND (coalesce(tab IN ('orders', 'order_lines'), FALSE) OR coalesce(query IN ('BEGIN', 'START TRANSACTION'), FALSE))
           THEN 1000 ELSE 0 END AS BIGINT) AS event_ts_s,
         kind, query, CASE WHEN tab IS NOT NULL THEN 'shop' END AS source_db, tab AS source_table,
         CASE k % 2 WHEN 0 THEN '{UUIDS[0]}' ELSE '{UUIDS[1]}' END AS gtid_uuid,
         CAST(series * 1000000000000 + k // 2 + 1 AS BIGINT) AS gtid_no, imgs FROM raw)"""


def events(log: str = "log") -> str:
    """Events with an operation; the log's columns stay."""
    return f"""
ev AS (SELECT * FROM (SELECT *, CASE
    WHEN kind = 'WRITE_ROWS' THEN 'INSERT' WHEN kind = 'UPDATE_ROWS' THEN 'UPDATE'
    WHEN kind = 'DELETE_ROWS' THEN 'DELETE' WHEN kind = 'XID' THEN 'COMMIT'
    WHEN kind = 'QUERY' AND query IN ('BEGIN', 'START TRANSACTION') THEN 'BEGIN'
    WHEN kind = 'QUERY' AND query = 'COMMIT' THEN 'COMMIT' END AS op FROM {log}) WHERE op IS NOT NULL)"""


# Events with their transaction, and whether a row is released.
TX = """
near AS (SELECT *,
    last_value(CASE WHEN op IN ('BEGIN', 'COMMIT') THEN op END IGNORE NULLS) OVER back AS prev_op,
    last_value(CASE WHEN op = 'BEGIN' THEN log_pos END IGNORE NULLS) OVER back AS prev_begin,
    first_value(CASE WHEN op IN ('BEGIN', 'COMMIT') THEN op END IGNORE NULLS) OVER ahead AS next_op
  FROM ev WINDOW back AS (PARTITION BY binlog_file ORDER BY log_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    ahead AS (PARTITION BY binlog_file ORDER BY log_pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
tx AS (SELECT *,
    CASE WHEN op = 'BEGIN' THEN binlog_file || ':' || log_pos
         WHEN prev_op = 'BEGIN' THEN binlog_file || ':' || prev_begin
         WHEN op <> 'COMMIT' THEN 'single_' || binlog_file || ':' || log_pos END AS txn_id,
    CASE WHEN op IN ('BEGIN', 'COMMIT') THEN NULL
         ELSE prev_op IS DISTINCT FROM 'BEGIN' OR next_op IS NOT DISTINCT FROM 'COMMIT' END AS committed FROM near)"""


def images(source: str) -> str:
    """Row images of the events of ``source``: after-images of updates, indexes from 0."""
    return f"""
img AS (SELECT * REPLACE (CAST(CASE op WHEN 'UPDATE' THEN image_idx // 2 ELSE image_idx END AS INTEGER) AS image_idx)
  FROM (SELECT * EXCLUDE (imgs), unnest(imgs) AS image, generate_subscripts(imgs, 1) - 1 AS image_idx
        FROM {source} WHERE op IN ('INSERT', 'UPDATE', 'DELETE'))
  WHERE op <> 'UPDATE' OR image_idx % 2 = 1)"""


ROW_COUNT = "CASE op WHEN 'UPDATE' THEN len(imgs) // 2 ELSE len(imgs) END"
EVENT_TIME = "make_timestamp(event_ts_s * 1000000)"
INSERT_ID = "'(' || binlog_file || ', ' || log_pos || '):' || txn_id || ':' || image_idx"
META = f"""{EVENT_TIME} AS _cdc_timestamp, op AS _cdc_operation, source_db AS _cdc_database,
  source_table AS _cdc_table"""
ORDER_COLUMNS = """CAST(image[1] AS BIGINT) AS o_orderkey, CAST(image[2] AS BIGINT) AS o_custkey,
  image[3] AS o_orderstatus, CAST(image[4] AS DOUBLE) AS o_totalprice, CAST(image[5] AS TIMESTAMP) AS o_orderdate,
  image[6] AS o_orderpriority"""
LINE_COLUMNS = """CAST(image[1] AS BIGINT) AS l_orderkey, CAST(image[2] AS BIGINT) AS line_no,
  CAST(image[3] AS BIGINT) AS l_partkey, CAST(image[4] AS BIGINT) AS l_suppkey, CAST(image[5] AS DOUBLE) AS l_quantity,
  CAST(image[6] AS DOUBLE) AS l_extendedprice, CAST(image[7] AS DOUBLE) AS l_discount, CAST(image[8] AS DOUBLE) AS l_tax,
  image[9] AS l_returnflag, image[10] AS l_linestatus, CAST(image[11] AS TIMESTAMP) AS l_shipdate"""
ORDER_ROWS = f"{META}, {ORDER_COLUMNS}, {INSERT_ID} AS _insert_id FROM img WHERE source_table = 'orders'"
SNAPSHOT_TIME = "TIMESTAMP '2024-06-01 00:00:00'"
SNAPSHOT_ORDERS = f"""SELECT {SNAPSHOT_TIME} AS _cdc_timestamp, 'SNAPSHOT' AS _cdc_operation, 'shop' AS _cdc_database,
  'orders' AS _cdc_table, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
  'snapshot:shop.orders:' || o_orderkey AS _insert_id FROM orders"""
START = "(binlog_file > 'mysql-bin.000000000001' OR (binlog_file = 'mysql-bin.000000000001' AND log_pos > 5000000))"


# The position of the last XID, as one row.
LAST_XID = """last_file AS (SELECT max(binlog_file) AS stop_file FROM log WHERE kind = 'XID'),
stop AS (SELECT stop_file, max(log_pos) AS stop_pos FROM log, last_file WHERE kind = 'XID' AND binlog_file = stop_file
  GROUP BY stop_file)"""


def with_(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"
