"""A change log, a column catalog and write errors derived from the driver's tables.

The tables hold no change log, so one is computed from ``orders`` and
``lineitem`` by fixed rules. With ``k = o_orderkey``, order ``k`` is one
transaction in log file ``k div 1000`` at ``base = 4 + (k % 1000) * 100,000``:

* ``base + 50``      a statement that is no marker, for some orders
* ``base + 100``     BEGIN or START TRANSACTION
* ``base + 200``     a row event without images, for some orders
* ``base + 300``     the order as insert, update (before/after pair) or delete
* ``base + 600 + e`` line items as inserts, ten images an event
* ``base + 90,000``  COMMIT or XID, unless the transaction stays open
* ``base + 92,000``  a row outside any transaction, for some orders
* ``base + 95,000``  ROTATE, at the end of a file

An order with more than 5,000 line items goes on in further transactions, each
in a file of its own series, so that no event and no transaction grows without
bound however the line items are spread.
"""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidelog.model import CHANGE_LOG_SCHEMA, ColumnSpec, TableSpec
from tidelog.operators.ordered import Running, running
from tidelog.session import broadcast_if_small, free_shuffles, new_path, prepare, stage
from tidelog.sources.change_log import read_change_log

DATABASE = "shop"
FIRST_EVENT_S = 1704067200
# How long a long transaction takes; longer than the streamed gate waits.
LONG_S = 1000
ORDERS_PER_FILE = 1000
ORDER_BYTES = 100_000
IMAGES_PER_EVENT = 10
LINES_PER_TXN = 5000
# Rows of the tables that one task turns into events.
ROWS_PER_TASK = 200_000
FILES_PER_SERIES = 1_000_000_000
NUMBERS_PER_SERIES = 1_000_000_000_000
UUIDS = ("3e11fa47-71ca-11e1-9e33-c80aa9429562", "5c2b8d90-0a4f-11ec-8d3d-0242ac130003")
# Slice width that cuts each derived file into several slices.
SLICE_BYTES = 16 * 1024 * 1024
LINE_ORDER = (
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
)

ORDERS = TableSpec(
    DATABASE,
    "orders",
    (
        ColumnSpec("o_orderkey", "bigint", True),
        ColumnSpec("o_custkey", "bigint"),
        ColumnSpec("o_orderstatus", "string"),
        ColumnSpec("o_totalprice", "decimal(18,2)"),
        ColumnSpec("o_orderdate", "timestamp_ntz"),
        ColumnSpec("o_orderpriority", "string"),
    ),
    ("o_orderkey",),
)
ORDER_LINES = TableSpec(
    DATABASE,
    "order_lines",
    (
        ColumnSpec("l_orderkey", "bigint", True),
        ColumnSpec("line_no", "bigint", True),
        ColumnSpec("l_partkey", "bigint"),
        ColumnSpec("l_suppkey", "bigint"),
        ColumnSpec("l_quantity", "decimal(18,2)"),
        ColumnSpec("l_extendedprice", "decimal(18,2)"),
        ColumnSpec("l_discount", "decimal(18,2)"),
        ColumnSpec("l_tax", "decimal(18,2)"),
        ColumnSpec("l_returnflag", "string"),
        ColumnSpec("l_linestatus", "string"),
        ColumnSpec("l_shipdate", "timestamp_ntz"),
    ),
    ("l_orderkey", "line_no"),
)
CUSTOMERS = TableSpec(
    DATABASE,
    "customer",
    (
        ColumnSpec("c_custkey", "bigint", True),
        ColumnSpec("c_name", "string"),
        ColumnSpec("c_nationkey", "int"),
        ColumnSpec("c_acctbal", "double"),
        ColumnSpec("c_mktsegment", "string"),
    ),
    ("c_custkey",),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def _money(column: str | Column) -> Column:
    return _text((F.col(column) if isinstance(column, str) else column).cast("decimal(18,2)"))


def _when(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def _file(k: Column, series: Column) -> Column:
    number = series * FILES_PER_SERIES + F.floor(k / ORDERS_PER_FILE) + 1
    digits = number.cast("string")
    # Twelve digits at least; every event has a name, and formatting it by a pattern takes longer than the rest of the event.
    return F.concat(F.lit("mysql-bin."), F.when(F.length(digits) < 12, F.lpad(digits, 12, "0")).otherwise(digits))


def _base(k: Column) -> Column:
    return F.lit(4).cast("bigint") + (k % ORDERS_PER_FILE) * ORDER_BYTES


def _begin(k: Column) -> Column:
    return F.when(k % 10 == 0, F.lit("START TRANSACTION")).otherwise(F.lit("BEGIN"))


# Which images an event carries; the images themselves are built per kept event.
NONE, EMPTY, BEFORE, PAIR, PAIR_AND_TAIL, NOTE = range(6)


def _event(
    keep: Column,
    offset: int,
    kind: str,
    query: Column | str | None = None,
    table: str | None = None,
    shape: int = NONE,
) -> Column:
    text = query if isinstance(query, Column) else F.lit(query).cast("string")
    return F.struct(
        keep.alias("keep"),
        F.lit(offset).alias("offset"),
        F.lit(kind).alias("kind"),
        text.alias("query"),
        F.lit(table).cast("string").alias("source_table"),
        F.lit(shape).alias("shape"),
    )


def _commit_events(k: Column) -> list[Column]:
    closed = k % 11 != 0
    return [
        _event(closed & (k % 2 == 0), 90_000, "QUERY", "COMMIT"),
        _event(closed & (k % 2 == 1), 90_000, "XID"),
    ]


def _spread(df: DataFrame, events: list[Column]) -> DataFrame:
    """The kept events of each row, beside the row's own columns."""
    flat = df.select("*", F.inline(F.array(*events))).where("keep")
    return flat.withColumn("log_pos", _base(F.col("k")) + F.col("offset"))


def _within() -> Column:
    """BEGIN and rows of a transaction."""
    rows = F.coalesce(F.col("source_table").isin("orders", "order_lines"), F.lit(False))
    return rows | F.coalesce(F.col("query").isin("BEGIN", "START TRANSACTION"), F.lit(False))


def _canonical(flat: DataFrame) -> DataFrame:
    k, series = F.col("k"), F.col("series")
    return flat.select(
        _file(k, series).alias("binlog_file"),
        F.col("log_pos").cast("bigint").alias("log_pos"),
        # Some transactions run long: their rows are older than their end.
        (k + FIRST_EVENT_S - F.when((k % 97 == 5) & _within(), LONG_S).otherwise(0)).cast("bigint").alias("event_ts_s"),
        "kind",
        "query",
        F.when(F.col("source_table").isNotNull(), F.lit(DATABASE)).alias("source_db"),
        "source_table",
        F.when(k % 2 == 0, F.lit(UUIDS[0])).otherwise(F.lit(UUIDS[1])).alias("gtid_uuid"),
        (series * NUMBERS_PER_SERIES + F.floor(k / 2) + 1).cast("bigint").alias("gtid_no"),
        "rows",
    )


def order_events(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")

    def image(price: Column) -> Column:
        return F.array(
            _text("o_orderkey"), _text("o_custkey"), _text("o_orderstatus"), _money(price), _when("o_orderdate"),
            _text("o_orderpriority"),
        )

    m = k % 5
    events = [
        _event(k % 97 == 0, 50, "QUERY", "CREATE TABLE t"),
        _event(k % 97 == 1, 50, "QUERY", "commit"),
        _event(F.lit(True), 100, "QUERY", _begin(k)),
        _event(k % 89 == 0, 200, "WRITE_ROWS", None, "orders", EMPTY),
        _event(m <= 2, 300, "WRITE_ROWS", None, "orders", BEFORE),
        _event((m == 3) & (k % 25 != 3), 300, "UPDATE_ROWS", None, "orders", PAIR),
        _event((m == 3) & (k % 25 == 3), 300, "UPDATE_ROWS", None, "orders", PAIR_AND_TAIL),
        _event(m == 4, 300, "DELETE_ROWS", None, "orders", BEFORE),
        *_commit_events(k),
        _event(k % 53 == 0, 92_000, "WRITE_ROWS", None, "audit", NOTE),
        _event(k % ORDERS_PER_FILE == ORDERS_PER_FILE - 1, 95_000, "ROTATE"),
    ]
    flat = _spread(orders.withColumns({"k": k, "series": F.lit(0).cast("bigint")}), events)
    before, after = image(F.col("o_totalprice")), image(F.col("o_totalprice") * 2)
    shape = F.col("shape")
    rows = (
        F.when(shape == EMPTY, F.array().cast("array<array<string>>"))
        .when(shape == BEFORE, F.array(before))
        .when(shape == PAIR, F.array(before, after))
        .when(shape == PAIR_AND_TAIL, F.array(before, after, before))
        .when(shape == NOTE, F.array(F.array(_text("o_orderkey"), F.lit("note"))))
    )
    return _canonical(flat.withColumn("rows", rows))


def numbered_lines(lines: DataFrame) -> DataFrame:
    """Line items with their place in the order, from 0."""
    sliced = lines.withColumn("_parts", F.expr("l_partkey div 1000"))
    return (
        running(
            sliced,
            ["l_orderkey"],
            [["l_linenumber", "_parts"]],
            LINE_ORDER,
            [Running("_place", "sum", F.lit(1).cast("bigint"), exclusive=True)],
        )
        .withColumnRenamed("_place", "place")
        .drop("_parts")
    )


def placed_lines(lines: DataFrame) -> DataFrame:
    """``numbered_lines`` of orders that one task can hold, out of one shuffle by ranges of orders."""
    place = F.row_number().over(W.partitionBy("l_orderkey").orderBy(*LINE_ORDER)) - 1
    return in_ranges(lines, "l_orderkey").withColumn("place", place.cast("bigint"))


def in_ranges(rows: DataFrame, key: str) -> DataFrame:
    """Ranges of the key with about ``ROWS_PER_TASK`` rows each, so that tasks do not grow with the table."""
    return rows.repartitionByRange(-(-rows.count() // ROWS_PER_TASK) or 1, key)


def line_events(lines: DataFrame) -> DataFrame:
    """Lines are numbered and grouped within a range of orders; only orders too large for that go by slices."""
    many = lines.groupBy("l_orderkey").agg(F.count("*").alias("n")).where(F.col("n") > LINES_PER_TXN)
    large = stage(many.select("l_orderkey"), "large-orders")
    if large.isEmpty():
        return _line_rows(_grouped(placed_lines(lines)))
    large, _ = broadcast_if_small(large)
    same = lines["l_orderkey"].eqNullSafe(large["l_orderkey"])
    events = _grouped(numbered_lines(lines.join(large, same, "left_semi")))
    k = F.col("k")
    bounds = [_event(F.lit(True), 100, "QUERY", _begin(k)), *_commit_events(k)]
    further = _spread(events.where((F.col("series") > 0) & (F.col("in_txn") == 0)).select("k", "series"), bounds)
    bounded = _canonical(further.withColumn("rows", F.lit(None).cast("array<array<string>>")))
    sliced = _line_rows(events).unionByName(bounded).repartitionByRange("binlog_file", "log_pos")
    return _line_rows(_grouped(placed_lines(lines.join(large, same, "left_anti")))).unionByName(sliced)


def _grouped(numbered: DataFrame) -> DataFrame:
    """At most IMAGES_PER_EVENT images an event."""
    image = F.array(
        _text("l_orderkey"), _text(F.col("place") + 1), _text("l_partkey"), _text("l_suppkey"), _money("l_quantity"),
        _money("l_extendedprice"), _money("l_discount"), _money("l_tax"), _text("l_returnflag"),
        _text("l_linestatus"), _when("l_shipdate"),
    )
    return (
        numbered.groupBy(F.col("l_orderkey").alias("k"), F.expr(f"place div {IMAGES_PER_EVENT}").alias("event_no"))
        .agg(F.array_sort(F.collect_list(F.struct("place", image.alias("image")))).alias("images"))
        .select("k", "event_no", F.transform("images", lambda i: i["image"]).alias("rows"))
        .withColumn("series", F.expr(f"event_no div {LINES_PER_TXN // IMAGES_PER_EVENT}"))
        .withColumn("in_txn", F.col("event_no") % (LINES_PER_TXN // IMAGES_PER_EVENT))
    )


def _line_rows(events: DataFrame) -> DataFrame:
    return _canonical(
        events.withColumns(
            {
                "log_pos": _base(F.col("k")) + 600 + F.col("in_txn"),
                "kind": F.lit("WRITE_ROWS"),
                "query": F.lit(None).cast("string"),
                "source_table": F.lit("order_lines"),
            }
        )
    )


def change_log(orders: DataFrame, lines: DataFrame) -> DataFrame:
    log = order_events(orders).unionByName(line_events(lines))
    return log.select(*CHANGE_LOG_SCHEMA.fieldNames())


_landed: dict[tuple[str, str], str] = {}
_landing = threading.Lock()


def landed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived log as landed files, each in log order, written once a session."""
    prepare(spark)
    with _landing:
        at = (spark.sparkContext.applicationId, sf_dir)
        if at not in _landed:
            path = new_path(spark, "log")
            # A range of orders is a range of the log: the tables are shuffled once and their events not again.
            orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
            for events in (order_events(in_ranges(orders, "o_orderkey")), line_events(lines)):
                part = events.select(*CHANGE_LOG_SCHEMA.fieldNames())
                part.sortWithinPartitions("binlog_file", "log_pos").write.mode("append").parquet(path)
                free_shuffles(spark)
            _landed[at] = path
    return read_change_log(spark, _landed[at])


def redelivered(log: DataFrame) -> DataFrame:
    """The log of a reader that began again behind the first file: all later files arrive twice."""
    return log.unionByName(log.where(F.col("binlog_file") > "mysql-bin.000000000001"))


# Source column types the derived catalog goes through in turn.
CATALOG_TYPES = (
    ("int", "int(11)", 10, 0),
    ("bigint", "bigint unsigned", 20, 0),
    ("tinyint", "tinyint(1)", 3, 0),
    ("tinyint", "TINYINT(4)", 3, 0),
    ("varchar", "varchar(255)", None, None),
    ("decimal", "decimal(12,2)", 12, 2),
    ("decimal", "decimal(50,10)", 50, 10),
    ("double", " Double ", 22, None),
    ("datetime", "datetime(6)", None, None),
    ("date", "date", None, None),
    ("time", "time", None, None),
    ("year", "year", None, None),
    ("json", "json", None, None),
    ("varbinary", "varbinary(16)", None, None),
    ("enum", "enum('a','b')", None, None),
    ("bit", "bit(8)", 8, None),
    ("uuid", "uuid", None, None),
)
CATALOG_TABLE_COLUMNS = 20


def column_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog with one column per part: twenty columns a table, names from the part."""
    p = table(spark, sf_dir, "part")
    kinds = F.array(
        *(
            F.struct(
                F.lit(d).alias("data_type"),
                F.lit(c).alias("column_type"),
                F.lit(n).cast("bigint").alias("numeric_precision"),
                F.lit(s).cast("bigint").alias("numeric_scale"),
            )
            for d, c, n, s in CATALOG_TYPES
        )
    )
    kind = F.element_at(kinds, (F.col("p_partkey") % len(CATALOG_TYPES) + 1).cast("int"))
    place = (F.col("p_partkey") % CATALOG_TABLE_COLUMNS + 1).cast("int")
    return p.withColumn("t", kind).select(
        F.lit(DATABASE).alias("table_schema"),
        F.concat(F.lit("t"), F.expr(f"p_partkey div {CATALOG_TABLE_COLUMNS}").cast("string")).alias("table_name"),
        place.alias("ordinal_position"),
        F.concat(F.translate("p_name", " ", "-"), F.lit("_"), place.cast("string")).alias("column_name"),
        "t.data_type",
        "t.column_type",
        F.when(F.col("p_size") % 2 == 0, F.lit("NO")).otherwise(F.lit("YES")).alias("is_nullable"),
        F.lit(None).cast("string").alias("column_default"),
        F.when(F.col("t.data_type") == "varchar", F.lit(255)).cast("bigint").alias("character_maximum_length"),
        "t.numeric_precision",
        "t.numeric_scale",
    )


ERROR_BATCH_ROWS = 97


def write_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One failed row per event, a hundred to a batch that has 97 rows.

    The event type decides the inner errors; a null reason is a plain-text error.
    """

    def errors(*pairs: tuple[str | None, str]) -> Column:
        return F.array(
            *(F.struct(F.lit(r).cast("string").alias("reason"), F.lit(m).alias("message")) for r, m in pairs)
        )

    e = F.col("event_type")
    inner = (
        F.when(e == "click", errors(("backendError", "try again"), ("invalid", "schema mismatch")))
        .when(e == "view", errors(("duplicate", "row seen"), ("backendError", "try again")))
        .when(e == "signup", errors((None, "connection timeout")))
        .when(e == "purchase", errors(("stopped", "Duplicate insert id")))
        .otherwise(errors(("invalid", "no such field"), (None, "row is broken")))
    )
    message = (
        F.when(F.col("user_id") % 4 == 0, F.lit("Rate Limit exceeded"))
        .when(F.col("user_id") % 4 == 1, F.lit("invalid table name"))
        .when(F.col("user_id") % 4 == 2, F.lit("service unavailable"))
        .otherwise(F.lit("permission denied"))
    )
    return table(spark, sf_dir, "events").select(
        F.expr("event_id div 100").alias("batch_id"),
        (F.col("event_id") % 100).alias("row_index"),
        "event_id",
        F.col("ts").cast("timestamp").alias("failed_at"),
        (F.col("event_id") % 6).cast("int").alias("attempt"),
        message.alias("message"),
        inner.alias("errors"),
    )


def gtid_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transaction-number set per order, as text with overlapping and touching intervals."""
    k = F.col("o_orderkey")
    n = F.expr("o_orderkey div 2 + 1")
    first = F.format_string(
        f"{UUIDS[0]}:%d-%d:%d:%d-%d", n, n + 4, n + 5, n + 3, n + 8
    )
    second = F.format_string(f" {UUIDS[1].upper()}:%d", F.when(k % 7 == 0, n + 1_000_000_000).otherwise(n))
    return table(spark, sf_dir, "orders").select(
        k.alias("set_id"), F.concat_ws(",", first, second).alias("gtid_set")
    )

STEPS = 3
FILES_PER_STEP = 4
# Events of a landed file and files of a landed step at most, unless the log is small.
EVENTS_PER_FILE = 250_000
MOST_FILES_PER_STEP = 24
# The streamed gate's state holds the rows of a micro-batch or two, in several copies on disk; so its steps are smaller.
GATE_FILES_PER_STEP = 4
_steps: dict[tuple[str, str, int | None], tuple[str, int]] = {}


def step_events(log: DataFrame, first: int, last: int) -> DataFrame:
    """The events of the log files ``first`` to ``last`` of the first series and its further series."""
    name = F.col("binlog_file")
    low, high, further = (_file_name(n) for n in (first, last, FILES_PER_SERIES))
    number = F.substring(name, 11, 12).cast("bigint") % FILES_PER_SERIES
    # The names say no more than the number, but reach the scan.
    return log.where((name >= low) & ((name <= high) | (name >= further)) & number.between(first, last))


def land_step(log: DataFrame, path: str, first: int, last: int, files: int | None = None) -> None:
    """Add the events of a step; without ``files`` they are copied as they lie and not shuffled.

    Files are of bounded size then; a step that would fit one is ``FILES_PER_STEP`` files.
    """
    part = step_events(log, first, last)
    if files:
        part.repartitionByRange(files, "binlog_file", "log_pos").write.mode("append").parquet(path)
        free_shuffles(log.sparkSession)
    else:
        events, rows = part.count(), EVENTS_PER_FILE
        if events <= EVENTS_PER_FILE:
            part, rows = part.coalesce(1), -(-events // FILES_PER_STEP)
        part.write.mode("append").option("maxRecordsPerFile", rows).parquet(path)


def _file_name(number: int) -> str:
    return f"mysql-bin.{number:012d}"


def step_bounds(log: DataFrame, steps: int = STEPS) -> list[tuple[int, int]]:
    """Log files cut into ``steps`` ranges."""
    number = F.substring("binlog_file", 11, 12).cast("bigint") % FILES_PER_SERIES
    last = log.agg(F.max(number)).first()[0]
    edges = [last * i // steps for i in range(steps + 1)]
    return [(a + 1, b) for a, b in zip(edges, edges[1:], strict=False) if b > a]


def step_shape(log: DataFrame, most_files: int | None = None) -> tuple[int, int]:
    """Steps, and files a step, for a stream that takes a step at a time: neither a step nor a file grows with the log."""
    events = log.count()
    steps = max(STEPS, -(-events // (EVENTS_PER_FILE * (most_files or MOST_FILES_PER_STEP))))
    return steps, max(FILES_PER_STEP, -(-events // (EVENTS_PER_FILE * steps)))


def landed_steps(spark: SparkSession, sf_dir: str, most_files: int | None = None) -> str:
    """Folder with the log landed step by step, as a stream finds it; written once a session and size of steps."""
    return _landed_steps(spark, sf_dir, most_files)[0]


def files_per_step(spark: SparkSession, sf_dir: str, most_files: int | None = None) -> int:
    """Files of each step of ``landed_steps``."""
    return _landed_steps(spark, sf_dir, most_files)[1]


def _landed_steps(spark: SparkSession, sf_dir: str, most_files: int | None) -> tuple[str, int]:
    log = landed_log(spark, sf_dir)
    with _landing:
        at = (spark.sparkContext.applicationId, sf_dir, most_files)
        if at not in _steps:
            path = new_path(spark, "steps")
            steps, files = step_shape(log, most_files)
            for first, last in step_bounds(log, steps):
                land_step(log, path, first, last, files)
            _steps[at] = path, files
    return _steps[at]
