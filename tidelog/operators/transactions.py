"""Transactions: which events belong together and which may be released."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.model import BEGIN, COMMIT, DEFAULT_BUFFER_CAPACITY, ROW_OPS
from tidelog.operators.images import after_images, explode_row_images, row_events
from tidelog.operators.ordered import Running, running, slice_of
from tidelog.session import broadcast_if_small

# Offsets are bytes and an event takes at least its 19-byte header, so a slice
# of this width holds a bounded number of events, however large its file is.
SLICE_BYTES = 64 * 1024 * 1024
# Least bytes of an event in the log.
EVENT_BYTES = 19


def _marker() -> Column:
    """Position and kind of a marker in one number, so that it can be hash-aggregated."""
    return F.when(F.col("op") == BEGIN, F.col("log_pos") * 2).when(F.col("op") == COMMIT, F.col("log_pos") * 2 + 1)


def _is_begin(marker: str) -> Column:
    return F.col(marker) % 2 == 0


def _opened_at(prev: str) -> Column:
    """Position of the BEGIN an event belongs to; null outside a transaction."""
    return F.when(F.col("op") == BEGIN, F.col("log_pos")).when(_is_begin(prev), F.shiftright(prev, 1))


def _is_row() -> Column:
    return F.col("op").isin(*ROW_OPS)


def assign_transaction(events: DataFrame, slice_bytes: int = SLICE_BYTES, deliver_once: bool = True) -> DataFrame:
    """Add ``txn_id`` and, for row events, ``committed``.

    A row belongs to the transaction that the marker before it opened, and is
    committed when the next marker in its file is a COMMIT. A transaction never
    spans two files. A row outside any transaction is a complete transaction of
    its own. ``deliver_once`` also drops repeated deliveries of an event, which
    costs nothing here as copies share file and position; where one event may
    come very often, ``merge_hot_copies`` goes first. ``undecided`` marks the
    events of a file's last transaction while no marker has followed it.
    """
    sliced = events.withColumn("_slice", slice_of("log_pos", slice_bytes))
    values = [
        Running("_prev", "max", _marker(), exclusive=True),
        Running("_next", "min", _marker(), exclusive=True, backward=True),
    ]
    if deliver_once:
        values.append(Running("_prev_pos", "max", F.col("log_pos"), exclusive=True))
    marked = running(sliced, ["binlog_file"], [["_slice"]], ["log_pos"], values)
    if deliver_once:
        marked = marked.where(F.col("_prev_pos").isNull() | (F.col("_prev_pos") < F.col("log_pos"))).drop("_prev_pos")

    alone = F.concat(F.lit("single_"), "binlog_file", F.lit(":"), F.col("log_pos").cast("string"))
    return (
        marked.withColumn("_begin", _opened_at("_prev"))
        .withColumn(
            "txn_id",
            F.when(
                F.col("_begin").isNotNull(), F.concat("binlog_file", F.lit(":"), F.col("_begin").cast("string"))
            ).when(_is_row(), alone),
        )
        .withColumn(
            "committed",
            F.when(_is_row(), F.col("_begin").isNull() | F.coalesce(~_is_begin("_next"), F.lit(False))),
        )
        .withColumn(
            "undecided", F.col("_begin").isNotNull() & F.col("_next").isNull() & (F.col("op") != COMMIT)
        )
        .drop("_slice", "_prev", "_next", "_begin")
    )


def merge_hot_copies(events: DataFrame, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Merge the copies of events where a slice holds more events than its bytes allow.

    Events are counted by slice, which few numbers suffice for; only a slice
    that is too full holds events that were delivered often, and its copies are
    merged before the shuffle. Without such a slice, the usual case, ``events``
    is returned as it is.
    """
    place = ["binlog_file", "_slice"]
    sliced = events.withColumn("_slice", slice_of("log_pos", slice_bytes))
    full = sliced.groupBy(*place).agg(F.count("*").alias("n")).where(F.col("n") > slice_bytes // EVENT_BYTES + 1)
    full = full.select(*place)
    if full.isEmpty():
        return events
    full, _ = broadcast_if_small(full)
    merged = sliced.join(full, place, "left_semi").dropDuplicates(["binlog_file", "log_pos"])
    return sliced.join(full, place, "left_anti").unionByName(merged).drop("_slice")


def gtid_transaction(events: DataFrame) -> DataFrame:
    """Transactions by the source's own numbers, where every event carries one."""
    own = F.concat("gtid_uuid", F.lit(":"), F.col("gtid_no").cast("string"))
    alone = F.concat(F.lit("single_"), "binlog_file", F.lit(":"), F.col("log_pos").cast("string"))
    return events.withColumn("txn_id", F.coalesce(own, alone))


def commit_gate(assigned: DataFrame) -> DataFrame:
    """Row images of committed transactions only."""
    return explode_row_images(after_images(row_events(assigned).where("committed")))


def flush_pending(assigned: DataFrame) -> DataFrame:
    """All row images, the open transactions' included and marked by ``committed``."""
    return explode_row_images(after_images(row_events(assigned)))


def commit_gate_by_id(events: DataFrame) -> DataFrame:
    """The gate for events that already carry ``txn_id``: keep ids that have a COMMIT."""
    committed = events.where(F.col("op") == COMMIT).select("txn_id").distinct()
    return row_events(events).join(committed, "txn_id", "left_semi")


def open_transaction_gauge(events: DataFrame, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """After each event: open transactions and the row events they hold back.

    Only file, position and operation travel through the shuffles. Totals are
    carried from slice to slice and from file to file; the last step sees one row
    per log file.
    """
    slim = events.select("binlog_file", "log_pos", "op").withColumn("_slice", slice_of("log_pos", slice_bytes))
    levels, order = [["_slice"]], ["log_pos"]
    marked = running(
        slim, ["binlog_file"], levels, order, [Running("_prev", "max", _marker(), exclusive=True)]
    ).withColumn("_begin", _opened_at("_prev"))
    in_txn = F.col("_begin").isNotNull()
    held = F.when(in_txn & _is_row(), F.lit(1)).otherwise(F.lit(0)).cast("bigint")
    counted = running(
        marked.drop("_prev"), ["binlog_file", "_begin"], levels, order, [Running("_n", "sum", held)]
    )
    opened = F.when(F.col("op") == BEGIN, 1).when((F.col("op") == COMMIT) & in_txn, -1).otherwise(0).cast("bigint")
    pending = F.when((F.col("op") == COMMIT) & in_txn, -F.col("_n")).otherwise(held)
    return running(
        counted,
        [],
        [["binlog_file"], ["_slice"]],
        order,
        [Running("open_transactions", "sum", opened), Running("pending_row_events", "sum", pending)],
    ).select("binlog_file", "log_pos", "op", "open_transactions", "pending_row_events")


def per_transaction(assigned: DataFrame) -> DataFrame:
    """One row per transaction: row events, images and whether it is committed."""
    return (
        assigned.where(F.col("txn_id").isNotNull())
        .groupBy("txn_id")
        .agg(
            F.count_if(_is_row()).alias("n_events"),
            F.sum(F.when(_is_row(), F.size("rows")).otherwise(0)).cast("bigint").alias("n_images"),
            F.bool_or(
                (F.col("op") == COMMIT) | F.coalesce(F.col("committed"), F.lit(False))
            ).alias("is_committed"),
        )
    )


def txn_totals(assigned: DataFrame) -> DataFrame:
    """Committed and open transactions, and the row events that are held back."""
    return per_transaction(assigned).agg(
        F.count_if("is_committed").alias("committed_transactions"),
        F.count_if(~F.col("is_committed")).alias("open_transactions"),
        F.coalesce(F.sum(F.when(~F.col("is_committed"), F.col("n_events"))), F.lit(0)).alias("buffered_events"),
    )


def open_transactions_topk(assigned: DataFrame, k: int = 100, capacity: int = DEFAULT_BUFFER_CAPACITY) -> DataFrame:
    """The ``k`` smallest open transactions, with a flag when all open ones exceed the capacity."""
    open_txns = per_transaction(assigned).where(~F.col("is_committed")).select("txn_id", "n_events")
    total = open_txns.agg(
        (F.coalesce(F.sum("n_events"), F.lit(0)) >= F.lit(capacity)).alias("over_capacity")
    )
    # One row on the right-hand side.
    return open_txns.orderBy("n_events", "txn_id").limit(k).crossJoin(F.broadcast(total))


def transaction_fates(events: DataFrame, capacity: int = DEFAULT_BUFFER_CAPACITY) -> DataFrame:
    """One row a transaction with row events: ``committed`` true with a COMMIT, false where room is made, null while held.

    Held events are those without a COMMIT. If they are ``capacity`` or more,
    whole transactions are released, by rising number of events and then id,
    until fewer are left. Only one row a transaction is sorted, in slices of the
    same number of events.
    """
    per = events.groupBy("txn_id").agg(
        F.count_if(_is_row()).alias("n_events"), F.bool_or(F.col("op") == COMMIT).alias("_closed")
    )
    some = per.where(F.col("n_events") > 0)
    held = some.where(~F.col("_closed"))
    total = held.agg(F.coalesce(F.sum("n_events"), F.lit(0)).alias("_total"))
    before = running(held, [], [["n_events"]], ["txn_id"], [Running("_before", "sum", F.col("n_events"), exclusive=True)])
    # One row on the right-hand side. A transaction goes if with all smaller ones gone there is still too much.
    room = F.when(F.col("_total") - F.col("_before") >= F.lit(capacity), F.lit(False))
    open_ = before.crossJoin(F.broadcast(total)).select("txn_id", room.alias("committed"))
    return some.where("_closed").select("txn_id", F.lit(True).alias("committed")).unionByName(open_)


def with_fates(events: DataFrame, fates: DataFrame, how: str = "left") -> DataFrame:
    """Row events with their transaction's ``committed``; rows without a ``txn_id`` have none."""
    # The fates of a batch grow with it, however small their file is, and are not broadcast.
    return row_events(events).join(fates.hint("merge"), "txn_id", how).select(*events.columns, "committed")


def release_over_capacity(events: DataFrame, capacity: int = DEFAULT_BUFFER_CAPACITY) -> DataFrame:
    """Row events with ``committed`` as in ``transaction_fates``."""
    return with_fates(events, transaction_fates(events, capacity))


def txn_lifecycle(events: DataFrame, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """What becomes of each event when the log itself names the transactions.

    A first row opens a transaction without BEGIN; a repeated BEGIN discards what
    the id held; a COMMIT releases it; a COMMIT of an id that is not open is an
    orphan; a row without id is released on its own.
    """
    alone = F.concat(F.lit("single_"), "binlog_file", F.lit(":"), F.col("log_pos").cast("string"))
    named = (
        events.withColumn("_alone", F.col("txn_id").isNull() & _is_row())
        .withColumn("txn_id", F.coalesce("txn_id", alone))
        .withColumn("_slice", slice_of("log_pos", slice_bytes))
    )
    # Offset and operation in one number; files follow each other by the levels.
    code = F.when(F.col("op") == BEGIN, F.lit(1)).when(F.col("op") == COMMIT, F.lit(2)).otherwise(F.lit(0))
    mark = F.col("log_pos") * 4 + code
    out = running(
        named,
        ["txn_id"],
        [["binlog_file", "_slice"]],
        ["log_pos"],
        [
            Running("_prev", "nearest", mark, exclusive=True),
            Running("_next", "nearest", F.when(code > 0, mark), exclusive=True, backward=True),
        ],
    )
    before, behind = F.col("_prev") % 4, F.col("_next") % 4
    status = (
        F.when(F.col("_alone"), F.lit("committed"))
        .when(F.col("op") == BEGIN, F.lit("begin"))
        .when(
            F.col("op") == COMMIT,
            F.when(before.isNull() | (before == 2), F.lit("orphan_commit")).otherwise(F.lit("commit")),
        )
        .when(behind == 2, F.lit("committed"))
        .when(behind == 1, F.lit("discarded"))
        .otherwise(F.lit("open"))
    )
    return out.withColumn("status", status).drop("_slice", "_prev", "_next", "_alone")
