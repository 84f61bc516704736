"""Whole jobs: snapshot with catch-up, and backfill with hand-over."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.model import Position, TableSpec
from tidelog.operators.images import route_event_kind
from tidelog.operators.positions import last_position, safe_point, save_high_water, with_opening
from tidelog.operators.rows import generic_change_rows, typed_change_rows
from tidelog.operators.transactions import (
    SLICE_BYTES,
    assign_transaction,
    commit_gate,
    flush_pending,
    merge_hot_copies,
)
from tidelog.sinks.targets import append_change_rows, raw_append
from tidelog.sources.change_log import select_log_tables
from tidelog.sources.tables import backfill_scan, snapshot_images, snapshot_scan


def catch_up_rows(
    log: DataFrame,
    spec: TableSpec,
    start: Position | None,
    stop: Position,
    gated: bool = True,
    slice_bytes: int = SLICE_BYTES,
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """One table's change rows from the log in ``(start, stop]``, each event once.

    ``gated`` releases committed transactions only; a transaction that is open
    at ``stop`` is released by a later run, which must start at ``safe_point``.
    A start inside a transaction is resolved by its BEGIN. ``transform`` runs on the
    released images. Other tables' rows are dropped before the shuffle.
    """
    ranged = with_opening(log, start, stop)
    events = route_event_kind(select_log_tables(ranged, [(spec.database, spec.table)]))
    assigned = assign_transaction(merge_hot_copies(events, slice_bytes), slice_bytes)
    images = commit_gate(assigned) if gated else flush_pending(assigned)
    if transform is not None:
        images = images.transform(transform)
    return typed_change_rows(images, spec)


def snapshot_plus_catch_up(
    rows: DataFrame,
    log: DataFrame,
    spec: TableSpec,
    snapshot_ts: Column,
    start: Position | None,
    stop: Position,
    gated: bool = True,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """The snapshot and every change in ``(start, stop]``, into one target.

    The snapshot has one row per key and is not shuffled. Log rows are made
    single where their transactions are assigned, at no further shuffle.
    """
    typed = rows.select(*(F.col(f"`{c.name}`").cast(c.spark_type).alias(c.name) for c in spec.columns))
    snapshot = snapshot_scan(typed, spec.database, spec.table, spec.key, snapshot_ts)
    return snapshot.unionByName(catch_up_rows(log, spec, start, stop, gated, slice_bytes))


def sync_once(
    tables: list[tuple[TableSpec, DataFrame]],
    log: DataFrame,
    snapshot_ts: Column | None,
    start: Position | None,
    stop: Position,
    target: str,
    state: str,
    gated: bool = True,
    slice_bytes: int = SLICE_BYTES,
    saved_at_s: int = 0,
) -> Position:
    """Snapshot and catch-up of all tables in one write; the point to go on from is saved once the write is done.

    Without a ``snapshot_ts`` only the log is read, as in the runs after the
    first. The saved point is ``stop``, or in front of the transaction that is
    open there, so that its rows come with a later run, whole and under its id.
    """
    snapshots = [] if snapshot_ts is None else [snapshot_images(rows, spec, snapshot_ts) for spec, rows in tables]
    names = [(spec.database, spec.table) for spec, _ in tables]
    events = route_event_kind(select_log_tables(with_opening(log, start, stop), names))
    assigned = assign_transaction(merge_hot_copies(events, slice_bytes), slice_bytes)
    changes = generic_change_rows(commit_gate(assigned) if gated else flush_pending(assigned))
    append_change_rows(reduce(DataFrame.unionByName, [*snapshots, changes]), target)
    reached = safe_point(log, start, stop) if gated else stop
    save_high_water(log.sparkSession, state, reached, saved_at_s)
    return reached


def backfill(
    spark: SparkSession,
    rows: DataFrame,
    log: DataFrame,
    target: str,
    state: str,
    where: str | Column | None = None,
    saved_at_s: int = 0,
) -> Position | None:
    """Copy one table as it is, and hand over to the log.

    The log position is saved before the scan and stays saved after it, so that
    the change log goes on from there and misses nothing.
    """
    start = last_position(log)
    if start is not None:
        save_high_water(spark, state, start, saved_at_s)
    raw_append(backfill_scan(rows, where), target)
    return start
