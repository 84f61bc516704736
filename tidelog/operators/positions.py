"""Log positions and transaction-number sets: where to start and where to stop."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidelog.model import BEGIN, Position
from tidelog.operators.images import is_marker, txn_marker
from tidelog.operators.ordered import Running, running, slice_of
from tidelog.session import broadcast_if_small

_log = logging.getLogger(__name__)

HIGH_WATER_SCHEMA = "save_no bigint, binlog_file string, log_pos bigint, saved_at_s bigint"
# Sets with more intervals than this are matched by a sorted pass.
BROADCAST_SPANS = 1_000
# Numbers per slice when sets are merged or matched.
SLICE_NUMBERS = 100_000


def after(position: Position) -> Column:
    """Strictly behind ``position``, written so that the scan can skip files and row groups."""
    return (F.col("binlog_file") > position.binlog_file) | (
        (F.col("binlog_file") == position.binlog_file) & (F.col("log_pos") > position.log_pos)
    )


def up_to(position: Position) -> Column:
    return (F.col("binlog_file") < position.binlog_file) | (
        (F.col("binlog_file") == position.binlog_file) & (F.col("log_pos") <= position.log_pos)
    )


def resume_filter(log: DataFrame, checkpoint: Position | None, default: Position | None = None) -> DataFrame:
    """Events behind the checkpoint, else behind the default; with neither, the whole log."""
    start = checkpoint or default
    return log.where(after(start)) if start else log


def catch_up_range(log: DataFrame, start: Position | None, stop: Position) -> DataFrame:
    """Events in ``(start, stop]``."""
    return resume_filter(log, start).where(up_to(stop))


def opening_before(log: DataFrame, position: Position) -> Position | None:
    """The BEGIN of the transaction that is open at ``position``, by the log's own columns.

    A transaction never spans files, so the last marker up to the position in
    its file decides; only markers of that file are read.
    """
    kind, query = F.col("kind"), F.col("query")
    here = (F.col("binlog_file") == position.binlog_file) & (F.col("log_pos") <= position.log_pos)
    last = log.where(here & is_marker(kind, query)).agg(F.max_by(F.struct("log_pos", txn_marker(kind, query)), "log_pos"))
    found = last.first()[0]
    return Position(position.binlog_file, found[0]) if found is not None and found[1] == BEGIN else None


def with_opening(log: DataFrame, start: Position | None, stop: Position) -> DataFrame:
    """Events in ``(start, stop]``, and the BEGIN of the transaction that ``start`` lies in.

    So rows behind a start inside a transaction keep its id and wait for its COMMIT.
    """
    ranged = catch_up_range(log, start, stop)
    opened = opening_before(log, start) if start is not None else None
    if opened is None:
        return ranged
    begin = (F.col("binlog_file") == opened.binlog_file) & (F.col("log_pos") == opened.log_pos)
    return ranged.unionByName(log.where(begin))


def safe_point(log: DataFrame, start: Position | None, stop: Position) -> Position:
    """The point to go on from after a gated run to ``stop``: nothing before it is undecided.

    Where a transaction is open at ``stop`` this is just before its BEGIN, but
    never before ``start``. A finished file's open tail holds nothing up, as
    only the file of ``stop`` is looked at.
    """
    opened = opening_before(log, stop)
    if opened is None:
        return stop
    before = Position(opened.binlog_file, opened.log_pos - 1)
    return before if start is None else max(before, start)


def high_water(events: DataFrame) -> DataFrame:
    """The last position as a one-row table."""
    return events.agg(F.max(F.struct("binlog_file", "log_pos")).alias("p")).select("p.binlog_file", "p.log_pos")


def last_position(events: DataFrame) -> Position | None:
    row = high_water(events).first()
    return Position(row[0], row[1]) if row and row[0] is not None else None


def save_high_water(spark: SparkSession, path: str, position: Position, saved_at_s: int) -> None:
    """Append one row; readers take the newest, so a crash leaves the former one valid."""
    previous = high_water_scan(spark, path).first()
    save_no = previous["save_no"] + 1 if previous else 0
    spark.createDataFrame([(save_no, *position, saved_at_s)], HIGH_WATER_SCHEMA).coalesce(1).write.mode(
        "append"
    ).parquet(path)


def high_water_scan(spark: SparkSession, path: str) -> DataFrame:
    """The newest saved position; no rows on a first run."""
    try:
        saved = spark.read.schema(HIGH_WATER_SCHEMA).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], HIGH_WATER_SCHEMA)
    return saved.orderBy(F.col("save_no").desc()).limit(1)


def load_high_water(spark: SparkSession, path: str) -> Position | None:
    row = high_water_scan(spark, path).first()
    return Position(row["binlog_file"], row["log_pos"]) if row else None


def starting_position(log: DataFrame, saved: Position | None, rule: str | Position = "earliest") -> Position | None:
    """Where to start: the saved point, else ``earliest``, ``latest`` or a given position."""
    if saved is not None:
        return saved
    if isinstance(rule, Position):
        return rule
    if rule == "earliest":
        return None
    if rule == "latest":
        return last_position(log)
    raise ValueError(f"unknown starting position {rule!r}")


def merge_spans(spans: DataFrame, group: Sequence[str], slice_numbers: int = SLICE_NUMBERS) -> DataFrame:
    """Join intervals ``(lo, hi)`` that overlap or touch, per ``group``.

    Of intervals with one start only the longest counts, which leaves a bounded
    number a slice. They are first joined within slices, where a long run of
    numbers shrinks to one row, and what is left is joined across slices.
    """
    keys = list(group)
    levels, order = [["_slice"]], ["lo", "hi"]
    longest = spans.groupBy(*keys, "lo").agg(F.max("hi").alias("hi"))
    sliced = longest.withColumn("_slice", slice_of("lo", slice_numbers))

    local = W.partitionBy(*keys, "_slice").orderBy(*order)
    here = sliced.withColumn("_reach", F.max("hi").over(local.rowsBetween(W.unboundedPreceding, -1)))
    runs = (
        here.withColumn("_island", F.max(_island_start()).over(local.rowsBetween(W.unboundedPreceding, 0)))
        .groupBy(*keys, "_slice", "_island")
        .agg(F.max("hi").alias("hi"))
        .withColumnRenamed("_island", "lo")
    )
    reach = running(runs, keys, levels, order, [Running("_reach", "max", F.col("hi"), exclusive=True)])
    islands = running(reach, keys, levels, order, [Running("_island", "max", _island_start())])
    return (
        islands.groupBy(*keys, "_island").agg(F.max("hi").alias("hi")).select(*keys, F.col("_island").alias("lo"), "hi")
    )


def _island_start() -> Column:
    """``lo`` where nothing before the interval reaches or touches it."""
    return F.when(F.col("_reach").isNull() | (F.col("lo") > F.col("_reach") + 1), F.col("lo"))


def executed_gtids(events: DataFrame, slice_numbers: int = SLICE_NUMBERS) -> DataFrame:
    """The set of transaction numbers in a log, as merged intervals per source."""
    numbers = events.where(F.col("gtid_uuid").isNotNull()).select(
        F.col("gtid_uuid").alias("source_uuid"), F.col("gtid_no").alias("lo"), F.col("gtid_no").alias("hi")
    )
    return merge_spans(numbers, ["source_uuid"], slice_numbers)


def _reach(spans: DataFrame, points: DataFrame, slice_numbers: int) -> DataFrame:
    """Add ``_reach`` to points (``source_uuid``, ``lo``): how far the merged interval before them goes.

    One sorted pass over both sides: the interval that starts last at or before
    a point is the only one that can hold it. Points are never paired with all
    intervals. Points of one number should be few, or made distinct before.
    """
    held = spans.select("source_uuid", "lo", F.col("hi").alias("_hi"), F.lit(0).alias("_probe"))
    both = (
        points.withColumn("_probe", F.lit(1))
        .unionByName(held, allowMissingColumns=True)
        .withColumn("_slice", slice_of("lo", slice_numbers))
    )
    # Merged intervals are apart, so the last one to start also reaches furthest.
    out = running(both, ["source_uuid"], [["_slice"]], ["lo", "_probe"], [Running("_reach", "max", F.col("_hi"))])
    return out.where(F.col("_probe") == 1).drop("_probe", "_slice", "_hi")


def _with_covered(probes: DataFrame, spans: DataFrame, slice_numbers: int) -> DataFrame:
    """Add ``_covered`` to probes (``source_uuid``, ``lo``, ``hi``): does one merged interval hold them?"""
    points = probes.select("source_uuid", "lo").where(F.col("lo").isNotNull()).distinct()
    reach = _reach(spans, points, slice_numbers)
    return (
        probes.join(reach, ["source_uuid", "lo"], "left")
        .withColumn("_covered", F.coalesce(F.col("_reach") >= F.col("hi"), F.lit(False)))
        .drop("_reach")
    )


def gtid_resume_filter(
    log: DataFrame, executed: DataFrame, slice_numbers: int = SLICE_NUMBERS, broadcast_spans: int = BROADCAST_SPANS
) -> DataFrame:
    """Events whose transaction is not in the executed set; events without a number stay."""
    spans, small = broadcast_if_small(executed.select("source_uuid", "lo", "hi"), broadcast_spans)
    if small:
        inside = (F.col("gtid_uuid") == F.col("source_uuid")) & F.col("gtid_no").between(F.col("lo"), F.col("hi"))
        return log.join(spans, inside, "left_anti")
    # A number has the events of one transaction; those without one need no look-up and are kept apart.
    numbered = F.col("gtid_uuid").isNotNull() & F.col("gtid_no").isNotNull()
    points = log.where(numbered).withColumns({"source_uuid": F.col("gtid_uuid"), "lo": F.col("gtid_no")})
    reach = _reach(executed, points, slice_numbers)
    left = reach.where(F.col("_reach").isNull() | (F.col("_reach") < F.col("lo"))).select(*log.columns)
    return left.unionByName(log.where(~numbered))


def gtid_contains(outer: DataFrame, inner: DataFrame, set_id: str, slice_numbers: int = SLICE_NUMBERS) -> DataFrame:
    """Per inner set: is every number of it in the outer set?

    ``outer`` holds merged intervals, ``inner`` intervals as written.
    """
    probes = inner.select(set_id, "source_uuid", "lo", "hi")
    covered = _with_covered(probes, outer, slice_numbers)
    return covered.groupBy(set_id).agg(F.bool_and("_covered").alias("contained"))


def purged_gtids(log: DataFrame) -> DataFrame:
    """Per source, the numbers that lie before the first one still in the log."""
    first = log.where(F.col("gtid_uuid").isNotNull()).groupBy(F.col("gtid_uuid").alias("source_uuid")).agg(
        (F.min("gtid_no") - 1).alias("hi")
    )
    return first.where(F.col("hi") > 0).select("source_uuid", F.lit(1).cast("bigint").alias("lo"), "hi")


def missing_sources(log: DataFrame, executed: DataFrame, slice_numbers: int = SLICE_NUMBERS) -> DataFrame:
    """Sources whose log no longer reaches back to the executed set.

    A number that is neither executed nor in the log any more would be skipped
    without a word, so a resume by numbers is not possible for these sources.
    """
    spans = merge_spans(executed, ["source_uuid"], slice_numbers)
    purged = purged_gtids(log).withColumn("source", F.col("source_uuid"))
    return gtid_contains(spans, purged, "source", slice_numbers).where(~F.col("contained")).select("source")


def resume_log(
    log: DataFrame,
    executed: DataFrame | None = None,
    checkpoint: Position | None = None,
    default: Position | None = None,
    slice_numbers: int = SLICE_NUMBERS,
) -> DataFrame:
    """Go on by transaction numbers where that is possible, else by position."""
    if executed is not None:
        if missing_sources(log, executed, slice_numbers).isEmpty():
            return gtid_resume_filter(log, executed, slice_numbers)
        if checkpoint is None:
            raise RuntimeError("the log has lost numbers that were not executed, and no position is known")
        _log.warning("the log has lost numbers that were not executed: going on from %s", checkpoint)
    return resume_filter(log, checkpoint, default)
