"""Gaps in a landed log: files and transaction numbers that should be there and are not.

A log that lost a file reads as if nothing had been in it. Two things show the
loss: log files are numbered one after the other, and every source numbers its
transactions without holes. Both are checked by one reduction of the log to
numbers and a window over these few rows; no event is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidelog.operators.positions import SLICE_NUMBERS, executed_gtids

FILE, NUMBER = "file", "number"


def file_series(binlog_file: str = "binlog_file") -> Column:
    """Name of a log file without its number."""
    return F.regexp_extract(binlog_file, r"^(.*?)\.?(\d+)$", 1)


def file_number(binlog_file: str = "binlog_file") -> Column:
    return F.regexp_extract(binlog_file, r"^(.*?)\.?(\d+)$", 2).cast("bigint")


def _holes(islands: DataFrame, kind: str) -> DataFrame:
    """Stretches between the islands (name, lo, hi) of each name; one row a hole."""
    ahead = W.partitionBy("name").orderBy("lo")
    held = islands.withColumn("_before", F.lag("hi").over(ahead))
    return held.where(F.col("lo") > F.col("_before") + 1).select(
        F.lit(kind).alias("kind"),
        "name",
        (F.col("_before") + 1).alias("first_missing"),
        (F.col("lo") - 1).alias("last_missing"),
    )


def log_files(log: DataFrame) -> DataFrame:
    """One row a log file: the name of its series and its number."""
    names = log.select("binlog_file").distinct()
    return names.select(file_series().alias("name"), file_number().alias("lo"), file_number().alias("hi"))


def marks(log: DataFrame) -> DataFrame:
    """How far a log reaches: kind, name and the highest number of each file series and source."""
    files = log_files(log).groupBy("name").agg(F.max("hi").alias("reached")).withColumn("kind", F.lit(FILE))
    numbered = log.where(F.col("gtid_uuid").isNotNull()).groupBy(F.col("gtid_uuid").alias("name"))
    numbers = numbered.agg(F.max("gtid_no").alias("reached")).withColumn("kind", F.lit(NUMBER))
    return files.unionByName(numbers).select("kind", "name", "reached")


def log_gaps(log: DataFrame, reached: DataFrame | None = None, slice_numbers: int = SLICE_NUMBERS) -> DataFrame:
    """kind, name, first_missing, last_missing: holes in file numbers and in each source's transaction numbers.

    ``reached`` are the ``marks`` of what was read before: the log must go on
    right behind them, and what lies at or before them (a repeated delivery) is
    not looked at. The window over files sees one row a log file; that over
    numbers one row an unbroken run of numbers.
    """
    runs = executed_gtids(log, slice_numbers).select(F.col("source_uuid").alias("name"), "lo", "hi")
    found = []
    for kind, islands in ((FILE, log_files(log)), (NUMBER, runs)):
        if reached is not None:
            last = reached.where(F.col("kind") == kind).select("name", "reached")
            islands = islands.join(last, "name", "left").where(F.col("reached").isNull() | (F.col("hi") > F.col("reached")))
            islands = islands.select("name", "lo", "hi").unionByName(last.select("name", F.col("reached").alias("lo"), F.col("reached").alias("hi")))
        found.append(_holes(islands, kind))
    return found[0].unionByName(found[1])


class LogGap(RuntimeError):
    """The log has a hole; going on would skip what is missing without a word."""


def require_unbroken(gaps: DataFrame, most: int = 20) -> None:
    """Raises ``LogGap`` that names the first ``most`` holes."""
    found = gaps.orderBy("kind", "name", "first_missing").limit(most).collect()
    if found:
        text = "; ".join(f"{g.kind} {g.name} {g.first_missing} to {g.last_missing}" for g in found)
        raise LogGap(f"the log has holes: {text}")
