"""Rows that failed in passing are tried again when their time has come.

Every round of tries is a folder of outcomes. A row whose outcome is ``retry``
waits until ``due_at_s``; the round that takes it up tries it with the next
attempt number, and its own outcome then says whether it waits again, is
written, ignored or set aside. A row is taken up once an attempt: a round looks
only at attempts that no earlier round has followed up, and a round that is
repeated replaces its folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.failures import RETRY
from tidelog.sinks.targets import read_or_none

# Tries rows that carry ``attempt`` (from 0) and returns them with ``outcome`` and ``retry_delay_s``.
Attempt = Callable[[DataFrame], DataFrame]

ROUND, OUTCOME, ATTEMPT, DUE = "round", "outcome", "attempt", "due_at_s"


def round_folder(path: str, number: int) -> str:
    return f"{path}/{ROUND}={number}"


def read_rounds(spark: SparkSession, path: str, schema: T.StructType, before: int | None = None) -> DataFrame | None:
    """All rounds, or those before a number, with ``round`` and ``outcome``; none before the first."""
    extra = [T.StructField(DUE, T.DoubleType()), T.StructField(ROUND, T.IntegerType())]
    names = {f.name for f in schema.fields}
    found = read_or_none(spark, path, T.StructType([*schema.fields, *(f for f in extra if f.name not in names)]))
    return found if found is None or before is None else found.where(F.col(ROUND) < before)


def due_rows(rounds: DataFrame, key: Sequence[str], now_s: float) -> DataFrame:
    """Rows to be tried again by ``now_s``, with the number of their next attempt.

    Rounds are partitioned by outcome, so waiting rows are read alone; of the
    others only keys and attempts are read.
    """
    waiting = rounds.where((F.col(OUTCOME) == RETRY) & (F.col(DUE) <= F.lit(float(now_s))))
    followed = rounds.where(F.col(ATTEMPT) > 0).select(*(F.col(k).alias(f"_{k}") for k in key), (F.col(ATTEMPT) - 1).alias("_attempt"))
    same = F.col(ATTEMPT) == F.col("_attempt")
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return waiting.join(followed, same, "left_anti").withColumn(ATTEMPT, F.col(ATTEMPT) + 1)


def run_round(
    spark: SparkSession, path: str, number: int, attempt: Attempt, key: Sequence[str], now_s: float, rows: DataFrame | None, shape: T.StructType
) -> None:
    """One round: ``rows`` that are new, and earlier ones whose time has come.

    ``shape`` are the columns of the rows; what ``attempt`` adds is kept beside
    them but not given to it again.
    """
    names = shape.fieldNames()
    given = [] if rows is None else [rows.select(*names).withColumn(ATTEMPT, F.lit(0))]
    if number:
        kept = T.StructType([*shape.fields, T.StructField(ATTEMPT, T.IntegerType()), T.StructField(OUTCOME, T.StringType())])
        rounds = read_rounds(spark, path, kept, number)
        if rounds is not None:
            given.append(due_rows(rounds, key, now_s).select(*names, ATTEMPT))
    if not given:
        return
    tried = attempt(given[0] if len(given) == 1 else given[0].unionByName(given[1]))
    due = F.when(F.col(OUTCOME) == RETRY, F.lit(float(now_s)) + F.col("retry_delay_s"))
    tried.withColumn(DUE, due).write.mode("overwrite").partitionBy(OUTCOME).parquet(round_folder(path, number))


def last_outcomes(rounds: DataFrame, key: Sequence[str]) -> DataFrame:
    """The state each row has reached: its outcome after the highest attempt."""
    state = F.max_by(F.struct(OUTCOME, ROUND), ATTEMPT)
    return rounds.groupBy(*key).agg(F.max(ATTEMPT).alias(ATTEMPT), state.alias("_s")).select(*key, ATTEMPT, f"_s.{OUTCOME}", f"_s.{ROUND}")
