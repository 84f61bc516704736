"""Tables of failed writes.

``errors`` is an array of ``(reason, message)`` per failed row, so that one row
is classified where it stands, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.failures import (
    IGNORED,
    PERMANENT,
    RETRY,
    batch_retryable,
    classify_row_error,
    retry_delay_s,
    retry_exhausted,
)
from tidelog.model import DEFAULT_RETRY_ATTEMPTS, DEFAULT_RETRY_INITIAL_S, DEFAULT_RETRY_MAX_S


def classify_rows(failed: DataFrame, batch_rows: Column) -> DataFrame:
    return failed.withColumn(
        "outcome", classify_row_error(F.col("errors"), F.col("row_index"), batch_rows)
    )


def batch_outcome(classified: DataFrame, retries_left: Column | None = None) -> DataFrame:
    """Per batch: how its failed rows fared and what follows for the batch.

    ``retries_left`` is a boolean that is equal over the rows of a batch.
    """
    left = F.bool_and(retries_left) if retries_left is not None else F.lit(True)
    counted = classified.groupBy("batch_id").agg(
        F.count_if(F.col("outcome") == RETRY).alias("retry_rows"),
        F.count_if(F.col("outcome") == IGNORED).alias("ignored_rows"),
        F.count_if(F.col("outcome") == PERMANENT).alias("permanent_rows"),
        left.alias("_left"),
    )
    verdict = (
        F.when(F.col("permanent_rows") > 0, F.lit("failed"))
        .when(F.col("retry_rows") == 0, F.lit("done"))
        .when(F.col("_left"), F.lit("retry"))
        .otherwise(F.lit("failed"))
    )
    return counted.withColumn("verdict", verdict).drop("_left")


def retry_order(classified: DataFrame) -> DataFrame:
    """The rows to write again, in their original order."""
    return classified.where(F.col("outcome") == RETRY).orderBy("batch_id", "row_index")


def retry_schedule(
    attempts: DataFrame,
    attempt: str,
    failed_at: str,
    initial_s: float = DEFAULT_RETRY_INITIAL_S,
    max_s: float = DEFAULT_RETRY_MAX_S,
    max_attempts: int = DEFAULT_RETRY_ATTEMPTS,
) -> DataFrame:
    """When each failed attempt is tried again, and whether its tries are used up."""
    delay = retry_delay_s(F.col(attempt), initial_s, max_s)
    return attempts.withColumns(
        {
            "delay_s": delay,
            "next_attempt_at": F.col(failed_at) + F.make_dt_interval(secs=delay.cast("decimal(18,6)")),
            "exhausted": retry_exhausted(F.col(attempt), max_attempts),
        }
    )


def retryable_batches(failed: DataFrame) -> DataFrame:
    return failed.withColumn("retryable", batch_retryable(F.col("message"), F.col("errors")))
