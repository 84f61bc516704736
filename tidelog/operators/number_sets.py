"""Transaction-number sets as ranges of a run: what is still to do, and what the log does not hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.operators.ordered import Running, running, slice_of
from tidelog.operators.positions import BROADCAST_SPANS, SLICE_NUMBERS, _reach, merge_spans
from tidelog.session import broadcast_if_small

SPANS = "source_uuid string, lo bigint, hi bigint"


def subtract_spans(spans: DataFrame, taken: DataFrame, slice_numbers: int = SLICE_NUMBERS) -> DataFrame:
    """Intervals (source_uuid, lo, hi) of the numbers that are in ``spans`` and not in ``taken``.

    Both sides are merged, then one sorted sweep over the ends of all intervals
    knows at each of them whether either side is open; a stretch up to the next
    end is left where only the first one is. Intervals are never paired.
    """

    def ends(side: DataFrame, name: str) -> DataFrame:
        merged = merge_spans(side.select("source_uuid", "lo", "hi"), ["source_uuid"], slice_numbers)
        both = F.array(
            F.struct(F.col("lo").alias("at"), F.lit(1).cast("bigint").alias(name)),
            F.struct((F.col("hi") + 1).alias("at"), F.lit(-1).cast("bigint").alias(name)),
        )
        return merged.select("source_uuid", F.inline(both))

    points = ends(spans, "wanted").unionByName(ends(taken, "gone"), allowMissingColumns=True)
    # Ends at one number are one point: an interval that begins where another ends leaves no gap.
    points = points.groupBy("source_uuid", "at").agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("wanted", "gone")))
    swept = running(
        points.withColumn("_slice", slice_of("at", slice_numbers)),
        ["source_uuid"],
        [["_slice"]],
        ["at"],
        [
            Running("_wanted", "sum", F.col("wanted")),
            Running("_gone", "sum", F.col("gone")),
            Running("_next", "min", F.col("at"), exclusive=True, backward=True),
        ],
    )
    return swept.where((F.col("_wanted") > 0) & (F.col("_gone") == 0)).select(
        "source_uuid", F.col("at").alias("lo"), (F.col("_next") - 1).alias("hi")
    )


def events_of_numbers(
    log: DataFrame, spans: DataFrame, slice_numbers: int = SLICE_NUMBERS, broadcast_spans: int = BROADCAST_SPANS
) -> DataFrame:
    """Events whose transaction number lies in ``spans`` (merged); events without a number go."""
    held, small = broadcast_if_small(spans.select("source_uuid", "lo", "hi"), broadcast_spans)
    if small:
        inside = (F.col("gtid_uuid") == F.col("source_uuid")) & F.col("gtid_no").between(F.col("lo"), F.col("hi"))
        return log.join(held, inside, "left_semi")
    numbered = log.where(F.col("gtid_uuid").isNotNull() & F.col("gtid_no").isNotNull())
    points = numbered.withColumns({"source_uuid": F.col("gtid_uuid"), "lo": F.col("gtid_no")})
    return _reach(spans, points, slice_numbers).where(F.col("_reach") >= F.col("lo")).select(*log.columns)
