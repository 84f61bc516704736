"""Running values over a long order, computed in bounded slices.

A plain window gives one task the whole of a group, so one hot log file, table
or transaction would stop the job. Here the order is cut into slices. Every
slice is first reduced to one row; a window over those few rows says what each
slice starts with; that row is then put at the head of its slice, and one window
per slice gives the running value. The full rows are shuffled once, by group and
slice, and no task holds more than a slice.

Levels nest: ``levels=[["binlog_file"], ["slice"]]`` carries totals from file to
file and, within a file, from slice to slice.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_HEAD = "_is_body"


@dataclass(frozen=True)
class Running:
    """One running value: ``kind`` is ``sum``, ``min``, ``max`` or ``nearest``.

    ``nearest`` is the last value on the way to the current row, nulls left out;
    within a slice the values must grow with the order, as positions do.
    ``exclusive`` leaves the current row out. ``backward`` runs from the end of
    the order towards the current row.
    """

    name: str
    kind: str
    value: Column
    exclusive: bool = False
    backward: bool = False

    def total(self, column: Column) -> Column:
        """Over the rows of a slice."""
        if self.kind == "nearest":
            return F.min(column) if self.backward else F.max(column)
        return {"sum": F.sum, "min": F.min, "max": F.max}[self.kind](column)

    def along(self, column: Column) -> Column:
        """Over a window that ends at the current row."""
        return F.last(column, ignorenulls=True) if self.kind == "nearest" else self.total(column)


def running(
    df: DataFrame,
    group: Sequence[str],
    levels: Sequence[Sequence[str]],
    order: Sequence[str],
    values: Sequence[Running],
) -> DataFrame:
    """Add the running ``values`` over ``order`` within ``group``.

    Each level is a list of columns that cut the order further; sorting by
    group, levels and order must give the intended sequence.
    """
    inputs = {f"_in_{v.name}": v.value for v in values}
    if not levels:
        return _apply(df.withColumns(inputs), list(group), order, values, with_head=False)

    partition = [*group, *(c for level in levels for c in level)]
    slices = df.withColumns(inputs).groupBy(*partition).agg(
        *(v.total(F.col(f"_in_{v.name}")).alias(f"_in_{v.name}") for v in values)
    )
    carried = running(
        slices,
        group,
        levels[:-1],
        levels[-1],
        [Running(f"_carry_{v.name}", v.kind, F.col(f"_in_{v.name}"), True, v.backward) for v in values],
    )
    # A slice that starts with nothing needs no head; so groups of one slice add no rows.
    carries = [(v.kind, F.col(f"_carry_{v.name}")) for v in values]
    brings = [c != 0 if kind == "sum" else c.isNotNull() for kind, c in carries]
    heads = carried.where(reduce(or_, brings)).select(
        *partition,
        *(F.col(f"_carry_{v.name}").alias(f"_in_{v.name}") for v in values),
        F.lit(False).alias(_HEAD),
    )
    joined = df.withColumn(_HEAD, F.lit(True)).unionByName(heads, allowMissingColumns=True)
    # Rows are shuffled without the inputs, which are worked out behind the shuffle.
    spread = joined.repartition(*(F.col(c) for c in partition))
    known = {name: F.when(F.col(_HEAD), value).otherwise(F.col(name)) for name, value in inputs.items()}
    return _apply(spread.withColumns(known), partition, order, values, with_head=True)


def _apply(
    body: DataFrame, partition: list[str], order: Sequence[str], values: Sequence[Running], with_head: bool
) -> DataFrame:
    first = [F.col(_HEAD)] if with_head else []
    base = W.partitionBy(*partition) if partition else W.partitionBy()
    ahead = base.orderBy(*first, *(F.col(c).asc() for c in order))
    back = base.orderBy(*first, *(F.col(c).desc() for c in order))
    out = {}
    for v in values:
        window = (back if v.backward else ahead).rowsBetween(W.unboundedPreceding, -1 if v.exclusive else 0)
        value = v.along(F.col(f"_in_{v.name}")).over(window)
        out[v.name] = F.coalesce(value, F.lit(0)) if v.kind == "sum" else value
    result = body.withColumns(out).drop(*(f"_in_{v.name}" for v in values))
    if with_head:
        result = result.where(F.col(_HEAD)).drop(_HEAD)
    return result


def slice_of(column: str, width: int) -> Column:
    """Slice number of a whole-number order: at most ``2 * width`` values a slice."""
    return F.expr(f"`{column}` div {int(width)}")
