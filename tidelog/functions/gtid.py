"""Transaction-number sets written as text: ``uuid:1-5:7,uuid:3``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def gtid_spans(text: Column) -> Column:
    """The text as an array of ``(source_uuid, lo, hi)``; ``n`` alone means ``n-n``."""

    def of_source(part: Column) -> Column:
        pieces = F.split(F.trim(part), ":")
        uuid = F.lower(F.trim(pieces[0]))

        def span(piece: Column) -> Column:
            ends = F.split(F.trim(piece), "-")
            return F.struct(
                uuid.alias("source_uuid"),
                F.trim(ends[0]).cast("bigint").alias("lo"),
                F.trim(F.element_at(ends, -1)).cast("bigint").alias("hi"),
            )

        return F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), span)

    sources = F.filter(F.split(text, ","), lambda p: F.length(F.trim(p)) > 0)
    return F.flatten(F.transform(sources, of_source))


def merged_gtid_spans(text: Column) -> Column:
    """The text's intervals, joined where they overlap or touch, in order.

    A set is one text in one row, so this needs no shuffle.
    """

    def add(merged: Column, span: Column) -> Column:
        last = F.element_at(merged, -1)
        touches = (last["source_uuid"] == span["source_uuid"]) & (span["lo"] <= last["hi"] + 1)
        joined = F.struct(
            last["source_uuid"].alias("source_uuid"),
            last["lo"].alias("lo"),
            F.greatest(last["hi"], span["hi"]).alias("hi"),
        )
        kept = F.slice(merged, F.lit(1), F.size(merged) - 1)
        return F.when((F.size(merged) > 0) & touches, F.concat(kept, F.array(joined))).otherwise(F.concat(merged, F.array(span)))

    none = F.array().cast("array<struct<source_uuid:string,lo:bigint,hi:bigint>>")
    return F.aggregate(F.array_sort(gtid_spans(text)), none, add)


def explode_gtid_sets(df: DataFrame, text: str, keep: list[str], merged: bool = False) -> DataFrame:
    """One row per interval, as written, or ``merged`` within each text."""
    spans = merged_gtid_spans(F.col(text)) if merged else gtid_spans(F.col(text))
    return df.select(*keep, F.inline(spans))
