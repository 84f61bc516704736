"""Source tables: snapshot, backfill and ordered scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.identifiers import bytes_to_text, snapshot_insert_id
from tidelog.model import (
    CDC_DATABASE,
    CDC_OPERATION,
    CDC_TABLE,
    CDC_TIMESTAMP,
    INSERT_ID,
    SNAPSHOT,
    Position,
    TableSpec,
)
from tidelog.operators.rows import cdc_metadata


def jdbc_options(
    url: str, table: str, column: str, lower: int, upper: int, partitions: int, fetch_size: int = 10_000
) -> dict[str, str]:
    """Options of a parallel JDBC read, cut along a whole-number key."""
    if partitions < 1 or upper < lower:
        raise ValueError("need at least one partition and lower <= upper")
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_size),
    }


def read_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def snapshot_scan(
    rows: DataFrame, database: str, table: str, key: Sequence[str], snapshot_ts: Column, start: Position | None = None
) -> DataFrame:
    """One SNAPSHOT change row per source row.

    The insert id names table and primary key, so that a repeated snapshot adds
    nothing. ``start`` is the log position taken before the scan.
    """
    plain = bytes_to_text(rows)
    out = plain.select(
        *cdc_metadata(snapshot_ts, F.lit(SNAPSHOT), F.lit(database), F.lit(table), plain.columns),
        *(F.col(f"`{c}`") for c in plain.columns),
        snapshot_insert_id(database, table, list(key)).alias(INSERT_ID),
    )
    if start is not None:
        out = out.withColumns({"start_file": F.lit(start.binlog_file), "start_pos": F.lit(start.log_pos)})
    return out


def snapshot_images(rows: DataFrame, spec: TableSpec, snapshot_ts: Column) -> DataFrame:
    """A snapshot in the form that all tables share: values as positional text."""
    plain = bytes_to_text(rows)
    return plain.select(
        snapshot_ts.alias(CDC_TIMESTAMP),
        F.lit(SNAPSHOT).alias(CDC_OPERATION),
        F.lit(spec.database).alias(CDC_DATABASE),
        F.lit(spec.table).alias(CDC_TABLE),
        F.array(*(F.col(f"`{c}`").cast("string") for c in spec.column_names)).alias("image"),
        snapshot_insert_id(spec.database, spec.table, list(spec.key)).alias(INSERT_ID),
    )


def backfill_scan(rows: DataFrame, where: str | Column | None = None) -> DataFrame:
    """Rows of one table without change metadata; the predicate is left to the scan."""
    return bytes_to_text(rows if where is None else rows.where(where))


def pk_ordered_scan(rows: DataFrame, key: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Rows in primary-key order, range by range."""
    ranged = rows.repartitionByRange(partitions, *key) if partitions else rows.repartitionByRange(*key)
    return ranged.sortWithinPartitions(*key)
