"""Row images to change rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.identifiers import event_time, insert_id
from tidelog.model import (
    CDC_DATABASE,
    CDC_OPERATION,
    CDC_TABLE,
    CDC_TIMESTAMP,
    INSERT_ID,
    METADATA_COLUMNS,
    TableSpec,
)
from tidelog.operators.images import named_columns


def metadata_clashes(columns: Sequence[str]) -> list[str]:
    """Source columns that hide a metadata column of the same name."""
    return [c for c in METADATA_COLUMNS if c in set(columns)]


def cdc_metadata(
    timestamp: Column, operation: Column, database: Column, table: Column, source_columns: Sequence[str]
) -> list[Column]:
    """The metadata columns; where the source has a column of that name, the source wins."""
    values = dict(zip(METADATA_COLUMNS, (timestamp, operation, database, table), strict=True))
    hidden = set(metadata_clashes(source_columns))
    return [value.alias(name) for name, value in values.items() if name not in hidden]


def typed_change_rows(images: DataFrame, spec: TableSpec, extra: Sequence[str] = ()) -> DataFrame:
    """Change rows of one table with its own columns and the insert id."""
    mine = images.where((F.col("source_db") == spec.database) & (F.col("source_table") == spec.table))
    return mine.select(
        *cdc_metadata(
            event_time(F.col("event_ts_s")),
            F.col("op"),
            F.col("source_db"),
            F.col("source_table"),
            spec.column_names,
        ),
        *named_columns(spec.columns),
        insert_id(F.col("binlog_file"), F.col("log_pos"), F.col("txn_id"), F.col("image_idx")).alias(INSERT_ID),
        *extra,
    )


def generic_change_rows(images: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Change rows of all tables at once, the values still positional text.

    One write then serves every table; readers of a table apply its columns.
    """
    return images.select(
        event_time(F.col("event_ts_s")).alias(CDC_TIMESTAMP),
        F.col("op").alias(CDC_OPERATION),
        F.col("source_db").alias(CDC_DATABASE),
        F.col("source_table").alias(CDC_TABLE),
        F.col("image"),
        insert_id(F.col("binlog_file"), F.col("log_pos"), F.col("txn_id"), F.col("image_idx")).alias(INSERT_ID),
        *extra,
    )


def rename_drop(df: DataFrame, rename: dict[str, str] | None = None, drop: Sequence[str] = ()) -> DataFrame:
    """Per-table renames and drops; a name the table lacks is an error."""
    wanted = [*(rename or {}), *drop]
    unknown = [c for c in wanted if c not in df.columns]
    if unknown:
        raise ValueError(f"no such columns: {', '.join(unknown)}")
    return df.select(*(F.col(f"`{c}`").alias((rename or {}).get(c, c)) for c in df.columns if c not in set(drop)))
