"""Shared schemas, names and defaults."""

from __future__ import annotations

from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import types as T

# The operations a change row can carry.
INSERT, UPDATE, DELETE, SNAPSHOT = "INSERT", "UPDATE", "DELETE", "SNAPSHOT"
BEGIN, COMMIT = "BEGIN", "COMMIT"
ROW_OPS = (INSERT, UPDATE, DELETE)
MARKER_OPS = (BEGIN, COMMIT)

# Metadata columns of a target row, in order.
CDC_TIMESTAMP = "_cdc_timestamp"
CDC_OPERATION = "_cdc_operation"
CDC_DATABASE = "_cdc_database"
CDC_TABLE = "_cdc_table"
METADATA_COLUMNS = (CDC_TIMESTAMP, CDC_OPERATION, CDC_DATABASE, CDC_TABLE)
INSERT_ID = "_insert_id"

# Defaults of the tuning parameters.
DEFAULT_MAX_ROWS = 1000
DEFAULT_BUFFER_CAPACITY = 1000
DEFAULT_RETRY_ATTEMPTS = 3
DEFAULT_RETRY_INITIAL_S = 1
DEFAULT_RETRY_MAX_S = 30
LATENCY_WEIGHT = 0.1

CHANGE_LOG_SCHEMA = T.StructType(
    [
        T.StructField("binlog_file", T.StringType()),
        T.StructField("log_pos", T.LongType()),
        T.StructField("event_ts_s", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("query", T.StringType()),
        T.StructField("source_db", T.StringType()),
        T.StructField("source_table", T.StringType()),
        T.StructField("gtid_uuid", T.StringType()),
        T.StructField("gtid_no", T.LongType()),
        T.StructField("rows", T.ArrayType(T.ArrayType(T.StringType()))),
    ]
)

CHANGE_ROW_SCHEMA = T.StructType(
    [
        T.StructField(CDC_TIMESTAMP, T.TimestampType()),
        T.StructField(CDC_OPERATION, T.StringType()),
        T.StructField(CDC_DATABASE, T.StringType()),
        T.StructField(CDC_TABLE, T.StringType()),
        T.StructField("image", T.ArrayType(T.StringType())),
        T.StructField(INSERT_ID, T.StringType()),
    ]
)

CATALOG_SCHEMA = T.StructType(
    [
        T.StructField("table_schema", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("ordinal_position", T.IntegerType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("column_type", T.StringType()),
        T.StructField("is_nullable", T.StringType()),
        T.StructField("column_default", T.StringType()),
        T.StructField("character_maximum_length", T.LongType()),
        T.StructField("numeric_precision", T.LongType()),
        T.StructField("numeric_scale", T.LongType()),
    ]
)


class Position(NamedTuple):
    """A point in the log; files compare as text, offsets as numbers."""

    binlog_file: str
    log_pos: int


class ColumnSpec(NamedTuple):
    name: str
    spark_type: str
    required: bool = False


@dataclass(frozen=True)
class TableSpec:
    """One source table: its columns in ordinal order and its primary key."""

    database: str
    table: str
    columns: tuple[ColumnSpec, ...]
    key: tuple[str, ...] = ()

    @property
    def column_names(self) -> tuple[str, ...]:
        return tuple(c.name for c in self.columns)
