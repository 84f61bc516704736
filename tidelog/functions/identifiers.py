"""Keys and small conversions of change rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def insert_id(binlog_file: Column, log_pos: Column, txn_id: Column, image_idx: Column) -> Column:
    """``(file, pos):transaction:index``, the same for every delivery of a row."""
    pos, idx = log_pos.cast("string"), image_idx.cast("string")
    return F.concat(F.lit("("), binlog_file, F.lit(", "), pos, F.lit("):"), txn_id, F.lit(":"), idx)


def snapshot_insert_id(database: str, table: str, key: list[str]) -> Column:
    """Snapshot rows have no log position: table and primary key name them.

    Key parts are escaped, so that two keys never give the same text.
    """
    parts = [F.regexp_replace(F.col(f"`{k}`").cast("string"), r"([\\|])", r"\\$1") for k in key]
    return F.concat(F.lit(f"snapshot:{database}.{table}:"), F.concat_ws("|", *parts))


def route_key(database: Column, table: Column) -> Column:
    """Name of the target table."""
    return F.concat_ws("_", database, table)


def route_splits(key: Column) -> Column:
    """Whether a target name splits back into exactly one database and one table."""
    return F.size(F.split(key, "_")) == 2


def event_time(epoch_s: Column) -> Column:
    return F.timestamp_seconds(epoch_s)


def bytes_to_text(df: DataFrame) -> DataFrame:
    """Every binary column as text. The bytes stay as they are, valid UTF-8 or not."""
    text = {
        f.name: F.col(f"`{f.name}`").cast("string") for f in df.schema.fields if isinstance(f.dataType, T.BinaryType)
    }
    return df.withColumns(text) if text else df
