"""Landed, decoded change logs: batch and streaming readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.model import CHANGE_LOG_SCHEMA
from tidelog.operators.images import is_marker


def read_change_log(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(CHANGE_LOG_SCHEMA).format(fmt).load(path)


def stream_change_log(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """The same log as a stream; files or bytes, not both, bound a micro-batch."""
    reader = spark.readStream.schema(CHANGE_LOG_SCHEMA).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.load(path)


def select_log_tables(log: DataFrame, tables: list[tuple[str, str | None]]) -> DataFrame:
    """Row events of the chosen tables, with all transaction markers."""
    chosen = tables_predicate(tables, "source_db", "source_table")
    return log.where(chosen | is_marker(F.col("kind"), F.col("query")))


def tables_predicate(tables: list[tuple[str, str | None]], database: str, table: str) -> Column:
    """The configured tables as a plain predicate, which reaches the scan.

    ``(db, None)`` stands for every table of a database.
    """
    by_db: dict[str, set[str] | None] = {}
    for db, name in tables:
        if not db:
            raise ValueError("a table needs its database")
        if name is None or by_db.get(db, set()) is None:
            by_db[db] = None
        else:
            by_db.setdefault(db, set()).add(name)
    chosen = F.lit(False)
    for db, names in by_db.items():
        here = F.col(database) == db
        chosen = chosen | (here if names is None else here & F.col(table).isin(*sorted(names)))
    return chosen
