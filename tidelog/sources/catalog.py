"""The column catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.model import CATALOG_SCHEMA


def column_catalog_scan(catalog: DataFrame, database: str | None = None, table: str | None = None) -> DataFrame:
    """Column metadata in ordinal order, of one table, one database or all."""
    found = catalog.select(*CATALOG_SCHEMA.fieldNames())
    if database is not None:
        found = found.where(F.col("table_schema") == database)
    if table is not None:
        found = found.where(F.col("table_name") == table)
    return found.orderBy("table_schema", "table_name", "ordinal_position")
