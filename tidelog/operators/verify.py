"""Checks after a run: source against target, and duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_checksum(columns: Sequence[str]) -> Column:
    """A 64-bit hash of a row; summed as a decimal it does not depend on the row order."""
    return F.xxhash64(*(F.col(f"`{c}`") for c in columns))


def table_fingerprint(df: DataFrame, keys: Sequence[str], checksum: Column) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count("*").alias("n_rows"), F.sum(checksum.cast("decimal(20,0)")).alias("checksum")
    )


def reconcile(source: DataFrame, target: DataFrame, keys: Sequence[str], checksum: Column) -> DataFrame:
    """Row counts and checksums of both sides, table by table; a side may lack a table."""
    left = table_fingerprint(source, keys, checksum).alias("s")
    right = table_fingerprint(target, keys, checksum).alias("t")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"s.{k}").eqNullSafe(F.col(f"t.{k}"))
    rows = [F.coalesce(F.col(f"{side}.n_rows"), F.lit(0)) for side in ("s", "t")]
    return left.join(right, same, "full_outer").select(
        *(F.coalesce(F.col(f"s.{k}"), F.col(f"t.{k}")).alias(k) for k in keys),
        rows[0].alias("source_rows"),
        rows[1].alias("target_rows"),
        ((rows[0] == rows[1]) & F.col("s.checksum").eqNullSafe(F.col("t.checksum"))).alias("is_equal"),
    )


def duplicate_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of copies."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)
