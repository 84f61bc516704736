"""Append-only targets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.identifiers import route_key, route_splits
from tidelog.model import CDC_DATABASE, CDC_TABLE, CHANGE_ROW_SCHEMA, INSERT_ID, METADATA_COLUMNS, TableSpec
from tidelog.operators.images import named_columns
from tidelog.operators.schema import target_struct


def even_out(df: DataFrame, *columns: str) -> DataFrame:
    """Gather rows by target partition before a write.

    Adaptive execution splits a hot partition over several tasks and joins small
    ones, so neither one huge file nor thousands of tiny ones result.
    """
    return df.hint("rebalance", *(F.col(c) for c in columns))


def append_change_rows(rows: DataFrame, path: str) -> None:
    """One write for all source tables, a folder per database and table."""
    even_out(rows, CDC_DATABASE, CDC_TABLE).write.partitionBy(CDC_DATABASE, CDC_TABLE).mode("append").parquet(path)


def read_target(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """One table of a shared target: only its folder is read, its columns are applied."""
    rows = read_targets(spark, path).where((F.col(CDC_DATABASE) == spec.database) & (F.col(CDC_TABLE) == spec.table))
    metadata = [c for c in METADATA_COLUMNS if c not in spec.column_names]
    return rows.select(*metadata, *named_columns(spec.columns), INSERT_ID)


def read_targets(spark: SparkSession, path: str) -> DataFrame:
    """All tables of a shared target, values still positional."""
    return spark.read.schema(CHANGE_ROW_SCHEMA).parquet(path)


def quarantine_routes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with their route, and a count of those whose joined name cannot be split back.

    Database and table travel as two columns, so no row is lost over its name.
    """
    routed = rows.withColumn("route_key", route_key(F.col(CDC_DATABASE), F.col(CDC_TABLE))).withColumn(
        "route_ok", route_splits(F.col("route_key"))
    )
    return routed, routed.where(~F.col("route_ok")).groupBy(CDC_DATABASE, CDC_TABLE).agg(F.count("*").alias("n_rows"))


def distinct_rows(rows: DataFrame, key: str = INSERT_ID) -> DataFrame:
    """One copy per insert id; copies are merged before the shuffle."""
    return rows.dropDuplicates([key])


def new_rows(
    rows: DataFrame,
    target: DataFrame | None,
    key: str = INSERT_ID,
    prune: str | None = None,
    bounds: tuple | None = None,
    single: bool = False,
) -> DataFrame:
    """Rows not yet in the target, each once.

    ``prune`` names a column of both sides that is equal in every copy of a row,
    such as the event time or a partition column: only the target's partitions
    and row groups between the lowest and highest value of ``rows`` are read.
    ``bounds`` gives these two values where they are known; else they take an
    extra pass over ``rows``. ``single`` says that ``rows`` repeats no key, as
    after ``assign_transaction``, and spares the search for copies.
    """
    fresh = rows if single else distinct_rows(rows, key)
    if target is None:
        return fresh
    if prune is not None:
        low, high = bounds or rows.agg(F.min(prune), F.max(prune)).first()
        if low is None:
            return fresh
        target = target.where(F.col(prune).between(F.lit(low), F.lit(high)))
    return fresh.join(target.select(key), key, "left_anti").select(*rows.columns)


def read_or_none(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    try:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def idempotent_append(
    rows: DataFrame,
    path: str,
    key: str = INSERT_ID,
    partition: Sequence[str] = (),
    prune: str | None = None,
    bounds: tuple | None = None,
    single: bool = False,
) -> None:
    """Append only rows the target lacks; doing it again adds nothing.

    One writer at a time: a plain folder has no transactions.
    """
    fresh = new_rows(rows, read_or_none(rows.sparkSession, path), key, prune, bounds, single)
    writer = (even_out(fresh, *partition) if partition else fresh).write.mode("append")
    (writer.partitionBy(*partition) if partition else writer).parquet(path)


def raw_append(rows: DataFrame, path: str) -> None:
    """Backfill rows as they are, without metadata."""
    rows.write.mode("append").parquet(path)


def ensure_target(
    spark: SparkSession, database: str, spec: TableSpec, location: str, partition: str | None = None
) -> str:
    """Create database and table where missing; an existing table is left as it is."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{location}'")
    name = f"`{database}`.`{spec.database}_{spec.table}`"
    struct = target_struct(spec)
    columns = [f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in struct.fields]
    columns.append(f"`{INSERT_ID}` string")
    by = f" PARTITIONED BY (`{partition}`)" if partition else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(columns)}) USING parquet{by}")
    return name


def append_to_table(rows: DataFrame, name: str) -> None:
    """Append by column name to a table made by ``ensure_target``."""
    spark = rows.sparkSession
    rows.select(*(F.col(f"`{c}`") for c in spark.table(name).columns)).write.insertInto(name)


# Text form of a period; text order is time order.
PERIOD_FORMATS = {"hour": "yyyy-MM-dd-HH", "day": "yyyy-MM-dd", "month": "yyyy-MM-dd", "year": "yyyy-MM-dd"}


def period_text(time: Column, granularity: str) -> Column:
    """Start of the hour, day, month or year as text."""
    if granularity not in PERIOD_FORMATS:
        raise ValueError(f"unknown granularity {granularity!r}")
    return F.date_format(F.date_trunc(granularity, time), PERIOD_FORMATS[granularity])


def add_time_partition(rows: DataFrame, field: str, granularity: str, name: str = "_cdc_period") -> DataFrame:
    return rows.withColumn(name, period_text(F.col(field), granularity))


def write_time_partitioned(
    rows: DataFrame, path: str, field: str, granularity: str = "day", name: str = "_cdc_period"
) -> None:
    even_out(add_time_partition(rows, field, granularity, name), name).write.partitionBy(name).mode("append").parquet(
        path
    )


def retained(rows: DataFrame, period: str, granularity: str, now: Column, expiration_s: int) -> DataFrame:
    """Rows of the periods that have not expired; expired folders are not read."""
    oldest = period_text(now - F.make_dt_interval(secs=F.lit(expiration_s)), granularity)
    return rows.where(F.col(period).cast("string") >= oldest)


def existing(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Those of the folders that are there."""
    folders = [(p, spark._jvm.org.apache.hadoop.fs.Path(p)) for p in paths]
    conf = spark._jsc.hadoopConfiguration()
    return [p for p, folder in folders if folder.getFileSystem(conf).exists(folder)]


def delete_folders(spark: SparkSession, paths: Sequence[str]) -> None:
    """Delete folders that are there."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def expire_partitions(spark: SparkSession, path: str, period: str, oldest_kept: str) -> list[str]:
    """Delete the folders of periods before ``oldest_kept``; no row is rewritten.

    The folder names are listed on the driver, one name per period.
    """
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith(f"{period}=") and name.split("=", 1)[1] < oldest_kept:
            fs.delete(status.getPath(), True)
            gone.append(name)
    return sorted(gone)
