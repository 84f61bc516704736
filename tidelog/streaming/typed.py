"""One stream of change rows into a typed table for every source table.

A micro-batch is computed once and staged by table and fitness in one write.
Each table of the batch then reads its own folder, applies the columns of the
catalog and replaces the batch's folder in its own target. What does not fit its
column, or lacks a required value, goes to the quarantine with the reasons.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.model import CDC_DATABASE, CDC_TABLE, CHANGE_ROW_SCHEMA, INSERT_ID, METADATA_COLUMNS, TableSpec
from tidelog.operators.images import cast_failures, fitting, named_columns
from tidelog.sinks.targets import delete_folders, existing, read_or_none
from tidelog.streaming.sinks import BatchWriter, batch_folder

FITS, REASONS = "_fits", "_reasons"
UNKNOWN = "no such table in the catalog"


def missing_values(spec: TableSpec) -> Column:
    """Names of the required columns whose positional value is null or absent."""
    checks = [F.when(F.try_element_at(F.col("image"), F.lit(i + 1)).isNull(), F.lit(c.name)) for i, c in enumerate(spec.columns) if c.required]
    return F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")


def misfits(specs: list[TableSpec]) -> Column:
    """Why a change row cannot go into its table; empty if it can. One expression for all tables."""
    reasons = F.array(F.lit(UNKNOWN))
    for spec in specs:
        here = (F.col(CDC_DATABASE) == spec.database) & (F.col(CDC_TABLE) == spec.table)
        own = F.concat(
            F.transform(cast_failures(spec.columns), lambda c: F.concat(F.lit("value does not fit "), c)),
            F.transform(missing_values(spec), lambda c: F.concat(F.lit("no value for "), c)),
        )
        reasons = F.when(here, own).otherwise(reasons)
    return reasons


def fits(specs: list[TableSpec]) -> Column:
    """Does a change row go into its table? The same as no ``misfits``, but compiled, as it works out no reasons."""
    found = F.lit(False)
    for spec in specs:
        here, whole = (F.col(CDC_DATABASE) == spec.database) & (F.col(CDC_TABLE) == spec.table), F.lit(True)
        for i, c in enumerate(spec.columns):
            value = F.try_element_at(F.col("image"), F.lit(i + 1))
            typed = fitting(value, c.spark_type).isNotNull()
            whole = whole & (typed if c.required else value.isNull() | typed)
        found = F.when(here, whole).otherwise(found)
    return found


def target_path(path: str, spec: TableSpec) -> str:
    return f"{path}/{spec.database}/{spec.table}"


def typed_sink(path: str, run: str, specs: list[TableSpec]) -> BatchWriter:
    """Change rows of any table into typed targets, repeatable batch by batch.

    The number of jobs of a batch is one and one for each table that it has rows
    of. Rows of a table that is not in ``specs`` are set aside, none is lost.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, here = batch.sparkSession, batch_folder(f"{path}/staged", run, batch_id)
        placed = batch.select(*CHANGE_ROW_SCHEMA.fieldNames()).withColumn(FITS, fits(specs))
        placed.write.mode("overwrite").partitionBy(FITS, CDC_DATABASE, CDC_TABLE).parquet(here)
        for spec in specs:
            folder = f"{here}/{FITS}=true/{CDC_DATABASE}={spec.database}/{CDC_TABLE}={spec.table}"
            out = batch_folder(target_path(path, spec), run, batch_id)
            if existing(spark, [folder]):
                staged = spark.read.schema(CHANGE_ROW_SCHEMA).option("basePath", here).parquet(folder)
                typed_rows(staged, spec).write.mode("overwrite").parquet(out)
            else:
                delete_folders(spark, [out])
        bad = f"{here}/{FITS}=false"
        aside = batch_folder(f"{path}/quarantine", run, batch_id)
        if existing(spark, [bad]):
            shape = T.StructType([*CHANGE_ROW_SCHEMA.fields, T.StructField(REASONS, T.ArrayType(T.StringType()))])
            # Only these rows have their reasons worked out.
            rows = spark.read.schema(CHANGE_ROW_SCHEMA).option("basePath", here).parquet(bad).withColumn(REASONS, misfits(specs))
            rows.select(*shape.fieldNames()).write.mode("overwrite").parquet(aside)
        else:
            delete_folders(spark, [aside])
        delete_folders(spark, [here])

    return write


def typed_rows(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Metadata, the table's own columns and the insert id; a source column hides metadata of its name."""
    metadata = [c for c in METADATA_COLUMNS if c not in spec.column_names]
    return rows.select(*metadata, *named_columns(spec.columns, strict=False), INSERT_ID)


def read_typed(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """One typed target over all runs and batches; empty before its first row."""
    shape = typed_rows(spark.createDataFrame([], CHANGE_ROW_SCHEMA), spec)
    found = read_or_none(spark, target_path(path, spec), shape.schema)
    return shape if found is None else found.select(*shape.columns)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    shape = T.StructType([*CHANGE_ROW_SCHEMA.fields, T.StructField(REASONS, T.ArrayType(T.StringType()))])
    found = read_or_none(spark, f"{path}/quarantine", shape)
    return spark.createDataFrame([], shape) if found is None else found.select(*shape.fieldNames())

