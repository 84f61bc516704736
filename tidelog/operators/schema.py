"""Target schemas from the column catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.mysql_types import STRING, TIMESTAMP, infer_spark_type, map_type, spark_type
from tidelog.model import METADATA_COLUMNS, ColumnSpec, TableSpec

# Target types of the metadata columns, in order.
METADATA_TYPES = (TIMESTAMP, STRING, STRING, STRING)


def derive_schema(catalog: DataFrame) -> DataFrame:
    """Target columns of every table: metadata first, then the source columns in order."""
    meta = F.array(
        *(
            F.struct(
                F.lit(i).alias("ordinal"),
                F.lit(name).alias("column_name"),
                F.lit(kind).alias("target_type"),
                F.lit(False).alias("required"),
            )
            for i, (name, kind) in enumerate(zip(METADATA_COLUMNS, METADATA_TYPES, strict=True), start=1)
        )
    )
    tables = catalog.select("table_schema", "table_name").distinct()
    source = catalog.select(
        "table_schema",
        "table_name",
        (F.col("ordinal_position") + len(METADATA_COLUMNS)).alias("ordinal"),
        "column_name",
        map_type(F.col("column_type")).alias("target_type"),
        (F.col("is_nullable") == "NO").alias("required"),
    )
    return tables.select("table_schema", "table_name", F.inline(meta)).unionByName(source)


def fallback_schema(first_row: T.StructType | None) -> list[tuple[str, str]]:
    """Without a catalog: metadata columns, and the columns of the first row where there is one."""
    columns = list(zip(METADATA_COLUMNS, METADATA_TYPES, strict=True))
    if first_row is not None:
        columns += [(f.name, infer_spark_type(f.dataType)) for f in first_row.fields]
    return columns


def table_spec(catalog: DataFrame, database: str, table: str, key: tuple[str, ...] = ()) -> TableSpec:
    """One table's columns for the driver to build a plan with; a table has at most 4,096."""
    rows = (
        catalog.where((F.col("table_schema") == database) & (F.col("table_name") == table))
        .select(
            "ordinal_position",
            "column_name",
            spark_type(F.col("column_type"), F.col("numeric_precision"), F.col("numeric_scale")).alias("spark_type"),
            (F.col("is_nullable") == "NO").alias("required"),
        )
        .collect()
    )
    rows.sort(key=lambda r: r["ordinal_position"])
    return TableSpec(
        database, table, tuple(ColumnSpec(r["column_name"], r["spark_type"], r["required"]) for r in rows), key
    )


def target_struct(spec: TableSpec) -> T.StructType:
    """The target table's Spark schema."""
    struct = T.StructType()
    hidden = set(spec.column_names)
    for name, kind in zip(METADATA_COLUMNS, METADATA_TYPES, strict=True):
        if name not in hidden:
            struct.add(name, T.TimestampType() if kind == TIMESTAMP else T.StringType(), True)
    for c in spec.columns:
        struct.add(c.name, T._parse_datatype_string(c.spark_type), not c.required)
    return struct
