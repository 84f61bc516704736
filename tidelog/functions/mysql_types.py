"""Source column types: mapping to target types and to Spark types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

BOOLEAN, INTEGER, FLOAT, NUMERIC = "BOOLEAN", "INTEGER", "FLOAT", "NUMERIC"
STRING, BYTES, TIMESTAMP, DATE, TIME, JSON = "STRING", "BYTES", "TIMESTAMP", "DATE", "TIME", "JSON"

# Type names that must match whole, then type names that must
# match at the start, in order; the first hit decides.
WHOLE_NAMES = {BOOLEAN: ("tinyint(1)", "boolean", "bool")}
NAME_STARTS = (
    (INTEGER, ("tinyint", "smallint", "mediumint", "int", "bigint")),
    (FLOAT, ("float", "double", "real")),
    (NUMERIC, ("decimal", "numeric")),
    (STRING, ("char", "varchar", "text", "tinytext", "mediumtext", "longtext", "enum", "set")),
    (BYTES, ("binary", "varbinary", "blob", "tinyblob", "mediumblob", "longblob")),
    (TIMESTAMP, ("datetime", "timestamp")),
    (DATE, ("date",)),
    (TIME, ("time",)),
    (INTEGER, ("year",)),
)

_SPACE = " \t\n\r\v\f"


def map_type(column_type: Column) -> Column:
    """Target type of a source column type, whatever its case or outer space."""
    name = F.lower(F.btrim(column_type, F.lit(_SPACE)))
    rule = F.when(F.lit(False), F.lit(None).cast("string"))
    for target, names in WHOLE_NAMES.items():
        rule = rule.when(name.isin(*names), F.lit(target))
    for target, starts in NAME_STARTS:
        rule = rule.when(name.rlike(f"^({'|'.join(starts)})"), F.lit(target))
    return rule.when(name == "json", F.lit(JSON)).otherwise(F.lit(STRING))


def spark_type(column_type: Column, precision: Column, scale: Column) -> Column:
    """Spark type text for a source column.

    Unsigned 64-bit numbers need 20 digits. A decimal wider than Spark's 38
    digits stays text, so that no digit is lost. Times of day span more than a
    day in the source and stay text as well.
    """
    target = map_type(column_type)
    name = F.lower(F.btrim(column_type, F.lit(_SPACE)))
    decimal = (
        F.when(precision.isNull(), F.lit("decimal(38,9)"))
        .when(precision > 38, F.lit("string"))
        .otherwise(F.format_string("decimal(%d,%d)", precision, F.coalesce(scale, F.lit(0))))
    )
    return (
        F.when(target == BOOLEAN, F.lit("boolean"))
        .when(name.rlike("^bigint.*unsigned"), F.lit("decimal(20,0)"))
        .when(target == INTEGER, F.lit("bigint"))
        .when(target == FLOAT, F.lit("double"))
        .when(target == NUMERIC, decimal)
        .when(target == BYTES, F.lit("binary"))
        .when(target == TIMESTAMP, F.lit("timestamp"))
        .when(target == DATE, F.lit("date"))
        .otherwise(F.lit("string"))
    )


def infer_type(json_value: Column) -> Column:
    """Target type of one JSON value; text that is not JSON counts as a string.

    A JSON fraction is read as a decimal and counts as FLOAT; null, objects and
    arrays count as STRING.
    """
    found = F.schema_of_variant(F.try_parse_json(json_value))
    return (
        F.when(found.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), F.lit(INTEGER))
        .when(found.startswith("DECIMAL") | found.isin("DOUBLE", "FLOAT"), F.lit(FLOAT))
        .when(found == "BOOLEAN", F.lit(BOOLEAN))
        .otherwise(F.lit(STRING))
    )


def infer_spark_type(data_type: T.DataType) -> str:
    """Target type of a Spark column, for rows that come without a catalog.

    Decimals and dates have no value rule of their own and fall to STRING.
    """
    if isinstance(data_type, T.IntegralType):
        return INTEGER
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return FLOAT
    if isinstance(data_type, T.BooleanType):
        return BOOLEAN
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return TIMESTAMP
    if isinstance(data_type, T.BinaryType):
        return BYTES
    return STRING
