"""Log events to row images."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.model import BEGIN, COMMIT, DELETE, INSERT, MARKER_OPS, ROW_OPS, UPDATE, ColumnSpec

# Log event kinds per operation.
EVENT_KINDS = {
    INSERT: ("WRITE_ROWS", "WRITE_ROWSv1", "WRITE_ROWSv2"),
    UPDATE: ("UPDATE_ROWS", "UPDATE_ROWSv1", "UPDATE_ROWSv2"),
    DELETE: ("DELETE_ROWS", "DELETE_ROWSv1", "DELETE_ROWSv2"),
}
# Statements that open and close a transaction, matched exactly.
BEGIN_STATEMENTS = ("BEGIN", "START TRANSACTION")
COMMIT_STATEMENTS = ("COMMIT",)


def txn_marker(kind: Column, query: Column) -> Column:
    """BEGIN or COMMIT for transaction bounds, null for everything else."""
    statement = kind == "QUERY"
    return F.when(statement & query.isin(*BEGIN_STATEMENTS), F.lit(BEGIN)).when(
        (statement & query.isin(*COMMIT_STATEMENTS)) | (kind == "XID"), F.lit(COMMIT)
    )


def is_marker(kind: Column, query: Column) -> Column:
    """Transaction bounds as a filter on the log's own columns, which the scan can take."""
    return (kind == "XID") | ((kind == "QUERY") & query.isin(*BEGIN_STATEMENTS, *COMMIT_STATEMENTS))


def event_op(kind: Column, query: Column) -> Column:
    rule = F.when(F.lit(False), F.lit(None).cast("string"))
    for op, kinds in EVENT_KINDS.items():
        rule = rule.when(kind.isin(*kinds), F.lit(op))
    return rule.otherwise(txn_marker(kind, query))


def route_event_kind(log: DataFrame) -> DataFrame:
    """Name each event's operation and drop events that carry none.

    The filter is on the log's own columns, so that it reaches the scan.
    """
    kind, query = F.col("kind"), F.col("query")
    kinds = [k for names in EVENT_KINDS.values() for k in names]
    return log.where(kind.isin(*kinds) | is_marker(kind, query)).withColumn("op", event_op(kind, query))


def row_events(events: DataFrame) -> DataFrame:
    return events.where(F.col("op").isin(*ROW_OPS))


def marker_events(events: DataFrame) -> DataFrame:
    return events.where(F.col("op").isin(*MARKER_OPS))


def after_images(events: DataFrame) -> DataFrame:
    """Updates come as before/after pairs: keep the second of each full pair."""
    after = F.filter("rows", lambda _, i: i % 2 == 1)
    return events.withColumn("rows", F.when(F.col("op") == UPDATE, after).otherwise(F.col("rows")))


def explode_row_images(events: DataFrame) -> DataFrame:
    """One row per image with its 0-based index; events without images give none."""
    return events.select("*", F.posexplode("rows").alias("image_idx", "image")).drop("rows")


# Bits of the whole-number types that a longer one holds.
NARROW = {"tinyint": 8, "smallint": 16, "int": 32}


def fitting(value: Column, spark_type: str) -> Column:
    """The value in a type, null if it does not fit.

    The same as ``try_cast``, which throws and catches an error for every number
    that is out of range, and takes many times as long for it.
    """
    if spark_type not in NARROW:
        return value.try_cast(spark_type)
    number, bound = value.try_cast("bigint"), 1 << (NARROW[spark_type] - 1)
    return F.when(number.between(-bound, bound - 1), number).cast(spark_type)


def named_columns(columns: tuple[ColumnSpec, ...], image: str = "image", strict: bool = True) -> list[Column]:
    """Positional image values as typed, named columns.

    A value that does not fit its column ends the job with the column's name.
    With ``strict=False`` it becomes null; ``cast_failures`` then names it.
    """
    out = []
    for i, c in enumerate(columns):
        value = F.try_element_at(F.col(image), F.lit(i + 1))
        typed = fitting(value, c.spark_type)
        if strict and c.spark_type != "string":
            text = F.concat(F.lit(f"value does not fit column {c.name} {c.spark_type}: "), value)
            typed = F.when(value.isNotNull() & typed.isNull(), F.raise_error(text)).otherwise(typed)
        out.append(typed.alias(c.name))
    return out


def positional_columns(n: int, image: str = "image") -> list[Column]:
    """Without a catalog the values are named by position."""
    return [F.try_element_at(F.col(image), F.lit(i + 1)).alias(f"col_{i}") for i in range(n)]


def cast_failures(columns: tuple[ColumnSpec, ...], image: str = "image") -> Column:
    """Names of the columns whose image value does not fit the column type."""
    checks = [
        F.when(
            F.try_element_at(F.col(image), F.lit(i + 1)).isNotNull()
            & fitting(F.try_element_at(F.col(image), F.lit(i + 1)), c.spark_type).isNull(),
            F.lit(c.name),
        )
        for i, c in enumerate(columns)
    ]
    return F.array_compact(F.array(*checks))


def missing_required(columns: tuple[ColumnSpec, ...]) -> Column:
    """Names of the required columns that are null in the row."""
    checks = [F.when(F.col(f"`{c.name}`").isNull(), F.lit(c.name)) for c in columns if c.required]
    return F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")


def log_order(rows: DataFrame) -> DataFrame:
    """Rows in log order: file, position, then image."""
    return rows.orderBy("binlog_file", "log_pos", "image_idx")
