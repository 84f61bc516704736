"""Targets, schemas and source scans."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidelog.model import CDC_OPERATION, CDC_TABLE, INSERT_ID, ColumnSpec, Position, TableSpec
from tidelog.operators.images import cast_failures, missing_required, named_columns, positional_columns
from tidelog.operators.rows import cdc_metadata, metadata_clashes, rename_drop
from tidelog.operators.schema import derive_schema, fallback_schema, table_spec, target_struct
from tidelog.sinks import targets
from tidelog.sources.catalog import column_catalog_scan
from tidelog.sources.change_log import select_log_tables, tables_predicate
from tidelog.sources.tables import jdbc_options, pk_ordered_scan, snapshot_scan
from tidelog.model import CATALOG_SCHEMA, CHANGE_LOG_SCHEMA, CHANGE_ROW_SCHEMA

NAMES = ["userId", "createdAt", "UserName", "user_name", "user123", "user_id", "user-name"]


def catalog(spark):
    rows = [
        ("app", "users", i + 1, name, "int", "int(11)", "NO" if i == 0 else "YES", None, None, 10, 0)
        for i, name in enumerate(NAMES)
    ]
    rows.append(("app", "other", 1, "x", "decimal", "decimal(12,2)", "YES", None, None, 12, 2))
    return spark.createDataFrame(list(reversed(rows)), CATALOG_SCHEMA)


def test_names_stay_as_they_are(spark):
    spec = table_spec(catalog(spark), "app", "users", ("userId",))
    assert list(spec.column_names) == NAMES
    assert [c.required for c in spec.columns] == [True] + [False] * 6
    struct = target_struct(spec)
    assert struct.fieldNames() == ["_cdc_timestamp", "_cdc_operation", "_cdc_database", "_cdc_table", *NAMES]
    assert not struct["userId"].nullable and struct["user-name"].nullable


def test_catalog_scan_is_ordered(spark):
    got = column_catalog_scan(catalog(spark), "app", "users").collect()
    assert [r.column_name for r in got] == NAMES


def test_derive_schema(spark):
    got = derive_schema(catalog(spark)).where("table_name = 'other'").orderBy("ordinal").collect()
    assert [(r.ordinal, r.column_name, r.target_type, r.required) for r in got] == [
        (1, "_cdc_timestamp", "TIMESTAMP", False),
        (2, "_cdc_operation", "STRING", False),
        (3, "_cdc_database", "STRING", False),
        (4, "_cdc_table", "STRING", False),
        (5, "x", "NUMERIC", False),
    ]


def test_fallback_schema(spark):
    assert [n for n, _ in fallback_schema(None)] == ["_cdc_timestamp", "_cdc_operation", "_cdc_database", "_cdc_table"]
    row = spark.sql("SELECT 1 AS id, 'x' AS name, 1.5D AS score").schema
    assert fallback_schema(row)[4:] == [("id", "INTEGER"), ("name", "STRING"), ("score", "FLOAT")]


def test_typed_and_missing_values(spark):
    columns = (ColumnSpec("id", "bigint", True), ColumnSpec("n", "tinyint", True), ColumnSpec("s", "string"))
    df = spark.createDataFrame([(1, ["7", "300", None]), (2, ["x", None]), (3, ["1", "2", "3", "4"])], "k int, image array<string>")
    got = df.select("k", cast_failures(columns).alias("unfit"), *named_columns(columns, strict=False)).withColumn(
        "missing", missing_required(columns)
    ).orderBy("k").collect()
    assert [(r.id, r.n, r.s) for r in got] == [(7, None, None), (None, None, None), (1, 2, "3")]
    assert [r.unfit for r in got] == [["n"], ["id"], []]
    assert [r.missing for r in got] == [["n"], ["id", "n"], []]
    assert df.select(*positional_columns(2)).columns == ["col_0", "col_1"]


def test_misfit_ends_a_strict_job(spark):
    df = spark.createDataFrame([(["7"],), (["x"],)], "image array<string>")
    columns = (ColumnSpec("id", "bigint"),)
    with pytest.raises(Exception, match="does not fit column id bigint: x"):
        df.select(*named_columns(columns)).collect()
    assert df.where("image[0] = '7'").select(*named_columns(columns)).first().id == 7


def test_source_column_wins_over_metadata(spark):
    assert metadata_clashes(["id", "_cdc_table"]) == [CDC_TABLE]
    names = ["id", "_cdc_table"]
    df = spark.createDataFrame([(1, "mine")], names)
    meta = cdc_metadata(F.current_timestamp(), F.lit("INSERT"), F.lit("d"), F.lit("t"), names)
    out = df.select(*meta, *names)
    assert out.columns == ["_cdc_timestamp", "_cdc_operation", "_cdc_database", "id", "_cdc_table"]
    assert out.first()["_cdc_table"] == "mine"


def test_rename_drop(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["id", "created_at", "internal_flag"])
    assert rename_drop(df, {"created_at": "createdAt"}, ["internal_flag"]).columns == ["id", "createdAt"]
    assert rename_drop(df, {"id": "created_at", "created_at": "id"}).columns == ["created_at", "id", "internal_flag"]
    with pytest.raises(ValueError, match="nope"):
        rename_drop(df, drop=["nope"])


def change_row(table, key, op="INSERT", db="app", day=1):
    return (dt.datetime(2024, 1, day), op, db, table, [str(key), "v"], f"id-{db}-{table}-{key}")


def test_shared_target(spark, path):
    """Table names that look like numbers or dates come back as text."""
    rows = spark.createDataFrame(
        [change_row("123", 1), change_row("2024-01-01", 2), change_row("123", 3, db="app_two")], CHANGE_ROW_SCHEMA
    )
    targets.append_change_rows(rows, path)
    spec = TableSpec("app", "123", (ColumnSpec("id", "bigint"), ColumnSpec("v", "string")))
    got = targets.read_target(spark, path, spec).collect()
    assert [(r._cdc_table, r.id, r.v) for r in got] == [("123", 1, "v")]
    assert targets.read_targets(spark, path).count() == 3
    plan = targets.read_target(spark, path, spec)._jdf.queryExecution().executedPlan().toString()
    assert "_cdc_table" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_append_again_adds_nothing(spark, path):
    rows = spark.createDataFrame([change_row("t", k, day=1 + k % 3) for k in (1, 2, 3, 2, 2)], CHANGE_ROW_SCHEMA)
    for prune in (None, "_cdc_timestamp", "_cdc_timestamp"):
        targets.idempotent_append(rows, path, prune=prune)
        assert spark.read.parquet(path).count() == 3
    more = rows.unionByName(spark.createDataFrame([change_row("t", 9)], CHANGE_ROW_SCHEMA))
    targets.idempotent_append(more, path, prune="_cdc_timestamp", bounds=(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 9)))
    assert spark.read.parquet(path).count() == 4
    targets.idempotent_append(rows.limit(0), path, prune="_cdc_timestamp")
    assert spark.read.parquet(path).count() == 4
    targets.idempotent_append(rows.limit(3), path, single=True)
    assert spark.read.parquet(path).count() == 4


def test_routes(spark):
    rows = spark.createDataFrame([change_row("users", 1), change_row("order_lines", 2)], CHANGE_ROW_SCHEMA)
    routed, bad = targets.quarantine_routes(rows)
    assert routed.count() == 2
    assert [(r._cdc_table, r.n_rows) for r in bad.collect()] == [("order_lines", 1)]


@pytest.mark.parametrize(("granularity", "oldest"), [("hour", "2024-01-02-05"), ("day", "2024-01-02"), ("month", "2024-01-01")])
def test_periods_expire(spark, path, granularity, oldest):
    rows = spark.sql("SELECT id, timestamp '2024-01-01 00:00:00' + make_interval(0,0,0,0,id) AS at FROM range(72)")
    targets.write_time_partitioned(rows, path, "at", granularity)
    now = F.lit("2024-01-03 05:30:00").cast("timestamp")
    kept = targets.retained(spark.read.parquet(path), "_cdc_period", granularity, now, 86_400)
    want = {"hour": 72 - 29, "day": 48, "month": 72}[granularity]
    assert kept.count() == want
    targets.expire_partitions(spark, path, "_cdc_period", oldest)
    spark.catalog.refreshByPath(path)
    assert spark.read.parquet(path).count() == want


def test_existing_table_is_left_alone(spark, path):
    spec = table_spec(catalog(spark), "app", "users", ("userId",))
    name = targets.ensure_target(spark, "ensure_test", spec, path)
    wider = TableSpec("app", "users", (*spec.columns, ColumnSpec("late", "string")), spec.key)
    assert targets.ensure_target(spark, "ensure_test", wider, path) == name
    assert "late" not in spark.table(name).columns
    rows = spark.range(3).select(*(F.col("id").alias(n) for n in NAMES))
    targets.append_to_table(snapshot_scan(rows, "app", "users", ["userId"], F.lit("2024-01-01").cast("timestamp")), name)
    got = spark.table(name).orderBy("userId").collect()
    assert [(r["user-name"], r[CDC_OPERATION], r[INSERT_ID]) for r in got] == [
        (i, "SNAPSHOT", f"snapshot:app.users:{i}") for i in range(3)
    ]


def test_table_selection(spark):
    rows = [
        ("f", 1, 0, "WRITE_ROWS", None, "app", "users", None, None, [["1"]]),
        ("f", 2, 0, "WRITE_ROWS", None, "app", "orders", None, None, [["1"]]),
        ("f", 3, 0, "WRITE_ROWS", None, "crm", "users", None, None, [["1"]]),
        ("f", 4, 0, "QUERY", "BEGIN", None, None, None, None, None),
        ("f", 5, 0, "QUERY", "DROP TABLE x", None, None, None, None, None),
        ("f", 6, 0, "XID", None, None, None, None, None, None),
    ]
    log = spark.createDataFrame(rows, CHANGE_LOG_SCHEMA)

    def kept(tables):
        return sorted(r.log_pos for r in select_log_tables(log, tables).collect())

    assert kept([("app", "users")]) == [1, 4, 6]
    assert kept([("app", None), ("app", "users")]) == [1, 2, 4, 6]
    assert kept([("app", "users"), ("crm", "users")]) == [1, 3, 4, 6]
    assert kept([]) == [4, 6]
    with pytest.raises(ValueError):
        tables_predicate([("", "users")], "d", "t")


def test_snapshot_position_and_jdbc_options(spark):
    rows = spark.createDataFrame([(1, bytearray(b"x"))], "id int, b binary")
    out = snapshot_scan(rows, "app", "t", ["id"], F.lit("2024-01-01").cast("timestamp"), Position("f1", 9)).first()
    assert (out.b, out.start_file, out.start_pos, out[INSERT_ID]) == ("x", "f1", 9, "snapshot:app.t:1")
    options = jdbc_options("jdbc:mysql://h/app", "app.t", "id", 1, 1000, 8)
    assert (options["numPartitions"], options["partitionColumn"], options["upperBound"]) == ("8", "id", "1000")
    with pytest.raises(ValueError):
        jdbc_options("u", "t", "id", 5, 1, 8)


def test_pk_order(spark):
    parts = pk_ordered_scan(spark.range(1000).repartition(7), ["id"], 4).rdd.glom().collect()
    assert [r.id for p in parts for r in p] == list(range(1000))
