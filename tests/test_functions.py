"""Unit cases of types, identifiers and failure rules."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.failures import batch_retryable, retry_delay_s
from tidelog.functions.gtid import gtid_spans
from tidelog.functions.identifiers import bytes_to_text, insert_id, route_key, route_splits, snapshot_insert_id
from tidelog.functions.mysql_types import infer_spark_type, infer_type, map_type, spark_type
from tidelog.operators.write_errors import batch_outcome, classify_rows, retry_order, retry_schedule

# Source types and the target types they must give.
CASES = [
    ("tinyint", "INTEGER"),
    ("tinyint unsigned", "INTEGER"),
    ("smallint", "INTEGER"),
    ("mediumint", "INTEGER"),
    ("int", "INTEGER"),
    ("int(11)", "INTEGER"),
    ("integer", "INTEGER"),
    ("bigint", "INTEGER"),
    ("year", "INTEGER"),
    ("interval x", "INTEGER"),
    ("tinyint(1)", "BOOLEAN"),
    ("boolean", "BOOLEAN"),
    ("bool", "BOOLEAN"),
    ("float", "FLOAT"),
    ("float(7,4)", "FLOAT"),
    ("double", "FLOAT"),
    ("double precision", "FLOAT"),
    ("real", "FLOAT"),
    ("decimal", "NUMERIC"),
    ("decimal(10,2)", "NUMERIC"),
    ("numeric", "NUMERIC"),
    ("numeric(15,5)", "NUMERIC"),
    ("char", "STRING"),
    ("char(10)", "STRING"),
    ("varchar", "STRING"),
    ("varchar(255)", "STRING"),
    ("text", "STRING"),
    ("tinytext", "STRING"),
    ("mediumtext", "STRING"),
    ("longtext", "STRING"),
    ("enum", "STRING"),
    ("set", "STRING"),
    ("uuid", "STRING"),
    ("unknown", "STRING"),
    ("custom_type", "STRING"),
    ("bit(8)", "STRING"),
    ("geometry", "STRING"),
    ("dec(3)", "STRING"),
    ("nvarchar(5)", "STRING"),
    ("", "STRING"),
    ("binary", "BYTES"),
    ("binary(16)", "BYTES"),
    ("varbinary", "BYTES"),
    ("blob", "BYTES"),
    ("tinyblob", "BYTES"),
    ("mediumblob", "BYTES"),
    ("longblob", "BYTES"),
    ("datetime", "TIMESTAMP"),
    ("datetime(6)", "TIMESTAMP"),
    ("timestamp", "TIMESTAMP"),
    ("timestamp(6)", "TIMESTAMP"),
    ("date", "DATE"),
    ("time", "TIME"),
    ("json", "JSON"),
]


def test_map_type(spark):
    df = spark.createDataFrame(CASES, "name string, want string").withColumn("got", map_type(F.col("name")))
    assert [(r.name, r.got) for r in df.collect()] == CASES


def test_map_type_ignores_case_and_space(spark):
    pairs = [("INT", "int"), ("InT", "int"), (" INT ", "int"), ("\tINT\n", "int"), ("VARCHAR", "varchar")]
    pairs.append(("DateTime", "datetime"))
    df = spark.createDataFrame(pairs, "a string, b string").select(map_type(F.col("a")), map_type(F.col("b")))
    assert all(r[0] == r[1] for r in df.collect())


def test_spark_type(spark):
    rows = [
        ("decimal(12,2)", 12, 2, "decimal(12,2)"),
        ("decimal", None, None, "decimal(38,9)"),
        ("decimal(65,30)", 65, 30, "string"),
        ("bigint unsigned", 20, 0, "decimal(20,0)"),
        ("bigint(20) UNSIGNED", 20, 0, "decimal(20,0)"),
        ("int unsigned", 10, 0, "bigint"),
        ("time", None, None, "string"),
        ("json", None, None, "string"),
        ("tinyint(1)", 3, 0, "boolean"),
    ]
    df = spark.createDataFrame(rows, "t string, p bigint, s bigint, want string")
    got = df.select("want", spark_type(F.col("t"), F.col("p"), F.col("s")).alias("got")).collect()
    assert all(r.want == r.got for r in got)


def test_infer_type(spark):
    rows = [("1", "INTEGER"), ("-7", "INTEGER"), ("1.5", "FLOAT"), ("1e300", "FLOAT"), ("true", "BOOLEAN")]
    rows += [('"x"', "STRING"), ("null", "STRING"), ("{}", "STRING"), ("[1]", "STRING"), ("not json", "STRING")]
    rows.append((None, "STRING"))
    df = spark.createDataFrame(rows, "v string, want string").withColumn("got", infer_type(F.col("v")))
    assert all(r.want == r.got for r in df.collect())


def test_infer_spark_type():
    assert infer_spark_type(T.ShortType()) == "INTEGER"
    assert infer_spark_type(T.DoubleType()) == "FLOAT"
    assert infer_spark_type(T.BooleanType()) == "BOOLEAN"
    assert infer_spark_type(T.TimestampType()) == "TIMESTAMP"
    assert infer_spark_type(T.BinaryType()) == "BYTES"
    assert infer_spark_type(T.DecimalType(5, 2)) == infer_spark_type(T.DateType()) == "STRING"


def test_insert_id(spark):
    df = spark.createDataFrame([("mysql-bin.000001", 12345, "abc-123", 0), ("mysql-bin.000001", 12345, "abc-123", 1)])
    got = [r[0] for r in df.select(insert_id(*(F.col(c) for c in df.columns))).collect()]
    assert got == ["(mysql-bin.000001, 12345):abc-123:0", "(mysql-bin.000001, 12345):abc-123:1"]


def test_snapshot_ids_differ_for_different_keys(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("a\\", "|b|c"), ("a", "\\|b|c")], "x string, y string")
    assert df.select(snapshot_insert_id("d", "t", ["x", "y"])).distinct().count() == 4


def test_route_key(spark):
    df = spark.createDataFrame([("app", "users"), ("app", "order_lines")], "d string, t string")
    key = route_key(F.col("d"), F.col("t"))
    assert [tuple(r) for r in df.select(key, route_splits(key)).collect()] == [
        ("app_users", True),
        ("app_order_lines", False),
    ]


def test_bytes_to_text_keeps_bad_bytes(spark):
    df = spark.createDataFrame([(1, bytearray(b"caf\xc3\xa9")), (2, bytearray(b"\xff\xfe"))], "id int, `a-b` binary")
    out = bytes_to_text(df)
    assert dict(out.dtypes)["a-b"] == "string"
    assert out.where("id = 1").first()["a-b"] == "café"
    assert bytes(out.where("id = 2").select(F.col("`a-b`").cast("binary")).first()[0]) == b"\xff\xfe"


def test_retry_delay(spark):
    got = spark.range(6).select(retry_delay_s(F.col("id"), 1, 10)).collect()
    assert [r[0] for r in got] == [1, 2, 4, 8, 10, 10]


def test_retry_schedule(spark):
    df = spark.sql("SELECT id AS attempt, timestamp '2024-01-01 00:00:00' AS failed_at FROM range(4)")
    got = retry_schedule(df, "attempt", "failed_at").orderBy("attempt").collect()
    assert [r.exhausted for r in got] == [False, False, True, True]
    assert [r.next_attempt_at.second for r in got] == [1, 2, 4, 8]


ERRORS = "array<struct<reason:string,message:string>>"


@pytest.mark.parametrize(
    ("message", "errors", "want"),
    [
        ("rate limit exceeded", [], True),
        ("temporary server error", [], True),
        ("service unavailable", [], True),
        ("connection timeout", [], True),
        ("invalid table name", [], False),
        ("permission denied", None, False),
        ("x", [("rateLimitExceeded", "slow")], True),
        ("x", [(None, "Backend gone")], True),
        ("x", [("invalid", "no"), ("invalid", "temporary hitch")], True),
        ("x", [(None, "rate too high")], False),
        (None, [("invalid", None)], False),
    ],
)
def test_batch_retryable(spark, message, errors, want):
    df = spark.createDataFrame([(message, errors)], f"m string, e {ERRORS}")
    assert df.select(batch_retryable(F.col("m"), F.col("e"))).first()[0] is want


def failed(spark, rows):
    return spark.createDataFrame(rows, f"batch_id string, row_index int, errors {ERRORS}")


def test_row_errors_of_three_batches(spark):
    df = failed(
        spark,
        [
            ("a", 0, [("backendError", "internal")]),
            ("a", 1, [("duplicate", "duplicate row")]),
            ("b", 0, [("invalid", "schema mismatch")]),
            ("c", 0, [("backendError", None)]),
            ("c", 1, [("serviceUnavailable", None)]),
        ],
    )
    got = {r.batch_id: r for r in batch_outcome(classify_rows(df, F.lit(2))).collect()}
    assert (got["a"].retry_rows, got["a"].ignored_rows, got["a"].permanent_rows, got["a"].verdict) == (1, 1, 0, "retry")
    assert (got["b"].retry_rows, got["b"].ignored_rows, got["b"].permanent_rows, got["b"].verdict) == (0, 0, 1, "failed")
    assert (got["c"].retry_rows, got["c"].ignored_rows, got["c"].permanent_rows, got["c"].verdict) == (2, 0, 0, "retry")
    last = batch_outcome(classify_rows(df, F.lit(2)), F.lit(False)).where("batch_id = 'c'").first()
    assert last.verdict == "failed"


@pytest.mark.parametrize(
    ("index", "errors", "want"),
    [
        (0, [("backendError", "x"), ("stopped", "Duplicate key")], "ignored"),
        (0, [("stopped", "x"), ("internalError", "y")], "retry"),
        (0, [(None, "DUPLICATE row"), (None, "timeout")], "ignored"),
        (0, [(None, "rate too high")], "retry"),
        (0, [("invalid", "temporary")], "permanent"),
        (0, [(None, "bad value")], "permanent"),
        (0, [], "permanent"),
        (0, None, "permanent"),
        (2, [("backendError", "x")], "permanent"),
        (-1, [("duplicate", "x")], "permanent"),
    ],
)
def test_classify_row_error(spark, index, errors, want):
    df = classify_rows(failed(spark, [("a", index, errors)]), F.lit(2))
    assert df.first().outcome == want


def test_retry_order(spark):
    df = failed(spark, [("a", i, [("backendError", "x")]) for i in (5, 1, 3)])
    assert [r.row_index for r in retry_order(classify_rows(df, F.lit(9))).collect()] == [1, 3, 5]


def test_gtid_spans(spark):
    texts = [("U:1-5:7, v:3",), ("",), (None,), ("u:1-2\n,v:9-9",)]
    got = [r[0] for r in spark.createDataFrame(texts, "t string").select(gtid_spans(F.col("t"))).collect()]
    assert [tuple(s) for s in got[0]] == [("u", 1, 5), ("u", 7, 7), ("v", 3, 3)]
    assert got[1] == []
    assert got[2] is None
    assert [tuple(s) for s in got[3]] == [("u", 1, 2), ("v", 9, 9)]
