from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.model import CHANGE_ROW_SCHEMA, ColumnSpec, TableSpec
from tidelog.operators.images import fitting
from tidelog.streaming import retries, typed

KEY = ["k"]
SHAPE = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])
KEPT = T.StructType([*SHAPE.fields, T.StructField("attempt", T.IntegerType()), T.StructField("outcome", T.StringType())])


def attempt(rows):
    """Row k is written at attempt k; tries are used up after three."""
    outcome = F.when(F.col("k") <= F.col("attempt"), "written").when(F.col("attempt") >= 2, "quarantine").otherwise("retry")
    return rows.withColumn("outcome", outcome).withColumn("retry_delay_s", F.pow(F.lit(2.0), "attempt"))


def tries(spark, path):
    return sorted((r["round"], r.k, r.attempt, r.outcome) for r in retries.read_rounds(spark, path, KEPT).collect())


def test_rows_are_taken_up_when_due_and_once(spark, path):
    rows = spark.createDataFrame([(k, "v") for k in range(5)], SHAPE)

    def run(number, now_s, new=None):
        retries.run_round(spark, path, number, attempt, KEY, now_s, new, SHAPE)

    run(0, 10, rows)
    first = tries(spark, path)
    assert first == [(0, 0, 0, "written")] + [(0, k, 0, "retry") for k in range(1, 5)]
    run(1, 10.5)
    assert tries(spark, path) == first
    run(2, 11, spark.createDataFrame([(9, "new")], SHAPE))
    second = [(2, 1, 1, "written"), (2, 2, 1, "retry"), (2, 3, 1, "retry"), (2, 4, 1, "retry"), (2, 9, 0, "retry")]
    assert tries(spark, path) == first + second
    # A repeated round replaces what it wrote.
    run(2, 11, spark.createDataFrame([(9, "new")], SHAPE))
    assert tries(spark, path) == first + second
    run(3, 20)
    third = [(3, 2, 2, "written"), (3, 3, 2, "quarantine"), (3, 4, 2, "quarantine"), (3, 9, 1, "retry")]
    assert tries(spark, path) == first + second + third
    run(4, 99)
    run(5, 999)
    end = {r.k: (r.attempt, r.outcome) for r in retries.last_outcomes(retries.read_rounds(spark, path, KEPT), KEY).collect()}
    assert end == {0: (0, "written"), 1: (1, "written"), 2: (2, "written"), 3: (2, "quarantine"), 4: (2, "quarantine"), 9: (2, "quarantine")}
    assert not [t for t in tries(spark, path) if t[0] == 5]


def test_no_rounds_and_no_rows(spark, path):
    assert retries.read_rounds(spark, path, KEPT) is None
    retries.run_round(spark, path, 1, attempt, KEY, 5, None, SHAPE)
    assert retries.read_rounds(spark, path, KEPT) is None


A = TableSpec("s", "a", (ColumnSpec("k", "bigint", True), ColumnSpec("n", "tinyint")), ("k",))
B = TableSpec("s", "b", (ColumnSpec("d", "date"), ColumnSpec("_cdc_table", "string")), ("d",))


def change(table, image, key):
    return (None, "INSERT", "s", table, image, key)


def test_each_table_gets_its_own_columns(spark, path):
    rows = [
        change("a", ["1", "5"], "i1"), change("a", ["2", None], "i2"), change("a", [None, "5"], "i3"), change("a", ["4", "999"], "i4"),
        change("a", ["5"], "i5"), change("b", ["2024-02-30", "x"], "i6"), change("b", ["2024-02-29", "own"], "i7"), change("c", ["1"], "i8"),
    ]
    sink = typed.typed_sink(path, "a", [A, B])
    for _ in range(2):
        sink(spark.createDataFrame(rows, CHANGE_ROW_SCHEMA), 0)
    sink(spark.createDataFrame([change("a", ["6", "6"], "i9")], CHANGE_ROW_SCHEMA), 1)
    a, b = typed.read_typed(spark, path, A), typed.read_typed(spark, path, B)
    assert dict(a.dtypes)["n"] == "tinyint" and dict(b.dtypes)["d"] == "date"
    assert sorted((r._insert_id, r.k, r.n) for r in a.collect()) == [("i1", 1, 5), ("i2", 2, None), ("i5", 5, None), ("i9", 6, 6)]
    assert [(r._insert_id, str(r.d), r._cdc_table) for r in b.collect()] == [("i7", "2024-02-29", "own")]
    bad = {r._insert_id: r._reasons for r in typed.read_quarantine(spark, path).collect()}
    assert bad == {"i3": ["no value for k"], "i4": ["value does not fit n"], "i6": ["value does not fit d"], "i8": [typed.UNKNOWN]}


def test_a_repeated_batch_that_lost_a_table_leaves_nothing_of_it(spark, path):
    sink = typed.typed_sink(path, "a", [A, B])
    sink(spark.createDataFrame([change("a", ["1", "1"], "i1"), change("c", [], "i2")], CHANGE_ROW_SCHEMA), 0)
    sink(spark.createDataFrame([change("b", [None, "t"], "i3")], CHANGE_ROW_SCHEMA), 0)
    assert typed.read_typed(spark, path, A).count() == 0 and typed.read_quarantine(spark, path).count() == 0
    assert typed.read_typed(spark, path, B).count() == 1
    assert typed.read_typed(spark, path + "-none", A).columns[-1] == "_insert_id"


def test_reasons_are_worked_out_for_misfits_only(spark, path, monkeypatch):
    reasons = typed.misfits

    def watched(specs):
        return F.when(F.col("_insert_id") == "i1", F.raise_error(F.lit("i1 fits"))).otherwise(reasons(specs))

    monkeypatch.setattr(typed, "misfits", watched)
    rows = [change("a", ["1", "5"], "i1"), change("a", ["2", "128"], "i2"), change("a", ["3", "x"], "i3"), change("a", [None, "-129"], "i4")]
    typed.typed_sink(path, "a", [A, B])(spark.createDataFrame(rows, CHANGE_ROW_SCHEMA), 0)
    assert [r._insert_id for r in typed.read_typed(spark, path, A).collect()] == ["i1"]
    bad = {r._insert_id: r._reasons for r in typed.read_quarantine(spark, path).collect()}
    unfit = "value does not fit n"
    assert bad == {"i2": [unfit], "i3": [unfit], "i4": [unfit, "no value for k"]}


def test_narrow_numbers_are_those_of_try_cast(spark):
    texts = ["127", "128", "-128", "-129", " 5 ", "+7", "1.5", "", "x", None, "32767", "32768", "2147483647", "2147483648", "9" * 19, "007"]
    rows = spark.createDataFrame([(t,) for t in texts], "v string")
    for kind in ("tinyint", "smallint", "int", "bigint", "decimal(18,2)"):
        got = rows.select(fitting(F.col("v"), kind).alias("got"), F.col("v").try_cast(kind).alias("want"))
        assert got.schema["got"].dataType == got.schema["want"].dataType
        assert got.where(~F.col("got").eqNullSafe(F.col("want"))).count() == 0
