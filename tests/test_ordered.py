"""Running values against a plain loop."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidelog.operators.ordered import Running, running, slice_of

KINDS = {"sum": sum, "min": min, "max": max}


def by_hand(rows, kind, exclusive, backward):
    """rows: (group, order, value), sorted by order within the group."""
    out = {}
    for g in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == g), key=lambda r: r[1], reverse=backward)
        for i, (_, order, _) in enumerate(mine):
            seen = [v for _, _, v in mine[: i if exclusive else i + 1] if v is not None]
            out[g, order] = KINDS[kind](seen) if seen else (0 if kind == "sum" else None)
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    rows=st.dictionaries(
        st.tuples(st.sampled_from(["a", "b", None]), st.integers(-40, 40)),
        st.one_of(st.none(), st.integers(-5, 5)),
        min_size=1,
        max_size=60,
    )
)
def test_running_equals_loop(spark, rows):
    data = [(g, o, v) for (g, o), v in rows.items()]
    df = spark.createDataFrame(data, "g string, o bigint, v bigint").withColumn("s", slice_of("o", 7))
    values = [
        Running(f"{k}_{x}_{b}", k, F.col("v"), bool(x), bool(b)) for k in KINDS for x in (0, 1) for b in (0, 1)
    ]
    got = running(df, ["g"], [["s"]], ["o"], values).collect()
    assert len(got) == len(data)
    for v in values:
        want = by_hand(data, v.kind, v.exclusive, v.backward)
        assert {(r.g, r.o): r[v.name] for r in got} == want, v.name


@pytest.mark.parametrize("backward", [False, True])
def test_nested_levels_carry_across(spark, backward):
    rng = random.Random(3)
    data = [(f"f{i // 50}", i, rng.randint(0, 9)) for i in range(200)]
    df = spark.createDataFrame(data, "f string, o bigint, v bigint").withColumn("s", slice_of("o", 8))
    got = running(df, [], [["f"], ["s"]], ["o"], [Running("r", "sum", F.col("v"), backward=backward)]).collect()
    want = by_hand([(None, o, v) for _, o, v in data], "sum", False, backward)
    assert {(None, r.o): r.r for r in got} == want


@pytest.mark.parametrize("backward", [False, True])
def test_nearest_over_levels_whose_values_start_anew(spark, backward):
    """Offsets begin at 0 in each file, so the nearest value is not the largest."""
    rng = random.Random(4)
    data = [(f"f{i // 40}", i % 40, i % 40 if rng.random() < 0.2 else None) for i in range(160)]
    df = spark.createDataFrame(data, "f string, o bigint, v bigint").withColumn("s", slice_of("o", 9))
    near = Running("r", "nearest", F.col("v"), exclusive=True, backward=backward)
    got = {(r.f, r.o): r.r for r in running(df, [], [["f", "s"]], ["o"], [near]).collect()}
    last = None
    for f, o, v in reversed(data) if backward else data:
        assert got[f, o] == last
        last = v if v is not None else last


def test_other_columns_pass_through(spark):
    df = spark.sql("SELECT id, array(id) AS payload, named_struct('x', id) AS st, 0 AS s FROM range(5)")
    got = running(df, [], [["s"]], ["id"], [Running("n", "sum", F.lit(1))])
    assert got.columns == ["id", "payload", "st", "s", "n"]
    assert [(r.id, r.payload, r.st.x, r.n) for r in got.orderBy("id").collect()] == [
        (i, [i], i, i + 1) for i in range(5)
    ]


def test_rows_are_shuffled_without_the_inputs_and_into_many_parts(spark):
    """Whatever the session's number of parts is, tasks do not grow with the rows."""
    df = spark.range(100).selectExpr("id % 3 AS g", "id", "id div 10 AS s")
    values = [Running("total", "sum", F.col("id") * 7), Running("top", "max", F.col("id") * 9)]
    out = running(df, ["g"], [["s"]], ["id"], values)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(g" in plan and ", 400), REPARTITION_BY_COL" in plan
    body = plan.split("REPARTITION_BY_COL")[-1].split("HashAggregate")[0]
    assert "* 7" not in body and "* 9" not in body
    assert out.where("id = 33").first().total == 7 * sum(range(0, 34, 3))
