"""Totals, running figures and chunks."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import event, events_of
from tidelog.operators.chunks import batch_write_stats, chunk_totals, row_chunks
from tidelog.operators.metrics import (
    error_stats,
    global_totals,
    latency_ema,
    metrics_snapshot,
    running_avg_batch,
    scan_throughput,
    table_totals,
    throughput_rates,
)
from tidelog.operators.verify import duplicate_report, reconcile, row_checksum


def three_events(spark):
    return events_of(
        spark,
        [
            event("", 123, "INSERT", [["x"]] * 5, ts=1, table="users"),
            event("", 456, "INSERT", [["x"]] * 3, ts=2, table="orders"),
            event("", 789, "INSERT", [["x"]] * 2, ts=3, table="users"),
        ],
    )


def test_totals(spark):
    total = global_totals(three_events(spark)).first()
    assert (total.events_processed, total.rows_processed, total.current_position) == (3, 10, "789")
    tables = {r.table_name: r for r in table_totals(three_events(spark)).collect()}
    assert (tables["app.users"].events_processed, tables["app.users"].rows_processed) == (2, 7)
    assert (tables["app.orders"].events_processed, tables["app.orders"].rows_processed) == (1, 3)
    named = events_of(spark, [event("mysql-bin.000002", 5, "INSERT", [["x"]])])
    assert global_totals(named).first().current_position == "mysql-bin.000002"
    empty = global_totals(named.limit(0)).first()
    assert (empty.events_processed, empty.rows_processed) == (0, 0)


def test_rates(spark):
    total = global_totals(three_events(spark))
    rates = throughput_rates(total, F.lit(4.0)).first()
    assert (rates.events_per_second, rates.rows_per_second) == (0.75, 2.5)
    assert throughput_rates(total, F.lit(0.0)).first().rows_per_second == 0.0


def test_snapshot(spark):
    events = events_of(
        spark,
        [event("", 1, "INSERT", [["x"]] * 5, table="users"), event("", 2, "INSERT", [["x"]] * 3, table="orders")],
    )
    errors = spark.sql("SELECT 1 AS seq, timestamp '2024-01-01' AS error_time, 'boom' AS message, true AS is_write_error")
    row = metrics_snapshot(events, [error_stats(errors)], F.lit(1.0)).first()
    assert (row.events_processed, row.rows_processed, row.error_count, row.last_error) == (2, 8, 1, "boom")
    assert set(row.table_metrics) == {"app.users", "app.orders"}
    assert row.table_metrics["app.users"].rows_processed == 5


def test_running_average(spark):
    rng = random.Random(1)
    data = [("w", i * rng.randint(1, 1) + i, rng.randint(1, 50)) for i in range(500)]
    got = running_avg_batch(
        spark.createDataFrame(data, "g string, seq bigint, n bigint"), ["g"], "seq", "n", slice_width=64
    ).orderBy("seq")
    total = 0
    for i, r in enumerate(got.collect(), start=1):
        total += data[i - 1][2]
        assert (r.batches_so_far, r.average_batch_size) == (i, total / i)


@pytest.mark.parametrize("zeros", [0, 700])
def test_ema_equals_fold(spark, zeros):
    rng = random.Random(zeros)
    data = [("hot", i, 0.0 if i < zeros or rng.random() < 0.3 else rng.uniform(0, 500)) for i in range(3000)]
    data += [("small", 10_000 + i, float(i)) for i in range(20)]
    got = latency_ema(
        spark.createDataFrame(data, "g string, seq bigint, ms double"), ["g"], "seq", "ms", slice_width=100
    ).collect()
    assert len(got) == len(data)
    ema = {}
    for g, seq, x in data:
        before = ema.get(g, 0.0)
        ema[g] = x if before == 0 else 0.1 * x + 0.9 * before
        ema[g, seq] = ema[g]
    assert max(abs(r.latency_ema - ema[r.g, r.seq]) for r in got) < 1e-9


@pytest.mark.parametrize(("max_rows", "size"), [(2, 2), (7, 7), (0, 1000), (-1, 1000)])
def test_chunks_are_exact(spark, max_rows, size):
    data = [("hot", i) for i in range(3000)] + [("b", i) for i in range(10)] + [(None, i) for i in range(5)]
    random.Random(2).shuffle(data)
    df = spark.createDataFrame(data, "t string, id int").repartition(5)
    got = row_chunks(df, ["t"], ["id"], max_rows, partitions=6)
    assert {(r.t, r.id): (r.row_no, r.chunk_id) for r in got.collect()} == {(t, i): (i, i // size) for t, i in data}
    sizes = chunk_totals(got, ["t"]).where("t = 'hot'").orderBy("chunk_id").collect()
    assert all(r.n_rows == size for r in sizes[:-1]) and sum(r.n_rows for r in sizes) == 3000


def test_two_one_row_events_fill_a_chunk_of_two(spark):
    df = spark.createDataFrame([("users", 1), ("users", 2)], "t string, id int")
    stats = batch_write_stats(chunk_totals(row_chunks(df, ["t"], ["id"], 2), ["t"])).first()
    assert (stats.batches_written, stats.rows_written, stats.average_batch_size) == (1, 2, 2.0)


def test_scan_throughput(spark):
    df = spark.createDataFrame([("a", 0), ("a", 4), ("b", 3)], "t string, s bigint")
    got = {r.t: (r.records, r.duration_s, r.records_per_second) for r in scan_throughput(df, ["t"], "s").collect()}
    assert got == {"a": (2, 4, 0.5), "b": (1, 0, 0.0)}


def test_reconcile(spark):
    source = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("only s", 1)], "t string, v int")
    target = spark.createDataFrame([("a", 2), ("a", 1), ("b", 9), ("only t", 1), ("only t", 1)], "t string, v int")
    got = {r.t: (r.source_rows, r.target_rows, r.is_equal) for r in reconcile(source, target, ["t"], row_checksum(["v"])).collect()}
    assert got == {"a": (2, 2, True), "b": (1, 1, False), "only s": (1, 0, False), "only t": (0, 2, False)}
    assert [tuple(r) for r in duplicate_report(target, ["t", "v"]).collect()] == [("only t", 1, 2)]


@pytest.mark.parametrize("weight", [0.001, 0.5, 0.99, 1.0])
def test_ema_of_any_weight(spark, weight):
    values = [0.0, 0.0, *(random.Random(5).uniform(1, 50) for _ in range(4000))]
    df = spark.createDataFrame([(1, i, v, "x") for i, v in enumerate(values)], "g int, seq bigint, ms double, other string")
    got = latency_ema(df, ["g"], "seq", "ms", weight, slice_width=700).orderBy("seq").collect()
    want, now = [], 0.0
    for v in values:
        now = v if now == 0 else weight * v + (1 - weight) * now
        want.append(now)
    assert [r["seq"] for r in got] == list(range(len(values))) and got[0]["other"] == "x"
    assert max(abs(r["latency_ema"] - w) for r, w in zip(got, want)) < 1e-9
    with pytest.raises(ValueError):
        latency_ema(df, ["g"], "seq", "ms", 0.0)
