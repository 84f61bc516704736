"""Positions, saved points and transaction-number sets."""

import random

import pytest
from pyspark.sql import functions as F

from tidelog.model import ColumnSpec, Position, TableSpec
from tidelog.operators import positions as pos
from tidelog.plans.sync import sync_once
from tidelog.session import prepare
from tidelog.sinks.targets import read_targets
from tidelog.sources.change_log import CHANGE_LOG_SCHEMA


def log_of(spark, points):
    return spark.createDataFrame(points, "binlog_file string, log_pos bigint, gtid_uuid string, gtid_no bigint")


POINTS = [("f1", 4, "u", 1), ("f1", 900, "u", 2), ("f1", 10000, "v", 1), ("f2", 4, "u", 3), ("f10", 5, None, None)]


def keys(df):
    return sorted((r.binlog_file, r.log_pos) for r in df.collect())


def test_range_is_half_open_and_files_compare_as_text(spark):
    log = log_of(spark, POINTS)
    assert keys(pos.catch_up_range(log, Position("f1", 900), Position("f10", 5))) == [("f1", 10000), ("f10", 5)]
    assert keys(pos.catch_up_range(log, None, Position("f1", 900))) == [("f1", 4), ("f1", 900)]
    assert keys(pos.resume_filter(log, None)) == sorted((p[0], p[1]) for p in POINTS)
    assert keys(pos.resume_filter(log, None, Position("f2", 3))) == [("f2", 4)]
    assert keys(pos.resume_filter(log, Position("f1", 10000), Position("f2", 4))) == [("f10", 5), ("f2", 4)]


def test_saved_point(spark, path):
    assert pos.load_high_water(spark, path) is None
    assert pos.high_water_scan(spark, path).count() == 0
    pos.save_high_water(spark, path, Position("f1", 50), 1)
    pos.save_high_water(spark, path, Position("f2", 7), 2)
    assert pos.load_high_water(spark, path) == Position("f2", 7)
    pos.save_high_water(spark, path, Position("f1", 60), 3)
    assert pos.load_high_water(spark, path) == Position("f1", 60)
    assert pos.high_water_scan(spark, path).count() == 1


def test_starting_position(spark):
    log = log_of(spark, POINTS)
    assert pos.starting_position(log, None) is None
    assert pos.starting_position(log, None, "latest") == Position("f2", 4)
    assert pos.starting_position(log, Position("f1", 1), "latest") == Position("f1", 1)
    assert pos.starting_position(log, None, Position("f1", 3)) == Position("f1", 3)
    assert pos.starting_position(log.limit(0), None, "latest") is None
    with pytest.raises(ValueError):
        pos.starting_position(log, None, "newest")


def numbers(spans):
    return {n for lo, hi in spans for n in range(lo, hi + 1)}


@pytest.mark.parametrize("width", [3, 17, 10_000])
def test_merge_equals_sets(spark, width):
    rng = random.Random(width)
    spans = [(rng.choice("uv"), lo, lo + rng.randint(0, 6)) for lo in (rng.randint(1, 300) for _ in range(90))]
    spans += [("w", 1, 1000), ("w", 2, 3), ("w", 500, 1001), ("w", 1003, 1003)]
    df = spark.createDataFrame(spans, "source_uuid string, lo bigint, hi bigint")
    got = pos.merge_spans(df, ["source_uuid"], width).collect()
    for u in "uvw":
        mine = sorted((r.lo, r.hi) for r in got if r.source_uuid == u)
        assert numbers(mine) == numbers((lo, hi) for x, lo, hi in spans if x == u)
        assert all(b[0] > a[1] + 1 for a, b in zip(mine, mine[1:], strict=False))


@pytest.mark.parametrize("broadcast", [0, 1_000])
def test_number_filter_with_and_without_broadcast(spark, broadcast):
    rng = random.Random(8)
    log = [("f", i, rng.choice(["u", "v", None]), rng.randint(1, 60)) for i in range(300)]
    spans = [("u", 1, 9), ("u", 20, 20), ("u", 30, 41), ("v", 50, 70)]
    done = {(u, n) for u, lo, hi in spans for n in range(lo, hi + 1)}
    executed = spark.createDataFrame(spans, "source_uuid string, lo bigint, hi bigint")
    got = pos.gtid_resume_filter(log_of(spark, log), executed, 7, broadcast)
    assert got.columns == ["binlog_file", "log_pos", "gtid_uuid", "gtid_no"]
    assert sorted(r.log_pos for r in got.collect()) == [p for _, p, u, n in log if (u, n) not in done]


def test_many_sets_that_start_at_one(spark):
    """All sets begin at number 1, as they do in practice; their ends decide."""
    outer = spark.createDataFrame([("u", 1, 500)], "source_uuid string, lo bigint, hi bigint")
    inner = spark.sql("SELECT id AS set_id, 'u' AS source_uuid, 1L AS lo, id + 1 AS hi FROM range(1000)")
    got = pos.gtid_contains(outer, inner, "set_id")
    assert got.where("contained = (set_id < 500)").count() == 1000
    merged = pos.merge_spans(inner, ["source_uuid"])
    assert [(r.lo, r.hi) for r in merged.collect()] == [(1, 1000)]


def test_contains(spark):
    outer = spark.createDataFrame([("u", 1, 10), ("u", 12, 20), ("v", 5, 5)], "source_uuid string, lo bigint, hi bigint")
    inner = spark.createDataFrame(
        [(1, "u", 2, 9), (1, "v", 5, 5), (2, "u", 9, 12), (3, "w", 1, 1), (4, "u", 12, 20), (5, "u", 11, 11)],
        "set_id int, source_uuid string, lo bigint, hi bigint",
    )
    got = {r.set_id: r.contained for r in pos.gtid_contains(outer, inner, "set_id", 4).collect()}
    assert got == {1: True, 2: False, 3: False, 4: True, 5: False}


def test_lost_numbers_fall_back_to_the_position(spark, caplog):
    log = log_of(spark, [("f", 100 + n, "u", n) for n in range(5, 12)] + [("f", 200, "v", 1)])
    schema = "source_uuid string, lo bigint, hi bigint"
    complete = spark.createDataFrame([("u", 1, 2), ("u", 3, 6)], schema)
    assert pos.missing_sources(log, complete).count() == 0
    assert sorted(r.log_pos for r in pos.resume_log(log, complete).collect()) == [107, 108, 109, 110, 111, 200]
    gap = spark.createDataFrame([("u", 1, 3), ("u", 5, 6)], schema)
    assert [r.source for r in pos.missing_sources(log, gap).collect()] == ["u"]
    assert sorted(r.log_pos for r in pos.resume_log(log, gap, Position("f", 109)).collect()) == [110, 111, 200]
    assert "lost numbers" in caplog.text
    with pytest.raises(RuntimeError):
        pos.resume_log(log, gap)
    assert pos.resume_log(log, None, None, Position("f", 110)).count() == 2


def marked_log(spark, *events):
    rows = [
        ("f1", p, 0, kind, query, "app" if kind == "WRITE_ROWS" else None, "t", None, None, [[str(p)]])
        for p, kind, query in events
    ]
    return spark.createDataFrame(rows, CHANGE_LOG_SCHEMA)


SPEC = TableSpec("app", "t", (ColumnSpec("id", "bigint", True),))


def delivered(spark, log, tmp_path, start, stops):
    target, state = str(tmp_path / "target"), str(tmp_path / "state")
    for stop in stops:
        begin = pos.load_high_water(spark, state) or start
        sync_once([(SPEC, None)], log, None, begin, Position("f1", stop), target, state)
    rows = read_targets(spark, target).collect()
    return sorted((r["_insert_id"], r["image"][0]) for r in rows), pos.load_high_water(spark, state)


def test_a_stop_inside_a_transaction_loses_and_renames_nothing(spark, tmp_path):
    log = marked_log(
        spark, (100, "QUERY", "BEGIN"), (200, "WRITE_ROWS", None), (300, "WRITE_ROWS", None), (400, "XID", None), (500, "WRITE_ROWS", None)
    )
    whole, end = delivered(spark, log, tmp_path / "one", None, [500])
    parts, same = delivered(spark, log, tmp_path / "many", None, [150, 250, 300, 400, 500])
    assert whole == parts and end == same == Position("f1", 500)
    assert [i for i, _ in whole] == ["(f1, 200):f1:100:0", "(f1, 300):f1:100:0", "(f1, 500):single_f1:500:0"]
    assert pos.safe_point(log, None, Position("f1", 250)) == Position("f1", 99)
    assert pos.safe_point(log, Position("f1", 220), Position("f1", 250)) == Position("f1", 220)
    assert pos.safe_point(log, None, Position("f1", 400)) == Position("f1", 400)


def test_a_start_inside_a_transaction_waits_for_its_commit(spark, tmp_path):
    log = marked_log(spark, (700, "QUERY", "BEGIN"), (800, "WRITE_ROWS", None))
    assert delivered(spark, log, tmp_path / "open", Position("f1", 750), [900])[0] == []
    done = log.unionByName(marked_log(spark, (850, "QUERY", "COMMIT")))
    rows, end = delivered(spark, done, tmp_path / "done", Position("f1", 750), [900])
    assert rows == [("(f1, 800):f1:700:0", "800")] and end == Position("f1", 900)


def test_shuffled_bytes_of_a_task_are_bounded(spark):
    """Sorted log rows take forty times their bytes in a shuffle."""
    prepare(spark)
    name = "spark.sql.adaptive.coalescePartitions.parallelismFirst"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        rows = spark.range(4_000_000).select(F.xxhash64("id").alias("h")).repartition("h")
        assert rows.select(F.spark_partition_id().alias("p")).distinct().count() >= 4
    finally:
        spark.conf.set(name, before)
