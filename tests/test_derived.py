"""The derived log, also where one order holds most line items."""

import duckdb
from pyspark.sql import functions as F

from tests.conftest import SF_DIR
from tidelog.operators.images import after_images, explode_row_images, route_event_kind, row_events
from tidelog.operators.transactions import assign_transaction
from tidelog.plans.oracle import LOG, with_
from tidelog.sources import derived as d


def test_hot_order(spark, tmp_path):
    """Order 7 holds 12,000 of 18,000 line items: they go over several transactions, ten images an event."""
    con = duckdb.connect()
    con.execute(f"CREATE TABLE orders AS SELECT * FROM '{SF_DIR}/orders.parquet'")
    con.execute(f"CREATE TABLE lineitem AS SELECT * FROM '{SF_DIR}/lineitem.parquet'")
    con.execute(f"INSERT INTO lineitem SELECT * REPLACE (7 AS l_orderkey) FROM '{SF_DIR}/lineitem.parquet'")
    con.execute(f"INSERT INTO lineitem SELECT * REPLACE (7 AS l_orderkey) FROM '{SF_DIR}/lineitem.parquet'")
    for t in ("orders", "lineitem"):
        con.execute(f"COPY {t} TO '{tmp_path}/{t}.parquet' (FORMAT parquet)")

    log = d.change_log(d.table(spark, str(tmp_path), "orders"), d.table(spark, str(tmp_path), "lineitem")).cache()
    got = sorted((r.binlog_file, r.log_pos, r.kind, r.rows) for r in log.collect())
    want = con.execute(with_(LOG) + "SELECT binlog_file, log_pos, kind, imgs FROM log").fetchall()
    assert got == sorted(want)
    assert max(len(r[3] or []) for r in got if r[2] == "WRITE_ROWS") == 10
    assert len({r[:2] for r in got}) == len(got)

    events = assign_transaction(route_event_kind(log), d.SLICE_BYTES)
    lines = explode_row_images(after_images(row_events(events))).where("source_table = 'order_lines'")
    hot = lines.where("image[0] = '7'")
    assert hot.count() > 12_000
    assert hot.select("txn_id").distinct().count() == 3
    assert hot.where("not committed").count() == 0
    log.unpersist()


def test_lines_are_shuffled_once_by_ranges_that_do_not_grow(spark, monkeypatch):
    """Numbered and grouped in one shuffle, with a task for so many rows, whatever the number of shuffle partitions."""
    monkeypatch.setattr(d, "ROWS_PER_TASK", 500)
    lines = d.table(spark, SF_DIR, "lineitem")
    plan = d.line_events(lines)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1
    assert d.line_events(lines).rdd.getNumPartitions() == -(-lines.count() // 500)
    assert d.in_ranges(lines.limit(0), "l_orderkey").rdd.getNumPartitions() <= 1


def test_steps_and_their_files_do_not_grow_with_the_log(spark, monkeypatch, path):
    """A larger log lands in more steps of the same number of files; a step alone gets files by its events."""
    monkeypatch.setattr(d, "EVENTS_PER_FILE", 200)
    monkeypatch.setattr(d, "MOST_FILES_PER_STEP", 5)
    log = d.landed_log(spark, SF_DIR).withColumn("binlog_file", F.format_string("mysql-bin.%012d", F.col("gtid_no") % 50 + 1))
    steps, files = d.step_shape(log)
    bounds = d.step_bounds(log, steps)
    assert steps == len(bounds) > d.STEPS and files == 5
    for n, (first, last) in enumerate(bounds):
        d.land_step(log, f"{path}/{n}", first, last, files)
        d.land_step(log, f"{path}/alone{n}", first, last)
        for folder in (n, f"alone{n}"):
            sizes = spark.read.parquet(f"{path}/{folder}").groupBy(F.input_file_name()).count().collect()
            assert len(sizes) >= files and max(r["count"] for r in sizes) < 2 * d.EVENTS_PER_FILE
    landed = spark.read.schema(log.schema).parquet(*(f"{path}/{n}" for n in range(len(bounds))))
    assert landed.count() == log.count() and landed.exceptAll(log).isEmpty()


def test_a_step_reads_its_own_files_of_the_log(spark):
    plan = d.step_events(d.landed_log(spark, SF_DIR), 2, 3)._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [")[1].split("ReadSchema")[0]
    assert "GreaterThanOrEqual(binlog_file,mysql-bin.000000000002)" in pushed
    assert "LessThanOrEqual(binlog_file,mysql-bin.000000000003)" in pushed


def test_a_step_alone_is_copied_without_a_shuffle(spark, monkeypatch, path):
    from pyspark.sql.classic.dataframe import DataFrame

    def shuffled(*_):
        raise AssertionError("the step was shuffled")

    log = d.landed_log(spark, SF_DIR)
    monkeypatch.setattr(DataFrame, "repartitionByRange", shuffled)
    d.land_step(log, path, 1, 1)
    assert spark.read.parquet(path).count() == d.step_events(log, 1, 1).count() > 0


def test_file_names_have_twelve_digits_at_least(spark):
    numbers = [(0, 0), (999, 0), (1000, 0), (123_456_789, 0), (5, 1), (1_000, 999), (999_000, 1_234), (7, 9_999)]
    rows = spark.createDataFrame(numbers, "k bigint, series bigint")
    name = d._file(F.col("k"), F.col("series"))
    # A pattern is parsed for every event.
    assert "format_string" not in str(name)
    want = [f"mysql-bin.{series * d.FILES_PER_SERIES + k // d.ORDERS_PER_FILE + 1:012d}" for k, series in numbers]
    assert [r[0] for r in rows.select(name).collect()] == want
