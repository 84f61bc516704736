"""Properties of physical plans that matter at scale."""

import __spark_entry__ as entry
from tests.conftest import SF_DIR
from tidelog.model import Position
from tidelog.operators.images import route_event_kind
from tidelog.operators.positions import catch_up_range, gtid_resume_filter
from tidelog.operators.transactions import SLICE_BYTES, assign_transaction
from tidelog.plans.sync import catch_up_rows
from tidelog.sources import derived as d


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_workers_and_no_cartesian_product(spark):
    for name, query in entry.queries().items():
        plan = plan_of(query(spark, SF_DIR))
        for word in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "CartesianProduct"):
            assert word not in plan, (name, word)


def test_range_reaches_the_scan(spark):
    log = catch_up_range(d.landed_log(spark, SF_DIR), Position("a", 1), Position("b", 2))
    pushed = plan_of(log).split("PushedFilters: [")[1].split("ReadSchema")[0]
    assert "GreaterThan(binlog_file,a)" in pushed and "LessThan(binlog_file,b)" in pushed


def test_event_kinds_reach_the_scan(spark):
    plan = plan_of(route_event_kind(d.landed_log(spark, SF_DIR)))
    assert "In(kind, [" in plan.split("PushedFilters: [")[1].split("ReadSchema")[0]


def test_rows_are_shuffled_once(spark):
    """Only one exchange carries the row images; the others carry one row per slice."""
    log = d.landed_log(spark, SF_DIR)
    rows = catch_up_rows(log, d.ORDERS, None, Position("z", 0), slice_bytes=SLICE_BYTES)
    lines = plan_of(rows).splitlines()
    assert sum("Exchange hashpartitioning" in line for line in lines) == 3
    with_images = [line for line in lines if "FileScan parquet" in line and "rows#" in line]
    assert len(with_images) == 1


def test_other_tables_are_dropped_before_the_shuffle(spark):
    log = d.landed_log(spark, SF_DIR)
    plan = plan_of(catch_up_rows(log, d.ORDERS, None, Position("z", 0)))
    first = plan[plan.index("FileScan parquet") :].split("PushedFilters: [")[1].split("ReadSchema")[0]
    assert "source_table" in first


def test_number_filter_broadcasts_only_small_sets(spark):
    log = d.landed_log(spark, SF_DIR)
    spans = spark.createDataFrame([(f"u{i % 2}", i, i) for i in range(50)], "source_uuid string, lo bigint, hi bigint")
    assert "BroadcastHashJoin" in plan_of(gtid_resume_filter(log, spans))
    large = plan_of(gtid_resume_filter(log, spans, broadcast_spans=10))
    assert "Join" not in large


def test_assign_uses_no_global_window(spark):
    plan = plan_of(assign_transaction(route_event_kind(d.landed_log(spark, SF_DIR))))
    assert "Exchange SinglePartition" not in plan
