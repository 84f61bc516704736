import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.compare import connect, spark_side, sql_side
from tests.conftest import EVENT_SCHEMA, SF_DIR, event
from tidelog.model import CHANGE_LOG_SCHEMA, Position
from tidelog.operators import state
from tidelog.operators.continuity import LogGap, log_gaps, marks, require_unbroken
from tidelog.operators.number_sets import SPANS, events_of_numbers, subtract_spans
from tidelog.operators.positions import load_high_water
from tidelog.operators.transactions import release_over_capacity
from tidelog.plans import all_queries
from tidelog.plans.backfill import Ledger, backfilled, plan_chunks, restartable_backfill
from tidelog.plans.registry import ORACLES, QUERIES
from tidelog.sources.change_log import stream_change_log
from tidelog.streaming import jobs, sinks
from tidelog.streaming.live import batch_figures, counting_sink, live_latency, live_snapshot, live_totals, read_figures

assert all_queries
ROWS = "_cdc_operation string, k bigint, v string, _insert_id string"


def change(op, k, v, file=None, at=0, image=0):
    return (op, k, v, f"(b.{file}, {at}):t:{image}" if file else f"snapshot:s.t:{k}")


def test_state_is_the_last_image_in_log_order(spark):
    rows = spark.createDataFrame(
        [
            change("SNAPSHOT", 1, "a"), change("SNAPSHOT", 2, "b"), change("SNAPSHOT", 3, "c"),
            # 9 is before 10, as numbers; file 2 is after file 1 whatever the offset.
            change("UPDATE", 1, "x", "000001", 9), change("UPDATE", 1, "y", "000001", 10),
            change("DELETE", 2, "b", "000002", 4), change("INSERT", 2, "again", "000001", 99),
            change("INSERT", 4, "n", "000002", 5, 0), change("UPDATE", 4, "m", "000002", 5, 1),
            change("INSERT", 5, None, "000002", 7),
        ],
        ROWS,
    )
    got = {r.k: r.v for r in state.current_state(rows, ["k"]).collect()}
    assert got == {1: "y", 3: "c", 4: "m", 5: None}


@pytest.mark.parametrize("seed", [1, 2])
def test_hash_tree_names_what_differs(spark, seed):
    rng = random.Random(seed)
    left = [(k, f"v{k}") for k in rng.sample(range(-500, 5000), 400)] + [(None, "n")]
    right = list(left)
    want = set()
    for k, v in rng.sample(left[:-1], 6):
        right.remove((k, v))
        kind = rng.choice(["missing", "changed"])
        want.add((k, kind))
        if kind == "changed":
            right.append((k, v + "!"))
    right.append((9000, "new"))
    want.add((9000, "extra"))
    right.append(left[0])
    want.add((left[0][0], "changed" if (left[0][0], "missing") not in want else "missing"))
    sides = [spark.createDataFrame(s, "k bigint, v string") for s in (left, right)]
    tree = [state.hash_tree(s, "k", ["v"], 8, 4) for s in sides]
    ranges = {r.node for r in state.differing_ranges(*tree, fanout=4).collect()}
    got = state.differing_rows(*sides, "k", ["v"], leaf_keys=8, fanout=4).collect()
    assert {r.k // 8 for r in got} == ranges
    assert all(r.range_lo <= r.k <= r.range_hi == r.range_lo + 7 for r in got)
    assert {(r.k, r.verdict) for r in got if r.k != left[0][0]} == {w for w in want if w[0] != left[0][0]}
    assert state.differing_rows(sides[0], sides[0], "k", ["v"]).count() == 0


@pytest.mark.parametrize("width", [7, 100_000])
def test_subtracting_number_sets(spark, width):
    rng = random.Random(width)

    def spans(n):
        return [(rng.choice("ab"), lo, lo + rng.randint(0, 12)) for lo in (rng.randint(1, 150) for _ in range(n))]

    for _ in range(3):
        a, b = spans(12), spans(8)
        want = {(u, n) for u, lo, hi in a for n in range(lo, hi + 1)} - {(u, n) for u, lo, hi in b for n in range(lo, hi + 1)}
        got = subtract_spans(spark.createDataFrame(a, SPANS), spark.createDataFrame(b, SPANS), width).collect()
        assert sorted((r.source_uuid, n) for r in got for n in range(r.lo, r.hi + 1)) == sorted(want)


def numbered_log(spark, events):
    rows = [(f, p, 1, "XID", None, None, None, u, n, None) for f, p, u, n in events]
    return spark.createDataFrame(rows, CHANGE_LOG_SCHEMA)


def test_events_of_numbers_agree_with_and_without_broadcast(spark):
    log = numbered_log(spark, [("b.1", i, u, i) for i in range(30) for u in ("a", "b", None)])
    spans = spark.createDataFrame([("a", 3, 7), ("b", 20, 25), ("c", 1, 9)], SPANS)
    got = [sorted((r.gtid_uuid, r.gtid_no) for r in events_of_numbers(log, spans, 5, n).collect()) for n in (100, 0)]
    assert got[0] == got[1] == [("a", n) for n in range(3, 8)] + [("b", n) for n in range(20, 26)]


def test_gaps_within_a_log_and_behind_what_was_read(spark):
    log = numbered_log(spark, [("b.000004", 1, "a", 5), ("b.000004", 2, "a", 6), ("b.000007", 1, "a", 9), ("b.000007", 2, None, None)])
    found = sorted(tuple(r) for r in log_gaps(log).collect())
    assert found == [("file", "b", 5, 6), ("number", "a", 7, 8)]
    before = numbered_log(spark, [("b.000002", 1, "a", 2), ("b.000002", 1, "z", 40)])
    found = sorted(tuple(r) for r in log_gaps(log, marks(before)).collect())
    assert found == [("file", "b", 3, 3), ("file", "b", 5, 6), ("number", "a", 3, 4), ("number", "a", 7, 8)]
    # A repeated delivery of what was read is no gap.
    assert log_gaps(numbered_log(spark, [("b.000001", 1, "a", 1), ("b.000003", 1, "a", 3)]), marks(before)).count() == 0
    with pytest.raises(LogGap, match="file b 5 to 6"):
        require_unbroken(log_gaps(log))


def test_a_removed_landed_file_ends_the_stream(spark, tmp_path):
    landed = str(tmp_path / "landed")
    sink = sinks.continuity_sink(str(tmp_path / "marks"), "a", sinks.append_sink(str(tmp_path / "out"), "a"))

    def land_and_run(*files):
        for f in files:
            numbered_log(spark, [(f"b.{f:06d}", 4, "a", f)]).coalesce(1).write.mode("append").parquet(landed)
        jobs.run_once(stream_change_log(spark, landed), sink, str(tmp_path / "checkpoint"))

    land_and_run(1)
    land_and_run(2, 3)
    with pytest.raises(Exception, match="file b 4 to 4"):
        land_and_run(5)
    out = sinks.read_batches(spark, str(tmp_path / "out"), CHANGE_LOG_SCHEMA)
    assert sorted(r.gtid_no for r in out.collect()) == [1, 2, 3]


def sequential(batches, capacity):
    """What is released when, event by event in plain Python."""
    held, out = [], []
    for n, batch in enumerate(batches):
        held += [e for e in batch if e[1] == "INSERT"]
        closed = {e[0] for e in batch if e[1] == "COMMIT"}
        out += [(n, e[2], True) for e in held if e[0] in closed]
        held = [e for e in held if e[0] not in closed]
        while len(held) >= capacity:
            sizes = {}
            for e in held:
                sizes[e[0]] = sizes.get(e[0], 0) + 1
            least = min(sizes, key=lambda t: (sizes[t], t))
            out += [(n, e[2], False) for e in held if e[0] == least]
            held = [e for e in held if e[0] != least]
    return sorted(out), sorted(e[2] for e in held)


def test_compared_states_are_read_once(spark, tmp_path):
    paths = [str(tmp_path / side) for side in "ab"]
    for path, factor in zip(paths, (1, 2), strict=True):
        spark.range(50).selectExpr("id AS k", f"IF(id = 7, {factor}, 0) AS v").write.parquet(path)
    out = state.differing_rows(*(spark.read.parquet(p) for p in paths), "k", ["v"], leaf_keys=8, fanout=4)
    assert not [f for f in out.inputFiles() if any(p in f for p in paths)]
    assert [tuple(r) for r in out.collect()] == [(0, 7, 7, "changed")]


def test_capacity_gate_is_the_sequential_one(spark, tmp_path):
    rng, at, batches = random.Random(4), 0, []
    for _ in range(5):
        batch = []
        for _ in range(30):
            at += 1
            batch.append((f"t{rng.randint(1, 12)}", "COMMIT" if rng.random() < 0.12 else "INSERT", at))
        batches.append(batch)
    out_path, gate = str(tmp_path / "out"), str(tmp_path / "gate")
    sink = sinks.capacity_gate_sink(gate, "a", sinks.append_sink(out_path, "a"), 20)
    for n, batch in enumerate(batches):
        df = spark.createDataFrame([event("b.1", p, op, [["1"]], txn=t) for t, op, p in batch], EVENT_SCHEMA)
        for _ in range(2 if n == 3 else 1):
            sink(df, n)
    got = sinks.read_batches(spark, out_path, T.StructType([*df.schema.fields, T.StructField("committed", T.BooleanType())]))
    held = sinks.held_events(spark, gate, "a", 4, df.schema)
    want = sequential(batches, 20)
    assert sorted((r.batch_id, r.log_pos, r.committed) for r in got.collect()) == want[0]
    assert sorted(r.log_pos for r in held.collect()) == want[1] and len(want[1]) < 20
    assert release_over_capacity(df.limit(0), 1).count() == 0
    # What is delivered is not written by the gate as well.
    assert not list((tmp_path / "gate").rglob("gate=released"))


def test_batches_are_exact_whatever_the_trigger_cuts(spark, tmp_path):
    rng, path, table, order = random.Random(6), str(tmp_path / "b"), ["t"], ["at"]
    sink, rows, at = sinks.exact_batch_sink(path, "a", table, order, 7), [], 0
    schema = T.StructType.fromDDL("t string, at bigint")
    for n, size in enumerate([5, 0, 40, 3, 13]):
        batch = []
        for _ in range(size):
            at += 1
            batch.append((rng.choice("xxyz"), at))
        rows += batch
        for _ in range(2 if n == 2 else 1):
            sink(spark.createDataFrame(batch, schema), n)
    got = sinks.full_batches(spark, path, "a", schema).select("t", "at", "chunk_id")
    assert got.groupBy("t", "chunk_id").count().where("count <> 7").count() == 0
    got = got.unionByName(sinks.flush_rest(spark, path, "a", 4, table, schema))
    want, seen = [], {}
    for t, a in rows:
        want.append((t, a, seen.get(t, 0) // 7))
        seen[t] = seen.get(t, 0) + 1
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def counted_rows(df, counter):
    """``df``, which adds to ``counter`` the rows that are worked out."""

    def task(batches):
        for batch in batches:
            counter.add(batch.num_rows)
            yield batch

    return df.mapInArrow(task, df.schema)


def test_exact_batches_work_a_batch_out_once_and_sort_bounded_parts(spark, tmp_path, monkeypatch):
    counter, parts, chunks = spark.sparkContext.accumulator(0), [], sinks.row_chunks
    monkeypatch.setattr(sinks, "row_chunks", lambda *given: parts.append(given[4]) or chunks(*given))
    sink = sinks.exact_batch_sink(str(tmp_path / "b"), "a", ["t"], ["at"], 7, part_rows=100)
    sink(counted_rows(spark.range(1000).select(F.lit("x").alias("t"), F.col("id").alias("at")), counter), 0)
    assert parts == [10] and counter.value == 1000
    assert not list((tmp_path / "b" / "taken").rglob("*.parquet"))


def test_backfill_goes_on_where_it_stopped(spark, tmp_path):
    rows = spark.range(1000).select(F.when(F.col("id") % 100 == 7, None).otherwise(F.col("id") * F.col("id")).alias("k"), F.col("id").cast("string").alias("v"))
    log = numbered_log(spark, [("b.000001", 40, "a", 1)])
    target, ledger, saved = (str(tmp_path / n) for n in ("raw", "ledger", "state"))
    ranges = plan_chunks(rows, "k", 90)
    assert 9 <= len(ranges) <= 12 and ranges[0][1] is None and ranges[-1][2] is None
    assert all(a[2] == b[1] for a, b in zip(ranges, ranges[1:]))

    def stop(n):
        if n == 2:
            raise KeyError("stopped")

    call = dict(key="k", target=target, ledger_path=ledger, state=saved, chunk_rows=90, step_chunks=2)
    with pytest.raises(KeyError):
        restartable_backfill(rows, log, after_step=stop, **call)
    assert len(Ledger(spark, ledger).written()) == 4
    with pytest.raises(RuntimeError, match="not complete"):
        backfilled(spark, rows, target, ledger)
    # Half a chunk that a killed step has left is replaced.
    spark.createDataFrame([(5, "torn", 6)], "k bigint, v string, _chunk bigint").write.mode("append").partitionBy("_chunk").parquet(target)
    steps = []
    later = numbered_log(spark, [("b.000001", 90, "a", 2)])
    assert restartable_backfill(rows, later, after_step=steps.append, **call) == Position("b.000001", 40)
    assert len(steps) == -(-(len(ranges) - 4) // 2)
    got = backfilled(spark, rows, target, ledger)
    assert got.exceptAll(rows).count() == 0 and rows.exceptAll(got).count() == 0
    assert restartable_backfill(rows, later, after_step=steps.append, **call) == load_high_water(spark, saved)
    assert len(steps) == -(-(len(ranges) - 4) // 2)
    done = Ledger(spark, ledger).read().where("status = 'complete'").collect()
    assert [(r.chunk_id, r.n_rows) for r in done] == [(-1, 1000)]


def test_backfill_of_an_empty_table_is_complete(spark, tmp_path):
    rows = spark.createDataFrame([], "k bigint, v string")
    target, ledger, saved = (str(tmp_path / n) for n in ("raw", "ledger", "state"))
    assert restartable_backfill(rows, numbered_log(spark, []), "k", target, ledger, saved) is None
    assert backfilled(spark, rows, target, ledger).count() == 0



def test_figures_of_written_rows_do_not_work_the_batch_out_again(spark, tmp_path):
    counter, path, figures = spark.sparkContext.accumulator(0), str(tmp_path / "rows"), str(tmp_path / "figures")
    batch = spark.range(50).select(
        F.timestamp_seconds(F.col("id") + 100).alias("_cdc_timestamp"), F.lit("s").alias("_cdc_database"),
        F.concat(F.lit("t"), F.col("id") % 2).alias("_cdc_table"),
    )
    sink = counting_sink(sinks.append_sink(path, "a"), figures, "a", sinks.appended(path, "a", batch.schema))
    sink(counted_rows(batch, counter), 0)
    assert counter.value == 50
    assert sorted((r.table_name, r.n_rows) for r in read_figures(spark, figures).where("n_rows > 0").collect()) == [("s.t0", 25), ("s.t1", 25)]


def test_live_figures_count_each_batch_once(spark, tmp_path):
    one = spark.sql(
        "SELECT timestamp_seconds(100 + id) AS _cdc_timestamp, 'INSERT' AS _cdc_operation, 's' AS _cdc_database, "
        "concat('t', id % 2) AS _cdc_table, array('x') AS image, string(id) AS _insert_id FROM range(3)"
    )
    path = str(tmp_path / "figures")
    sink = counting_sink(lambda batch, batch_id: None, path, "a")
    for n in (0, 1, 1, 2):
        sink(one, n)
    counting_sink(lambda batch, batch_id: None, path, "b")(one.limit(0), 0)
    # Figures of further batches, more than a query remembers, as the sink writes them.
    for run, first in (("a", 3), ("b", 1)):
        more = spark.range(first, first + 60).select(
            F.lit("s.t0").alias("table_name"), F.lit(2).cast("bigint").alias("n_rows"),
            F.timestamp_seconds(F.col("id") + 1000).alias("last_event_time"), F.lit(None).cast("double").alias("took_ms"),
            F.lit(run).alias("run"), F.col("id").alias("batch_id"),
        )
        more.write.mode("append").partitionBy("run", "batch_id").parquet(path)
    figures = read_figures(spark, path)
    now = F.timestamp_seconds(F.lit(2000))
    total = live_totals(figures, now).first()
    assert (total.rows_written, total.batches_written, total.lag_s) == (9 + 240, 123, 2000 - 1062)
    assert total.average_batch_size == pytest.approx(249 / 123)
    snapshot = live_snapshot(figures, now).first()
    assert {k: (v.rows_written, v.batches_written) for k, v in snapshot.table_metrics.items()} == {"s.t0": (246, 123), "s.t1": (3, 3)}
    assert live_latency(figures).count() == 4
    assert live_totals(read_figures(spark, str(tmp_path / "none")), now).first().rows_written == 0
    assert batch_figures(one.limit(0), 5.0).collect()[0].took_ms == 5.0



@pytest.mark.parametrize("name", ["commit_gate", "force_flush"])
def test_gate_queries_fail_without_the_streams_rows(spark, monkeypatch, name):
    """The batch form settles what the stream leaves out, but it cannot stand in for the stream."""

    def hardly_any(path, run):
        return lambda batch, batch_id: batch.where("length(_insert_id) < 3").write.mode("overwrite").parquet(sinks.batch_folder(path, run, batch_id))

    monkeypatch.setattr(sinks, "append_sink", hardly_any)
    ours = spark_side(QUERIES[name](spark, SF_DIR))
    theirs = sql_side(connect(SF_DIR), ORACLES[name])
    assert ours[0] == theirs[0] and ours[1] == theirs[1] and ours[3] != theirs[3]
