"""Streams against the batch answer, and against crashes."""

import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_DIR
from tidelog.model import CDC_TIMESTAMP, CHANGE_LOG_SCHEMA, INSERT_ID
from tidelog.operators.images import route_event_kind, row_events
from tidelog.operators.transactions import commit_gate_by_id, gtid_transaction
from tidelog.sources import derived as d
from tidelog.sources.change_log import read_change_log, stream_change_log
from tidelog.streaming import jobs, sinks
from tidelog.streaming.gate import commit_gate_stream, force_flush_stream


def write_log(spark, events, path):
    """events: (pos, ts, kind, gtid_no)"""
    rows = [
        ("f", p, ts, kind, None, "app" if kind != "XID" else None, "t", "u", no, [[str(p)]] if kind != "XID" else None)
        for p, ts, kind, no in events
    ]
    spark.createDataFrame(rows, CHANGE_LOG_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def stream_events(spark, path):
    return gtid_transaction(route_event_kind(stream_change_log(spark, path, max_files=1)))


def drain(spark, rows, tmp_path, name="out"):
    jobs.run_once(rows, sinks.append_sink(str(tmp_path / name), "a"), str(tmp_path / f"{name}-cp"))
    return sinks.read_batches(spark, str(tmp_path / name), rows.schema)


def test_gate_equals_batch(spark, tmp_path):
    """Commits arrive one, two and three files behind their rows."""
    path = str(tmp_path / "log")
    write_log(spark, [(1, 10, "WRITE_ROWS", 1), (2, 11, "WRITE_ROWS", 2), (3, 12, "WRITE_ROWS", 3)], path)
    write_log(spark, [(4, 13, "XID", 1), (5, 14, "WRITE_ROWS", 3)], path)
    write_log(spark, [(6, 15, "XID", 3), (7, 16, "WRITE_ROWS", 4)], path)
    got = drain(spark, commit_gate_stream(stream_events(spark, path), "1 minute", "1 minute"), tmp_path)
    batch = commit_gate_by_id(gtid_transaction(route_event_kind(read_change_log(spark, path))))
    assert sorted(r.log_pos for r in got.collect()) == sorted(r.log_pos for r in batch.collect()) == [1, 3, 5]


def test_hot_transaction_is_spread(spark, tmp_path):
    path = str(tmp_path / "log")
    write_log(spark, [(i, 10, "WRITE_ROWS", 1) for i in range(2000)], path)
    write_log(spark, [(5000, 12, "XID", 1)], path)
    got = drain(spark, commit_gate_stream(stream_events(spark, path), "1 minute", "1 minute", salts=8), tmp_path)
    assert sorted(r.log_pos for r in got.collect()) == list(range(2000))
    sizes = [r["count"] for r in got.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) > 2 and max(sizes) < 1500


def test_forced_release(spark, tmp_path):
    path = str(tmp_path / "log")
    write_log(spark, [(1, 10, "WRITE_ROWS", 1), (2, 11, "WRITE_ROWS", 2), (3, 11, "XID", 2)], path)
    write_log(spark, [(4, 1000, "WRITE_ROWS", 3), (5, 1000, "XID", 3)], path)
    write_log(spark, [(6, 1001, "WRITE_ROWS", 4), (7, 1001, "XID", 5)], path)
    got = drain(spark, force_flush_stream(stream_events(spark, path), "10 seconds", "60 seconds"), tmp_path)
    # Row 6 is young and stays held; the batch form releases it.
    assert sorted((r.log_pos, r.committed) for r in got.collect()) == [(1, False), (2, True), (4, True)]


def target_rows(spark, path, rows):
    return sorted(r[INSERT_ID] for r in sinks.read_batches(spark, path, rows.schema).collect())


def test_crash_after_write_then_replay(spark, tmp_path):
    """The sink wrote a batch but the batch was not recorded: the repeat replaces it."""
    log = d.landed_log(spark, SF_DIR)
    landed, out, at = (str(tmp_path / n) for n in ("landed", "out", "cp"))
    for first, last in d.step_bounds(log, 2):
        d.land_step(log, landed, first, last)
    rows = jobs.change_row_stream(stream_change_log(spark, landed, max_files=d.FILES_PER_STEP))
    sink = sinks.idempotent_sink(out, "a", CDC_TIMESTAMP)
    crashed = []

    def crash_once(batch, batch_id):
        sink(batch, batch_id)
        if batch_id == 1 and not crashed:
            crashed.append(batch_id)
            raise RuntimeError("lost after the write")

    with pytest.raises(Exception, match="lost after the write"):
        jobs.run_once(rows, crash_once, at)
    want = sorted(r[0] for r in jobs.change_row_stream(log).select(INSERT_ID).collect())
    assert len(target_rows(spark, out, rows)) == len(want)
    jobs.run_once(rows, crash_once, at)
    assert target_rows(spark, out, rows) == want
    again = sinks.idempotent_sink(out, "b", CDC_TIMESTAMP)
    jobs.run_once(jobs.change_row_stream(stream_change_log(spark, landed)), again, str(tmp_path / "cp2"))
    assert target_rows(spark, out, rows) == want


def test_only_the_days_of_a_batch_are_read(spark, tmp_path, monkeypatch):
    """Folders read per batch do not grow with the batches before."""
    out, read = str(tmp_path / "out"), []
    days_of = sinks.read_days
    monkeypatch.setattr(sinks, "read_days", lambda s, p, schema, days: read.append(days) or days_of(s, p, schema, days))
    sink = sinks.idempotent_sink(out, "a", "at")
    for batch_id in range(12):
        rows = spark.sql(f"SELECT timestamp '2024-01-01' + make_interval(0, 0, 0, {batch_id}) AS at, 'k{batch_id}' AS _insert_id")
        again = spark.sql(f"SELECT timestamp '2024-01-01' + make_interval(0, 0, 0, {max(0, batch_id - 1)}) AS at, 'k{max(0, batch_id - 1)}' AS _insert_id")
        sink(rows.unionByName(again), batch_id)
        sink(rows.unionByName(again), batch_id)
    assert max(map(len, read)) <= 2
    assert sorted(r[0] for r in spark.read.parquet(out).select("_insert_id").collect()) == sorted(f"k{i}" for i in range(12))


def test_json_log(spark, tmp_path):
    path = str(tmp_path / "json")
    log = d.landed_log(spark, SF_DIR)
    log.write.json(path)
    assert read_change_log(spark, path, "json").exceptAll(log).count() == 0
    rows = row_events(route_event_kind(stream_change_log(spark, path, "json", max_bytes=1_000_000)))
    got = drain(spark, rows, tmp_path).count()
    assert got == row_events(route_event_kind(log)).count()


def test_state_of_the_gate_stays_in_the_jvm(spark, tmp_path):
    path = str(tmp_path / "log")
    write_log(spark, [(1, 10, "WRITE_ROWS", 1), (2, 11, "XID", 1)], path)
    out = str(tmp_path / "out")
    rows = commit_gate_stream(stream_events(spark, path), "1 minute", "1 minute")
    query = jobs.run_once(rows, sinks.append_sink(out, "a"), str(tmp_path / "cp"))
    operators = [o["operatorName"] for o in json.loads(query.lastProgress.json)["stateOperators"]]
    assert operators == ["symmetricHashJoin"]


def test_rows_are_counted_as_they_pass(spark, tmp_path):
    landed = d.landed_steps(spark, SF_DIR)
    rows = jobs.with_metrics(jobs.change_row_stream(stream_change_log(spark, landed, max_files=d.FILES_PER_STEP)))
    query = jobs.run_once(rows, sinks.append_sink(str(tmp_path / "out"), "a"), str(tmp_path / "cp"))
    totals = jobs.progress_totals(query)
    assert totals["rows_processed"] == sinks.read_batches(spark, str(tmp_path / "out"), rows.schema).count() > 0
    assert totals["batches_written"] >= 2 and totals["rows_per_second"] > 0 and totals["last_event_time"]


def test_totals_over_more_batches_than_a_query_remembers(spark, tmp_path):
    log, out, kept = str(tmp_path / "log"), str(tmp_path / "out"), str(tmp_path / "progress")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "5")
    try:
        for part in range(4):
            for i in range(3):
                write_log(spark, [(part * 10 + i, 10, "WRITE_ROWS", 1)], log)
            rows = jobs.with_metrics(jobs.change_row_stream(stream_change_log(spark, log, max_files=1)))
            query = jobs.run_once(rows, sinks.append_sink(out, "a"), str(tmp_path / "cp"))
            for _ in range(2):
                jobs.record_progress(spark, query, kept)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    totals = jobs.recorded_totals(spark, kept).first()
    n = sinks.read_batches(spark, out, rows.schema).count()
    assert totals["total_batches_written"] >= 12 and totals["rows_processed"] == n > 0
    assert totals["write_latency_ms"] > 0 and totals["average_batch_size"] == n / totals["total_batches_written"]


def gate_log(spark, landed, *events):
    rows = [
        (f, p, 0, kind, query, "app" if kind == "WRITE_ROWS" else None, "t", None, None, [[str(p)]])
        for f, p, kind, query in events
    ]
    spark.createDataFrame(rows, CHANGE_LOG_SCHEMA).coalesce(1).write.mode("append").parquet(landed)


def test_position_gate_refuses_a_log_out_of_order(spark, tmp_path):
    landed = str(tmp_path / "log")
    gate_log(spark, landed, ("f", 5, "WRITE_ROWS", None))
    gate_log(spark, landed, ("f", 1, "QUERY", "BEGIN"))
    gate = sinks.position_gate_sink(str(tmp_path / "gate"), "a", sinks.append_sink(str(tmp_path / "out"), "a"))
    rows = route_event_kind(stream_change_log(spark, landed, max_files=1))
    with pytest.raises(Exception, match="out of order: f:1 came after f:5"):
        jobs.run_once(rows, gate, str(tmp_path / "cp"))


def test_position_gate_settles_the_open_tail_of_a_finished_file(spark, tmp_path):
    landed, at = str(tmp_path / "log"), str(tmp_path / "gate")
    gate_log(spark, landed, ("f1", 1, "QUERY", "BEGIN"), ("f1", 2, "WRITE_ROWS", None))
    for n in range(2, 6):
        gate_log(spark, landed, (f"f{n}", 1, "QUERY", "BEGIN"), (f"f{n}", 2, "WRITE_ROWS", None), (f"f{n}", 3, "XID", None))
    gate = sinks.position_gate_sink(at, "a", sinks.append_sink(str(tmp_path / "out"), "a"))
    rows = route_event_kind(stream_change_log(spark, landed, max_files=1))
    jobs.run_once(rows, gate, str(tmp_path / "cp"))
    released = spark.read.parquet(str(tmp_path / "out")).select("binlog_file").collect()
    assert sorted(r[0] for r in released) == ["f2", "f3", "f4", "f5"]
    gone = sinks.discarded_events(spark, at, "a", rows.schema)
    assert sorted((r["binlog_file"], r["log_pos"]) for r in gone.collect()) == [("f1", 1), ("f1", 2)]
    left = [p.name for p in (tmp_path / "gate" / "run=a" / "batch_id=0").iterdir()]
    assert [n for n in left if "SUCCESS" not in n] == ["gate=discarded"]


def test_position_gate_holds_open_transactions_over_batches(spark, tmp_path):
    """A transaction over three files, an abandoned one, and a crash in between."""
    landed, out = str(tmp_path / "log"), str(tmp_path / "out")

    def land(*events):
        rows = [
            ("f", p, 0, kind, query, "app" if kind == "WRITE_ROWS" else None, "t", None, None, [[str(p)]])
            for p, kind, query in events
        ]
        spark.createDataFrame(rows, CHANGE_LOG_SCHEMA).coalesce(1).write.mode("append").parquet(landed)

    land((1, "QUERY", "BEGIN"), (2, "WRITE_ROWS", None))
    land((3, "WRITE_ROWS", None))
    land((4, "WRITE_ROWS", None), (5, "XID", None), (6, "WRITE_ROWS", None), (7, "QUERY", "BEGIN"), (8, "WRITE_ROWS", None))
    land((9, "QUERY", "BEGIN"), (10, "WRITE_ROWS", None), (11, "QUERY", "COMMIT"), (12, "QUERY", "BEGIN"))
    land((13, "WRITE_ROWS", None))
    keep, crashed = sinks.append_sink(out, "a"), []

    def deliver(released, batch_id):
        if batch_id == 2 and not crashed:
            crashed.append(1)
            raise RuntimeError("lost before the delivery")
        keep(released, batch_id)

    gate = sinks.position_gate_sink(str(tmp_path / "gate"), "a", deliver)
    rows = route_event_kind(stream_change_log(spark, landed, max_files=1))
    with pytest.raises(Exception, match="lost before the delivery"):
        jobs.run_once(rows, gate, str(tmp_path / "cp"))
    jobs.run_once(rows, gate, str(tmp_path / "cp"))
    got = spark.read.parquet(out).select("batch_id", "log_pos", "txn_id").orderBy("log_pos").collect()
    assert [(r.batch_id, r.log_pos, r.txn_id) for r in got] == [
        (2, 2, "f:1"),
        (2, 3, "f:1"),
        (2, 4, "f:1"),
        (2, 6, "single_f:6"),
        (3, 10, "f:9"),
    ]


def test_state_lies_on_disk_in_parts_by_cores(spark, tmp_path):
    """A stream with state keeps it out of the heap; the session's own settings stay as they were."""
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.streaming.minBatchesToRetain")
    rows = jobs.change_row_stream(stream_change_log(spark, d.landed_steps(spark, SF_DIR)), gate=("10 minutes", "5 minutes"))
    jobs.run_once(rows, sinks.append_sink(str(tmp_path / "out"), "a"), str(tmp_path / "cp"), state=True)
    kept = (tmp_path / "cp" / "offsets" / "0").read_text()
    assert "RocksDBStateStoreProvider" in kept
    assert f'"spark.sql.shuffle.partitions":"{jobs.STATE_PARTS_PER_CORE * spark.sparkContext.defaultParallelism}"' in kept
    assert before == (spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.streaming.minBatchesToRetain"))


def test_resume_takes_the_log_in_bounded_batches(spark, monkeypatch):
    """A larger log gives more micro-batches, not larger ones, and the same rows."""
    from tidelog.plans import sink_queries

    monkeypatch.setattr(d, "EVENTS_PER_FILE", 400)
    monkeypatch.setattr(d, "MOST_FILES_PER_STEP", 4)
    plain, sizes = sinks.idempotent_sink, []

    def watched(*args):
        write = plain(*args)

        def counted(batch, batch_id):
            sizes.append(batch.count())
            write(batch, batch_id)

        return counted

    monkeypatch.setattr(sinks, "idempotent_sink", watched)
    log = d.landed_log(spark, SF_DIR)
    files = F.substring("binlog_file", 11, 12).cast("bigint")
    log = log.withColumn("binlog_file", F.format_string("mysql-bin.%012d", files * 4 + F.expr("log_pos div 25000000")))
    monkeypatch.setattr(d, "landed_log", lambda *_: log)
    rows = sink_queries.resumed(spark, SF_DIR)
    assert len(sizes) > 4 and max(sizes) < sum(sizes) / 4
    assert rows.count() == rows.select("_insert_id").distinct().count() == sum(sizes) / 2


def test_a_gate_keeps_no_images(spark, tmp_path):
    """Keys alone pass the gate; images come from the log again, as often as the gate lets an event through."""
    path, out = str(tmp_path / "log"), str(tmp_path / "out")
    write_log(spark, [(1, 10, "WRITE_ROWS", 1), (1, 10, "WRITE_ROWS", 1), (2, 11, "WRITE_ROWS", 2), (5, 11, "WRITE_ROWS", None)], path)
    write_log(spark, [(3, 13, "XID", 1), (4, 14, "WRITE_ROWS", 3)], path)
    stream = stream_change_log(spark, path, max_files=1)
    keys = jobs.gated_keys(stream, lambda events: commit_gate_stream(events, "1 minute", "1 minute"))
    assert not {"rows", "image"} & set(keys.columns)
    sink = jobs.change_rows_sink(str(tmp_path / "keys"), lambda: read_change_log(spark, path), sinks.append_sink(out, "a"))
    jobs.run_once(keys, sink, str(tmp_path / "cp"), state=True)
    whole = drain(spark, jobs.change_row_stream(stream, gate=("1 minute", "1 minute")), tmp_path, "whole")
    got = sinks.read_batches(spark, out, whole.drop("run", "batch_id").schema)
    assert sorted(map(tuple, got.select(whole.columns[:6]).collect())) == sorted(map(tuple, whole.select(whole.columns[:6]).collect()))
    assert got.count() == 2 and not (tmp_path / "keys" / "run=keys" / "batch_id=0").exists()


def test_leftovers_keep_rows_without_an_id(spark, tmp_path):
    rows = [
        (f, p, 10, kind, None, "app", "t", "u", no, images)
        for f, p, kind, no, images in [
            ("f", 1, "WRITE_ROWS", 1, [["a"], ["b"]]), (None, 2, "WRITE_ROWS", 1, [["c"]]), ("f", 3, "XID", 1, None),
            ("f", 4, "UPDATE_ROWS", 2, [["d"], ["e"], ["x"]]), ("f", 4, "UPDATE_ROWS", 2, [["d"], ["e"], ["x"]]), ("f", 5, "WRITE_ROWS", 2, []),
        ]
    ]
    log = spark.createDataFrame(rows, CHANGE_LOG_SCHEMA)
    released = spark.createDataFrame([("(f, 1):u:1:0",), (None,)], f"{INSERT_ID} string")
    got = sorted(("" if r.image is None else r.image[0], r.committed) for r in jobs.leftovers(log, released).collect())
    assert got == [("b", True), ("c", True), ("e", False), ("e", False)]


def test_snapshots_of_state_follow_its_changes(spark, tmp_path):
    """Changes that a snapshot holds can go; without snapshots the folder grows with the log."""
    with jobs.state_settings(spark):
        assert int(spark.conf.get("spark.sql.streaming.stateStore.minDeltasForSnapshot")) <= 2


def test_steps_of_the_gate_are_bounded(spark, monkeypatch):
    log = spark.range(1000)
    monkeypatch.setattr(d, "EVENTS_PER_FILE", 10)
    assert d.step_shape(log, d.GATE_FILES_PER_STEP) == (25, 4)
    assert d.step_shape(log) == (5, 20)
