"""Transactions against a plain replay of the log."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import event, events_of
from tidelog.operators.images import after_images, explode_row_images, route_event_kind
from tidelog.operators.transactions import (
    assign_transaction,
    commit_gate,
    commit_gate_by_id,
    flush_pending,
    merge_hot_copies,
    open_transaction_gauge,
    open_transactions_topk,
    txn_lifecycle,
    txn_totals,
)


def random_log(seed, n=400, files=3):
    rng, out = random.Random(seed), []
    for f in range(files):
        pos = 4
        for _ in range(n):
            pos += rng.randint(1, 400)
            op = rng.choices(["BEGIN", "COMMIT", "INSERT", "UPDATE"], [2, 2, 5, 1])[0]
            rows = [[str(pos)], [str(pos + 1)]] if op in ("INSERT", "UPDATE") else None
            out.append(event(f"f{f}", pos, op, rows))
    return out


def replay(events):
    """Transaction and fate of each event, and the gauge after it."""
    found, gauge, open_txns, pending = {}, {}, 0, 0
    current = file = None
    members = {}
    for e in sorted(events, key=lambda e: (e[0], e[1])):
        f, pos, op = e[0], e[1], e[3]
        if f != file:
            file, current = f, None
        if op == "BEGIN":
            current = f"{f}:{pos}"
            members[current] = []
            open_txns += 1
            found[f, pos] = (current, None)
        elif op == "COMMIT":
            found[f, pos] = (current, None)
            if current:
                for m in members[current]:
                    found[m] = (current, True)
                open_txns -= 1
                pending -= len(members[current])
            current = None
        elif current:
            members[current].append((f, pos))
            found[f, pos] = (current, False)
            pending += 1
        else:
            found[f, pos] = (f"single_{f}:{pos}", True)
        gauge[f, pos] = (open_txns, pending)
    return found, gauge


@pytest.mark.parametrize("slice_bytes", [300, 5_000, 10_000_000])
def test_assign_equals_replay(spark, slice_bytes):
    log = random_log(slice_bytes)
    want, gauge = replay(log)
    df = events_of(spark, log)
    got = assign_transaction(df, slice_bytes).collect()
    assert {(r.binlog_file, r.log_pos): (r.txn_id, r.committed) for r in got} == want
    twice = assign_transaction(df.unionByName(df), slice_bytes).collect()
    assert sorted((r.binlog_file, r.log_pos, r.txn_id or "", str(r.committed)) for r in twice) == sorted(
        (*k, t or "", str(c)) for k, (t, c) in want.items()
    )
    levels = open_transaction_gauge(df, slice_bytes).collect()
    assert {(r.binlog_file, r.log_pos): (r.open_transactions, r.pending_row_events) for r in levels} == gauge


def test_one_transaction_with_most_rows(spark):
    """A transaction over many slices is released whole, and spread over many tasks."""
    log = [event("f0", 100, "BEGIN")] + [event("f0", 200 + 20 * i, "INSERT", [[str(i)]]) for i in range(5000)]
    log += [event("f0", 200 + 20 * 5000, "COMMIT"), event("f0", 200 + 20 * 5001, "BEGIN")]
    log += [event("f0", 200 + 20 * 5002, "INSERT", [["open"]])]
    assigned = assign_transaction(events_of(spark, log), 2_000)
    rows = commit_gate(assigned)
    assert rows.count() == 5000
    assert {r[0] for r in rows.select("txn_id").distinct().collect()} == {"f0:100"}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert rows.select(F.spark_partition_id()).distinct().count() == 8
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    totals = txn_totals(assigned).first()
    assert (totals.committed_transactions, totals.open_transactions, totals.buffered_events) == (1, 1, 1)


@pytest.mark.parametrize("limit", [100_000, 0])
def test_event_delivered_very_often(spark, monkeypatch, limit):
    """One event makes up most of the log; few or too many hot keys to broadcast."""
    monkeypatch.setattr("tidelog.session.broadcast_if_small.__defaults__", (limit,))
    log = random_log(11, n=100, files=2)
    hot = next(e for e in log if e[3] == "INSERT")
    want, _ = replay(log)
    merged = merge_hot_copies(events_of(spark, log + [hot] * 5000), slice_bytes=5_000)
    assert merged.count() == len(log)
    got = assign_transaction(merged, 5_000).collect()
    assert {(r.binlog_file, r.log_pos): (r.txn_id, r.committed) for r in got} == want
    plain = events_of(spark, log)
    assert merge_hot_copies(plain, slice_bytes=50_000) is plain


def test_flush_marks_open_rows(spark):
    log = [event("f0", 1, "BEGIN"), event("f0", 2, "INSERT", [["a"], ["b"]])]
    rows = flush_pending(assign_transaction(events_of(spark, log))).collect()
    assert [(r.image, r.image_idx, r.committed) for r in rows] == [(["a"], 0, False), (["b"], 1, False)]


def test_topk(spark):
    log = []
    for i, n in enumerate([3, 1, 2, 1]):
        base = 1000 * i
        log.append(event("f0", base + 1, "BEGIN"))
        log += [event("f0", base + 10 + j, "INSERT", [["x"]]) for j in range(n)]
    found = open_transactions_topk(assign_transaction(events_of(spark, log)), 3, capacity=7).collect()
    assert [(r.txn_id, r.n_events, r.over_capacity) for r in found] == [
        ("f0:1001", 1, True),
        ("f0:3001", 1, True),
        ("f0:2001", 2, True),
    ]
    assert not open_transactions_topk(assign_transaction(events_of(spark, log)), 1, capacity=8).first().over_capacity


def test_images(spark):
    log = [
        event("f0", 1, "INSERT", []),
        event("f0", 2, "UPDATE", [["b0"], ["a0"], ["b1"], ["a1"], ["tail"]]),
        event("f0", 3, "DELETE", [["x"], ["y"]]),
        event("f0", 4, "UPDATE", [["only before"]]),
    ]
    rows = explode_row_images(after_images(events_of(spark, log))).collect()
    assert [(r.log_pos, r.image_idx, r.image[0]) for r in rows] == [
        (2, 0, "a0"),
        (2, 1, "a1"),
        (3, 0, "x"),
        (3, 1, "y"),
    ]


def test_event_kinds(spark):
    rows = [
        ("WRITE_ROWSv2", None, "INSERT"), ("UPDATE_ROWSv1", None, "UPDATE"), ("DELETE_ROWS", None, "DELETE"),
        ("QUERY", "BEGIN", "BEGIN"), ("QUERY", "START TRANSACTION", "BEGIN"), ("QUERY", "COMMIT", "COMMIT"),
        ("XID", None, "COMMIT"), ("QUERY", "begin", None), ("QUERY", " COMMIT", None), ("QUERY", None, None),
        ("ROTATE", None, None), (None, None, None), ("WRITE_ROWSv3", None, None),
    ]
    df = spark.createDataFrame(rows, "kind string, query string, want string")
    got = route_event_kind(df).collect()
    assert len(got) == 7
    assert all(r.op == r.want for r in got)


def lifecycle_by_hand(events):
    open_ids, status = {}, {}
    for e in sorted(events, key=lambda e: (e[0], e[1])):
        at, op, txn = (e[0], e[1]), e[3], e[9]
        if op == "BEGIN":
            for m in open_ids.get(txn, []):
                status[m] = "discarded"
            open_ids[txn] = []
            status[at] = "begin"
        elif op == "COMMIT":
            status[at] = "commit" if txn in open_ids else "orphan_commit"
            for m in open_ids.pop(txn, []):
                status[m] = "committed"
        elif txn is None:
            status[at] = "committed"
        else:
            open_ids.setdefault(txn, []).append(at)
            status[at] = "open"
    return status


@pytest.mark.parametrize("slice_bytes", [50, 1_000_000])
def test_lifecycle_equals_replay(spark, slice_bytes):
    rng = random.Random(5)
    log = [
        event(f"f{i // 150}", 10 * i, rng.choice(["BEGIN", "COMMIT", "INSERT", "INSERT"]), [["x"]], txn=rng.choice("abc"))
        for i in range(300)
    ]
    log += [event("f9", i, "INSERT", [["x"]], txn=None) for i in range(3)]
    got = txn_lifecycle(events_of(spark, log, with_txn=True), slice_bytes).collect()
    assert {(r.binlog_file, r.log_pos): r.status for r in got} == lifecycle_by_hand(log)


def test_gate_by_id(spark):
    log = [
        event("f0", 1, "INSERT", [["a"]], txn="t1"),
        event("f0", 2, "COMMIT", txn="t1"),
        event("f0", 3, "INSERT", [["b"]], txn="t2"),
    ]
    assert [r.log_pos for r in commit_gate_by_id(events_of(spark, log, with_txn=True)).collect()] == [1]
