import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelog.llm import quality, toxicity
from tidelog.llm.linear_svm import dual_coordinate_descent, logistic_scale, scores


def word(rng):
    return "".join(rng.choice(("ka", "lo", "mi", "ser", "tun", "be")) for _ in range(rng.randint(1, 3)))


def made(kind, n=400, seed=1):
    """Texts with labels: 0 for shouting or toxic words, 1 otherwise (quality), and the other way round (toxic)."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [word(rng) for _ in range(rng.randint(5, 60))]
        mark = i % 3 == 0
        if mark and kind == "quality":
            words = [w.upper() + "!!" for w in words]
        elif mark:
            words[rng.randrange(len(words))] = rng.choice(("grumbat", "grumbats", "grum.bat", "plonker", "g r u m b a t"))
        rows.append((i, " ".join(words), int(mark) if kind == "toxic" else int(not mark)))
    return rows


@pytest.mark.parametrize("kind", ["quality", "toxic"])
def test_held_out_rows_are_told_apart(spark, kind):
    rows = made(kind)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], f"doc_id bigint, {kind} int")
    report = quality.quality_report if kind == "quality" else toxicity.toxicity_report
    got = report(docs, labels).join(labels, "doc_id").where("held_out").collect()
    right = [r["predicted"] == r[kind] for r in got]
    assert len(got) > 50 and np.mean(right) > 0.9
    assert all(0 <= r["score"] <= 1 for r in got)


@pytest.mark.parametrize("report", [quality.quality_report, toxicity.toxicity_report])
def test_odd_rows_and_labels(spark, odd_docs, no_docs, report):
    kinds = "doc_id bigint, quality int, toxic int"
    some = [(1, 1, 0), (2, 0, 1), (3, None, None), (6, 0, 1), (7, 1, 0), (8, 1, 0), (8, 0, 1)]
    some += [(99, 0, 0), (None, 1, 1), (9, 7, 7)]
    for rows in (some, [], [(1, 1, 1), (6, 1, 1)]):
        found = report(odd_docs, spark.createDataFrame(rows, kinds)).collect()
        assert len(found) == odd_docs.count()
        assert all(r["score"] is not None and 0 <= r["score"] <= 1 for r in found)
        assert len({r["score"] for r in found if r["doc_id"] == 8}) == 1
        assert [r["held_out"] for r in found if r["doc_id"] is None] == [True, True]
        if rows != some:
            assert len({r["score"] for r in found}) == 1
    assert report(no_docs, spark.createDataFrame(some, kinds)).count() == 0


def test_held_out_labels_are_not_learned(spark):
    rows = made("quality", 300)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id bigint, quality int")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    turned = labels.withColumn("quality", F.when(held_out, 1 - F.col("quality")).otherwise(F.col("quality")))
    a = {r["doc_id"]: r["score"] for r in quality.quality_report(docs, labels).collect()}
    b = {r["doc_id"]: r["score"] for r in quality.quality_report(docs, turned).collect()}
    assert a == b


def test_filter_keeps_columns(spark, odd_docs):
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    kept = quality.keep_good(odd_docs, labels)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()


def test_stretches_do_not_change_the_margin():
    rows = made("toxic", 200)
    model = toxicity.fit_model([r[1] for r in rows], [r[2] for r in rows], {0: 130, 1: 70})
    symbols = toxicity.Symbols()
    whole = model.text_margins([r[1] for r in rows], symbols)
    alone = np.array([model.text_margins([r[1]], symbols)[0] for r in rows])
    assert np.allclose(whole, alone, atol=1e-5)
    long = " ".join(r[1] for r in rows if not r[2]) + " " + "kalo " * 60_000
    both, first, last = model.text_margins([long + "grumbat", long, "grumbat"], symbols)
    assert both == pytest.approx(max(first, last)) and last > first and last > 0
    assert model.text_margins([None, "", "ab"], symbols).tolist() == pytest.approx([model.bias] * 3)


def test_kernel_equals_its_definition():
    import itertools

    symbols = toxicity.Symbols()
    (a,), (b,) = symbols.units("grumbat"), symbols.units("grxum-bat")

    def features(unit):
        out, square = {}, 0.0
        for n in (3, 4):
            for at in itertools.combinations(range(len(unit)), n):
                spread = at[-1] - at[0] + 1
                if spread <= toxicity.SPREAD and all(unit[i] for i in at):
                    key = tuple(unit[i] for i in at)
                    out[key] = out.get(key, 0) + toxicity.DECAY**spread
                    square += toxicity.DECAY ** (2 * spread)
        return {k: v / square**0.5 for k, v in out.items()}

    fa, fb = features(a), features(b)
    plain = sum(v * fb.get(k, 0) for k, v in fa.items())
    assert toxicity.Landmarks([b]).kernel([a])[0, 0] == pytest.approx(plain, rel=1e-6)


def test_dual_coordinate_descent_reaches_the_optimum():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(80, 3))
    y = np.where(x @ [1, -2, 0.5] + 0.3 + rng.normal(size=80) > 0, 1.0, -1.0)
    rows = [(np.arange(3), r) for r in x]
    w, b = dual_coordinate_descent(rows, y, 3, np.ones(80), epochs=400)

    def loss(w, b):
        return (w @ w + b * b) / 2 + np.maximum(0, 1 - y * (x @ w + b)).sum()

    best = loss(w, b)
    assert all(loss(w + d, b + e) >= best - 0.02 for d, e in ((rng.normal(size=3) * 0.05, rng.normal() * 0.05) for _ in range(200)))
    slope, offset = logistic_scale(x @ w + b, y, np.ones(80))
    assert slope > 0 and 0.5 < scores(np.array([2.0]), slope, offset)[0] < 1
