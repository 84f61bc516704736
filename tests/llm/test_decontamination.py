import hashlib
import random
import re

import pytest

from tidelog.llm.decontamination import built_parts, contamination_report, decontaminate, find_contamination, without

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def expected(text, items, size=10):
    w, hit, found = plain_words(text), set(), set()
    for item_id, item in items:
        iw = plain_words(item)
        n = min(size, len(iw))
        windows = {tuple(iw[i : i + n]) for i in range(len(iw) - n + 1)} if n else set()
        for i in range(len(w) - n + 1 if n else 0):
            if tuple(w[i : i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(str(item_id))
    ids = ",".join(sorted(found))
    return len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)


def made(seed=3):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "c", "dé", "E1", "f"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice((0, 1, 3, 9, 10, 11, 25, 60)))) for i in range(25)]
    docs = []
    for i in range(60):
        parts = [text(rng.randint(0, 30))]
        if i % 2:
            parts.insert(rng.randint(0, 1), items[rng.randrange(25)][1].upper().replace(" ", ", "))
        docs.append((i, " zz ".join(parts)))
    return docs, items


@pytest.mark.parametrize("part_words", [100_000, 40])
def test_equals_brute_force(spark, part_words):
    docs, items = made()
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {r[0]: tuple(r)[1:] for r in contamination_report(df, bench, part_words=part_words).collect()}
    assert got == {i: expected(t, items) for i, t in docs}


def test_odd_rows_and_clashing_columns(spark, odd_docs, no_docs):
    item = "the quick brown fox jumps over the lazy dog near the old river"
    bench = spark.createDataFrame([(1, item), (2, None), (None, item), (3, "")], "item_id bigint, text string")
    for part_words in (100_000, 12):
        rows = contamination_report(odd_docs, bench, part_words=part_words).collect()
        assert len(rows) == odd_docs.count()
        by_id = {}
        for r in rows:
            by_id.setdefault(r["doc_id"], []).append((r["n_words"], r["n_hit"], r["n_items"]))
        assert by_id[8] == [(15, 13, 1)] * 2 and by_id[1] == [(15, 13, 1)]
        assert by_id[2] == by_id[3] == by_id[4] == [(0, 0, 0)] and by_id[5] == [(30_001, 0, 0)]
        kept = decontaminate(odd_docs, bench, max_coverage=0.9, part_words=part_words)
        assert kept.columns == odd_docs.columns
        one = kept.where("doc_id = 8").collect()
        assert [(r["text"], r["n_chars"], r["spans"], r["items"]) for r in one] == [(" bank today", 11, "p", "i")] * 2
        assert decontaminate(odd_docs, bench, part_words=part_words).where("doc_id in (1, 8)").count() == 0
        assert kept.count() == odd_docs.count()
    assert contamination_report(no_docs, bench).count() == 0
    assert contamination_report(odd_docs, bench.limit(0)).where("contaminated").count() == 0


def test_spans_are_word_places(spark):
    items = spark.createDataFrame([("x", "a b c")], "item_id string, text string")
    docs = spark.createDataFrame([(1, "q A-b. C! r a b"), (2, "a b c a b c")], "doc_id bigint, text string")
    got = {r["doc_id"]: (r["spans"], r["items"]) for r in find_contamination(docs, items).collect()}
    assert got == {1: ([1, 4], ["x"]), 2: ([0, 6], ["x"])}


def test_windows_that_a_cut_brings_together_go_too(spark):
    items = spark.createDataFrame([(1, "a b c d")], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "x a b a b c d c d y " + "z " * 20)], "doc_id bigint, text string")
    assert decontaminate(docs, items).first()["text"].split() == ["x", "y"] + ["z"] * 20


@pytest.mark.parametrize("part_words", [100_000, 4])
def test_no_window_is_left_with_items_in_parts(spark, part_words):
    items = spark.createDataFrame([(1, "a b c d"), (2, "p q r s")], "item_id bigint, text string")
    rest = " y " + "z " * 40
    texts = ["x a b a b c d c d", "x a b p q r s c d", "x p a b p q a b c d r s c d q r s", "x", "x a b c d"]
    docs = [(i, t + rest) for i, t in enumerate(texts)] + [(0, texts[0] + rest), (None, texts[1] + rest), (9, None)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    rows = decontaminate(df, items, part_words=part_words).collect()
    assert len(rows) == 8
    assert all(r["text"].split() == ["x", "y"] + ["z"] * 40 for r in rows if r["doc_id"] != 9)


def test_automata_are_built_apart(spark):
    items = spark.createDataFrame([(i, f"w{i} " * 12) for i in range(10)], "item_id bigint, text string")
    assert built_parts(items, 10, 30).count() >= 5 and built_parts(items, 10, 1000).count() == 1


def test_cutting_keeps_the_rest():
    assert without("é one, two three. four", [1, 3]) == "é  three. four"
    assert without("one", []) == "one"
    assert without(None, []) is None
