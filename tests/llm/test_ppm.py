import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidelog.llm import postings, ppm
from tidelog.llm.queries import QUERIES


def expected(docs):
    """Scores by the definitions, on dictionaries."""
    tokens = [(i, "".join(c.lower() if c.isascii() else c for c in t or "").encode().split()) for i, t in docs]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in tokens]
    learned = [w for (_, w), h in zip(tokens, held) if not h]
    c = Counter(w for text in learned for w in text)
    n, v = sum(c.values()) + len(learned), len(c) + bool(learned)
    trie = defaultdict(Counter)
    for w, k in c.items():
        x = b" " + w + b" "
        for p in range(1, len(x)):
            for o in range(min(ppm.DEPTH, p) + 1):
                trie[x[p - o : p]][x[p]] += k
    if learned:
        for context in (b"", b" "):
            trie[context][ppm.END] += len(learned)

    def chance(context, symbol):
        log, out = 0.0, set()
        for k in range(len(context) + 1):
            left = {s: m for s, m in trie.get(context[k:], {}).items() if s not in out}
            if not left:
                continue
            total = sum(left.values()) + len(left)
            if symbol in left:
                return log + math.log10(left[symbol] / total)
            log += math.log10(len(left) / total)
            out |= set(left)
        return log - math.log10(max(ppm.SYMBOLS - len(out), 1))

    def word(w):
        x = b" " + w + b" "
        return sum(chance(x[max(0, p - ppm.DEPTH) : p], x[p]) for p in range(1, len(x)))

    base = lambda m: math.log10((m + 0.1) / (n + 0.1 * (v + 1)))
    rows = []
    for (i, ws), h in zip(tokens, held):
        rows.append(
            (
                str(i),
                h,
                len(ws) + 1,
                sum(c[w] > 0 for w in ws) + bool(learned),
                n,
                round(sum(base(c[w]) for w in ws) + base(len(learned)), 5),
                round(sum(word(w) for w in ws) + chance(b" ", ppm.END), 5),
            )
        )
    return sorted(rows)


def rows_of(df):
    return sorted((str(r[0]), *r[1:5], round(r["base_score"], 5), round(r["score"], 5)) for r in df.collect())


@pytest.mark.parametrize("sizes", [(1 << 24, 1 << 20), (200, 60)])
def test_equals_definition(spark, monkeypatch, sizes):
    monkeypatch.setattr(ppm, "TEXT_BLOCK", sizes[0])
    monkeypatch.setattr(ppm, "WORD_BLOCK", sizes[1])
    rng = np.random.default_rng(6)
    parts = ["the", "The", "an", "ana", "anan", "é", "éa", "zzz", "banana", "\x00", "🙂"]
    docs = [(i, " ".join("".join(rng.choice(parts, rng.integers(1, 4))) for _ in range(rng.integers(0, 25)))) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    assert rows_of(ppm.score_texts(df)) == expected(docs)


def test_odd_rows(spark, odd_docs, no_docs):
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    got = ppm.score_texts(odd_docs)
    assert rows_of(got) == expected(docs)
    assert got.columns[:5] == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens"]
    assert ppm.score_texts(no_docs).count() == 0
    alone = odd_docs.where("doc_id is null")
    assert rows_of(ppm.score_texts(alone)) == expected([(r["doc_id"], r["text"]) for r in alone.collect()])


def test_chances_of_a_context_add_up_to_one():
    path = ppm.Path({b"": {97: 5, 98: 2, 32: 4, 10: 1}, b" ": {97: 3, 10: 1}, b"a": {98: 2, 32: 1}})
    path.enter(b"ba", {98: 1})
    symbols = [b for b in range(256) if b not in ppm.SPACES] + [ppm.BLANK, ppm.END]
    assert len(symbols) == ppm.SYMBOLS
    for context in (b"ba", b"a", b" "):
        path.leave(context)
        assert sum(10 ** path.chance(context, s) for s in symbols) == pytest.approx(1)


def test_lists_hold_large_counts():
    items, keys = np.array([0, 1, 1, *[2] * 40], dtype=np.int32), np.array([1, 0, 1, *[1] * 40], dtype=np.int32)
    ends, entries = postings.packed(items, keys, 3, count_bits=4)
    lists = postings.lists(ends, entries)
    flat, lengths = postings.flat(lists)
    assert lengths.tolist() == [1, 5, 0]
    assert [(int(e) >> 4, int(e) & 15) for e in flat] == [(1, 1), (0, 1), (1, 1), (2, 15), (2, 15), (2, 10)]
    part, some = postings.flat(lists.slice(1, 1))
    assert some.tolist() == [5] and len(part) == 5


def expected_across(docs):
    """Scores of whole texts by the definition: contexts run over the blanks between words."""
    lines = [(i, b" " + b"".join(w + b" " for w in "".join(c.lower() if c.isascii() else c for c in t or "").encode().split()) + b"\n") for i, t in docs]
    trie = defaultdict(Counter)
    for i, x in lines:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 10:
            for p in range(1, len(x)):
                for o in range(min(ppm.DEPTH, p) + 1):
                    trie[x[p - o : p]][x[p]] += 1

    def chance(context, symbol):
        log, out = 0.0, set()
        for k in range(len(context) + 1):
            left = {s: m for s, m in trie.get(context[k:], {}).items() if s not in out}
            if not left:
                continue
            total = sum(left.values()) + len(left)
            if symbol in left:
                return log + math.log10(left[symbol] / total)
            log += math.log10(len(left) / total)
            out |= set(left)
        return log - math.log10(max(ppm.SYMBOLS - len(out), 1))

    return [round(sum(chance(x[max(0, p - ppm.DEPTH) : p], x[p]) for p in range(1, len(x))), 5) for _, x in lines]


@pytest.mark.parametrize("sizes", [(1 << 24, 1 << 20), (200, 60)])
def test_contexts_run_over_words(spark, odd_docs, monkeypatch, sizes):
    monkeypatch.setattr(ppm, "TEXT_BLOCK", sizes[0])
    monkeypatch.setattr(ppm, "WORD_BLOCK", sizes[1])
    rng = np.random.default_rng(7)
    parts = ["the", "The", "a", "an", "I", "é", "zzz", "banana", "\x00", "🙂"]
    docs = [(i, " ".join("".join(rng.choice(parts, rng.integers(1, 3))) for _ in range(rng.integers(0, 25)))) for i in range(60)]
    docs += [(60, "a b c d e f"), (61, "f e d c b a"), (62, " ab  ab "), (63, ""), (64, None), (None, "the an")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    got = sorted((str(r["doc_id"]), round(r["score"], 5)) for r in ppm.score_texts(df, across=True).collect())
    assert got == sorted(zip((str(i) for i, _ in docs), expected_across(docs)))
    odd = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    got = sorted((str(r["doc_id"]), round(r["score"], 5)) for r in ppm.score_texts(odd_docs, across=True).collect())
    assert got == sorted(zip((str(i) for i, _ in odd), expected_across(odd)))


def test_the_query_scores_the_order_of_words(spark, tmp_path):
    words = "the quick brown fox jumps over a lazy dog and runs home again".split()
    docs = [(i, " ".join(words)) for i in range(1, 40)] + [(40, " ".join(reversed(words)))]
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    scores = {r["doc_id"]: r["score"] for r in QUERIES["op8_ppm_scores"](spark, str(tmp_path)).collect()}
    assert scores[40] < scores[1] - 1


@pytest.mark.parametrize("most", [0, 40])
def test_keys_that_go_to_every_task_are_those_that_travel(spark, monkeypatch, most):
    monkeypatch.setattr(ppm, "TEXT_BLOCK", 200)
    monkeypatch.setattr(ppm, "COMMON", most)
    docs = [(i, f"the an{'a' * (i % 7)} banana {i % 3} the end") for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    got = sorted((str(r["doc_id"]), round(r["score"], 5)) for r in ppm.score_texts(df, across=True).collect())
    assert got == sorted(zip((str(i) for i, _ in docs), expected_across(docs)))
