import math
from collections import Counter

import numpy as np
import pytest

from tidelog.llm import ranked_search
from tidelog.llm.ranked_search import Best, Block, best_documents, blocks_of, pair_lists, search, terms


def plain(docs, items, k):
    """Every document scored for every item."""
    counts = [(d, Counter(terms(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in set(items):
        rows = []
        for doc, c in counts:
            m = 50 + 50 * sum(c.values()) * n // total
            score = 0
            for t in set(terms(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m))
            if score > 0:
                rows.append((-score, doc is None, doc or 0))
        out += [(item, i + 1, None if none else d, -s) for i, (s, none, d) in enumerate(sorted(rows)[:k])]
    return sorted(out, key=str)


def found(df):
    return sorted([(r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()], key=str)


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(11)
    words = np.array([f"w{i}" for i in range(60)])
    chance = 1 / np.arange(1, 61)
    docs = [(i, " ".join(rng.choice(words, rng.integers(1, 60), p=chance / chance.sum()))) for i in range(300)]
    docs += [(1000 + i, docs[7][1]) for i in range(40)]
    items = [(i, " ".join(rng.choice(words, rng.integers(1, 12)))) for i in range(25)] + [(25, "w1 nowhere W1, w2"), (26, None), (27, "...")]
    return docs, items


@pytest.mark.parametrize("k,most_docs,query_terms", [(50, 4096, 200_000), (5, 16, 200_000), (3, 7, 40), (1, 1, 10)])
def test_best_documents_are_those_of_full_scoring(spark, corpus, k, most_docs, query_terms):
    docs, items = corpus
    got = best_documents(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
        spark.createDataFrame(items, "item_id long, text string"), k=k, query_terms=query_terms, most_docs=most_docs,
    )
    assert found(got) == plain(docs, items, k)


def test_skipping_looks_at_less_and_finds_the_same(corpus):
    docs, items = corpus
    wanted = {t: i for i, t in enumerate(sorted({t for _, x in items for t in terms(x)}))}
    batch = ranked_search.pa.RecordBatch.from_pydict({"doc_id": [d for d, _ in docs], "text": [t for _, t in docs]})
    rows = list(blocks_of([batch], wanted, 64, 1 << 20))
    weights = np.array([10 + 97 * i % 1000 for i in range(len(wanted))])
    looked = {True: 0, False: 0}
    for _, text in items:
        own = [wanted[t] for t in sorted(set(terms(text)))]
        order = sorted(own, key=lambda t: (weights[t], t))
        pairs = [(min(p), max(p)) for p in zip(order[::2], order[1::2])]
        results = []
        for paired in (True, False):
            best = Best(5)
            for row in rows:
                block = Block(row)
                lists = block.weighed(weights, len(docs), 5000)
                made = pair_lists(lists, pairs)
                most = {pairs[p]: int(np.frombuffer(made["pair_impacts"], dtype=np.int64)[[0, *made["pair_ends"]][i]]) for i, p in enumerate(made["pairs"])}
                joint = {p: most.get(p, 0) for p in pairs} if paired else {}
                looked[paired] += search(block, lists, joint, own, best)
            results.append(best.rows)
        assert results[0] == results[1]
    everything = sum(len(lists) for row in rows for lists in [Block(row).places]) * len(items)
    assert looked[True] < looked[False] < everything


def test_odd_rows_and_empty_tables(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "the old River; token x", "a"), (1, "the old River; token x", "a"), (2, None, "b"), (None, "text", "c")], "item_id long, text string, score string")
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    asked = [(1, "the old River; token x"), (None, "text")]
    assert found(best_documents(odd_docs, items)) == plain(docs, asked, 50)
    assert best_documents(no_docs, items).count() == 0
    assert best_documents(odd_docs, items.limit(0)).count() == 0
    assert best_documents(odd_docs, items).columns == ["item_id", "rank", "doc_id", "score"]
