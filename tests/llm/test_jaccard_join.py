import numpy as np
import pytest

from tests.llm.test_simhash import joined
from tidelog.llm.jaccard_join import Scheme, alike_documents, bands, cheapest, linked, need, shingles, verified


def plain_sets(texts):
    out = []
    for t in texts:
        w = "".join(c.lower() if c.isascii() else c for c in t or "").encode().split()
        out.append({b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))} if w else set())
    return out


def plain_components(docs, share=(90, 100)):
    sets = plain_sets([t for _, t in docs])
    edges = []
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and share[1] * len(a & b) >= share[0] * len(a | b):
                edges.append((i, j))
    roots = joined(len(docs), edges)
    ids = {}
    for (d, _), r in zip(docs, roots):
        if d is not None and (r not in ids or d < ids[r]):
            ids[r] = d
    return sorted(((d, len(s), (ids.get(r) if s else d)) for (d, _), r, s in zip(docs, roots, sets)), key=str)


def found(df):
    return sorted([(r.doc_id, r.n_shingles, r.component_id) for r in df.select("doc_id", "n_shingles", "component_id").collect()], key=str)


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(12)
    words = [f"w{i}" for i in range(400)]
    docs = []
    for size in (1, 2, 3, 5, 9, 11, 14, 20, 30, 60, 200, 500):
        for _ in range(4):
            base = list(rng.choice(words, size))
            for copy in range(6):
                text = list(base)
                for _ in range(int(rng.integers(0, 1 + size // 50 + copy))):
                    at = int(rng.integers(0, len(text) + 1))
                    text[at : at + int(rng.integers(0, 2))] = rng.choice(words, int(rng.integers(0, 2))).tolist()
                docs.append((len(docs), " ".join(text)))
    # Short texts of very few words, which share nearly all parts by chance.
    docs += [(len(docs) + i, " ".join(rng.choice(words[:2], int(rng.integers(9, 16))))) for i in range(80)]
    return docs


def test_components_are_those_of_all_pairs(spark, corpus):
    got = found(alike_documents(spark.createDataFrame(corpus, "doc_id long, text string").repartition(4)))
    assert got == plain_components(corpus)


def test_groups_larger_than_a_block_lose_no_link(spark, corpus):
    got = found(alike_documents(spark.createDataFrame(corpus, "doc_id long, text string").repartition(4), block=60, whole=50))
    assert got == plain_components(corpus)


@pytest.mark.parametrize("allowed,spare", [((1,) * 9, 2), ((2, 2, 2, 1), 0), ((2, 0, 2, 2, 2, 1), 2), ((1, 1, 2, 1, 2), 0)])
def test_pigeonhole(allowed, spare):
    """Sets that differ in as many elements as a scheme allows for have a key in common."""
    rng = np.random.default_rng(3)
    differ = sum(allowed) - 1 - spare
    scheme = Scheme(10, 70, allowed, spare)
    for _ in range(400):
        own = np.unique(rng.integers(0, 1 << 62, int(rng.integers(8, 70))).astype(np.uint64))
        gone = int(rng.integers(0, differ + 1))
        other = np.concatenate([np.delete(own, rng.choice(len(own), gone, replace=False)), rng.integers(0, 1 << 62, differ - gone).astype(np.uint64)])
        assert np.intersect1d(scheme.keys(own), scheme.keys(np.unique(other))).size


def test_bands_cover_all_sizes_and_needs_are_exact():
    cut = bands(5000, (90, 100))
    assert cut[0][0] == 1 and all(a[1] + 1 == b[0] for a, b in zip(cut, cut[1:])) and cut[-1][1] >= 5000
    for low, high in cut[:6]:
        most = max(
            n + m - 2 * c
            for n in range(1, high + 1) for m in range(n, n * 100 // 90 + 1) for c in range(n + 1) if linked(n, m, c, (90, 100))
        )
        assert need(high, (90, 100)) == most


def test_allocation_covers_the_need_at_the_least_cost():
    for low, high in bands(3000, (90, 100))[1:]:
        scheme = cheapest(low, high, (90, 100))
        assert sum(scheme.allowed) == need(high, (90, 100)) + 1 + scheme.spare
    # Small sets have parts of too few elements: they are matched on deletions.
    assert cheapest(9, 11, (90, 100)).allowed == (2,)
    assert set(cheapest(400, 499, (90, 100)).allowed) == {1} and cheapest(400, 499, (90, 100)).spare > 0


def test_verified_compares_across_sides_only():
    sets = [np.arange(20, dtype=np.uint64), np.arange(21, dtype=np.uint64), np.arange(1, 21, dtype=np.uint64)]
    assert len(verified(sets, 3, [1, 2, 3], (90, 100))) == 2
    assert {tuple(sorted(e)) for e in verified(sets, 2, [1, 2, 3], (90, 100))} == {(0, 2), (1, 2)}
    assert verified(sets, 3, [1, 1, 1], (90, 100)) == []


def test_odd_rows(spark, odd_docs, no_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    named = odd_docs.withColumnRenamed("score", "keys_").withColumnRenamed("items", "set_").withColumnRenamed("kinds", "node")
    got = alike_documents(named)
    assert found(got) == plain_components(docs)
    kept = [c for c in named.columns if c not in ("doc_id", "text")]
    assert got.columns == ["doc_id", "n_shingles", "component_id", *kept]
    assert got.select("keys_", "set_", "node").distinct().collect() == [("s", "i", 7)]
    assert alike_documents(no_docs).count() == 0
    assert len(shingles("a b")) == 1 and len(shingles(" \n")) == 0
