import re
from collections import Counter

import numpy as np
import pytest

from tidelog.llm.collocations import BITMAP_BITS, HatTrie, _WORD_BITS, bitmap, collocations


def plain(docs, least=10, most=2000):
    f, n = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    found = {(g, p): a for (g, p), a in f.items() if len(p) > 1 and a >= least}
    rows = {}
    for (g, p), a in found.items():
        longer = [b for (h, q), b in found.items() if h == g and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
        if any(100 * b >= 50 * a for b in longer):
            continue
        cuts = [(1_000_000 * a * a // (f[g, p[:k]] * f[g, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        rows.setdefault(g, []).append((-score, -a, " ".join(p).encode(), f[g, p[:k]], f[g, p[k:]]))
    return sorted(
        (g, i + 1, p.decode(), -a, left, right, n[g], -s)
        for g, own in rows.items() for i, (s, a, p, left, right) in enumerate(sorted(own)[:most])
    )


def found(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(13)
    words = np.array(["the", "of", "Über", "rare", "x", "y", "z", "a.b", "new", "york", "city", "é", "\x1c", "s;t"])
    chance = 1 / np.arange(1, len(words) + 1)
    docs = []
    for i in range(200):
        w = rng.choice(words, int(rng.integers(0, 60)), p=chance / chance.sum()).tolist()
        w += ["new", "york", "city"] * int(rng.integers(0, 2))
        docs.append((rng.choice([" ", "  ", "\t"]).join(w), [None, "en", "de", ""][i % 4]))
    return docs + [("the of " * 500, "en"), (None, "en"), ("", None), (" . ,\n", "fr")]


@pytest.mark.parametrize("sizes", [{}, {"entries": 30, "burst": 4, "numbered": 64}, {"bits": 64}])
def test_phrases_are_those_of_plain_counting(spark, corpus, sizes):
    docs = spark.createDataFrame(corpus, "text string, lang string").repartition(5)
    assert found(collocations(docs, **{"bits": 1 << 20} | sizes)) == plain(corpus)


def test_limits_and_other_columns(spark, corpus):
    docs = spark.createDataFrame([(*d, 1, "p") for d in corpus], "text string, lang string, a int, phrase string")
    assert found(collocations(docs, least=3, most=5, bits=1 << 20)) == plain(corpus, 3, 5)


def test_trie_bursts_and_spills_whole_subtrees():
    trie, rng = HatTrie(3, burst=8), np.random.default_rng(1)
    ids = rng.integers(1, 9, (4000, 3))
    packed = ids[:, 0] << 2 * _WORD_BITS | ids[:, 1] << _WORD_BITS | ids[:, 2]
    for at in range(0, 4000, 500):
        trie.add(packed[at : at + 500])
    assert trie.burst_into == set(trie.children)
    assert trie.entries == len(np.unique(packed))
    before = dict(trie.sizes)
    out = {first: dict(rest) for first, rest in trie.spill(trie.entries // 2)}
    assert 0 < len(out) < 8 and all(len(rest) == before[first] for first, rest in out.items())
    for first, rest in trie.spill(0):
        assert first not in out
        out[first] = dict(rest)
    want = Counter(packed.tolist())
    assert {first << 2 * _WORD_BITS | k: n for first, rest in out.items() for k, n in rest.items()} == want
    assert trie.entries == 0 and not trie.children


def test_bitmap_holds_all_it_is_told(spark):
    rows = [("en", f"a{i} b{i % 7}") for i in range(500)]
    made = bitmap(spark.createDataFrame(rows, "lang string, phrase string"), 2, 1 << 16)
    assert made.nbytes == 1 << 13 and 300 < int(np.unpackbits(made).sum()) <= 500
    assert BITMAP_BITS // 8 == 16 << 20


def test_odd_rows_and_empty_tables(spark, odd_docs, no_docs):
    docs = [(r.text, r.lang) for r in odd_docs.collect()]
    assert found(collocations(odd_docs, least=1)) == plain(docs, 1)
    assert collocations(no_docs).count() == 0
