import numpy as np
import pytest
import xxhash

from tidelog.llm.bitmaps import bitmap, holds
from tidelog.llm.components import components, large_star, small_star
from tidelog.llm.simhash import (
    ALIKE,
    CLOSE,
    BKTree,
    Scheme,
    alike,
    apart,
    as_words,
    fingerprint,
    forest,
    keep_one,
    likely_forest,
    likely_groups,
    near_duplicates,
    rare_first,
    repeated_rare,
    set_fingerprint,
    shingle_set,
    sketch,
)


def plain_fingerprint(text, size=4):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(values, radius):
    """Least place reachable, by comparing all with all."""
    root = np.arange(len(values))
    near = apart(values, values) <= radius
    while True:
        new = np.array([root[row].min() for row in near])
        if (new == root).all():
            return root
        root = new


def joined(n, edges):
    root = list(range(n))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return np.array([top(i) for i in range(n)])


@pytest.fixture(scope="module")
def clusters():
    rng = np.random.default_rng(2)
    values = np.repeat(rng.integers(0, 1 << 63, (12, 1), dtype=np.uint64), 40, axis=0)
    for row in values:
        for bit in rng.choice(64, rng.integers(0, 9), replace=False):
            row[0] ^= np.uint64(1 << int(bit))
    values = np.unique(values, axis=0)
    rng.shuffle(values)
    return values


def test_fingerprints():
    for text in (None, "", " \n", "one", "A b C", "a b c d", "a b c d e a b c d e f g É é", "x " * 50):
        assert int.from_bytes(fingerprint(text), "big") == plain_fingerprint(text)
    assert fingerprint("a b c d e f", bits=256)[:8] == fingerprint("a b c d e f")


def test_tree_finds_all(clusters):
    tree = BKTree(clusters, np.arange(len(clusters)))
    found = {(int(p), int(q)) for p, which in tree.within(clusters, np.arange(len(clusters)), 4) for q in which}
    assert found == {tuple(x) for x in np.argwhere(apart(clusters, clusters) <= 4).tolist()}


def test_forest_joins_what_links_join(clusters):
    n, half = len(clusters), len(clusters) // 2
    assert (joined(n, forest(clusters, None, 4)) == groups(clusters, 4)).all()
    parts = forest(clusters[:half], None, 4) + forest(clusters[:half], clusters[half:], 4)
    parts += [(a + half, b + half) for a, b in forest(clusters[half:], None, 4)]
    assert (joined(n, parts) == groups(clusters, 4)).all()


@pytest.mark.parametrize("tree", [4096, 7])
def test_groups_equal_brute_force(spark, tree):
    rng = np.random.default_rng(4)
    texts = []
    for i in range(25):
        words = [f"w{k}" for k in rng.integers(0, 400, 120)]
        for _ in range(6):
            copy = list(words)
            for at in rng.integers(0, 120, rng.integers(0, 3)):
                copy[at] = "Q"
            texts.append(" ".join(copy))
    docs = [(int(i), t) for i, t in zip(rng.permutation(len(texts)), texts)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    got = {r["doc_id"]: r for r in near_duplicates(df, tree=tree).collect()}
    docs.sort()
    prints = [plain_fingerprint(t) for _, t in docs]
    assert [got[i]["fingerprint"] for i, _ in docs] == [f"{p:016x}" for p in prints]
    root = groups(np.array(prints, dtype=np.uint64)[:, None], 4)
    assert [got[i]["component_id"] for i, _ in docs] == [docs[r][0] for r in root]


def test_shards_of_alike_fingerprints_meet():
    rng = np.random.default_rng(1)
    left = rng.integers(0, 1 << 63, (400, 4), dtype=np.uint64)
    bits = np.unpackbits(left.view(np.uint8), axis=1)
    for row in bits:
        row[rng.choice(256, 39, replace=False)] ^= 1
    right = np.packbits(bits, axis=1).view(np.uint64)
    assert (apart(left, right).diagonal() <= ALIKE.radius).all()
    assert (ALIKE.shards(left) == ALIKE.shards(right)).any(axis=1).mean() > 0.97
    assert (CLOSE.shards(left[:, :1]).shape[1], Scheme(radius=2).shards(left[:, :1]).shape[1]) == (15, 6)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count() and "text" not in rows[0] and rows[0]["value"] == "v" and rows[0]["root"] == "r"
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[2]["component_id"] == by_id[3]["component_id"] == by_id[4]["component_id"] == 2
    assert by_id[2]["fingerprint"] == "0" * 16 and by_id[8]["component_id"] == 1
    assert sorted((r["component_id"] is None, r["fingerprint"] == "0" * 16) for r in rows if r["doc_id"] is None) == [
        (False, True),
        (True, False),
    ]
    kept = keep_one(odd_docs).collect()
    assert kept[0].asDict().keys() == set(odd_docs.columns)
    assert sorted(str(r["doc_id"]) for r in kept) == ["1", "2", "5", "6", "7", "9", "9", "None"]
    assert near_duplicates(no_docs).count() == keep_one(no_docs).count() == 0


def test_equal_rows_alone_become_one(spark):
    df = spark.createDataFrame([(5, "a b c d e f g h")] * 4 + [(6, "other words here")], "doc_id bigint, text string")
    assert sorted(r["doc_id"] for r in keep_one(df).collect()) == [5, 6]


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 200)] + [(300, 301), (302, 301), (400, 400), (7, None), (301, 300)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(201)} | {300: 300, 301: 300, 302: 300, 400: 400}


def test_words_of_bytes():
    assert as_words([b"\x00" * 7 + b"\x01", b"\xff" * 8]).tolist() == [[1], [(1 << 64) - 1]]


def plain_set(text, size):
    split = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    return {b" ".join(split[i : i + size]) for i in range(max(1, len(split) - size + 1))} if split else set()


def kept_by_brute_force(docs, size=5):
    """Least id of each group of texts with an exact Jaccard similarity of 0.8."""
    docs = sorted(docs)
    sets = [plain_set(t, size) for _, t in docs]
    n = range(len(docs))
    edges = [(i, j) for i in n for j in n if i < j and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    return sorted(docs[r][0] for r in set(joined(len(docs), edges).tolist()))


def made_copies():
    """Copies of texts from hardly to much changed, and unrelated texts that repeat the same line."""
    rng = np.random.default_rng(5)
    texts = []
    for _ in range(12):
        split = [f"w{k}" for k in rng.integers(0, 5000, 200)]
        for changed in (0, 1, 2, 4, 5, 6, 8, 10):
            copy = list(split)
            for at in rng.choice(200, changed, replace=False):
                copy[at] = f"q{rng.integers(0, 10**6)}"
            texts.append(" ".join(copy))
    line = " one line that is here often" * 20
    texts += [" ".join(f"w{k}" for k in rng.integers(0, 5000, 200)) + line for _ in range(6)]
    return [(int(i), t) for i, t in zip(rng.permutation(len(texts)), texts)]


@pytest.mark.parametrize("block", [1 << 18, 900])
def test_only_texts_alike_by_their_sets_go(spark, block):
    docs = made_copies()
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    assert sorted(r["doc_id"] for r in keep_one(df, shingle=5, block=block).collect()) == kept_by_brute_force(docs)


def test_alike_texts_that_fingerprints_miss_go(spark):
    """Repeated lines, short texts at the limit, and fingerprints that link nothing."""
    rng = np.random.default_rng(7)
    long = [" ".join(f"w{k}" for k in rng.integers(0, 5000, 200)) for _ in range(8)]
    short = [" ".join(f"w{k}" for k in rng.integers(0, 5000, 9)) for _ in range(8)]
    texts = long + [t + " six words that are not new" * times for t, times in zip(long, (20, 40, 60, 80, 100, 130, 160, 200))]
    texts += short + [t + " more" for t in short]
    docs = list(enumerate(texts))
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    want = kept_by_brute_force(docs)
    assert want == [*range(8), *range(16, 24)]
    assert sorted(r["doc_id"] for r in keep_one(df, shingle=5).collect()) == want
    none = Scheme(bits=256, radius=0, choices=1, chosen=14)
    assert sorted(r["doc_id"] for r in keep_one(df, scheme=none, shingle=5).collect()) == want


def test_sets_vote_once_a_shingle():
    text = " ".join(f"w{i}" for i in range(200))
    a, b = (set_fingerprint(shingle_set(t, 5), 256) for t in (text, text + " six words that are not new" * 200))
    assert apart(as_words([a]), as_words([b]))[0, 0] <= ALIKE.radius


def test_rarest_of_alike_sets_meet():
    rng = np.random.default_rng(8)
    for n in (1, 4, 5, 9, 10, 100):
        for _ in range(50):
            every = np.unique(rng.integers(0, 1 << 62, n, dtype=np.uint64))
            common = np.sort(rng.choice(every, len(every) // 2, replace=False))
            counts = rng.integers(3, 9, len(common))
            part = np.sort(rng.choice(every, -(-4 * len(every) // 5), replace=False))
            assert set(rare_first(every, common, counts, (4, 5))) & set(rare_first(part, common, counts, (4, 5)))


@pytest.mark.parametrize("entries", [3, 1 << 20])
def test_repeated_rare_hashes_are_those_of_several_sets(spark, entries):
    rng, rows = np.random.default_rng(8), []
    for i in range(60):
        own = np.unique(rng.integers(-40, 40, int(rng.integers(0, 9))) * 10**17)
        # Every third set comes several times.
        rows += [(own.astype(np.int64).tobytes(), i.to_bytes(16, "little"))] * (1 + 3 * (i % 3 == 0))
    got = repeated_rare(spark.createDataFrame(rows, "rare_ binary, set_ binary").repartition(5), entries)
    owners = {}
    for rare, own in rows:
        for h in np.frombuffer(rare, dtype=np.int64).tolist():
            owners.setdefault(h, set()).add(own)
    assert sorted(r.hash for r in got.collect()) == sorted(h for h, o in owners.items() if len(o) > 1)


def test_bitmap_misses_none(spark):
    hashes = np.random.default_rng(9).integers(-(1 << 63), 1 << 63, 400)
    bits = bitmap(spark.createDataFrame([(int(h),) for h in hashes], "h long"), "h", 1 << 14)
    assert holds(bits, hashes).all() and len(bits) == 1 << 11
    assert holds(bits, np.arange(10_000)).mean() < 0.05


def test_sketches_leave_no_alike_sets_apart():
    rng = np.random.default_rng(3)
    share, sets = (4, 5), []
    for n in [1, 2, 5, 60, 64, 65, 128, 129, 300, 1000, 1030]:
        base = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        for lost in (0, n // 20, n // 10, n // 9, n // 5, n // 2):
            sets.append(np.unique(np.append(base[lost:], rng.integers(0, 1 << 63, lost, dtype=np.uint64))))
            sets.append(np.unique(base[lost:]) if lost < n else np.unique(base))
    order = rng.permutation(len(sets))
    sets = [sets[i] for i in order]
    sizes, marks = np.array([len(s) for s in sets]), rng.integers(0, 40, len(sets))
    for second in (None, rng.integers(0, 2, len(sets)).astype(bool)):
        root = joined(len(sets), likely_forest(sizes, [sketch(s) for s in sets], marks, second, share))
        for a in range(len(sets)):
            for b in range(a):
                meet = marks[a] != marks[b] and (second is None or second[a] != second[b])
                if meet and alike(sizes[a], sizes[b], len(np.intersect1d(sets[a], sets[b])), share):
                    assert root[a] == root[b]
    # Unrelated sets are ruled out.
    others = [np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for n in rng.integers(200, 2000, 60)]
    sizes = np.array([len(s) for s in others])
    assert likely_forest(sizes, [sketch(s) for s in others], np.arange(60), None, share) == []


@pytest.mark.parametrize("blocks", [1, 3])
def test_only_sets_that_may_be_alike_send_their_texts(spark, blocks):
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 1 << 63, 400, dtype=np.uint64)) for _ in range(30)]
    # Two that differ in few hashes; one more of the same mark as an alike one.
    sets += [sets[0][5:], sets[1][7:]]
    marks = [*range(31), 1]
    rows = [(b"g", blocks, bytes([i]), len(s), m, sketch(s), i) for i, (s, m) in enumerate(zip(sets, marks))]
    members = spark.createDataFrame(rows, "group_ binary, blocks_ int, set_ binary, n_ long, mark_ long, sketch_ binary, first_ long")
    found = likely_groups(members, members, 1 << 20, (4, 5)).collect()
    assert sorted(bytes(r["set_"])[0] for r in found) == [0, 30]
    assert len({bytes(r["group_"]) for r in found}) == 1


def test_groups_are_found_without_broadcasts(spark):
    """Sides that are small enough to broadcast, round after round, fill the driver."""
    edges = spark.createDataFrame([(1, 2), (2, 3)], "u bigint, v bigint")
    for star in (large_star(edges), small_star(edges)):
        plan = star._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
