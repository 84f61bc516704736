"""Documents whose sets of word shingles are alike, by partitions of the universe of shingles.

Two sets of Jaccard similarity s or more differ in at most H elements, a number
that follows from their sizes. Sizes are cut into bands, and each band has a
scheme: hashing deals all shingles to segments, and segment i is matched on v_i,
where 1 asks for equal parts of the two sets and 2 for parts that differ in at
most one element (a part is also indexed under each of its one-deletion
neighbours). If the v_i add up to H + 1, two sets that differ in H elements
match in some segment: that is the pigeonhole. A little more than H + 1
(``spare``) means several matches, so that empty and single-element parts,
which many sets have, need not be indexed by sets that have few of them.

The cost of an allocation is its keys a set and the chance that a set must be
indexed under such weak parts; each band gets the cheapest. The smaller set of a
pair settles the band, the larger is indexed by the schemes of all bands that it
can meet.

Sets that share a key are candidates. Equal sets are one node before that. Links
are verified on the sets themselves, in two steps: first every set with the
least one of each of its keys, which joins nearly all; then, for keys whose sets
are still of different components, the others among themselves. Pairs that are
joined already are not compared, and no pair is made that does not share a key.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import arrow_schema, aside, beside, bounded_batches, ddl, map_rows, spent, staged, worker_store
from tidelog.llm.components import components

SHINGLE = 3
#: Jaccard similarity of linked sets, as a fraction.
SHARE = (90, 100)
#: What a set that is indexed under weak parts costs, in keys.
WEAK_COST = 100_000
#: Sets that are compared with one centre in one task, and shingles of a key's sets verified at a time.
CENTRE_SETS = 256
VERIFY_BLOCK = 1 << 20
#: Shingles up to which keys that hang together are verified as one group.
WHOLE_GROUP = 1 << 18
#: Words whose hashes a worker remembers.
WORDS_KEPT = 400_000

_GROWTH = 1.25
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes; fewer words are one shingle, none are none."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    known = worker_store("jaccard").setdefault("words", WordHashes())
    hashes = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
    width = min(size, len(words))
    n = len(words) - width + 1
    total = np.full(n, width, dtype=np.uint64)
    for i in range(width):
        total = mixed(total * _ODD[0] + hashes[i : i + n] * _ODD[1] + _ODD[2])
    return np.unique(total)


def linked(size: int | np.ndarray, other: int | np.ndarray, common: int | np.ndarray, share: tuple[int, int]):
    return common * share[1] >= share[0] * (size + other - common)


def largest_partner(size: int, share: tuple[int, int]) -> int:
    """The largest set that a set of ``size`` can be linked with."""
    return size * share[1] // share[0]


@dataclass(frozen=True)
class Scheme:
    """Sizes ``low`` to ``high`` of a band, v_i of its segments, and by how much they exceed the pigeonhole's need."""

    low: int
    high: int
    allowed: tuple[int, ...]
    spare: int

    def keys(self, own: np.ndarray) -> np.ndarray:
        """Keys of a set: two sets that the pigeonhole brings together have one in common."""
        allowed = np.array(self.allowed)
        mine = mixed(own + np.array([self.low], dtype=np.uint64) * _ODD[0])
        segment = (mine >> np.uint64(32)) * np.uint64(len(allowed)) >> np.uint64(32)
        segment = segment.astype(np.int64)
        order = np.argsort(segment, kind="stable")
        segment, element = segment[order], mixed(mine[order] + _ODD[1])
        sizes = np.bincount(segment, minlength=len(allowed))
        # A part's hash is the sum of its elements', so a deletion is a difference.
        ends = np.cumsum(sizes)
        running = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(element, dtype=np.uint64)])
        parts = running[ends] - running[ends - sizes]
        names = (np.arange(len(allowed), dtype=np.uint64) + np.uint64(self.low << 32)) * _ODD[2]
        exact = allowed == 1
        weak = exact & (sizes < 2)
        if weak.sum() <= self.spare:
            exact &= ~weak
        whole = exact | (allowed == 2)
        found = [mixed(parts[whole] + names[whole])]
        near = allowed[segment] == 2
        if near.any():
            found.append(mixed(parts[segment[near]] - element[near] + names[segment[near]]))
        return np.unique(np.concatenate(found))


def need(high: int, share: tuple[int, int]) -> int:
    """The most elements in which a set of at most ``high`` and a linked one that is not smaller differ."""
    # The larger one's size l: differing elements are at most (1 - s) / (1 + s) of the sum of sizes.
    return (share[1] - share[0]) * (high + largest_partner(high, share)) // (share[1] + share[0])


def bands(largest: int, share: tuple[int, int]) -> list[tuple[int, int]]:
    """Bands of sizes up to ``largest``; the first holds sets that are linked with equal ones only."""
    out, low = [], 1
    while low <= largest:
        high = max(low, int(low * _GROWTH) - 1)
        while low == 1 and need(high + 1, share) == 0:
            high += 1
        out.append((low, high))
        low = high + 1
    return out


def at_most(k: int, mean: float) -> float:
    """Chance of ``k`` or fewer of a Poisson number."""
    term = total = math.exp(-mean)
    for i in range(1, k + 1):
        term *= mean / i
        total += term
    return min(1.0, total)


def cost(low: int, high: int, ones: int, twos: int, spare: int) -> float:
    """Keys a set, and what weak parts cost, of ``ones`` segments with v = 1 and ``twos`` with v = 2."""
    n = ones + twos
    part = low / n
    weak = at_most(1, part) * ones if n > 1 else 0.0
    # A part of two elements has neighbours of one.
    weak_twos = at_most(2, part) * twos if n > 1 else 0.0
    keys = ones + twos * ((low + high) / 2 / n + 1)
    return keys + WEAK_COST * (1 - at_most(spare, weak) + weak_twos)


def cheapest(low: int, high: int, share: tuple[int, int]) -> Scheme:
    """The allocation of least cost for a band."""
    differ = need(high, share)
    if not differ:
        return Scheme(low, high, (1,), 0)
    options = []
    for spare in range(5 + differ // 10):
        total = differ + 1 + spare
        for twos in range(total // 2 + 1) if differ < 64 else (0,):
            options.append((cost(low, high, total - 2 * twos, twos, spare), spare, total - 2 * twos, twos))
    _, spare, ones, twos = min(options)
    return Scheme(low, high, (2,) * twos + (1,) * ones, spare)


class Schemes:
    """Schemes of all bands, made when a set of their sizes comes."""

    def __init__(self, share: tuple[int, int]):
        self.share, self.made = share, []
        for low, high in bands(1, share):
            self.made.append(cheapest(low, high, share))

    def of(self, size: int) -> list[Scheme]:
        """The schemes a set is indexed by: its own, and those of smaller sets that it can be linked with."""
        while self.made[-1].high < size:
            low = self.made[-1].high + 1
            self.made.append(cheapest(low, max(low, int(low * _GROWTH) - 1), self.share))
        return [s for s in self.made if s.low <= size and size <= largest_partner(s.high, self.share)]

    def keys(self, own: np.ndarray) -> np.ndarray:
        # Sets that only equal ones are linked with have no keys: equal sets are one node already.
        found = [s.keys(own) for s in self.of(len(own)) if need(s.high, self.share)]
        return np.unique(np.concatenate([np.zeros(0, dtype=np.uint64), *found]))


def with_keys(docs: DataFrame, share: tuple[int, int], shingle: int) -> DataFrame:
    """``docs`` with these in place of the text: set_, the digest of its shingles; n_shingles; keys_."""

    def start():
        own = Schemes(share)

        def step(texts):
            made = {"set_": [], "n_shingles": [], "keys_": []}
            for text in texts:
                s = shingles(text, shingle)
                made["set_"].append(xxhash.xxh3_128_digest(s.tobytes()))
                made["n_shingles"].append(len(s))
                made["keys_"].append(own.keys(s).tobytes())
            return made

        return step

    return map_rows(docs, ["text"], start, {"set_": "binary", "n_shingles": "long", "keys_": "binary"}, drop=("text",))


def key_rows(nodes: DataFrame) -> DataFrame:
    """key, node: one row a key of a node."""
    columns = {"key": "long", "node": "long"}
    schema = arrow_schema(columns)
    bounded_batches(nodes.sparkSession)

    def task(batches):
        for batch in batches:
            lists = [np.frombuffer(k, dtype=np.int64) for k in batch.column(0).to_pylist()]
            row = pa.array(np.repeat(np.arange(len(lists)), [len(k) for k in lists]))
            keys = pa.array(np.concatenate([np.zeros(0, dtype=np.int64), *lists]))
            yield pa.RecordBatch.from_arrays([keys, batch.column(1).take(row)], schema=schema)

    return nodes.select("keys_", "node").mapInArrow(task, ddl(columns))


def candidates(docs: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, text of the ``wanted`` nodes, staged; repeated rows of a document may repeat a node."""
    named = nodes.join(wanted, "node", "left_semi").select(
        "node", F.col("first_.key_id_").alias("asked_id_"), F.col("first_.key_hash_").alias("asked_hash_")
    )
    same = F.col("key_id_").eqNullSafe(F.col("asked_id_")) & (F.col("key_hash_") == F.col("asked_hash_"))
    texts = docs.select(F.col("doc_id").alias("key_id_"), F.xxhash64("text").alias("key_hash_"), "text")
    return staged(texts.join(named, same).select("node", "text"), "texts")


LINK = {"a": "long", "b": "long"}


def links_of(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([e[i] for e in found], pa.int64()) for i in (0, 1)], schema=arrow_schema(LINK))


def centre_links(tied: DataFrame, texts: DataFrame, share: tuple[int, int], shingle: int) -> DataFrame:
    """The pairs (a, b) of ``tied`` that are links.

    The sets of one centre ``b`` are dealt to groups of about ``CENTRE_SETS``,
    each with a copy of the centre; a task holds one centre's set at a time.
    """
    groups = tied.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / CENTRE_SETS).cast("int").alias("groups"))
    members = tied.join(groups, "b").select("b", F.pmod(F.xxhash64("a"), "groups").cast("int").alias("group"), F.col("a").alias("node"))
    centres = groups.select("b", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("group"), F.col("b").alias("node"))
    keys = ["b", "group"]
    rows = members.unionAll(centres).join(texts, "node").select(*keys, (F.col("node") != F.col("b")).alias("member"), "node", "text")
    rows = rows.repartition(*keys).sortWithinPartitions(*keys, "member", "node")
    bounded_batches(tied.sparkSession)

    def task(batches):
        key, centre = None, None
        for batch in batches:
            found = []
            for b, group, member, node, text in zip(*(c.to_pylist() for c in batch.columns)):
                if not member:
                    if key != (b, group):
                        key, centre = (b, group), shingles(text, shingle)
                    continue
                own = shingles(text, shingle)
                if linked(len(own), len(centre), min(len(own), len(centre)), share):
                    common = len(own) + len(centre) - len(np.union1d(own, centre))
                    if linked(len(own), len(centre), common, share):
                        found.append((node, b))
            yield links_of(found)

    return rows.mapInArrow(task, ddl(LINK)).distinct()


def verified(sets: list[np.ndarray], n_left: int, roots: list[int], share: tuple[int, int]) -> list[tuple[int, int]]:
    """Edges that join what links join among ``sets``, of which those with the same root are joined already.

    With a right side, those from ``n_left`` on, only pairs across the sides are
    compared.
    """
    across = n_left < len(sets)
    sizes = np.array([len(s) for s in sets])
    ends = np.cumsum(sizes)
    distinct, codes = np.unique(np.concatenate(sets), return_inverse=True)
    marked = np.zeros(len(distinct), dtype=bool)
    _, root = np.unique(np.array(roots), return_inverse=True)
    places, edges = np.arange(len(sets)), []
    for first in range(n_left if across else len(sets) - 1):
        behind = places[n_left:] if across else places[first + 1 :]
        near = behind[root[behind] != root[first]]
        near = near[linked(sizes[near], sizes[first], np.minimum(sizes[near], sizes[first]), share)]
        if not len(near):
            continue
        own = codes[ends[first] - sizes[first] : ends[first]]
        marked[own] = True
        for m in near.tolist():
            if root[m] == root[first]:
                continue
            common = int(np.count_nonzero(marked[codes[ends[m] - sizes[m] : ends[m]]]))
            if linked(sizes[m], sizes[first], common, share):
                root[root == root[m]] = root[first]
                edges.append((m, first))
        marked[own] = False
    return edges


def group_links(members: DataFrame, texts: DataFrame, share: tuple[int, int], shingle: int) -> DataFrame:
    """Edges (a, b) that join what links join among the sets of each key of ``members`` (key, blocks, node, root).

    A key of more than one block is verified block by block and pair of blocks.
    """
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    placed = members.withColumn("own", own).select(
        "key", "own", "node", "root", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    )
    keys = ["key", "low", "high"]
    rows = placed.join(texts, "node").select(
        "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), (F.col("own") > F.col("other")).alias("second"),
        "node", "root", "text",
    )
    rows = rows.repartition(*keys).sortWithinPartitions(*keys, "second", "node")
    bounded_batches(members.sparkSession)

    def task(batches):
        key, names, roots, sides = None, ([], []), ([], []), ([], [])

        def edges():
            left, right = sides
            if key is None or len(left) + len(right) < 2 or key[1] != key[2] and not (left and right):
                return links_of([])
            both = names[0] + names[1]
            return links_of([(both[i], both[j]) for i, j in verified(left + right, len(left), roots[0] + roots[1], share)])

        for batch in batches:
            for *place, second, node, root, text in zip(*(c.to_pylist() for c in batch.columns)):
                if place != key:
                    yield edges()
                    key, names, roots, sides = place, ([], []), ([], []), ([], [])
                # Repeated rows of a node follow each other.
                if names[second][-1:] != [node]:
                    names[second].append(node)
                    roots[second].append(root)
                    sides[second].append(shingles(text, shingle))
        yield edges()

    return rows.mapInArrow(task, ddl(LINK)).distinct()


def mixed_keys(shared: DataFrame, nodes: DataFrame, groups: DataFrame, block: int, whole: int = WHOLE_GROUP) -> DataFrame:
    """key, blocks, node, root of sets to be compared with each other: those of keys that are of several components yet.

    Every set has been compared with the least of its keys, so what is left is
    among the others. Keys that hang together by their sets are one group, in
    which each set is once, as long as that has ``whole`` shingles at most;
    beyond it every key is a group of its own, and keys of the same sets are one.
    """
    rows = shared.where("node > least").join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rows = rows.join(nodes.select("node", "n_"), "node").select("key", "node", "root", "n_")
    keys = rows.groupBy("key").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.ceil(F.sum("n_") / block).cast("int").alias("blocks"),
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("sum"), F.min("node").alias("first"),
    )
    alike = keys.where("low < high").groupBy("n", "sum", "first").agg(F.min("key").alias("key"), F.min("blocks").alias("blocks"))
    mixed = staged(rows.join(alike.select("key", "blocks", "first"), "key"), "mixed")
    together = components(staged(mixed.select(F.col("node").alias("a"), F.col("first").alias("b")).distinct(), "mixed-links"))
    together = staged(together.withColumnRenamed("root", "group"), "mixed-groups")
    sets = mixed.select("node", "root", "n_").distinct().join(together, "node")
    small = sets.groupBy("group").agg(F.sum("n_").alias("sum_n")).where(F.col("sum_n") <= whole).select("group")
    at_once = sets.join(small, "group").select(
        F.xxhash64(F.lit("group"), "group").alias("key"), F.lit(1).alias("blocks"), "node", "root"
    )
    large = mixed.join(together.join(small, "group", "left_anti").select("node"), "node", "left_semi")
    return at_once.unionByName(large.select("key", "blocks", "node", "root"))


def alike_documents(
    docs: DataFrame, share: tuple[int, int] = SHARE, shingle: int = SHINGLE, block: int = VERIFY_BLOCK, whole: int = WHOLE_GROUP
) -> DataFrame:
    """``docs`` less the text, with n_shingles and component_id.

    Two documents are linked when the Jaccard similarity of their sets of
    distinct ``shingle``-word shingles is ``share`` or more. ``component_id`` is
    the smallest doc_id reachable over links, the row's own included; null if
    no row of the group has one. Texts of fewer words are one shingle; null,
    empty and blank ones have none and are linked with nothing. Repeated rows
    fall into one group. Other columns pass; those named like a result are
    replaced. An empty table gives an empty one. No link is lost.
    """
    plain = aside(docs, "doc_id", "text", drop=("n_shingles", "component_id"))
    keyed = plain.withColumns({"key_id_": F.col("doc_id"), "key_hash_": F.xxhash64("text")})
    marked = staged(with_keys(keyed, share, shingle), "sets")
    nodes = marked.where("n_shingles > 0").groupBy("set_").agg(
        F.first("n_shingles").alias("n_"), F.first("keys_").alias("keys_"), F.min("key_id_").alias("first_id_"),
        F.min(F.struct("key_id_", "key_hash_")).alias("first_"),
    )
    nodes = staged(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    # A key's sets are tied to its least one; keys of one set go.
    keys = key_rows(nodes)
    least = keys.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least < most")
    shared = staged(keys.join(least.select("key", "least"), "key"), "keys")
    tied = staged(shared.where("node > least").select(F.col("node").alias("a"), F.col("least").alias("b")).distinct(), "tied")
    texts = candidates(docs, nodes, shared.select("node").distinct())
    links = staged(centre_links(tied, texts, share, shingle), "links")
    first = staged(components(links), "components")
    spent(tied)
    more = staged(group_links(staged(mixed_keys(shared, nodes, first, block, whole), "members"), texts, share, shingle), "links")
    spent(shared, texts)
    found = components(first.select(F.col("node").alias("a"), F.col("root").alias("b")).unionAll(more)) if more.limit(1).count() else first
    named = nodes.select("set_", "node", "first_id_").join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("first_id_").alias("component_id"))
    named = named.join(least, "root").select(F.col("set_").alias("named_set_"), "component_id")
    out = marked.join(named, marked["set_"] == named["named_set_"], "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("key_id_"))
    return beside(out.withColumn("component_id", own), "doc_id", "n_shingles", "component_id")
