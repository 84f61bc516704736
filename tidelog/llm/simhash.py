"""SimHash near duplicates, found with BK-trees.

A text's fingerprint has a bit set where over half the hashes of its word
shingles have it. Two fingerprints are linked when they differ in few bits, and
linked fingerprints form a group.

Distinct fingerprints are dealt to shards, and each shard is a BK-tree whose
children hang by their distance to the parent; a search follows only edges
within the radius. How they are dealt is a ``Scheme``. For few differing bits
the bits are cut into ``radius + 2`` blocks, of which two linked fingerprints
share two at least, and a shard is a pair of blocks with its values: no link is
lost. For many, wide fingerprints are used, and shards are chosen bits with
their values, in as many choices as find a link of the radius's similarity
almost surely.

A shard of many fingerprints is several trees of bounded size, and each pair of
those is searched by itself. A task gives back one edge for each fingerprint
that joins a group, not one for each pair.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.bitmaps import bitmap, holds
from tidelog.llm.common import arrow_schema, bounded_batches, ddl, map_rows, spent, staged
from tidelog.llm.components import components

SHINGLE = 4
SEED = 42

#: Fingerprints of one tree, and of one leaf, which is compared as a whole.
TREE = 4096
LEAF = 64

#: Texts are near duplicates when they share 4 of 5 of their distinct shingles; shingles of the sets in one block.
SHARE = (4, 5)
SET_BLOCK = 1 << 20
#: Sampled texts and shingles kept of them to order shingles by how frequent they are; results do not depend on it.
ORDER_TEXTS = 5_000
ORDER_SHINGLES = 50_000
#: Hashes that one list of the search for repeated ones holds.
PART_ENTRIES = 1 << 20

_HASHES = 4096
_WORD = 64


@dataclass(frozen=True)
class Scheme:
    """Width of fingerprints, bits by which linked ones may differ, and how shards are dealt.

    ``choices`` of ``chosen`` bits each make the shards; without choices they
    are pairs of blocks.
    """

    bits: int = 64
    radius: int = 4
    choices: int = 0
    chosen: int = 0

    def shards(self, values: np.ndarray) -> np.ndarray:
        """Shard numbers of each row of ``values`` (64-bit words), one column for each way of dealing."""
        bits = np.unpackbits(values.astype(">u8").view(np.uint8), axis=1)
        if self.choices:
            order = np.random.default_rng(SEED)
            groups = [order.choice(self.bits, self.chosen, replace=False) for _ in range(self.choices)]
        else:
            blocks = np.array_split(np.arange(self.bits), self.radius + 2)
            groups = [np.concatenate(pair) for pair in itertools.combinations(blocks, 2)]
        columns = [bits[:, g].astype(np.int64) @ (1 << np.arange(len(g))) for g in groups]
        return np.column_stack(columns) + (np.arange(len(groups)) << 40)


#: Links of the fingerprints themselves: at most 4 of 64 bits, none lost.
CLOSE = Scheme()
#: Texts that share 0.8 of their shingles differ in 39 of 256 bits, give or take 6.
ALIKE = Scheme(bits=256, radius=52, choices=48, chosen=14)


def words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z made small; null has none."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def widened(hashes: np.ndarray, width: int) -> np.ndarray:
    """Each hash followed by further words that are mixed from it."""
    out = [hashes]
    for i in range(1, width):
        x = hashes + np.uint64(i * 0x9E3779B97F4A7C15 % (1 << 64))
        x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        out.append(x ^ x >> np.uint64(31))
    return np.stack(out, axis=1)


def shingle_hashes(text: str | None, shingle: int) -> Iterator[np.ndarray]:
    """XXH64 of each shingle of the text in turn, some at a time; fewer words than a shingle's are one."""
    split = words(text)
    if not split:
        return
    joined = b" ".join(split)
    ends = np.cumsum([len(w) + 1 for w in split])
    n = max(1, len(split) - shingle + 1)
    firsts = [0, *ends[: n - 1].tolist()]
    lasts = (ends[-n:] - 1).tolist()
    for at in range(0, n, _HASHES):
        places = zip(firsts[at : at + _HASHES], lasts[at : at + _HASHES])
        yield np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in places], dtype=np.uint64)


def majority(some: Iterable[np.ndarray], bits: int) -> bytes:
    """Bits set in over half the hashes (widened); of no hashes, zero."""
    ones, n = np.zeros(bits, dtype=np.int64), 0
    for hashes in some:
        wide = widened(hashes, bits // _WORD).astype(">u8").view(np.uint8).reshape(len(hashes), -1)
        ones += np.unpackbits(wide, axis=1).sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return np.packbits(2 * ones > n).tobytes()


def fingerprint(text: str | None, shingle: int = SHINGLE, bits: int = 64) -> bytes:
    """Majority of the bits of all shingles' hashes, repeats included; of no words, zero."""
    return majority(shingle_hashes(text, shingle), bits)


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """The distinct hashes of the text's shingles, sorted; of no words, none."""
    return np.unique(np.concatenate([np.zeros(0, dtype=np.uint64), *shingle_hashes(text, shingle)]))


def set_fingerprint(own: np.ndarray, bits: int) -> bytes:
    """Majority of the bits of a set of hashes, each with one vote."""
    return majority((own[at : at + _HASHES] for at in range(0, len(own), _HASHES)), bits)


def rare_first(own: np.ndarray, common: np.ndarray, counts: np.ndarray, share: tuple[int, int]) -> np.ndarray:
    """The first hashes of a set, those not in ``common`` (sorted) before the others by their ``counts``.

    So many that of two sets of Jaccard similarity ``share`` or more, whose
    common elements are at least that share of each, one is first in both. That
    holds for any order that is the same for all sets; this one makes it rare.
    """
    n = len(own) - -(-share[0] * len(own) // share[1]) + 1 if len(own) else 0
    known = np.zeros(len(own), dtype=np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, own), len(common) - 1)
        known = np.where(common[at] == own, counts[at], 0)
    return own[np.lexsort((own, known))[:n]]


def sketch(own: np.ndarray) -> bytes:
    """A bit for each of a power of two places, as many as the set has hashes or more: whether an odd number falls there.

    Of two sets no more bits differ than hashes, also where the halves of the
    longer sketch are laid over each other.
    """
    places = 1 << max(6, (len(own) - 1).bit_length())
    at = (own & np.uint64(places - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=places) & 1).astype(np.uint8)).tobytes()


def with_fingerprint(docs: DataFrame, shingle: int, bits: int, name: str) -> DataFrame:
    """``docs`` with the fingerprint's bytes in place of the text."""

    def start():
        return lambda texts: {name: [fingerprint(t, shingle, bits) for t in texts]}

    return map_rows(docs, ["text"], start, {name: "binary"}, drop=("text",))


def common_shingles(docs: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, sorted, and counts of shingles that are frequent in a sample; only an order depends on it."""
    every = max(1, docs.count() // ORDER_TEXTS)
    some = docs.where(F.pmod(F.xxhash64("text"), F.lit(every)) == 0).select("text")
    columns = {"hash": "long"}
    bounded_batches(docs.sparkSession)

    def task(batches):
        for batch in batches:
            for text in batch.column(0).to_pylist():
                own = shingle_set(text, shingle).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(own)], schema=arrow_schema(columns))

    counted = some.mapInArrow(task, ddl(columns)).groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 2")
    found = counted.orderBy(F.desc("n"), "hash").limit(ORDER_SHINGLES).toArrow()
    hashes = np.asarray(found.column(0).to_numpy()).astype(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], np.asarray(found.column(1).to_numpy()).astype(np.int64)[order]


def with_sets(docs: DataFrame, shingle: int, bits: int, share: tuple[int, int]) -> DataFrame:
    """``docs`` with these in place of the text: value_, the fingerprint of the set of shingles; set_, its digest;
    n_, its size; sketch_, its ``sketch``; rare_, the hashes that sets alike to it have one of."""
    shared = docs.sparkSession.sparkContext.broadcast(common_shingles(docs, shingle))

    def start():
        common, counts = shared.value

        def step(texts):
            made = {"value_": [], "set_": [], "n_": [], "sketch_": [], "rare_": []}
            for text in texts:
                own = shingle_set(text, shingle)
                made["value_"].append(set_fingerprint(own, bits))
                made["set_"].append(xxhash.xxh3_128_digest(own.tobytes()))
                made["n_"].append(len(own))
                made["sketch_"].append(sketch(own))
                made["rare_"].append(rare_first(own, common, counts, share).tobytes())
            return made

        return step

    columns = {"value_": "binary", "set_": "binary", "n_": "long", "sketch_": "binary", "rare_": "binary"}
    return map_rows(docs, ["text"], start, columns, drop=("text",))


def apart(values: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Differing bits of each value and each other one."""
    total = np.zeros((len(values), len(others)), dtype=np.int16)
    for w in range(values.shape[1]):
        total += np.bitwise_count(values[:, w, None] ^ others[None, :, w])
    return total


class BKTree:
    """Children of a node by their distance to it; branches of few fingerprints are leaves."""

    def __init__(self, values: np.ndarray, places: np.ndarray):
        self.values, self.places, self.children = values, places, {}
        if len(values) > LEAF:
            distance = apart(values[:1], values[1:])[0]
            self.values, self.places = values[:1], places[:1]
            for d in np.unique(distance):
                under = np.flatnonzero(distance == d) + 1
                # Equal ones never come twice, so a branch of distance 0 is empty.
                self.children[int(d)] = BKTree(values[under], places[under])

    def within(self, asked: np.ndarray, which: np.ndarray, radius: int):
        """Places in the tree and numbers of those asked that are within ``radius``, leaf by leaf."""
        if not len(which):
            return
        distance = apart(self.values, asked[which])
        near = distance <= radius
        if near.any():
            for place, row in zip(self.places, near):
                if row.any():
                    yield place, which[row]
        for d, child in self.children.items():
            yield from child.within(asked, which[np.abs(distance[0] - d) <= radius], radius)


def forest(left: np.ndarray, right: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """Edges that join what links inside ``left``, or between ``left`` and ``right``, join; numbers run on into right."""
    asked = left if right is None else right
    shift = 0 if right is None else len(left)
    root = np.arange(len(left) + (0 if right is None else len(right)))
    tree = BKTree(left, np.arange(len(left)))
    for place, found in tree.within(asked, np.arange(len(asked)), radius):
        roots = np.unique(np.append(root[found + shift], root[place]))
        if len(roots) > 1:
            root[np.isin(root, roots)] = roots[0]
    joined = np.flatnonzero(root != np.arange(len(root)))
    return list(zip(joined.tolist(), root[joined].tolist()))


def as_words(values: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(values), dtype=">u8").astype(np.uint64).reshape(len(values), -1)


def dealt(nodes: DataFrame, scheme: Scheme) -> DataFrame:
    """value and shard of each fingerprint, once for each way of dealing."""
    columns = {"value": "binary", "shard": "long"}
    schema = arrow_schema(columns)
    bounded_batches(nodes.sparkSession)

    def task(batches):
        for batch in batches:
            if batch.num_rows:
                shards = scheme.shards(as_words(batch.column(0).to_pylist()))
                for column in shards.T:
                    yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(column)], schema=schema)

    return nodes.select("value").mapInArrow(task, ddl(columns))


def near_links(nodes: DataFrame, scheme: Scheme = CLOSE, tree: int = TREE) -> DataFrame:
    """Edges (a, b) that join the groups of the distinct ``value``s of ``nodes``.

    The two ends of every link found are joined by edges. Shards of one
    fingerprint go; a shard of more than ``tree`` is split into trees by hash,
    and a search is made for each tree and each pair of trees.
    """
    keyed = dealt(nodes, scheme)
    sizes = keyed.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sizes = sizes.select("shard", F.ceil(F.col("n") / tree).cast("int").alias("trees"))
    own = (F.pmod(F.xxhash64("value"), F.col("trees"))).cast("int")
    # Of a pair of trees both ends go to the pair's place; second tells the two apart.
    placed = (
        keyed.join(sizes.hint("merge"), "shard")
        .withColumn("own", own)
        .select("shard", "own", "value", F.explode(F.sequence(F.lit(0), F.col("trees") - 1)).alias("other"))
        .select(
            "shard",
            F.least("own", "other").alias("low"),
            F.greatest("own", "other").alias("high"),
            (F.col("own") > F.col("other")).alias("second"),
            "value",
        )
    )
    keys = ["shard", "low", "high"]
    sorted_rows = placed.repartition(*keys).sortWithinPartitions(*keys, "second", "value")
    columns = {"a": "binary", "b": "binary"}
    schema = arrow_schema(columns)
    radius = scheme.radius
    bounded_batches(nodes.sparkSession)

    def task(batches):
        key, sides = None, ([], [])

        def edges():
            left, right = sides
            if key is None or len(left) + len(right) < 2 or key[1] != key[2] and not (left and right):
                return []
            both = left + right
            found = forest(as_words(left), as_words(right) if right else None, radius)
            return [(both[i], both[j]) for i, j in found]

        for rows in batches:
            made = []
            for *place, second, value in zip(*(c.to_pylist() for c in rows.columns)):
                if place != key:
                    made += edges()
                    key, sides = place, ([], [])
                sides[second].append(value)
            yield batch(made)
        yield batch(edges())

    def batch(made):
        return pa.RecordBatch.from_arrays(
            [pa.array([a for a, _ in made], pa.binary()), pa.array([b for _, b in made], pa.binary())], schema=schema
        )

    return sorted_rows.mapInArrow(task, ddl(columns)).distinct()


def grouped(marked: DataFrame, scheme: Scheme, tree: int) -> DataFrame:
    """named_value_, root_ and component_id of each distinct ``value_`` of ``marked`` (doc_id, value_)."""
    # Equal fingerprints are one node; the smallest id stands for its documents.
    nodes = staged(marked.groupBy(F.col("value_").alias("value")).agg(F.min("doc_id").alias("first_id")), "nodes")
    groups = components(staged(near_links(nodes, scheme, tree), "links"))
    # Sorted joins: what is small enough to broadcast here still fills the driver, as groups come in several parts.
    labelled = nodes.join(groups.hint("merge"), nodes["value"] == groups["node"], "left").select(
        "value", "first_id", F.coalesce("root", "value").alias("root")
    )
    smallest = labelled.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return labelled.join(smallest.hint("merge"), "root").select(
        F.col("value").alias("named_value_"), F.col("root").alias("root_"), "component_id"
    )


def near_duplicates(docs: DataFrame, scheme: Scheme = CLOSE, shingle: int = SHINGLE, tree: int = TREE) -> DataFrame:
    """``docs`` less the text, with fingerprint (hex digits) and component_id.

    ``component_id`` is the smallest doc_id reachable over links of the scheme,
    the row's own included; of a group without ids it is null. Null, empty and
    blank texts have fingerprint zero and are linked like any other; repeated
    rows fall into one group. Other columns pass; those named like a result are
    replaced.
    """
    plain = docs.drop("fingerprint", "component_id")
    marked = staged(with_fingerprint(plain, shingle, scheme.bits, "value_"), "fingerprints")
    named = grouped(marked, scheme, tree)
    joined = marked.join(named.hint("merge"), marked["value_"] == named["named_value_"])
    return joined.withColumn("fingerprint", F.lower(F.hex("value_"))).drop("value_", "named_value_", "root_")


def alike(size: int | np.ndarray, other: int | np.ndarray, common: int | np.ndarray, share: tuple[int, int]):
    """Whether sets of these sizes with ``common`` elements have a Jaccard similarity of ``share`` or more."""
    return common * share[1] >= share[0] * (size + other - common)


def set_forest(left: list[np.ndarray], right: list[np.ndarray] | None, share: tuple[int, int]) -> list[tuple[int, int]]:
    """``forest`` by exact similarity of sets, none of them empty.

    A set is compared with those that no earlier one has reached, so equal and
    alike ones cost one comparison each, not one a pair.
    """
    sets = left + (right or [])
    sizes = np.array([len(s) for s in sets])
    starts = np.cumsum(sizes) - sizes
    distinct, codes = np.unique(np.concatenate(sets), return_inverse=True)
    second = np.arange(len(sets)) >= len(left)
    marked = np.zeros(len(distinct), dtype=bool)
    waiting, edges = np.ones(len(sets), dtype=bool), []
    for first in range(len(sets)):
        if not waiting[first]:
            continue
        waiting[first] = False
        reached = [first]
        while reached:
            at = reached.pop()
            asked = waiting & alike(sizes, sizes[at], np.minimum(sizes, sizes[at]), share)
            if right is not None:
                asked &= second != second[at]
            if not asked.any():
                continue
            own = codes[starts[at] : starts[at] + sizes[at]]
            marked[own] = True
            common = np.add.reduceat(marked[codes], starts, dtype=np.int64)
            marked[own] = False
            near = np.flatnonzero(asked & alike(sizes, sizes[at], common, share)).tolist()
            waiting[near] = False
            edges += [(n, at) for n in near]
            reached += near
    return edges


def in_blocks(members: DataFrame, *columns: Column) -> DataFrame:
    """group_, low, high, second, set_ and ``columns`` of ``members``, once for each pair of blocks of their group."""
    own = F.pmod(F.xxhash64("set_"), F.col("blocks_")).cast("int")
    placed = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks_") - 1)))
    return placed.select(
        "group_",
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
        (F.col("own") > F.col("other")).alias("second"),
        "set_",
        *columns,
    )


def likely_forest(
    sizes: np.ndarray, sketches: list[bytes], marks: np.ndarray, second: np.ndarray | None, share: tuple[int, int]
) -> list[tuple[int, int]]:
    """Edges that join what pairs of different marks join whose sketches leave open that they are alike.

    With ``second``, pairs of one that is and one that is not. No two alike sets
    of different marks are left apart: the bits in which sketches differ are no
    more than the hashes that only one of the two has.
    """
    order = np.argsort(sizes, kind="stable")
    sizes, marks = sizes[order], marks[order]
    second = second[order] if second is not None else None
    # Sorted by size, sketches of one length follow each other.
    lengths = np.array([len(s) for s in sketches])[order] // 8
    tables, firsts = {}, {}
    for words_ in np.unique(lengths).tolist():
        rows = order[lengths == words_]
        firsts[words_] = int(np.searchsorted(lengths, words_))
        tables[words_] = np.frombuffer(b"".join(sketches[i] for i in rows), dtype=np.uint64).reshape(len(rows), words_)
    root, edges = np.arange(len(sizes)), []
    last = np.searchsorted(sizes, sizes * share[1] // share[0], "right")
    for i in range(len(sizes)):
        words_ = int(lengths[i])
        own = tables[words_][i - firsts[words_]]
        for wide in (words_, 2 * words_):
            if wide not in tables:
                continue
            low = max(i + 1, firsts[wide])
            high = min(int(last[i]), firsts[wide] + len(tables[wide]))
            if low >= high:
                continue
            fits = marks[low:high] != marks[i]
            if second is not None:
                fits &= second[low:high] != second[i]
            near = np.flatnonzero(fits) + low
            if not len(near):
                continue
            others = tables[wide][near - firsts[wide]]
            if wide > words_:
                others = others[:, :words_] ^ others[:, words_:]
            bits = np.bitwise_count(others ^ own).sum(axis=1, dtype=np.int64)
            near = near[alike(sizes[i], sizes[near], (sizes[i] + sizes[near] - bits) // 2, share)]
            for at in near[root[near] != root[i]].tolist():
                if root[at] != root[i]:
                    edges.append((int(order[i]), int(order[at])))
                    root[root == root[at]] = root[i]
    return edges


def likely_groups(members: DataFrame, named: DataFrame, block: int, share: tuple[int, int]) -> DataFrame:
    """``members`` in the groups that are left of theirs by sketches, which travel in place of texts.

    A group is what pairs of different ``mark_``s hold together whose sketches
    do not rule out that they are alike; most sets that only have a rare hash
    in common are in none.
    """
    keys = ["group_", "low", "high"]
    rows = in_blocks(members, "n_", "mark_", "sketch_").repartition(*keys).sortWithinPartitions(*keys, "second", "set_")
    columns = {"a": "binary", "b": "binary"}
    schema = arrow_schema(columns)
    bounded_batches(members.sparkSession)

    def task(batches):
        key, held = None, []

        def edges():
            if len(held) < 2 or key[1] != key[2] and held[0][0] == held[-1][0]:
                return []
            second, names, sizes, marks, sketches = zip(*held)
            sides = np.array(second) if key[1] != key[2] else None
            found = likely_forest(np.array(sizes), list(sketches), np.array(marks), sides, share)
            return [(names[i], names[j]) for i, j in found]

        def batch_of(made):
            arrays = [pa.array([a for a, _ in made], pa.binary()), pa.array([b for _, b in made], pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        for batch in batches:
            made = []
            for *place, second, name, n, mark, bits in zip(*(c.to_pylist() for c in batch.columns)):
                if place != key:
                    made += edges()
                    key, held = place, []
                held.append((second, name, n, mark, bits))
            yield batch_of(made)
        yield batch_of(edges())

    links = staged(rows.mapInArrow(task, ddl(columns)).distinct(), "likely")
    found = named.select("set_", "n_", "first_").join(components(links).withColumnRenamed("node", "set_"), "set_")
    sizes = found.groupBy("root").agg(blocks(block))
    out = staged(found.join(sizes, "root").select(F.col("root").alias("group_"), "blocks_", "set_", "first_"), "members")
    spent(links)
    return out


def alike_links(docs: DataFrame, members: DataFrame, shingle: int, share: tuple[int, int]) -> DataFrame:
    """Edges (a, b) that join what exact similarity joins inside each group of ``members``.

    Members are (group_, blocks_, set_, first_), the last the key of a row of
    ``docs`` with that set. Texts go to their groups, as they take less room
    than their hashes. A group is searched for each block and each pair of its
    blocks, as in ``near_links``.
    """
    placed = in_blocks(members, F.col("first_.key_id_").alias("asked_id_"), F.col("first_.key_hash_").alias("asked_hash_"))
    keys = ["group_", "low", "high"]
    same = F.col("key_id_").eqNullSafe(F.col("asked_id_")) & (F.col("key_hash_") == F.col("asked_hash_"))
    rows = docs.join(placed, same).select(*keys, "second", "set_", "text")
    rows = rows.repartition(*keys).sortWithinPartitions(*keys, "second", "set_")
    columns = {"a": "binary", "b": "binary"}
    schema = arrow_schema(columns)
    bounded_batches(members.sparkSession)

    def task(batches):
        key, names, sides = None, ([], []), ([], [])

        def edges():
            left, right = sides
            if key is None or len(left) + len(right) < 2 or key[1] != key[2] and not (left and right):
                return []
            both = names[0] + names[1]
            return [(both[i], both[j]) for i, j in set_forest(left, right or None, share)]

        for batch in batches:
            made = []
            for *place, second, name, text in zip(*(c.to_pylist() for c in batch.columns)):
                if place != key:
                    made += edges()
                    key, names, sides = place, ([], []), ([], [])
                # Equal rows follow each other; the set without words has no other that is alike.
                if names[second][-1:] != [name] and len(own := shingle_set(text, shingle)):
                    names[second].append(name)
                    sides[second].append(own)
            yield batch_of(made)
        yield batch_of(edges())

    def batch_of(made):
        return pa.RecordBatch.from_arrays(
            [pa.array([a for a, _ in made], pa.binary()), pa.array([b for _, b in made], pa.binary())], schema=schema
        )

    return rows.mapInArrow(task, ddl(columns)).distinct()


def blocks(block: int):
    """Blocks of a group whose sets have ``n_`` elements."""
    return F.ceil(F.sum("n_") / block).cast("int").alias("blocks_")


def exploded(marked: DataFrame, keep: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """hash, set_ of the rare hashes that ``keep`` picks, each once a set."""
    columns = {"hash": "long", "set_": "binary"}
    schema = arrow_schema(columns)
    bounded_batches(marked.sparkSession)

    def task(batches):
        for batch in batches:
            lists = [np.frombuffer(r, dtype=np.int64) for r in batch.column(0).to_pylist()]
            row = np.repeat(np.arange(len(lists)), [len(r) for r in lists])
            hashes = np.concatenate([np.zeros(0, dtype=np.int64), *lists])
            kept = keep(hashes)
            yield pa.RecordBatch.from_arrays([pa.array(hashes[kept]), batch.column(1).take(pa.array(row[kept]))], schema=schema)

    return marked.select("rare_", "set_").mapInArrow(task, ddl(columns)).distinct()


def repeated_rare(marked: DataFrame, part_entries: int = PART_ENTRIES) -> DataFrame:
    """hash: the rare hashes that more than one set has, staged.

    Hashes travel packed, with 8 bytes of a set that has them: a batch of rows
    sends each part of the hashes one list, and a hash of many sets twice, with
    the least and the greatest, so a frequent hash is no longer list than others.
    """
    total = marked.agg(F.sum(F.length("rare_"))).first()[0] or 0
    parts = max(1, -(-total // (8 * part_entries)))
    packed = {"part": "long", "pairs": "binary"}
    bounded_batches(marked.sparkSession)

    def ends(hashes, owners):
        """Each hash with its least and, where that is another, its greatest owner."""
        pairs = np.column_stack([hashes, owners])[np.lexsort((owners, hashes))]
        pairs = pairs[np.concatenate([[True], (pairs[1:] != pairs[:-1]).any(axis=1)])[: len(pairs)]]
        step = pairs[1:, 0] != pairs[:-1, 0]
        edge = np.concatenate([[True], step]), np.concatenate([step, [True]])
        return pairs[(edge[0] | edge[1])[: len(pairs)]]

    def spread(batches):
        for batch in batches:
            lists = [np.frombuffer(r, dtype=np.int64) for r in batch.column(0).to_pylist()]
            owner = np.array([int.from_bytes(s[:8], "little", signed=True) for s in batch.column(1).to_pylist()], dtype=np.int64)
            pairs = ends(np.concatenate([np.zeros(0, dtype=np.int64), *lists]), np.repeat(owner, [len(r) for r in lists]))
            part = pairs[:, 0] % parts
            order = np.argsort(part, kind="stable")
            part, pairs = part[order], pairs[order]
            cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)] if len(part) else [0]
            made = [(int(part[a]), pairs[a:b].tobytes()) for a, b in zip(cuts, cuts[1:])]
            arrays = [pa.array([m[0] for m in made], pa.int64()), pa.array([m[1] for m in made], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow_schema(packed))

    def gather(batches):
        now, held = None, []

        def found():
            pairs = np.frombuffer(b"".join(held), dtype=np.int64).reshape(-1, 2)
            hashes = ends(pairs[:, 0], pairs[:, 1])[:, 0]
            # Two entries are left of a hash only where two sets have it.
            return pa.RecordBatch.from_arrays([pa.array(hashes[:-1][hashes[1:] == hashes[:-1]])], schema=arrow_schema({"hash": "long"}))

        for batch in batches:
            for part, pairs in zip(*(c.to_pylist() for c in batch.columns)):
                if part != now:
                    if held:
                        yield found()
                    now, held = part, []
                held.append(pairs)
        if held:
            yield found()

    rows = marked.select("rare_", "set_").mapInArrow(spread, ddl(packed)).repartition("part").sortWithinPartitions("part")
    return staged(rows.mapInArrow(gather, "hash long"), "repeated")


def shared_rare(marked: DataFrame, named: DataFrame, block: int, part_entries: int = PART_ENTRIES) -> DataFrame:
    """Groups (group_, blocks_, set_, n_, mark_, sketch_) of sets of several ``mark_``s with a rare hash in common.

    ``marked`` rows have ``set_`` and ``rare_``; ``named`` has a row a set. A
    bitmap of the hashes that several sets have keeps the others from travelling.
    Groups that share a set are one where that takes no more rows; else every
    hash has a group, and hashes of the same sets are one.
    """
    repeated = repeated_rare(marked, part_entries)
    bits = marked.sparkSession.sparkContext.broadcast(bitmap(repeated, "hash"))
    rows = exploded(marked, lambda hashes: holds(bits.value, hashes)).join(repeated, "hash", "left_semi")
    rows = staged(rows.join(named.select("set_", "n_", "mark_"), "set_"), "rare")
    groups = rows.groupBy("hash").agg(
        F.min("mark_").alias("least_"), F.max("mark_").alias("most_"), blocks(block), F.count(F.lit(1)).alias("count_"),
        F.sum(F.xxhash64("set_").cast("decimal(38,0)")).alias("sum_"), F.min("set_").alias("low_"),
    )
    groups = groups.where("least_ < most_").groupBy("count_", "sum_", "low_").agg(F.min("hash").alias("hash"), F.min("blocks_").alias("blocks_"))
    mixed = staged(rows.join(groups.select("hash", "blocks_", "low_"), "hash"), "mixed")
    # Hashes that hang together by their sets are one group, in which each set is once for each block, where that
    # takes no more rows than a group for each hash.
    ties = staged(mixed.select(F.col("set_").alias("a"), F.col("low_").alias("b")).distinct(), "ties")
    together = staged(components(ties).withColumnRenamed("node", "set_"), "together")
    sets = mixed.groupBy("set_", "n_").agg(F.count(F.lit(1)).alias("hashes_")).join(together, "set_")
    sizes = sets.groupBy("root").agg(
        F.ceil(F.sum("n_") / block).cast("int").alias("blocks_"), F.count(F.lit(1)).alias("sets_"), F.sum("hashes_").alias("rows_")
    )
    small = sizes.where(F.col("sets_") * F.col("blocks_") <= F.col("rows_")).select("root", "blocks_")
    at_once = sets.join(small, "root").select(F.xxhash64("root").alias("group_"), "blocks_", "set_")
    large = mixed.join(together.join(small, "root", "left_anti").select("set_"), "set_", "left_semi")
    found = at_once.unionByName(large.select(F.col("hash").alias("group_"), "blocks_", "set_"))
    out = staged(found.join(named.select("set_", "n_", "mark_", "sketch_"), "set_"), "members")
    spent(mixed, ties, together)
    bits.unpersist()
    spent(repeated, rows)
    return out


def keep_one(
    docs: DataFrame,
    scheme: Scheme = ALIKE,
    shingle: int = SHINGLE,
    tree: int = TREE,
    share: tuple[int, int] = SHARE,
    block: int = SET_BLOCK,
) -> DataFrame:
    """``docs`` with one row of each group of near duplicates; columns as given.

    Texts are linked when the sets of their shingles have a Jaccard similarity
    of ``share`` or more, and linked texts form a group; no link is lost.
    Groups of near fingerprints say which texts are compared first, which joins
    nearly all. The few links that fingerprints miss are found by the rarest
    shingles of each set, of which two alike ones share one (``rare_first``):
    texts that do and are not joined yet are compared as well, unless a short
    sketch of each set rules a link out.

    The row of the smallest doc_id stays, rows without an id come last; of
    several, the one of the least text hash, and of equal rows one. Texts
    without words are one group. Ids, hashes and fingerprints are grouped; texts
    move to be compared within their group, and to meet the rows that stay.
    """

    def with_key(df):
        return df.withColumns({"key_hash_": F.xxhash64("text"), "key_id_": F.col("doc_id")})

    narrow = with_key(docs.select("doc_id", "text"))
    marked = staged(with_sets(narrow, shingle, scheme.bits, share), "fingerprints")
    # Equal sets are one node, which any of its rows can stand for.
    nodes = staged(
        marked.groupBy("set_").agg(
            F.first("value_").alias("value"), F.first("n_").alias("n_"), F.first("sketch_").alias("sketch_"),
            F.min(F.struct("key_id_", "key_hash_")).alias("first_"),
        ),
        "nodes",
    )
    links = staged(near_links(nodes.select("value").distinct(), scheme, tree), "links")
    near = components(links)
    named = nodes.join(near, nodes["value"] == near["node"], "left").withColumn("group_", F.coalesce("root", "value"))
    sizes = named.groupBy("group_").agg(F.count(F.lit(1)).alias("count_"), blocks(block)).where("count_ > 1 and blocks_ > 0")
    members = staged(named.join(sizes, "group_").select("group_", "blocks_", "set_", "first_"), "members")
    edges = staged(alike_links(narrow, members, shingle, share), "alike")
    groups = staged(components(edges), "groups")
    spent(links, members, edges)
    # What fingerprints miss: sets of different groups so far that have a rare hash in common.
    named = nodes.join(groups, nodes["set_"] == groups["node"], "left")
    named = staged(named.withColumn("mark_", F.xxhash64(F.coalesce("root", "set_"))), "named")
    met = shared_rare(marked, named, block)
    others = likely_groups(met, named, block, share)
    missed = staged(alike_links(narrow, others, shingle, share), "alike")
    spent(met, others, named)
    if missed.limit(1).count():
        groups = components(groups.select(F.col("node").alias("a"), F.col("root").alias("b")).unionAll(missed))
    marked = marked.drop("value_", "n_", "sketch_", "rare_")
    rows = marked.join(groups, marked["set_"] == groups["node"], "left").withColumn("root_", F.coalesce("root", "set_"))
    order = Window.partitionBy("root_").orderBy(F.col("key_id_").asc_nulls_last(), "key_hash_")
    first = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= 1)
    stay = staged(first.select(F.col("key_id_").alias("stay_id_"), F.col("key_hash_").alias("stay_hash_")), "stay")
    left = with_key(docs)
    same = left["key_id_"].eqNullSafe(stay["stay_id_"]) & (left["key_hash_"] == stay["stay_hash_"])
    kept = left.join(stay, same, "left_semi")
    # Equal rows stay together up to here; only where there are some is one picked.
    equal = marked.join(stay, marked["key_id_"].eqNullSafe(stay["stay_id_"]) & (marked["key_hash_"] == stay["stay_hash_"]))
    if equal.groupBy("key_id_", "key_hash_").count().where("count > 1").limit(1).count():
        kept = kept.dropDuplicates(["key_id_", "key_hash_"])
    return kept.drop("key_id_", "key_hash_")
