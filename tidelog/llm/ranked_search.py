"""Ranked lexical search: MaxScore with bounds of term pairs.

Documents are indexed in blocks of bounded size, each made by the task that
reads its texts, so the index needs no shuffle and a frequent term's list is
spread over all blocks. A block holds its documents' lengths and, for each term
that a query asks for, the documents and how often it occurs there. Global
figures (documents, terms, documents of each term) are sums over the blocks.

With these a second pass gives every block the lists of term pairs: for two
terms of one query that stand next to each other by weight, the documents that
hold both and their joint impacts, with the largest of these. A document's
share of a pair is at most the larger of both single maxima and that joint
maximum, which is less than the sum of the single ones wherever no document has
both at their best.

A query goes through the blocks of a task with the k best scores so far. Terms
are taken by rising maximum; those whose bounds, pairs before singles, stay
below the k-th score need not be followed, a block whose whole bound does is
skipped, and what the other terms find is dropped as soon as the rest can no
longer lift it. The largest joint impacts give a k-th score to start from.
Nothing is skipped on equality, so ties are settled by the id.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.llm.common import arrow_schema, bounded_batches, ddl, staged

#: Documents and postings of one block; a longer document is a block of its own.
BLOCK_DOCS = 4096
BLOCK_POSTINGS = 1 << 20
#: Distinct terms, about, of the queries that one pass over the index answers.
QUERY_TERMS = 200_000

# A-Z made small, everything that is no term character a blank. Bytes from 0x80 on belong to terms.
_LETTERS = bytes(
    32 if b < 0x30 or 0x3A <= b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F else b + 32 if 0x41 <= b <= 0x5A else b
    for b in range(256)
)

INDEX = {
    "doc_ids": "array<long>",
    "lengths": "array<long>",
    "terms": "array<int>",
    "ends": "array<int>",
    "places": "binary",
    "counts": "binary",
}
PAIRS = {"pairs": "array<int>", "pair_ends": "array<int>", "pair_places": "binary", "pair_impacts": "binary"}


def terms(text: str | None) -> list[bytes]:
    """Maximal runs of digits, letters and characters beyond ASCII, A-Z made small; null has none."""
    return text.encode("utf-8", "surrogatepass").translate(_LETTERS).split() if text else []


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(weights: np.ndarray | int, counts: np.ndarray, middles: np.ndarray) -> np.ndarray:
    """What a term adds to a document's score; all numbers are 64-bit integers."""
    counts = counts.astype(np.int64)
    return weights * (1_000_000_000 * counts // (1000 * counts + 20 * middles))


class Block:
    """One block of the index: lists of places (numbers within the block, rising) and counts by term."""

    def __init__(self, row: dict):
        self.doc_ids = row["doc_ids"]
        self.lengths = np.array(row["lengths"], dtype=np.int64)
        self.places = np.frombuffer(row["places"], dtype=np.uint16)
        self.counts = np.frombuffer(row["counts"], dtype=np.uint32)
        ends = [0, *row["ends"]]
        self.spans = {t: (a, b) for t, a, b in zip(row["terms"], ends, ends[1:])}

    def weighed(self, weights: np.ndarray, n_docs: int, n_terms: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """Places and impacts of each term."""
        middles = 50 + 50 * self.lengths * n_docs // max(n_terms, 1)
        return {
            t: (self.places[a:b], impacts(int(weights[t]), self.counts[a:b], middles[self.places[a:b]]))
            for t, (a, b) in self.spans.items()
        }


def blocks_of(batches: Iterable[pa.RecordBatch], wanted: dict[bytes, int], most_docs: int, most_postings: int):
    """Rows of the index from batches of (doc_id, text)."""
    ids, lengths, found, n_found = [], [], [], 0

    def row():
        keys = [np.full(len(c), i, dtype=np.int64) | t.astype(np.int64) << 16 for i, (t, c) in enumerate(found)]
        keys = np.concatenate([np.zeros(0, dtype=np.int64), *keys])
        counts = np.concatenate([np.zeros(0, dtype=np.uint32), *(c for _, c in found)])
        order = np.argsort(keys)
        numbers, lists = np.unique(keys >> 16, return_counts=True)
        return {
            "doc_ids": list(ids),
            "lengths": list(lengths),
            "terms": numbers.tolist(),
            "ends": np.cumsum(lists).tolist(),
            "places": (keys[order] & 0xFFFF).astype(np.uint16).tobytes(),
            "counts": counts[order].astype(np.uint32).tobytes(),
        }

    for batch in batches:
        for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
            own = terms(text)
            if not own:
                continue
            numbers = np.fromiter(map(wanted.get, own, [-1] * len(own)), dtype=np.int32, count=len(own))
            numbers, counts = np.unique(numbers[numbers >= 0], return_counts=True)
            if ids and (len(ids) >= most_docs or n_found + len(numbers) > most_postings):
                yield row()
                ids, lengths, found, n_found = [], [], [], 0
            ids.append(doc_id)
            lengths.append(len(own))
            found.append((numbers, counts.astype(np.uint32)))
            n_found += len(numbers)
    if ids:
        yield row()


def one_row(row: dict, columns: dict[str, str]) -> pa.RecordBatch:
    schema = arrow_schema(columns)
    return pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in schema], schema=schema)


def index(docs: DataFrame, wanted: dict[bytes, int], most_docs: int, most_postings: int) -> DataFrame:
    """The staged blocks of ``docs``; ``wanted`` numbers the terms that are indexed."""
    spark = bounded_batches(docs.sparkSession)
    shared = spark.sparkContext.broadcast(wanted)

    def task(batches):
        for row in blocks_of(batches, shared.value, most_docs, most_postings):
            yield one_row(row, INDEX)

    try:
        return staged(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(task, ddl(INDEX)), "postings")
    finally:
        shared.unpersist()


def figures(blocks: DataFrame, n_wanted: int) -> tuple[int, int, np.ndarray]:
    """Documents and terms of all blocks, and the weight of each indexed term."""
    whole = blocks.agg(
        F.sum(F.size("doc_ids")).alias("n"), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("l")
    ).first()
    n_docs, n_terms = whole["n"] or 0, whole["l"] or 0
    lists = F.transform("terms", lambda t, i: F.struct(t.alias("t"), (F.col("ends")[i] - F.coalesce(F.get("ends", i - 1), F.lit(0))).alias("n")))
    df = blocks.select(F.explode(lists).alias("x")).groupBy("x.t").agg(F.sum("x.n").alias("df")).toArrow()
    weights = np.zeros(n_wanted, dtype=np.int64)
    for t, n in zip(df.column(0).to_pylist(), df.column(1).to_pylist()):
        weights[t] = weight(n_docs, n)
    return n_docs, n_terms, weights


def neighbours_by_weight(queries: list[tuple[int, np.ndarray]], weights: np.ndarray) -> list[tuple[int, int]]:
    """The pairs that get lists: in each query, terms two by two in order of weight."""
    pairs = set()
    for _, own in queries:
        order = own[np.lexsort((own, weights[own]))].tolist()
        pairs.update((min(p), max(p)) for p in zip(order[::2], order[1::2]))
    return sorted(pairs)


def pair_lists(lists: dict[int, tuple[np.ndarray, np.ndarray]], pairs: list[tuple[int, int]]) -> dict:
    """Documents of a block that hold both terms of a pair, with joint impacts, by falling impact."""
    numbers, places, joint = [], [], []
    for number, (a, b) in enumerate(pairs):
        if a in lists and b in lists:
            both, at_a, at_b = np.intersect1d(lists[a][0], lists[b][0], assume_unique=True, return_indices=True)
            if len(both):
                sums = lists[a][1][at_a] + lists[b][1][at_b]
                order = np.argsort(-sums, kind="stable")
                numbers.append(number)
                places.append(both[order])
                joint.append(sums[order])
    return {
        "pairs": numbers,
        "pair_ends": np.cumsum([len(p) for p in places]).astype(int).tolist(),
        "pair_places": np.concatenate([np.zeros(0, dtype=np.uint16), *places]).tobytes(),
        "pair_impacts": np.concatenate([np.zeros(0, dtype=np.int64), *joint]).tobytes(),
    }


class Best:
    """The k best (score, id) of a query so far: higher scores first, then smaller ids, rows without an id last."""

    def __init__(self, k: int):
        self.k, self.rows, self.least = k, [], 1

    def add(self, scores: list[int], ids: list[int | None]) -> None:
        self.rows += zip(scores, ids)
        self.rows.sort(key=lambda r: (-r[0], r[1] is None, r[1] or 0))
        del self.rows[self.k :]
        if len(self.rows) == self.k:
            self.least = max(self.least, self.rows[-1][0])


class Bounds:
    """Upper bounds of what the first terms of a query, by rising maximum, add to a document of a block."""

    def __init__(self, own: list[int], lists: dict, joint: dict[tuple[int, int], int]):
        most = {t: int(lists[t][1].max()) for t in own if t in lists}
        self.order = sorted(most, key=lambda t: (most[t], t))
        # Each prefix is bounded by the better of its last term alone and its last term with the partner before it.
        self.upto = [0]
        for i, t in enumerate(self.order):
            bound = self.upto[i] + most[t]
            for j in range(i - 1, -1, -1):
                pair = (min(t, self.order[j]), max(t, self.order[j]))
                if pair in joint:
                    # What lies between the partners is bounded one by one.
                    between = sum(most[o] for o in self.order[j + 1 : i])
                    bound = min(bound, self.upto[j] + between + max(most[t], most[self.order[j]], joint[pair]))
                    break
            self.upto.append(bound)


def search(block: Block, lists: dict, joint: dict, own: list[int], best: Best) -> int:
    """Adds the block's documents to ``best``; returns how many postings were looked at."""
    bounds = Bounds(own, lists, joint)
    order, upto = bounds.order, bounds.upto
    if not order or upto[-1] < best.least:
        return 0
    # Terms before ``first`` cannot lift a document to the k-th score by themselves.
    first = next(i for i in range(len(order)) if upto[i + 1] >= best.least)
    scores = np.zeros(len(block.doc_ids), dtype=np.int64)
    seen = 0
    for t in order[first:]:
        places, some = lists[t]
        scores[places] += some
        seen += len(places)
    alive = np.flatnonzero(scores + upto[first] >= best.least)
    for i in range(first - 1, -1, -1):
        if not len(alive):
            return seen
        places, some = lists[order[i]]
        at = np.minimum(np.searchsorted(places, alive), len(places) - 1)
        scores[alive] += np.where(places[at] == alive, some[at], 0)
        seen += len(alive)
        alive = alive[scores[alive] + upto[i] >= best.least]
    alive = alive[(scores[alive] >= best.least) & (scores[alive] > 0)]
    if len(alive) > best.k:
        # Ties with the k-th stay: ids decide.
        kth = np.partition(scores[alive], len(alive) - best.k)[len(alive) - best.k]
        alive = alive[scores[alive] >= kth]
    if len(alive):
        best.add(scores[alive].tolist(), [block.doc_ids[i] for i in alive.tolist()])
    return seen


def ranked(
    spark: SparkSession, docs: DataFrame, queries: list[tuple[int, np.ndarray]], wanted: dict[bytes, int], k: int, most_docs: int, most_postings: int
) -> DataFrame:
    """query, doc_id, score: the best k of each task for each query of one group."""
    blocks = index(docs, wanted, most_docs, most_postings)
    n_docs, n_terms, weights = figures(blocks, len(wanted))
    pairs = neighbours_by_weight(queries, weights)
    shared = spark.sparkContext.broadcast((weights, pairs, queries))

    def add_pairs(batches):
        weights, pairs, _ = shared.value
        for batch in batches:
            for row in batch.to_pylist():
                yield one_row(row | pair_lists(Block(row).weighed(weights, n_docs, n_terms), pairs), INDEX | PAIRS)

    indexed = staged(blocks.mapInArrow(add_pairs, ddl(INDEX | PAIRS)), "pairs")
    columns = {"query": "int", "doc_id": "long", "score": "long"}
    schema = arrow_schema(columns)

    def find(batches):
        weights, pairs, queries = shared.value
        best = {q: Best(k) for q, _ in queries}
        number = {p: i for i, p in enumerate(pairs)}
        asked = []
        for q, own in queries:
            order = own[np.lexsort((own, weights[own]))].tolist()
            asked.append((q, order, [number[min(p), max(p)] for p in zip(order[::2], order[1::2])]))
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                lists = block.weighed(weights, n_docs, n_terms)
                ends = [0, *row["pair_ends"]]
                joint_impacts = np.frombuffer(row["pair_impacts"], dtype=np.int64)
                spans = {p: (a, b) for p, a, b in zip(row["pairs"], ends, ends[1:])}
                joint = {pairs[p]: int(joint_impacts[a]) for p, (a, _) in spans.items()}
                for q, own, own_pairs in asked:
                    # A pair's k-th joint impact is a score that k documents of this block reach at least.
                    for p in own_pairs:
                        a, b = spans.get(p, (0, 0))
                        if b - a >= k:
                            best[q].least = max(best[q].least, int(joint_impacts[a + k - 1]))
                    search(block, lists, {p: joint.get(p, 0) for p in (pairs[i] for i in own_pairs)}, own, best[q])
        rows = [(q, doc_id, score) for q in best for score, doc_id in best[q].rows]
        arrays = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)]
        yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return indexed.mapInArrow(find, ddl(columns))


def best_documents(
    docs: DataFrame, items: DataFrame, k: int = 50, query_terms: int = QUERY_TERMS, most_docs: int = BLOCK_DOCS, most_postings: int = BLOCK_POSTINGS
) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` highest-scoring documents of each item, scores above 0 only.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are
    left out. Null, empty and termless texts are no documents and find nothing.
    Equal scores are ordered by doc_id, rows without one last; each row is a
    document, so repeated rows all count. Equal rows of ``items`` are one item;
    items of the same terms are searched once. Empty tables give no rows.

    Queries are answered in groups of about ``query_terms`` terms, each with an
    index of its terms; figures over all documents are the same in each.
    """
    spark = bounded_batches(docs.sparkSession)
    most_docs = min(most_docs, 1 << 16)
    columns = {"item_id": "long", "set": "binary"}
    schema = arrow_schema(columns)

    def sets(batches):
        for batch in batches:
            ids, texts = (c.to_pylist() for c in batch.columns)
            made = [b" ".join(sorted(set(terms(t)))) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(made, pa.binary())], schema=schema)

    asked = items.select(F.col("item_id").cast("long"), "text").mapInArrow(sets, ddl(columns)).where("length(set) > 0").distinct()
    asked = staged(asked, "items")
    distinct = asked.select("set").distinct()
    total = distinct.agg(F.sum(F.size(F.split(F.col("set").cast("string"), " ")))).first()[0] or 0
    groups = max(1, -(-total // query_terms))
    results = []
    for group in range(groups):
        own = distinct.where(F.pmod(F.xxhash64("set"), F.lit(groups)) == group).toArrow().column(0).to_pylist()
        if not own:
            continue
        own.sort()
        wanted: dict[bytes, int] = {}
        queries = [(q, np.array(sorted(wanted.setdefault(t, len(wanted)) for t in s.split(b" ")), dtype=np.int64)) for q, s in enumerate(own)]
        found = ranked(spark, docs, queries, wanted, k, most_docs, most_postings)
        # Each task gives at most k rows a query, so a query's rows grow with the tasks, not with the documents.
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        found = staged(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "ranked")
        names = spark.createDataFrame(pa.table({"query": pa.array(range(len(own)), pa.int32()), "set": pa.array(own, pa.binary())}))
        results.append(found.join(F.broadcast(names), "query").select("set", "rank", "doc_id", "score"))
    if not results:
        return asked.limit(0).select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    whole = results[0]
    for more in results[1:]:
        whole = whole.unionAll(more)
    return asked.join(whole, "set").select("item_id", "rank", "doc_id", "score")
