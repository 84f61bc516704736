"""Approximate nearest neighbours by cross-polytope hashing.

A table turns each unit vector by a pseudo-rotation (random signs and a fast
Hadamard transform, three times) and puts it in the bucket of the nearest
signed axis. A query looks into its own bucket and the next nearest ones of
each table; everything found is ranked by exact distances. How many buckets are
probed is measured: some queries are searched exactly, and the probes are as
many as their true neighbours needed.

Equal vectors are one node that keeps the ids of its first copies: more than
``k + 1`` of them can never be among the ``k`` nearest, as ties go to smaller
ids. Buckets that hold many nodes are split among tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import arrow_schema, bounded_batches, ddl, staged

K = 10
TABLES = 4
SEED = 7
#: Share of true neighbours that the probes must find among the queries searched exactly, and how many those are.
RECALL = 0.96
MEASURED_QUERIES = 64
#: From so many nodes a bucket on, buckets are the signed axes of two rotations instead of one.
WIDE_BUCKET = 5000
#: Nodes of one bucket that one task compares.
BUCKET_SLICE = 20_000

_ROWS = 2048


def signs(dimension: int, tables: int, hashes: int, seed: int = SEED) -> np.ndarray:
    """Random signs of each table, hash and round, for vectors filled up to a power of two."""
    width = 1 << max(0, dimension - 1).bit_length()
    return np.random.default_rng(seed).choice(np.array([-1.0, 1.0], dtype=np.float32), (tables, hashes, 3, width))


def hadamard(rows: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row."""
    n, width = rows.shape
    half = 1
    while half < width:
        pairs = rows.reshape(n, -1, 2, half)
        rows = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, width)
        half *= 2
    return rows / np.float32(np.sqrt(width))


def rotated(vectors: np.ndarray, rounds: np.ndarray) -> np.ndarray:
    """Unit vectors of ``vectors``, turned by one pseudo-rotation."""
    length = np.linalg.norm(vectors.astype(np.float64), axis=1, keepdims=True)
    out = np.zeros((len(vectors), rounds.shape[1]), dtype=np.float32)
    out[:, : vectors.shape[1]] = vectors / length
    for flips in rounds:
        out = hadamard(out * flips)
    return out


def losses(vectors: np.ndarray, table: np.ndarray) -> np.ndarray:
    """For each vector and bucket of a table, how far the bucket's axes are from the nearest ones."""
    total = None
    for rounds in table:
        turned = rotated(vectors, rounds)
        values = np.stack([turned, -turned], axis=2).reshape(len(turned), -1)
        loss = (values.max(axis=1, keepdims=True) - values) ** 2
        total = loss if total is None else (total[:, :, None] + loss[:, None, :]).reshape(len(turned), -1)
    return total


def buckets(vectors: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The bucket of each vector: the signed axis nearest in each hash of the table."""
    code = np.zeros(len(vectors), dtype=np.int64)
    for rounds in table:
        turned = rotated(vectors, rounds)
        axis = np.abs(turned).argmax(axis=1)
        below = turned[np.arange(len(turned)), axis] < 0
        code = code * (2 * turned.shape[1]) + 2 * axis + below
    return code


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as a matrix."""
    flat = np.asarray(column.flatten())
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def squared(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    gap = rows - query
    return np.einsum("ij,ij->i", gap, gap)


def usable(vector: Column) -> Column:
    """Not null, no null or non-finite component, not all zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def nodes_of(vectors: DataFrame, k: int) -> DataFrame:
    """node (its least id), vector and ids (its ``k + 1`` least) of the distinct vectors."""
    single = vectors.groupBy("vector", "vec_id").agg(F.lit(1).alias("one"))
    place = Window.partitionBy("vector").orderBy("vec_id")
    first = single.withColumn("place", F.row_number().over(place)).where(F.col("place") <= k + 1)
    found = first.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    return found.select(F.col("ids")[0].alias("node"), "vector", "ids")


def exact_nearest(nodes: DataFrame, queries: list[tuple[int, list[float]]], k: int) -> DataFrame:
    """query_node, vec_id and distance of the ``k + 1`` ids nearest to each of a bounded list of queries.

    Each task keeps its own nearest; those of all tasks are merged.
    """
    numbers = [q for q, _ in queries]
    points = np.array([v for _, v in queries], dtype=np.float64)
    columns = {"query_node": "long", "vec_id": "long", "distance": "double"}
    schema = arrow_schema(columns)
    bounded_batches(nodes.sparkSession)

    def task(batches):
        best: list[list] = [[] for _ in numbers]
        for rows in batches:
            at, ids = matrix(rows.column(0)).astype(np.float64), rows.column(1).to_pylist()
            for i, point in enumerate(points if len(at) else ()):
                near = squared(point, at)
                close = np.argsort(near, kind="stable")[: k + 1]
                best[i] = sorted(best[i] + [(near[j], v) for j in close for v in ids[j]])[: k + 1]
        made = [(q, v, d**0.5) for q, found in zip(numbers, best) for d, v in found]
        yield pa.RecordBatch.from_arrays(
            [pa.array([m[i] for m in made], f.type) for i, f in enumerate(schema)], schema=schema
        )

    found = nodes.select("vector", "ids").mapInArrow(task, ddl(columns))
    return nearest_of(found, k + 1)


def nearest_of(found: DataFrame, n: int) -> DataFrame:
    """The ``n`` nearest (query_node, vec_id, distance) of each query, each id once."""
    once = found.groupBy("query_node", "vec_id").agg(F.min("distance").alias("distance"))
    order = Window.partitionBy("query_node").orderBy("distance", "vec_id")
    return once.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n).drop("place")


def probes_needed(nodes: DataFrame, queries: DataFrame, tables: np.ndarray, k: int, recall: float) -> int:
    """Buckets to probe in each table, so that ``recall`` of the true neighbours of some queries are found.

    The queries are a bounded choice by hash; each is compared with all nodes.
    For a true neighbour it counts at which place its bucket stands among the
    query's, in the table where that place is best.
    """
    chosen = queries.orderBy(F.xxhash64("query_node"), "query_node").limit(MEASURED_QUERIES)
    sample = [(r[0], list(r[1])) for r in chosen.select("query_node", "vector").collect()]
    if not sample:
        return 1
    near = exact_nearest(nodes, sample, k).withColumnRenamed("vec_id", "near_id")
    # A copy's vector is that of its node, found by any of its ids.
    by_id = nodes.select(F.explode("ids").alias("near_id"), F.col("vector").alias("near_vector"))
    pairs = by_id.join(F.broadcast(near), "near_id").where("near_id <> query_node").collect()
    points = dict(sample)
    places = []
    for r in pairs:
        query = np.array([points[r["query_node"]]], dtype=np.float32)
        other = np.array([r["near_vector"]], dtype=np.float32)
        place = min(
            int((loss[0] < loss[0, buckets(other, table)[0]]).sum()) for table in tables for loss in [losses(query, table)]
        )
        places.append(place + 1)
    return int(np.quantile(places, recall, method="higher")) if places else 1


def keyed(df: DataFrame, tables: np.ndarray, probes: int | None, carried: list[str]) -> DataFrame:
    """``carried`` columns and a row for each table with its bucket, or with each of the ``probes`` nearest ones."""
    bounded_batches(df.sparkSession)
    fields = {"long": ["node", "query_node"], "array<float>": ["vector"], "array<long>": ["ids"]}
    kinds = {name: kind for kind, names in fields.items() for name in names}
    columns = {c: kinds[c] for c in carried} | {"bucket": "long"}
    schema = arrow_schema(columns)
    place = carried.index("vector")

    def task(batches):
        for rows in batches:
            if not rows.num_rows:
                continue
            for at in range(0, rows.num_rows, 64 if probes else _ROWS):
                part = rows.slice(at, 64 if probes else _ROWS)
                vectors = matrix(part.column(place))
                for t, table in enumerate(tables):
                    if probes is None:
                        found = buckets(vectors, table)[:, None]
                    else:
                        loss = losses(vectors, table)
                        found = np.argsort(loss, axis=1, kind="stable")[:, :probes]
                    picked = pa.array(np.repeat(np.arange(part.num_rows), found.shape[1]))
                    codes = pa.array(found.astype(np.int64).ravel() * len(tables) + t)
                    # In pieces, as a query's vector stands in a row for each probe.
                    for b in range(0, len(codes), 4 * _ROWS):
                        piece = part.take(picked.slice(b, 4 * _ROWS))
                        yield pa.RecordBatch.from_arrays([*piece.columns, codes.slice(b, 4 * _ROWS)], schema=schema)

    return df.select(*carried).mapInArrow(task, ddl(columns))


def compare_in_buckets(index: DataFrame, probing: DataFrame, k: int) -> DataFrame:
    """query_node, vec_id, distance: for each bucket probed, its ids nearest to the query.

    A bucket of many nodes is split by hash into slices of bounded size, and
    its queries go to each slice. A task holds the queries of a slice, as
    blocks, while the slice's nodes stream past.
    """
    sizes = index.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / BUCKET_SLICE).cast("int").alias("slices"))
    crowded = sizes.where("slices > 1")
    one = F.coalesce("slices", F.lit(1))
    rows = index.join(crowded, "bucket", "left").select(
        "bucket",
        F.pmod(F.xxhash64("node"), one).cast("int").alias("slice"),
        F.lit(1).alias("side"),
        F.col("node").alias("number"),
        "vector",
        "ids",
    )
    asked = probing.join(crowded, "bucket", "left").select(
        "bucket",
        F.explode(F.sequence(F.lit(0), one - 1)).alias("slice"),
        F.lit(0).alias("side"),
        F.col("query_node").alias("number"),
        "vector",
        F.lit(None).cast("array<bigint>").alias("ids"),
    )
    keys = ["bucket", "slice"]
    together = rows.unionAll(asked).repartition(*keys).sortWithinPartitions(*keys, "side", "number")
    columns = {"query_node": "long", "vec_id": "long", "distance": "double"}
    schema = arrow_schema(columns)

    def task(batches):
        key, numbers, points, best = None, [], [], {}

        def result():
            made = [(q, v, d**0.5) for q, found in best.items() for d, v in found]
            return pa.RecordBatch.from_arrays(
                [pa.array([m[i] for m in made], f.type) for i, f in enumerate(schema)], schema=schema
            )

        for batch in batches:
            place = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()))
            vectors = matrix(batch.column(4)).astype(np.float64)
            number, ids = batch.column(3).to_pylist(), batch.column(5).to_pylist()
            at = 0
            while at < len(place):
                end = at
                while end < len(place) and place[end] == place[at]:
                    end += 1
                if place[at][:2] != key:
                    if best:
                        yield result()
                    key, numbers, points, best = place[at][:2], [], [], {}
                if place[at][2] == 0:
                    numbers += number[at:end]
                    points += list(vectors[at:end])
                else:
                    for q, point in zip(numbers, points):
                        near = squared(point, vectors[at:end])
                        close = np.argsort(near, kind="stable")[: k + 1]
                        old = best.get(q, [])
                        best[q] = sorted(old + [(near[j], v) for j in close for v in ids[at + j]])[: k + 1]
                at = end
        if best:
            yield result()

    return together.mapInArrow(task, ddl(columns))


def nearest(
    vectors: DataFrame, asked: str, k: int = K, tables: int = TABLES, recall: float = RECALL
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows found for each row of ``vectors`` where ``asked`` (SQL) holds.

    ``vectors`` has vec_id and embedding; the score is the Euclidean distance
    in double precision. Rows without an id and vectors that are null, empty,
    zero or hold null or non-finite components take no part; vectors of another
    length than most are an error. A row never finds its own id, repeated rows
    count once, ties go to smaller ids, and where there are ``k`` rows or fewer
    besides, all are found: queries that the buckets leave short are compared
    with all rows, in blocks. Other columns are not carried.
    """
    clean = vectors.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    clean = clean.select("vec_id", F.col("embedding").cast("array<float>").alias("vector"), F.expr(asked).alias("asked"))
    nodes = staged(nodes_of(clean, k), "nodes")
    shape = nodes.agg(F.min(F.size("vector")), F.max(F.size("vector")), F.count(F.lit(1))).first()
    spark = vectors.sparkSession
    if not shape[2]:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    if shape[0] != shape[1]:
        raise ValueError(f"vectors of {shape[0]} to {shape[1]} components")
    asking = clean.where("asked").select("vec_id", "vector").distinct()
    heads = nodes.select(F.col("node").alias("query_node"), F.col("vector").alias("query_vector"))
    queries = asking.join(heads, asking["vector"] == heads["query_vector"]).select(
        F.col("vec_id").alias("query_id"), "query_node"
    )
    queries = staged(queries, "queries")
    heads = heads.withColumnRenamed("query_vector", "vector").join(
        queries.select("query_node").distinct(), "query_node", "left_semi"
    )
    width = 2 << max(0, shape[0] - 1).bit_length()
    hashes = 1 if shape[2] < WIDE_BUCKET * width else 2
    turns = signs(shape[0], tables, hashes)
    probes = probes_needed(nodes, heads, turns, k, recall)
    index = keyed(nodes, turns, None, ["node", "vector", "ids"])
    probing = keyed(heads, turns, probes, ["query_node", "vector"])
    found = staged(nearest_of(compare_in_buckets(index, probing, k), k + 1), "found")

    # A query that has k others within reach needs k + 1 ids, as its own may be among them.
    total = nodes.select(F.sum(F.size("ids"))).first()[0]
    counted = found.groupBy("query_node").agg(F.count(F.lit(1)).alias("n"))
    short = heads.join(counted, "query_node", "left").where(F.coalesce("n", F.lit(0)) < min(k + 1, total))
    block: list[tuple[int, list[float]]] = []
    rest = []
    for r in short.select("query_node", "vector").toLocalIterator():
        block.append((r[0], list(r[1])))
        if len(block) == 1000:
            rest.append(staged(exact_nearest(nodes, block, k), "rest"))
            block = []
    if block:
        rest.append(staged(exact_nearest(nodes, block, k), "rest"))
    for more in rest:
        found = found.unionAll(more)
    if rest:
        found = nearest_of(found, k + 1)
    order = Window.partitionBy("query_id").orderBy("distance", "vec_id")
    named = queries.join(found, "query_node").where(F.col("vec_id") != F.col("query_id"))
    ranked = named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", F.col("distance").alias("score"))
