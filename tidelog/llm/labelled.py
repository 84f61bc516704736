"""Bounded samples of labelled documents, from which classifiers are fitted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import remainder

#: Rows whose crc32(doc_id) by this leaves 0 are held out: no label of theirs is read.
HELD_OUT = 5


def learnable(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """doc_id and label (0 or 1) of the labelled documents that are not held out.

    A doc_id labelled more than once counts as 0 if any of its labels is 0;
    labels that are null or neither 0 nor 1, and labels without a document,
    are left out.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & (remainder("doc_id", HELD_OUT) != 0))
    known = known.groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
    return known.join(docs.select("doc_id"), "doc_id", "left_semi")


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int
) -> tuple[DataFrame, dict[int, int]]:
    """doc_id, label, text of at most ``per_class`` documents a class, and the count of each class.

    The choice follows a hash of the id, so it is the same in every run. Of
    several rows of one doc_id the least text is taken.
    """
    known = learnable(docs, labels, label).persist()
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    chosen = [
        known.where(F.col("label") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for v in (0, 1)
    ]
    # At most 2 * per_class rows: small enough to send to every task.
    ids = docs.sparkSession.createDataFrame(
        [tuple(r) for c in chosen for r in c.collect()], "doc_id bigint, label int"
    )
    known.unpersist()
    texts = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    return texts.groupBy("doc_id", "label").agg(F.min("text").alias("text")), counts
