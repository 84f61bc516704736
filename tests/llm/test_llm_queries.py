"""The registered queries and the pipeline, on the smallest tables."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.compare import connect, spark_side, sql_side
from tests.conftest import SF_DIR
from tidelog.llm.common import new_folder, table
from tidelog.llm.decontamination import contamination_report
from tidelog.llm.queries import ORACLES, QUERIES
from tidelog.llm.secrets import MARK


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    ours = spark_side(QUERIES[name](spark, SF_DIR))
    if name in ORACLES:
        theirs = sql_side(connect(SF_DIR), ORACLES[name])
        assert ours[0] == theirs[0] and ours[3] == theirs[3]
    elif name.startswith("op10"):
        assert ours[1] == 50
    else:
        assert ours[1] >= 200


def test_pipeline_stages(spark):
    documents = table(spark, SF_DIR, "documents")
    docs, kept = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        path = new_folder(spark, name)
        before = docs
        stage(spark, docs, SF_DIR).write.parquet(path)
        docs = spark.read.parquet(path)
        kept[name] = docs
        if name != "packing":
            assert docs.columns == documents.columns
            assert docs.join(before, "doc_id", "left_anti").count() == 0
    labels = table(spark, SF_DIR, "labels")
    good = documents.join(labels.where("quality = 1"), "doc_id")
    assert good.join(kept["quality"], "doc_id", "left_semi").count() >= 0.95 * good.count()
    texts = kept["near_duplicates"].groupBy("text").count()
    assert texts.where("count > 1").count() == 0
    hits = contamination_report(kept["decontamination"], table(spark, SF_DIR, "benchmark"))
    assert hits.where("contaminated").count() == 0
    masked = kept["secrets"].where(f"text like '%{MARK}%'")
    assert masked.where("length(text) <> n_chars").count() == 0
    assert kept["secrets"].where(r"text rlike 'AKIA[A-Z0-9]{16}|[0-9a-f]{24}'").count() == 0
    whole = kept["packing"].groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert len(whole) == kept["secrets"].count() and all(r[1] == r[2] for r in whole)
