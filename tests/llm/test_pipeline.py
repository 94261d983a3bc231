"""The pipeline and the registered queries at the smallest scale."""

import collections

import pytest

import corpus_pipeline
from suite import check
from tests.llm.test_operators import brute_components
from zonal.llm.oracle import ORACLE
from zonal.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_stages_by_their_inputs(spark, tmp_path):
    """Every stage works on what the one before kept, keeps the columns, and does its part."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, kept = docs.columns, {}
    for k, (name, step) in enumerate(corpus_pipeline.STAGES):
        out = step(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept[name] = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        if name != "sharding":
            assert docs.columns == names
    labels = {r[0]: r[1] for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality").collect()}
    good = {i for i, _ in kept["quality_classifier"]}
    assert sum((i in good) == (q == 1) for i, q in labels.items()) >= 0.95 * len(labels)
    components = brute_components(kept["quality_classifier"])
    assert {i for i, _ in kept["near_deduplication"]} == {i for i, n, c in components if n == 0 or c == i}
    assert set(kept["benchmark_decontamination"]) <= set(kept["near_deduplication"])
    times = collections.Counter(kept["source_mixing"])
    assert set(times) <= set(kept["benchmark_decontamination"]) and max(times.values()) <= 2
    assert collections.Counter(kept["sharding"]) == times
    sizes = collections.Counter(r[0] for r in docs.select("shard").collect())
    assert max(sizes.values()) - min(sizes.values()) <= 1


@pytest.mark.parametrize("step", corpus_pipeline.STAGES, ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_an_empty_table(spark, step):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    assert step[1](spark, docs, SF).count() == 0


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_agrees_with_its_sql(spark, name, monkeypatch):
    monkeypatch.setattr(check, "QUERIES", QUERIES)
    monkeypatch.setattr(check, "ORACLE", ORACLE)
    assert check.compare(spark, check.database(SF), name, SF) == ""
