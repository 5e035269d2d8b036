"""The pipeline against its stages' definitions, and the queries with SQL."""

import oracle
import pytest

import corpus_pipeline
from tidemark.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    assert oracle.difference(queries.QUERIES[name](spark, SF), oracle.connect(SF), queries.SQL[name]) is None


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        after = stage(spark, kept, SF)
        assert after.columns == docs.columns and after.count() <= kept.count(), name
        kept = after
    texts = [r.text for r in kept.select("text").collect()]
    assert len(set(texts)) == len(texts)
    mixed = corpus_pipeline.mix_sources(spark, kept, SF)
    assert set(r.doc_id for r in mixed.select("doc_id").collect()) <= {r.doc_id for r in kept.collect()}
    packed = corpus_pipeline.pack(spark, mixed, SF).toPandas()
    whole = packed[packed.start == 0]
    assert len(whole) == mixed.count()
