"""Every query and stage on empty tables, on null rows, and beside columns of its helpers' names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import queries

CLASHING = ["_u", "_sha", "_key", "_salt", "_row", "_cdf", "_source", "copies", "rate", "copy", "shuffle_key", "key",
            "held", "row", "sha", "node", "clump", "same", "bands", "n", "kept", "part", "own", "chance", "RATE_", "leaf"]
TABLES = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "labels": "doc_id long, quality int, toxic int",
    "pages": "page_id long, url string, html string",
    "conversations": "conv_id long, turn int, role string, text string",
    "embeddings": "vec_id long, embedding array<float>",
}
WORDS = "the and of to in that is was for it with as his on be at by from or an were are".split()
ROWS = [(n, " ".join(WORDS[n % 5 :] * (1 + n % 3)), "en", f"s{n % 2}", n) for n in range(12)]
ROWS += [(3, ROWS[3][1], "en", "s0", None), (3, ROWS[3][1], "en", "s0", None), (None, ROWS[4][1], None, None, None),
         (None, None, None, None, None), (20, "", "en", "s0", 0), (21, None, "en", "s1", None)]


def with_columns(frame):
    return frame.select("*", *[F.lit(f"own {name}").alias(name) for name in CLASHING])


def folder_of(spark, root, kind):
    for name, schema in TABLES.items():
        nulls = [(None,) * len(schema.split(", "))] * 2
        given = {"empty": [], "null": nulls, "rows": ROWS if name == "documents" else nulls}[kind]
        with_columns(spark.createDataFrame(given, schema)).write.parquet(f"{root}/{name}.parquet")
    return str(root)


@pytest.mark.parametrize("kind", ["empty", "null"])
def test_queries_without_values(spark, tmp_path, kind):
    folder = folder_of(spark, tmp_path, kind)
    for name, query in queries.QUERIES.items():
        rows = query(spark, folder).collect()
        if kind == "empty":
            # The conversation that its query adds is there.
            assert len(rows) == (name == "op1_chat_windows"), name


@pytest.mark.parametrize("kind", ["empty", "null", "rows"])
def test_stages_keep_columns(spark, tmp_path, kind):
    folder = folder_of(spark, tmp_path, kind)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, folder)
        rows = after.collect()
        if name == "pack":
            continue
        assert after.columns == docs.columns, name
        assert all(r[c] == f"own {c}" for r in rows for c in CLASHING), name
        if kind == "rows":
            known = {(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in docs.collect()}
            assert rows and {(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in rows} <= known, name
        docs = after if kind == "rows" else docs
    if kind == "empty":
        assert corpus_pipeline.run(spark, folder).count() == 0
