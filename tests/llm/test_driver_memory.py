"""Tables that grow with the corpus are not broadcast, also where their files are small."""

import itertools

import pytest
from pyspark.sql import functions as F

from tidemark import session
from tidemark.llm import audit, components, exact, scoring, simhash
from tidemark.operators import lookup

WORDS = "the quick brown fox jumps over a lazy dog while rain falls on old stone roofs and a cat sleeps by the warm fire".split()


@pytest.fixture
def plans(monkeypatch):
    """With no table small, the plan of everything that is written, by label."""
    found = {}

    def staged(frame, label):
        found.setdefault(label, []).append(frame._jdf.queryExecution().executedPlan().toString())
        return session.staged(frame, label)

    monkeypatch.setattr(lookup, "BROADCAST_ROWS", -1)
    monkeypatch.setattr(components, "BROADCAST_ROWS", -1)
    for module in (audit, components, exact, scoring, simhash):
        monkeypatch.setattr(module, "staged", staged)
    return found


def copies(spark):
    """Texts in groups of near copies, some with copies of their own."""
    rows = []
    for group, at in itertools.product(range(6), range(8)):
        words = [f"{w}{group}" for w in WORDS * 3]
        words[at * 5 % 40] = f"other{at}"
        rows.append((len(rows) if at else None, " ".join(words), "en" if at % 2 else None))
    rows += [(100 + k, text, "en") for k, (_, text, _) in enumerate(rows[::9])]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3).persist()


def rows_of(frame):
    return sorted(str(r) for r in frame.collect())


def test_near_copies(spark, plans, monkeypatch):
    docs = copies(spark)
    found = rows_of(simhash.first_of_each_group(docs))
    for label in ("prints", "members", "sets", "centres", "slacks", "met", "asked", "edges"):
        bad = [p for p in plans[label] if any("BroadcastHashJoin" in x and "_block" not in x for x in p.split("\n"))]
        assert not bad, (label, bad[0])
    monkeypatch.undo()
    assert found == rows_of(simhash.first_of_each_group(docs)) and len(found) < docs.count()


def test_audit(spark, plans, monkeypatch):
    docs = copies(spark)
    labels = docs.select("doc_id", F.lit(1).alias("quality"), (F.col("doc_id") % 2).alias("toxic"))
    facts = audit.document_facts(docs, labels)
    found = rows_of(audit.filter_interactions(facts, audit.failing_ids(facts)))
    for label in ("members", "failing-E", "cells"):
        assert not [p for p in plans[label] if "BroadcastHashJoin" in p], label
    monkeypatch.undo()
    facts = audit.document_facts(docs, labels)
    assert found == rows_of(audit.filter_interactions(facts, audit.failing_ids(facts)))


def test_scores(spark, plans, monkeypatch):
    docs = copies(spark).unionByName(copies(spark).where("doc_id % 3 = 0"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("quality")).where("doc_id % 5 > 0 OR doc_id IS NULL")
    monkeypatch.setattr(scoring, "CHUNK", 4096)
    found = rows_of(scoring.quality_scores(docs, labels))
    assert not [p for p in plans["marks"] if "BroadcastHashJoin" in p]
    # Texts are chunked where they lie.
    assert not [p for p in plans["chunks"] if "Join" in p]
    good = {r.doc_id for r in labels.where("quality = 1").collect()} - {None}
    marked = scoring.cross_entropy_difference(docs, F.col("doc_id").isin(*good))
    assert found == rows_of(marked) and "in_target=True" in "".join(found)
