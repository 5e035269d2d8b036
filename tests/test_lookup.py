"""Joins whose table is not small: Spark must not broadcast it, whatever its files weigh."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import lookup
from tidemark.operators.lookup import key_side, lookup_join


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def tables(spark, folder):
    sha = F.unhex(F.sha2(F.col("key").cast("string"), 256)).alias("k")
    facts = spark.range(3000).select("id", F.expr("if(id % 3 = 0, 7, id % 500)").alias("key"))
    facts = facts.withColumn("key", F.expr("if(id % 11 = 0, null, key)"))
    # Names that the join uses itself.
    facts = facts.select(sha, "id", F.lit("t").alias("_salt"), F.lit("m").alias("_maybe"), F.lit(1).alias("_block"))
    spark.range(0, 600, 7).withColumnRenamed("id", "key").select(sha).write.parquet(f"{folder}/table")
    return facts, spark.read.parquet(f"{folder}/table")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("options", [{"spread": ["id"]}, {"spread": []}, {"spread": ["id"], "wide": True}])
def test_tables_that_are_not_small_are_shuffled(spark, folder, monkeypatch, how, options):
    if how == "left" and "wide" in options:
        pytest.skip("wide is for rows that are in the table or not")
    facts, table = tables(spark, folder)
    fast = lookup_join(facts, table, ["k"], how, **options)
    assert "BroadcastHashJoin" in plan_of(fast)
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 10)
    slow = lookup_join(facts, table, ["k"], how, **options)
    plan = plan_of(slow)
    assert "SortMergeJoin" in plan
    joins = [line for line in plan.split("\n") if "BroadcastHashJoin" in line]
    assert all("_block" in line for line in joins), joins  # the sieve
    assert fast.columns == slow.columns
    assert sorted(map(str, fast.collect())) == sorted(map(str, slow.collect()))


@pytest.mark.parametrize("blocks", [1, 8192])
def test_a_sieve_lets_every_row_of_the_table_through(spark, folder, monkeypatch, blocks):
    monkeypatch.setattr(lookup, "BLOCK_BITS", 256)
    monkeypatch.setattr(lookup, "SIEVE_BLOCKS", blocks)
    facts, table = tables(spark, folder)
    judged = lookup._sieved(facts, table, ["k"], "maybe").cache()
    assert judged.count() == facts.count()
    assert judged.where(~F.col("maybe")).join(table, "k", "left_semi").count() == 0
    if blocks > 1:
        held = facts.join(table, "k", "left_semi").count()
        assert held <= judged.where("maybe").count() < held + (facts.count() - held) / 10


def test_sides_of_a_join_are_broadcast_only_if_few(spark, folder, monkeypatch):
    facts, table = tables(spark, folder)
    assert "BroadcastHashJoin" in plan_of(facts.join(key_side(table), "k"))
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 10)
    for how in ("inner", "left", "left_semi"):
        assert "Broadcast" not in plan_of(facts.join(key_side(table), "k", how))
    assert "Broadcast" not in plan_of(facts.join(key_side(table, few=False), "k"))
