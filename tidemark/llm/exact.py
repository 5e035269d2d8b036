"""Exact de-duplication: frequent digests without a shuffle of their rows, the rest with one."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.lookup import lookup_join
from tidemark.session import staged

COUNTERS = 1024


def exact_dedup(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", counters: int = COUNTERS
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical; a null text counts as empty.  Of equal texts the row with
    the largest id stays (null ids are smaller than all others; of rows with the same id one
    stays).  Other columns of ``docs`` are ignored, an empty table gives no rows.

    Misra-Gries counters find every digest held by more than 2 / ``counters`` of all rows, and
    never more than ``counters`` digests.  Those are counted exactly where they lie, and their
    winners, at most ``counters`` rows, are broadcast.  All other digests are shuffled, reduced
    before and joined back, so that adaptive execution can split what is large; each has at most
    2 / ``counters`` of the rows.  Whole texts go into the digests, however long.
    """
    digest = F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))
    rows = staged(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            digest.alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )
    heavy = F.broadcast(frequent_digests(rows, counters))
    last = F.struct("doc_id", "row")
    winners = (
        rows.join(heavy, "digest", "left_semi")
        .groupBy("digest")
        .agg(F.max(last).alias("winner"), F.count("*").alias("group_size"))
    )
    hot = rows.join(F.broadcast(winners), "digest")
    light = rows.join(heavy, "digest", "left_anti")
    groups = light.groupBy("digest").agg(F.max(last).alias("winner"), F.count("*").alias("group_size"))
    rest = light.join(groups, "digest")
    return hot.unionByName(rest).select(
        "doc_id",
        F.col("winner.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("winner.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def frequent_digests(rows: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters`` digests, every one with over 2 / ``counters`` of the rows among them.

    A counter is at most rows / ``counters`` below the true count and never above it, so a sum
    of at least rows / ``counters`` is reached by all such digests and by few others.
    """
    sketches = rows.select("digest").mapInArrow(
        lambda batches: _misra_gries(batches, counters), "digest binary, seen long"
    )
    found = (
        sketches.groupBy("digest")
        .agg(F.sum("seen").alias("seen"))
        .where(F.col("seen") >= F.lit(max(2.0, rows.count() / counters)))
        .select("digest")
        .collect()  # at most ``counters``
    )
    return rows.sparkSession.createDataFrame([(bytes(r[0]),) for r in found], "digest binary")


def _misra_gries(batches: Iterator[pa.RecordBatch], counters: int) -> Iterator[pa.RecordBatch]:
    """Summaries merged batch by batch: what exceeds the counters is subtracted from all."""
    held: dict[bytes, int] = {}
    for batch in batches:
        for item in batch.column(0).value_counts():
            key = item["values"].as_py()
            held[key] = held.get(key, 0) + item["counts"].as_py()
        if len(held) > counters:
            over = sorted(held.values(), reverse=True)[counters]
            held = {key: count - over for key, count in held.items() if count > over}
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())],
        ["digest", "seen"],
    )


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns as they were.

    Rows are matched by id and digest; where several rows have both alike, one stays.  Texts are
    only shuffled where that is so.  An empty table stays empty.
    """
    found = exact_dedup(docs)
    key = pair_key(F.col("doc_id"), F.unhex("text_sha256"))
    return keep_rows(docs, found.select(key.alias("key"), "kept"))


def row_key(doc_id: Column, text: Column) -> Column:
    """Id and digest of a row as one value that is never null."""
    return pair_key(doc_id, text_sha(text))


def pair_key(doc_id: Column, sha: Column) -> Column:
    """``row_key`` from a digest that is known."""
    return F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary"), sha)


def keep_rows(docs: DataFrame, verdicts: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose ``row_key`` has a kept one among ``verdicts`` (``key, kept``).

    Of rows with one key, one stays.  The others are looked up and left out, so a row that is
    alone with its key stays where it is.
    """
    known = verdicts.groupBy("key").agg(F.count("*").alias("n"), F.bool_or("kept").alias("kept"))
    special = staged(known.where("n > 1 or not kept"), "verdicts")
    name = unused(docs, "key")
    keyed = docs.withColumn(name, row_key(F.col(doc_id), F.col(text)))
    named = special.withColumnRenamed("key", name)
    spread = [F.monotonically_increasing_id()]
    rest = lookup_join(keyed, named.select(name), [name], "left_anti", spread, wide=True)
    twice = lookup_join(keyed, named.where("kept").select(name), [name], "left_semi", spread, wide=True)
    return rest.drop(name).unionByName(one_of_each(twice, [name]).select(*docs.columns))


def unused(frame: DataFrame, name: str) -> str:
    """A column name like ``name`` that the frame does not have, whatever their case."""
    taken = {c.lower() for c in frame.columns}
    while name in taken:
        name += "_"
    return name


def text_sha(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def one_of_each(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each value of ``keys``."""
    if set(keys) == set(rows.columns):
        return rows.distinct()
    values, held = [c for c in rows.columns if c not in keys], unused(rows, "held")
    return rows.groupBy(*keys).agg(F.first(F.struct(*values)).alias(held)).select(*keys, f"{held}.*")
