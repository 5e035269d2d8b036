"""How filters interact: relations of failing ids, split by left-semi and left-anti joins.

Every filter is one stored table of the ids that fail it.  The rows are split by one table after
the other into those in it and those not, which leaves one cell for each set of filters that a
row fails; a prefix of an order of filters keeps the rows of the cells without any of them.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.exact import text_sha
from tidemark.operators.lookup import fits_broadcast, lookup_join
from tidemark.session import staged

# n filters have n! orders, each with a row per step.
MOST_FILTERS = 7


def document_facts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A written table with ``row, part, good, toxic`` and what the filters ask about a text.

    ``part`` is the language (null: empty); ``good`` and ``toxic`` say whether any label of the
    id has ``quality`` or ``toxic`` 1.  Texts are read once and whole; null counts as empty.  A null
    id has no labels, rows with one id are rows of their own, other columns are ignored, and
    without documents the table is empty.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    # Null ids have no labels; ids labelled several times are reduced before they are joined.
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(
        F.bool_or(F.col("quality") == 1).alias("good"),
        F.bool_or(F.col("toxic") == 1).alias("toxic"),
    )
    split = docs.select(
        F.col("doc_id").alias("id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        text_sha(F.col("text")).alias("sha"),
        F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), "").alias("words"),
        text.alias("text"),
    )
    read = staged(
        split.select(
            F.monotonically_increasing_id().alias("row"),
            "id",
            "part",
            "sha",
            F.size("words").cast("long").alias("words"),
            F.size(F.array_distinct("words")).cast("long").alias("distinct_words"),
            F.length("text").cast("long").alias("characters"),
            F.regexp_count("text", F.lit("[A-Z]")).cast("long").alias("capitals"),
            F.col("text").rlike("[#$%&*|]").alias("symbols"),
        ),
        "facts",
    )
    flags = staged(known, "label-flags")
    return staged(lookup_join(read, flags, ["id"], "left", []).na.fill(False, ["good", "toxic"]), "members")


def failing_ids(facts: DataFrame) -> dict[str, DataFrame]:
    """The written id table (``row``) of each of five filters, in their order.

    A: fewer than 100 words.  B: distinct words under 80 % of the words.  C: capital letters over
    10 % of the characters.  D: one of ``#$%&*|``.  E: the text of a row with a smaller id, in
    whatever part, kept or not (rows without an id neither fail it nor make others fail).
    """
    failed = {
        "A": facts.where(F.col("words") < 100),
        "B": facts.where(100 * F.col("distinct_words") < 80 * F.col("words")),
        "C": facts.where(100 * F.col("capitals") > 10 * F.col("characters")),
        "D": facts.where("symbols"),
        "E": _repeated(facts),
    }
    return {name: staged(rows.select("row"), f"failing-{name}") for name, rows in failed.items()}


def _repeated(facts: DataFrame) -> DataFrame:
    """Rows whose text a smaller id has; texts held once are not looked up."""
    least = facts.groupBy("sha").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most")
    found = lookup_join(facts, staged(least.drop("most"), "repeated"), ["sha"], "inner", [F.col("row")])
    return found.where("id > least")


def failure_cells(members: DataFrame, failing: dict[str, DataFrame], key: str = "row") -> DataFrame:
    """``members`` and ``failed``: the number whose bit n says that the row fails filter n.

    Each table splits the rows by a left-semi and a left-anti join on the unique key.  A split is
    written before the next, so the plan stays short; rows never multiply.  Tables are
    broadcast only if they are measured to be small.
    """
    cells = members.withColumn("failed", F.lit(0))
    for bit, ids in enumerate(failing.values()):
        wanted = ids.select(key)
        small = fits_broadcast(wanted)
        inside = lookup_join(cells, wanted, [key], "left_semi", [], small)
        inside = inside.withColumn("failed", F.col("failed") + F.lit(1 << bit))
        cells = staged(inside.unionByName(lookup_join(cells, wanted, [key], "left_anti", [], small)), "cells")
    return cells


def filter_interactions(members: DataFrame, failing: dict[str, DataFrame], key: str = "row") -> DataFrame:
    """What each filter does at each step of every order, for each part of the rows.

    ``members`` has ``key`` (unique and not null), ``part``, ``good`` and ``toxic``; ``failing``
    a table of keys per filter (one letter each; repeated keys and keys of no member do nothing).
    Returns ``part, filter_order, step`` and ``kept`` (after the step), ``removed`` (in it),
    ``redundant`` (failing its filter, removed before), ``unique_fails`` (failing no other),
    ``good_lost`` and ``toxic_lost`` (removed in it), and ``shapley`` (removed by its filter,
    summed over all orders).  Zeros are rows as well; without members there are none.

    Rows are reduced to one count per part and cell where they lie; everything after that is a
    table of at most 2^n cells a part.
    """
    if not 0 < len(failing) <= MOST_FILTERS:
        raise ValueError(f"between 1 and {MOST_FILTERS} filters")
    names = list(failing)
    cells = failure_cells(members.select(key, "part", "good", "toxic"), failing, key)
    counts = staged(
        cells.groupBy("part", "failed").agg(
            F.count("*").alias("rows"),
            F.sum(F.col("good").cast("long")).alias("good"),
            F.sum(F.col("toxic").cast("long")).alias("toxic"),
        ),
        "cell-counts",
    )
    # A filter and the set of filters before it: the order within the set changes nothing.
    last = len(names) - 1
    turns = [
        F.struct(
            F.lit(bit).alias("filter"),
            F.lit(before).alias("before"),
            F.lit(factorial(before.bit_count()) * factorial(last - before.bit_count())).cast("long").alias("orders"),
        )
        for bit in range(len(names))
        for before in range(1 << len(names))
        if not before >> bit & 1
    ]
    each = counts.select("*", F.inline(F.array(*turns)))
    own = F.expr("shiftleft(1, filter)")
    fails = F.col("failed").bitwiseAND(own) != 0
    gone = F.col("failed").bitwiseAND(F.col("before")) != 0

    def total(when: Column, of: str = "rows") -> Column:
        return F.sum(F.when(when, F.col(of)).otherwise(F.lit(0)))

    steps = each.groupBy("part", "filter", "before", "orders").agg(
        total(~gone & ~fails).alias("kept"),
        total(fails & ~gone).alias("removed"),
        total(fails & gone).alias("redundant"),
        total(F.col("failed") == own).alias("unique_fails"),
        total(fails & ~gone, "good").alias("good_lost"),
        total(fails & ~gone, "toxic").alias("toxic_lost"),
    )
    values = staged(steps, "steps")
    shares = values.groupBy("part", "filter").agg(F.sum(F.col("removed") * F.col("orders")).alias("shapley"))
    spark = members.sparkSession
    placed = spark.createDataFrame(
        [
            ("".join(names[k] for k in order), step + 1, order[step], reduce(lambda a, k: a | 1 << k, order[:step], 0))
            for order in permutations(range(len(names)))
            for step in range(len(names))
        ],
        "filter_order string, step int, filter int, before int",
    )
    # One row per order and step: n * n! of them, whatever the size of the tables.
    return (
        values.join(shares, ["part", "filter"])
        .join(F.broadcast(placed), ["filter", "before"])
        .select(
            "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
            "toxic_lost", "shapley",
        )
    )


# The same numbers from the definitions: every order applied to every document.
AUDIT_SQL = """
WITH texts AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
        list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words,
        row_number() OVER () AS n
    FROM documents
), judged AS (
    SELECT n, part, len(words) < 100 AS a, 100 * len(list_distinct(words)) < 80 * len(words) AS b,
        100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text) AS c,
        regexp_matches(text, '[#$%&*|]') AS d,
        coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS e,
        doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) AS good,
        doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL) AS toxic
    FROM texts
), fails AS (
    SELECT part, map {'A': a, 'B': b, 'C': c, 'D': d, 'E': e} AS f, coalesce(good, false) AS good,
        coalesce(toxic, false) AS toxic, a::INT + b::INT + c::INT + d::INT + e::INT AS failed, count(*) AS rows
    FROM judged GROUP BY ALL
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
    SELECT p.x || q.x || r.x || s.x || t.x AS filter_order
    FROM letters p, letters q, letters r, letters s, letters t
    WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5
), steps AS (
    SELECT filter_order, CAST(k AS INT) AS step, substr(filter_order, CAST(k AS INT), 1) AS letter,
        string_split(substr(filter_order, 1, CAST(k AS INT) - 1), '') AS before
    FROM orders, (SELECT unnest(range(1, 6)) AS k)
), counted AS (
    SELECT part, filter_order, step, letter,
        sum(rows) FILTER (NOT f[letter] AND NOT gone) AS kept, sum(rows) FILTER (f[letter] AND NOT gone) AS removed,
        sum(rows) FILTER (f[letter] AND gone) AS redundant, sum(rows) FILTER (f[letter] AND failed = 1) AS unique_fails,
        sum(rows) FILTER (f[letter] AND NOT gone AND good) AS good_lost,
        sum(rows) FILTER (f[letter] AND NOT gone AND toxic) AS toxic_lost
    FROM (SELECT *, len(list_filter(before, lambda x: x <> '' AND f[x])) > 0 AS gone FROM fails, steps)
    GROUP BY part, filter_order, step, letter
)
SELECT part, filter_order, step, CAST(coalesce(kept, 0) AS BIGINT) AS kept,
    CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
    CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
    CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
    CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM counted
"""
