"""First-write-wins merging of new rows into a projection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dedup import keep_first
from tidemark.operators.lookup import fits_broadcast, lookup_join
from tidemark.session import staged

KEYS = ["obs_time", "internal_series_code"]


def touched_only(
    projection: DataFrame,
    partitions: DataFrame,
    by: list[str],
    spread: list[str],
    small: bool | None = None,
) -> DataFrame:
    """Projection rows in the given partitions; a small list prunes folders while scanning."""
    return lookup_join(projection, partitions.select(*by), by, "left_semi", spread, small)


def merge_first_wins(
    projection: DataFrame,
    incoming: DataFrame,
    keys: list[str] | None = None,
    order: str | None = None,
) -> DataFrame:
    """Union, keeping the first row per key: projection rows win, then ``order``.

    ``keys`` are the instant (or its ISO text, for published files) and the series code.
    """
    return keep_first(
        _turns(projection, 0).unionByName(_turns(incoming, 1), allowMissingColumns=True),
        keys or KEYS,
        ["_turn", order] if order else ["_turn"],
    ).drop("_turn")


def _turns(rows: DataFrame, turn: int) -> DataFrame:
    return rows.withColumn("_turn", F.lit(turn))


def unseen_rows(
    projection: DataFrame,
    incoming: DataFrame,
    keys: list[str] | None = None,
    order: str | None = None,
    unique: bool = False,
    null_keys: bool = True,
) -> DataFrame:
    """The rows a first-write-wins merge would add: first per key and not in the projection.

    Only the key columns of the projection are read.  Incoming rows known to be ``unique``
    skip their own de-duplication.  Where keys are never null, plain equality lets the join
    reuse the partitioning of the de-duplication.
    """
    keys = keys or KEYS
    firsts = incoming if unique else keep_first(incoming, keys, [order] if order else keys)
    known = projection.select(*keys).distinct()  # copies of one key would meet in one task
    if not null_keys:
        return firsts.join(known, keys, "left_anti")
    left, right = firsts.alias("new"), known.alias("old")
    same = [F.col(f"new.{key}").eqNullSafe(F.col(f"old.{key}")) for key in keys]
    return left.join(right, reduce(Column.__and__, same), "left_anti")


def merge_outcome(
    projection: DataFrame, incoming: DataFrame, keys: list[str] | None = None, order: str | None = None
) -> DataFrame:
    """The first incoming row of every key, and what a first-write-wins merge makes of it.

    Besides the row's columns there are ``is_stored`` and ``stored_value`` (of the projection's
    row with the key), and ``batch_rows, least_value, largest_value`` of all incoming rows with
    it; null values do not count for these two.  ``added_rows`` and ``refused_rows`` read it, so
    write it once: both come from the shuffle by key that the merge needs anyway, and copies of a
    key are reduced before it.  Null keys are equal to each other.
    """
    keys = keys or KEYS
    rest = [name for name in incoming.columns if name not in keys]
    rank = F.struct(order) if order else F.struct(*rest)
    firsts = incoming.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), rank).alias("_first"),
        F.count("*").alias("batch_rows"),
        F.min("value").alias("least_value"),
        F.max("value").alias("largest_value"),
    )
    known = projection.groupBy(*keys).agg(
        F.first("value").alias("stored_value"), F.lit(True).alias("is_stored")
    )
    left, right = firsts.alias("new"), known.alias("old")
    same = [F.col(f"new.{key}").eqNullSafe(F.col(f"old.{key}")) for key in keys]
    return left.join(right, reduce(Column.__and__, same), "left").select(
        *[F.col(f"new.{key}") for key in keys],
        "_first.*",
        F.coalesce("is_stored", F.lit(False)).alias("is_stored"),
        "stored_value",
        "batch_rows",
        "least_value",
        "largest_value",
    )


def added_rows(outcome: DataFrame) -> DataFrame:
    """The rows that the merge adds."""
    extra = ("is_stored", "stored_value", "batch_rows", "least_value", "largest_value")
    return outcome.where(~F.col("is_stored")).drop(*extra)


def refused_rows(outcome: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row per key with another value than the one that stays.

    ``stored_value`` is the value that stays: the projection's (``is_stored``) or that of the
    key's first incoming row.  ``refused_value`` is the first incoming row's, if the projection
    had the key; the rest says which values the batch had.  Values are compared with null and NaN
    equal to themselves, so repeating what is stored is no conflict.
    """
    differs = ~F.col("value").eqNullSafe(F.col("stored_value"))
    within = ~F.col("least_value").eqNullSafe(F.col("largest_value"))
    found = outcome.where(F.when(F.col("is_stored"), differs | within).otherwise(within))
    stays = F.when(F.col("is_stored"), F.col("stored_value")).otherwise(F.col("value"))
    refused = F.when(F.col("is_stored") & differs, F.col("value"))
    return found.select(
        *(keys or KEYS),
        stays.alias("stored_value"),
        refused.alias("refused_value"),
        "batch_rows",
        "least_value",
        "largest_value",
        "is_stored",
    )


def merge_as_published(
    projection: DataFrame,
    incoming: DataFrame,
    by: list[str],
    keys: list[str] | None = None,
    order: str | None = None,
) -> DataFrame:
    """Merge where a partition found on one side only passes through, duplicates included.

    ``by`` are the partition columns.  Which partitions are shared is a small table of its
    own (written once, since four joins read it), so the rows of a large partition are never
    brought together to find out.
    """
    shared = staged(
        projection.select(*by).distinct().join(incoming.select(*by).distinct(), by), "shared"
    )
    spread = keys or KEYS
    few = fits_broadcast(shared)

    def split(rows: DataFrame, how: str) -> DataFrame:
        return lookup_join(rows, shared, by, how, spread, few)

    merged = merge_first_wins(
        split(projection, "left_semi"), split(incoming, "left_semi"), keys, order
    )
    return merged.unionByName(split(projection, "left_anti"), allowMissingColumns=True).unionByName(
        split(incoming, "left_anti"), allowMissingColumns=True
    )
