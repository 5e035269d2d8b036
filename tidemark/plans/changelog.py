"""What changed between two versions of a dataset, or between any two tables of observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.dedup import keep_first
from tidemark.operators.merge import KEYS
from tidemark.plans.layout import DatasetLayout
from tidemark.plans.versions import read_version
from tidemark.schemas import COMMIT_LOG, MANIFEST
from tidemark.session import read_table

FACTS = ("unit", "frequency")
CHANGES = ("added", "removed", "changed")


def changelog(
    old: DataFrame,
    new: DataFrame,
    keys: list[str] | None = None,
    value: str = "value",
    facts: tuple[str, ...] = FACTS,
    unique: bool = False,
    order: str | None = None,
) -> DataFrame:
    """``keys, change, old_value, new_value, facts_changed`` for every key that differs.

    ``change`` is added, removed or changed: the value differs, or one of ``facts``, which are
    compared by a hash of 128 bits.  Null and NaN equal themselves, null keys each other.  Of
    several rows with one key the first by ``order`` counts (without one, by all columns), unless
    both sides are known to be ``unique``.  Either side may be empty.

    Both sides meet in one grouping of fixed-width columns, so nothing is sorted and copies are
    reduced before the shuffle; rows that are the same on both sides end there.
    """
    keys = keys or KEYS
    if unknown := {value, *facts, *keys} - {*old.columns} | {value, *facts, *keys} - {*new.columns}:
        raise ValueError(f"columns {sorted(unknown)} are not in both tables")
    both = _side(old, 0, keys, value, facts, unique, order).unionByName(
        _side(new, 1, keys, value, facts, unique, order)
    )

    def at(side: int, name: str):
        return F.max(F.when(F.col("side") == side, F.col(name)))

    met = both.groupBy(*keys).agg(
        F.bool_or(F.col("side") == 0).alias("was"),
        F.bool_or(F.col("side") == 1).alias("is"),
        at(0, "seen").alias("old_value"),
        at(1, "seen").alias("new_value"),
        *[at(side, f"facts{n}").alias(f"facts{n}_{side}") for side in (0, 1) for n in (0, 1)],
    )
    facts_changed = (F.col("facts0_0") != F.col("facts0_1")) | (F.col("facts1_0") != F.col("facts1_1"))
    differs = ~F.col("old_value").eqNullSafe(F.col("new_value")) | facts_changed
    change = F.when(~F.col("was"), "added").when(~F.col("is"), "removed").when(differs, "changed")
    return met.withColumn("change", change).where(F.col("change").isNotNull()).select(
        *keys,
        "change",
        "old_value",
        "new_value",
        F.coalesce(facts_changed, F.lit(False)).alias("facts_changed"),
    )


def _side(rows, side, keys, value, facts, unique, order) -> DataFrame:
    if not unique:
        ranks = [order] if order else [value, *facts]
        rows = keep_first(rows.select(*dict.fromkeys([*keys, value, *facts, *ranks])), keys, ranks)
    # A null and an empty text are different facts.
    shown = [F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit("null")) for name in facts]
    return rows.select(
        *keys,
        F.col(value).alias("seen"),
        F.xxhash64(F.lit(1), *shown).alias("facts0"),
        F.xxhash64(F.lit(2), *shown).alias("facts1"),
        F.lit(side).alias("side"),
    )


def previous_version(spark: SparkSession, layout: DatasetLayout, version_id: str) -> str | None:
    """The version committed before ``version_id``; None for the first one or an unknown one."""
    log = read_table(spark, layout.commit_log, COMMIT_LOG).where(F.trim("version_id") != "")
    firsts = log.groupBy("version_id").agg(F.min("commit_seq").alias("seq"))
    own = firsts.where(F.col("version_id") == version_id).select(F.col("seq").alias("own"))
    before = firsts.join(F.broadcast(own), F.col("seq") < F.col("own"))
    return before.agg(F.max_by("version_id", "seq")).first()[0]


def version_changelog(
    spark: SparkSession, layout: DatasetLayout, version_id: str, against: str | None = None
) -> DataFrame:
    """The changes that a version makes to the one before it (or to ``against``).

    The first version of a dataset adds all its rows.
    """
    old_id = against or previous_version(spark, layout, version_id)
    new = read_version(spark, layout, version_id)
    old = new.limit(0) if old_id is None else read_version(spark, layout, old_id)
    ids = [one for one in (version_id, old_id) if one is not None]
    manifests = spark.read.schema(MANIFEST).json([layout.manifest(one) for one in ids])
    unique = manifests.agg(F.bool_and(F.coalesce("unique_keys", F.lit(False)))).first()[0]
    return changelog(old, new, unique=bool(unique), order="ord")


def change_counts(changes: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Per series (or ``by``): ``added, removed, changed``."""
    counts = [F.count_if(F.col("change") == kind).alias(kind) for kind in CHANGES]
    return changes.groupBy(*(by or [KEYS[1]])).agg(*counts)
