"""Checks of what merges left behind, and versions that were never committed."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.merge import KEYS
from tidemark.plans.files import file_records, file_statistics, recorded_files, stored_files
from tidemark.plans.layout import DatasetLayout
from tidemark.plans.versions import new_version_id, read_stored, read_versions
from tidemark.schemas import COMMIT_LOG, PARTITION_COLUMNS
from tidemark.session import folder_names, list_files, read_table, remove_path, staged, work_folder

# Versions read in one plan.
AT_ONCE = 32
VERSION_ID = "v[0-9]{8}_[0-9]{6}_[0-9]{6}"


def audit_merges(spark: SparkSession, layout: DatasetLayout) -> DataFrame:
    """Every noted merge held against the versions it brought in.

    ``version_id`` (its last version), ``turn``, ``versions``, ``rows_in`` (rows of the versions),
    ``repeated`` (further rows with a key of the merge), ``known`` (keys that a merge before had),
    ``added`` (points the projection got, from the records) and ``whole``: rows_in = added +
    repeated + known, and the keys to be added have the same order-independent sum of hashes as
    those that were.  The first three come from the versions alone.  A dataset whose first merges
    were not noted is not whole from then on.  Nothing noted: no rows.

    Versions are reduced to one row per key and merge, ``AT_ONCE`` of them in a plan; a key has at
    most as many rows as there are merges, and these are reduced to the first one before joining.
    """
    records = file_records(spark, layout)
    merges = records.where("change = 0").select("version_id", "turn", "merged_id")
    turns = [tuple(r) for r in merges.select("merged_id", "turn").orderBy("turn").collect()]  # one per version
    schema = "obs_time timestamp, internal_series_code string, turn bigint, n bigint"
    met = spark.createDataFrame([], schema)
    if turns:
        path = work_folder(spark, "audit")
        for at in range(0, len(turns), AT_ONCE):
            rows = read_versions(spark, layout, dict(turns[at : at + AT_ONCE]), None)
            counted = rows.groupBy(*KEYS, F.col("commit_seq").cast("bigint").alias("turn")).agg(F.count("*").alias("n"))
            counted.write.mode("append").parquet(path)
        met = spark.read.schema(schema).parquet(path)
    # A merge of many versions may have been cut between two plans.
    met = met.groupBy(*KEYS, "turn").agg(F.sum("n").alias("n"))
    first = met.groupBy(*KEYS).agg(F.min("turn").alias("first"))
    is_first = F.col("turn") == F.col("first")
    key_hash = F.xxhash64(*KEYS).cast("decimal(38,0)")
    of_versions = met.join(first, KEYS).groupBy("turn").agg(
        F.sum("n").alias("rows_in"),
        F.sum(F.col("n") - 1).alias("repeated"),
        F.count_if(~is_first).alias("known"),
        F.sum(F.when(is_first, key_hash)).cast("decimal(38,0)").alias("wanted_sum"),
    )
    of_files = records.where("change <> 0").groupBy("turn").agg(
        F.sum(F.col("points") * F.col("change")).alias("added"),
        F.sum(F.col("key_sum") * F.col("change")).cast("decimal(38,0)").alias("added_sum"),
    )
    named = merges.groupBy("version_id", "turn").agg(F.count("*").alias("versions"))
    both = named.join(of_versions, "turn", "left").join(of_files, "turn", "left")
    both = both.na.fill(0, ["rows_in", "repeated", "known", "added"])
    zero = F.lit(0).cast("decimal(38,0)")
    same = F.coalesce("wanted_sum", zero) == F.coalesce("added_sum", zero)
    adds_up = F.col("rows_in") == F.col("added") + F.col("repeated") + F.col("known")
    return both.withColumn("whole", same & adds_up).select(
        "version_id", "turn", "versions", "rows_in", "repeated", "known", "added", "whole"
    )


def damaged_files(spark: SparkSession, layout: DatasetLayout) -> DataFrame:
    """``file``, series, year, month and ``damage`` where the projection is not what records say.

    ``damage`` is missing (a recorded file is gone), unrecorded (a file nobody noted) or changed:
    rows differ in number or in the sum of their hashes, or cannot be read.  Every data file is
    read once, and only sums are compared.  Unrecorded files have no series if they have no rows.
    """
    wanted = recorded_files(file_records(spark, layout)).select(
        "file", *PARTITION_COLUMNS, F.struct("points", "row_sum").alias("wanted")
    )
    listed = stored_files(spark, layout)
    if listed.isEmpty():
        found = wanted.select("file", *PARTITION_COLUMNS, F.col("wanted").alias("found")).limit(0)
    else:
        # A file that cannot be read gives no rows and is found to differ.
        rows = read_stored(spark, layout.projections, ignoreCorruptFiles=True)
        inside = F.substring_index(F.col("_metadata.file_path"), "/projections/", -1)
        counted = file_statistics(rows.withColumn("file", inside))
        found = counted.select("file", *PARTITION_COLUMNS, F.struct("points", "row_sum").alias("found"))
    both = wanted.join(found, ["file", *PARTITION_COLUMNS], "full")
    both = both.join(listed.select("file", F.lit(True).alias("there")), "file", "full")
    recorded = recorded_files(file_records(spark, layout)).select("file").distinct()
    both = both.join(recorded.withColumn("noted", F.lit(True)), "file", "left")
    damage = (
        F.when(F.col("noted").isNull(), "unrecorded")
        .when(F.col("there").isNull(), "missing")
        .when(~F.col("wanted").eqNullSafe(F.col("found")), "changed")
    )
    marked = both.withColumn("damage", damage).where(F.col("damage").isNotNull())
    return marked.select("file", *PARTITION_COLUMNS, "damage")


def orphan_versions(spark: SparkSession, layout: DatasetLayout, before: datetime) -> DataFrame:
    """``version_id, started_at, files, bytes`` of version folders without a commit.

    Only those of runs that began before ``before``, by the time their id names: a later one may
    still be at work.  Sizes are those of finished files; a run that broke while writing may have
    none.  Folders whose name is no version id are not looked at.  The driver sees the names of the
    version folders, one per run; files are listed by Spark.
    """
    names = folder_names(spark, layout.versions, VERSION_ID)
    limit = new_version_id(before)
    old = spark.createDataFrame([(one,) for one in names if one < limit], "version_id string")
    commits = read_table(spark, layout.commit_log, COMMIT_LOG).select("version_id").distinct()
    left = old.join(commits, "version_id", "left_anti")
    files = list_files(spark, layout.versions)
    sizes = files.groupBy(F.regexp_extract("file_path", f"/versions/({VERSION_ID})/", 1).alias("version_id")).agg(
        F.count("*").alias("files"), F.sum("bytes").alias("bytes")
    )
    started = F.to_timestamp_ntz(F.substring("version_id", 2, 15), F.lit("yyyyMMdd_HHmmss")).cast("timestamp")
    return left.join(sizes, "version_id", "left").select(
        "version_id",
        started.alias("started_at"),
        F.coalesce("files", F.lit(0)).alias("files"),
        F.coalesce("bytes", F.lit(0)).alias("bytes"),
    )


def remove_orphans(spark: SparkSession, layout: DatasetLayout, before: datetime) -> list[str]:
    """Remove the folders of ``orphan_versions``; the ids removed.

    The commit log is read again just before: a version committed meanwhile stays.  What was removed
    is gone, so ``before`` should leave every run the time it may take.
    """
    found = staged(orphan_versions(spark, layout, before), "orphans")
    commits = read_table(spark, layout.commit_log, COMMIT_LOG).select("version_id").distinct()
    left = found.join(commits, "version_id", "left_anti").orderBy("version_id")
    ids = [r[0] for r in left.select("version_id").collect()]  # one per broken run
    for one in ids:
        remove_path(spark, layout.version(one))
    return ids
