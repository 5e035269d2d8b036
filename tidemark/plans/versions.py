"""Immutable versions of a dataset: data, file index, manifest and the commit log."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.paths import partition_folder
from tidemark.functions.times import manifest_text
from tidemark.operators.enrich import instant_literal
from tidemark.operators.lookup import lookup_join
from tidemark.operators.partitions import partition_statistics, write_partitioned
from tidemark.plans.layout import DatasetLayout
from tidemark.schemas import (
    COMMIT_LOG,
    FILE_INDEX,
    MANIFEST,
    OBSERVATIONS,
    PARTITION_COLUMNS,
    STORED_OBSERVATIONS,
)
from tidemark.session import read_table, write_object


def new_version_id(run_ts: datetime) -> str:
    """``vYYYYMMDD_HHMMSS_ffffff`` in UTC."""
    utc = run_ts.astimezone(timezone.utc) if run_ts.tzinfo else run_ts
    return utc.strftime("v%Y%m%d_%H%M%S_%f")


def commit_version(
    observations: DataFrame,
    layout: DatasetLayout,
    version_id: str,
    run_ts: datetime,
    unique_keys: bool = False,
) -> bool:
    """Write a version: data, file index, manifest, and the commit row last.

    Until the commit row is there nobody sees the version, so a run that dies leaves an
    orphan folder and the next attempt overwrites it.  No rows, no version (False); a
    version already committed is left alone (True).  ``unique_keys`` notes that no two rows
    share an instant and a code, which saves projecting a de-duplication.
    """
    spark = observations.sparkSession
    known = read_table(spark, layout.commit_log, COMMIT_LOG).agg(
        F.coalesce(F.max("commit_seq"), F.lit(0)).alias("last_seq"),
        F.coalesce(F.bool_or(F.col("version_id") == version_id), F.lit(False)).alias("done"),
    ).first()
    if known["done"]:
        return True
    write_partitioned(
        as_observations(observations),
        layout.data(version_id),
        mode="overwrite",
        folders=layout.partition_columns,
    )
    # One pass over the files just written, reading the time columns only.
    stored = read_stored(spark, layout.data(version_id))
    index = partition_statistics(
        stored.withColumn("file_name", F.col("_metadata.file_name")), ("file_name",)
    ).select(*FILE_INDEX.fieldNames())
    index.write.mode("overwrite").parquet(layout.file_index(version_id))
    index = read_file_index(spark, layout, version_id)
    if index.isEmpty():
        return False
    manifest = manifest_of(
        index,
        version_id,
        layout.dataset_id,
        run_ts,
        layout.partition_strategy,
        unique_keys,
        layout.partition_columns,
    )
    # One object, as its path says: whoever is told of the version reads just that.
    write_object(spark, layout.manifest(version_id), manifest.toJSON().first() + "\n")
    append_commit(spark, layout, version_id, run_ts, known["last_seq"] + 1)
    return True


def as_observations(rows: DataFrame) -> DataFrame:
    """The stored column set; columns a custom stage did not make are null."""
    return rows.select(
        *[
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in OBSERVATIONS.fields
        ]
    )


def read_stored(spark: SparkSession, path: str, **options) -> DataFrame:
    """A partitioned observation table, with ``_metadata`` still reachable."""
    return spark.read.schema(STORED_OBSERVATIONS).options(**options).parquet(path)


def read_file_index(spark: SparkSession, layout: DatasetLayout, version_id: str) -> DataFrame:
    return read_table(spark, layout.file_index(version_id), FILE_INDEX)


def read_version(
    spark: SparkSession, layout: DatasetLayout, version_id: str, small_index: bool | None = None
) -> DataFrame:
    """The rows of the files a version's index lists, and of no other file."""
    by = [*layout.partition_columns, "file_name"]
    listed = read_file_index(spark, layout, version_id).select(*by)
    rows = read_stored(spark, layout.data(version_id)).withColumn(
        "file_name", F.col("_metadata.file_name")
    )
    kept = lookup_join(rows, listed, by, "left_semi", ["obs_time"], small_index)
    return kept.select(*STORED_OBSERVATIONS.fieldNames())


def read_versions(
    spark: SparkSession, layout: DatasetLayout, seqs: dict[str, int], small_index: bool
) -> DataFrame:
    """The rows of several versions; ``commit_seq`` is the number ``seqs`` gives each."""
    return reduce(
        DataFrame.unionAll,
        [
            read_version(spark, layout, one, small_index).withColumn("commit_seq", F.lit(seq))
            for one, seq in seqs.items()
        ],
    )


def manifest_of(
    index: DataFrame,
    version_id: str,
    dataset_id: str,
    created_at: datetime,
    partition_strategy: str = "series_year_month",
    unique_keys: bool = False,
    folders: Sequence[str] = PARTITION_COLUMNS,
) -> DataFrame:
    """One manifest row from a file index (or from partition statistics without files).

    Texts carry a literal ``Z`` on wall-clock times, by convention; ``date_range_utc`` has
    the instants.  It has counts and ranges; the files, partitions and series themselves are
    tables (``version_files``, ``version_partitions``, ``version_series``) at every size.
    """
    code = F.col("internal_series_code")
    partition = partition_folder(folders)
    has_files = "file_name" in index.columns
    name = F.concat(partition, "file_name") if has_files else F.lit(None).cast("string")

    def range_of(low: str, high: str) -> Column:
        return F.struct(
            manifest_text(F.min(low)).alias("min_obs_time"),
            manifest_text(F.max(high)).alias("max_obs_time"),
        )

    return index.agg(
        F.lit(version_id).alias("version_id"),
        F.lit(dataset_id).alias("dataset_id"),
        manifest_text(instant_literal(created_at)).alias("created_at"),
        manifest_text(F.min("collection_date")).alias("collection_date"),
        F.coalesce(F.sum("points"), F.lit(0)).alias("data_points_count"),
        F.count_distinct(code).alias("series_count"),
        range_of("min_obs_local", "max_obs_local").alias("date_range"),
        range_of("min_obs_time", "max_obs_time").alias("date_range_utc"),
        F.lit(partition_strategy).alias("partition_strategy"),
        F.count_distinct(name).alias("file_count"),
        F.count_distinct(partition).alias("partition_count"),
        F.lit(unique_keys).alias("unique_keys"),
    ).select(*MANIFEST.fieldNames())


def version_partitions(
    index: DataFrame, folders: Sequence[str] = PARTITION_COLUMNS
) -> DataFrame:
    """``partition``: every partition path of a file index, once."""
    return index.select(partition_folder(folders).alias("partition")).distinct()


def version_files(index: DataFrame, folders: Sequence[str] = PARTITION_COLUMNS) -> DataFrame:
    """``file``: the path of every data file of a version, once."""
    return index.select(F.concat(partition_folder(folders), "file_name").alias("file")).distinct()


def version_series(index: DataFrame) -> DataFrame:
    """``internal_series_code``: every series of a file index, once."""
    return index.select("internal_series_code").distinct()


def load_manifest(
    spark: SparkSession, layout: DatasetLayout, version_id: str
) -> DataFrame | None:
    """The manifest as one row, or None when the version has none; other errors are raised."""
    try:
        return spark.read.schema(MANIFEST).json(layout.manifest(version_id))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def append_commit(
    spark: SparkSession,
    layout: DatasetLayout,
    version_id: str,
    committed_at: datetime,
    commit_seq: int,
) -> None:
    """Move the pointer: appending means readers never find it missing."""
    row = spark.range(1).select(
        F.lit(commit_seq).cast("bigint").alias("commit_seq"),
        F.lit(layout.dataset_id).alias("dataset_id"),
        F.lit(version_id).alias("version_id"),
        instant_literal(committed_at).alias("committed_at"),
    )
    row.coalesce(1).write.mode("append").parquet(layout.commit_log)


def current_versions(commit_log: DataFrame) -> DataFrame:
    """The version each dataset points at; a blank pointer means no current version."""
    return (
        commit_log.groupBy("dataset_id")
        .agg(F.trim(F.max_by("version_id", "commit_seq")).alias("version_id"))
        .where("version_id <> ''")
    )


def current_version(spark: SparkSession, layout: DatasetLayout) -> str | None:
    log = read_table(spark, layout.commit_log, COMMIT_LOG)
    row = current_versions(log.where(F.col("dataset_id") == layout.dataset_id)).first()
    return row["version_id"] if row else None


def committed_versions(spark: SparkSession, layout: DatasetLayout) -> DataFrame:
    """``dataset_id, version_id`` of every committed version, newest first."""
    log = read_table(spark, layout.commit_log, COMMIT_LOG)
    rows = log.select("commit_seq", "dataset_id", "version_id").distinct()
    return rows.orderBy(F.desc("commit_seq")).select("dataset_id", "version_id")


def list_versions(paths: DataFrame, column: str = "path") -> DataFrame:
    """Distinct versions with a manifest among object paths, newest first per dataset.

    A manifest is an object ``manifest.json``, or objects below a folder of that name.
    """
    parts = F.split(F.regexp_replace(column, "(/manifest[.]json)/[^/]+$", "$1"), "/")
    version = F.try_element_at(parts, F.lit(-2))
    return (
        paths.where(
            (F.get(parts, 0) == "datasets")
            & (F.get(parts, 2) == "versions")
            & (F.try_element_at(parts, F.lit(-1)) == "manifest.json")
            & version.startswith("v")
        )
        .select(F.get(parts, 1).alias("dataset_id"), version.alias("version_id"))
        .distinct()
        .orderBy("dataset_id", F.desc("version_id"))
    )
