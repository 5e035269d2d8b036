"""Partitions by series, year and month: columns, layout on disk, counts and statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.paths import checked_code, month_text, partition_in
from tidemark.schemas import PARTITION_COLUMNS
from tidemark.session import settings


def with_partition_columns(observations: DataFrame) -> DataFrame:
    """Add year and month by wall clock; a row without code or time fails the job."""
    return (
        observations.withColumn(
            "internal_series_code", checked_code(F.col("internal_series_code"), F.col("obs_local"))
        )
        .withColumn("year", F.year("obs_local"))
        .withColumn("month", month_text(F.col("obs_local")))
    )


def write_partitioned(
    observations: DataFrame,
    path: str,
    mode: str = "error",
    folders: Sequence[str] = PARTITION_COLUMNS,
    laid_out: bool = False,
    **options,
) -> None:
    """Write Parquet with one folder per partition, files ordered by series and time."""
    rows = observations
    if "year" not in observations.columns:
        rows = with_partition_columns(observations)
    order = [name for name in ("internal_series_code", "obs_local") if name not in folders]
    write_folders(rows, path, list(folders), mode, "parquet", order, laid_out, **options)


def write_folders(
    rows: DataFrame,
    path: str,
    folders: list[str],
    mode: str,
    file_format: str,
    order: list[str] | None = None,
    laid_out: bool = False,
    **options,
) -> None:
    """Write one folder per combination of the ``folders`` columns.

    Rows are rebalanced by folder: a small one lies in one task and gives one file, while
    one that holds much of the data is split over tasks and files.  Small tasks are merged
    only until every core has one: merging more would not save a file, only leave fewer tasks
    to create them all.  Writing sorts by folder anyway, so ordering the files further is
    almost free.  Rows read from files written like this are ``laid_out``: not shuffled again.
    """
    dealt = rows if laid_out else rows.hint("rebalance", *folders)
    writer = (
        dealt
        .sortWithinPartitions(*folders, *(order or []))
        .write.mode(mode)
        .partitionBy(*folders)
        .format(file_format)
    )
    for key, value in options.items():
        writer = writer.option(key, value)
    with settings(
        rows.sparkSession,
        spark__sql__adaptive__coalescePartitions__parallelismFirst="true",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="64KB",
    ):
        writer.save(path)


def partition_counts(observations: DataFrame) -> DataFrame:
    """Points per partition."""
    return (
        with_partition_columns(observations)
        .groupBy(*PARTITION_COLUMNS)
        .agg(F.count("*").alias("points"))
    )


def distinct_partitions(paths: DataFrame, column: str) -> DataFrame:
    """Sorted distinct partitions named in object paths; other paths are ignored."""
    return (
        paths.where(F.col(column).contains("/year="))  # cheaper than the pattern
        .select(partition_in(F.col(column)).alias("partition"))
        .where("partition <> ''")
        .distinct()
        .orderBy("partition")
    )


def present_partitions(
    stored: DataFrame, folders: Sequence[str] = PARTITION_COLUMNS
) -> DataFrame:
    """Sorted distinct partitions of a stored table; reads no data column."""
    return stored.select(*folders).distinct().orderBy(*folders)


def partition_statistics(rows: DataFrame, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """Count and ranges per partition (and per ``extra_keys``): what manifests are made of."""
    return rows.groupBy(*PARTITION_COLUMNS, *extra_keys).agg(
        F.count("*").alias("points"),
        F.min("obs_local").alias("min_obs_local"),
        F.max("obs_local").alias("max_obs_local"),
        F.min("obs_time").alias("min_obs_time"),
        F.max("obs_time").alias("max_obs_time"),
        F.min("collection_date").alias("collection_date"),
    )
