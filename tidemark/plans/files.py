"""What lies in the files of a projection: noted by every merge, it spares later merges reading
and adds up to the projection's size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.operators.lookup import lookup_join
from tidemark.plans.layout import DatasetLayout
from tidemark.plans.versions import read_stored
from tidemark.schemas import FILE_RECORDS, OBSERVATIONS, PARTITION_COLUMNS, STORED_OBSERVATIONS
from tidemark.session import list_files, read_table, staged, work_area

# Files named in the scan itself, which then opens no other; more are picked by a join.
NAMED_FILES = 10_000

_SUM = "decimal(38,0)"
_FACTS = ("points", "min_obs_time", "max_obs_time", "key_sum", "row_sum")
_CELL = ("file", *PARTITION_COLUMNS)


def file_records(spark: SparkSession, layout: DatasetLayout) -> DataFrame:
    """What every merge did to the projection's files; empty before the first noted one."""
    schema = StructType([*FILE_RECORDS.fields, StructField("version_id", StringType())])
    return read_table(spark, layout.file_records(), schema)


def recorded_files(records: DataFrame) -> DataFrame:
    """``file``, series, month and statistics of the files that records say are there."""
    facts = [F.max(name).alias(name) for name in _FACTS]
    there = records.where("change <> 0").groupBy(*_CELL).agg(F.sum("change").alias("there"), *facts)
    return there.where("there > 0").drop("there")


def stored_files(spark: SparkSession, layout: DatasetLayout) -> DataFrame:
    """``file, file_path`` of the projection's data files; ``file`` is the path inside of it."""
    found = list_files(spark, layout.projections, "*.parquet")
    return found.select(_inside(F.col("file_path")).alias("file"), "file_path")


def _inside(path: Column) -> Column:
    return F.substring_index(path, "/projections/", -1)


def file_statistics(rows: DataFrame) -> DataFrame:
    """Per file, series and month: points, time range, and order-independent sums of hashes.

    ``rows`` have a column ``file``.  ``key_sum`` covers instant and code, ``row_sum`` all stored
    columns; both are sums of 64-bit hashes, so equal multisets of rows have equal sums.
    """

    def summed(*names: str) -> Column:
        return F.sum(F.xxhash64(*names).cast(_SUM)).cast(_SUM)

    return rows.groupBy(*_CELL).agg(
        F.count("*").alias("points"),
        F.min("obs_time").alias("min_obs_time"),
        F.max("obs_time").alias("max_obs_time"),
        summed("obs_time", "internal_series_code").alias("key_sum"),
        summed(*OBSERVATIONS.fieldNames()).alias("row_sum"),
    )


def rows_in_files(spark: SparkSession, layout: DatasetLayout, files: DataFrame) -> DataFrame:
    """The projection's rows in the given files (a written table with ``file, file_path``).

    Up to ``NAMED_FILES`` of them are named in the scan, which leaves the others closed; more
    are picked by a join on the path.  The rows are the same.
    """
    path = F.col("_metadata.file_path")
    names = files.select("file_path").limit(NAMED_FILES + 1).collect()
    rows = read_stored(spark, layout.projections)
    if len(names) <= NAMED_FILES:
        kept = rows.where(path.isin([r[0] for r in names]) if names else F.lit(False))
        return kept.withColumn("file", _inside(path))
    named = rows.withColumn("file", _inside(path))
    return lookup_join(named, files.select("file"), ["file"], "left_semi", ["obs_time"])


def overlapping_files(
    spark: SparkSession, layout: DatasetLayout, index: DataFrame, few: bool | None = None
) -> DataFrame | None:
    """``file, file_path`` of the files that may share a key with the versions of a file index.

    A file is left out only if its records say that, for every series and month it has in common
    with the versions, its times end before theirs begin or begin after theirs end.  Files without
    a record stay.  None if nothing is recorded.

    Both sides are cut into series and months, which equal keys share.  The versions have one range
    for each, so the join gives one row per recorded cell, however many files a series has.
    """
    records = file_records(spark, layout)
    if not records.inputFiles():
        return None
    spans = index.where("points > 0").groupBy(*PARTITION_COLUMNS).agg(
        F.min("min_obs_time").alias("begins"), F.max("max_obs_time").alias("ends")
    )
    cells = recorded_files(records).select(*_CELL, "min_obs_time", "max_obs_time")
    joined = lookup_join(cells, spans, PARTITION_COLUMNS, "left", ["file"], few)
    meets = (F.col("min_obs_time") <= F.col("ends")) & (F.col("max_obs_time") >= F.col("begins"))
    apart = joined.groupBy("file").agg(F.bool_or(F.coalesce(meets, F.lit(False))).alias("meets"))
    left_out = apart.where("not meets").select("file")
    return staged(stored_files(spark, layout).join(left_out, "file", "left_anti"), "overlapping")


def overlapping_rows(
    spark: SparkSession, layout: DatasetLayout, index: DataFrame, few: bool | None = None
) -> DataFrame:
    """The projection's rows that a merge of the versions of ``index`` has to look at."""
    files = overlapping_files(spark, layout, index, few)
    if files is None:
        return read_table(spark, layout.projections, STORED_OBSERVATIONS).select(
            *STORED_OBSERVATIONS.fieldNames()
        )
    return rows_in_files(spark, layout, files).select(*STORED_OBSERVATIONS.fieldNames())


def record_files(spark: SparkSession, layout: DatasetLayout, ids: list[str]) -> None:
    """Note what the merge of the versions ``ids`` changed: files that came and files that went.

    Found by listing, not by what the merge meant to write: files of a merge that broke and was
    repeated are noted by the repetition, which replaces its own record.  Only new files are read.
    Files that unnoted merges left are taken for this one's.
    """
    with work_area(spark, "recording"):
        others = file_records(spark, layout).where(F.col("version_id") != ids[-1])
        last = others.agg(F.max("turn")).first()[0] or 0
        known = recorded_files(others)
        stored = stored_files(spark, layout)
        came = staged(stored.join(known.select("file"), "file", "left_anti"), "came")
        went = known.join(stored.select("file"), "file", "left_anti").withColumn("change", F.lit(-1))
        added = file_statistics(rows_in_files(spark, layout, came)).withColumn("change", F.lit(1))
        merged = spark.range(1).select(
            F.explode(F.array(*[F.lit(one) for one in ids])).alias("merged_id"), F.lit(0).alias("change")
        )
        rows = added.unionByName(went).unionByName(merged, allowMissingColumns=True)
        rows = rows.withColumn("turn", F.lit(last + 1))
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in FILE_RECORDS.fields]
        rows.select(*columns).coalesce(8).write.mode("overwrite").parquet(layout.file_records(ids[-1]))


def projection_totals(spark: SparkSession, layout: DatasetLayout) -> DataFrame:
    """What every noted merge brought, from the records alone; no data file is read.

    ``version_id`` (its last version), ``turn``, ``versions``, ``points_added``,
    ``partitions_added`` (series and months that no merge before had), ``series_added``,
    ``files_added`` and ``files_removed``.  Sums over the first merges are the projection's size
    after them.
    """
    records = file_records(spark, layout)
    moved = records.where("change <> 0")
    files = moved.groupBy("version_id", "turn", "file", "change").agg(
        F.sum(F.col("points") * F.col("change")).alias("points")
    )
    sizes = files.groupBy("version_id", "turn").agg(
        F.sum("points").alias("points_added"),
        F.count_if(F.col("change") == 1).alias("files_added"),
        F.count_if(F.col("change") == -1).alias("files_removed"),
    )

    def firsts(keys: list[str], name: str) -> DataFrame:
        first = moved.groupBy(*keys).agg(F.min("turn").alias("turn"))
        return first.groupBy("turn").agg(F.count("*").alias(name))

    merges = records.where("change = 0").groupBy("version_id", "turn").agg(F.count("*").alias("versions"))
    counted = merges.join(sizes, ["version_id", "turn"], "left")
    counted = counted.join(firsts(PARTITION_COLUMNS, "partitions_added"), "turn", "left")
    counted = counted.join(firsts(["internal_series_code"], "series_added"), "turn", "left")
    names = ("points_added", "partitions_added", "series_added", "files_added", "files_removed")
    return counted.select(
        "version_id", "turn", "versions", *[F.coalesce(name, F.lit(0)).alias(name) for name in names]
    )
