"""Published JSON partitions: one JSON document per file, or one row per line."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from tidemark.functions.numbers import parse_decimal
from tidemark.functions.times import drop_zone, iso_text
from tidemark.operators.merge import merge_first_wins
from tidemark.operators.partitions import with_partition_columns, write_folders
from tidemark.schemas import PUBLISHED
from tidemark.session import settings


# Files of the two published forms, and whether every line is a document.
FORMS = (("data.json", False), ("part-*.json", True))
# No JSON holds this in any encoding, so a file split by it is one document.
_NEVER = "\0" * 8


def scan_published(
    spark: SparkSession,
    root: str,
    glob: str | None = None,
    lines: bool = False,
    on_broken: str = "fail",
) -> DataFrame:
    """Rows of every published file below ``root``: documents ``data.json`` and exported lines.

    With ``glob`` only files of such names are read.  A file holds an array of rows, an object with a ``data`` array, or an object that is
    one row itself; any other JSON gives no rows, and a missing root an empty table.  With
    ``lines`` every line is such a document, and large files can be split over tasks.
    A value is read as text and converted, so one that is no number is null and costs no other
    row.  A document that is not JSON (cut off, say) fails the read; with ``on_broken="skip"`` it
    is left out and found in ``published_rejects``.
    """
    if on_broken not in ("fail", "skip"):
        raise ValueError(f"unknown way with broken documents: {on_broken}")
    if glob is None:
        return reduce(
            DataFrame.unionByName, [scan_published(spark, root, *form, on_broken) for form in FORMS]
        )
    documents = _documents(spark, root, glob, lines)
    if documents is None:
        return spark.createDataFrame([], PUBLISHED)
    rows = documents.select(F.inline(_rows_of(documents, on_broken)))
    return rows.withColumn("value", parse_decimal(F.col("value"))).select(*PUBLISHED.fieldNames())


def published_rejects(
    spark: SparkSession, root: str, glob: str | None = None, lines: bool = False
) -> DataFrame:
    """``path, document`` of what ``scan_published`` cannot read: broken or cut-off JSON."""
    if glob is None:
        return reduce(
            DataFrame.unionByName, [published_rejects(spark, root, *form) for form in FORMS]
        )
    documents = _documents(spark, root, glob, lines)
    if documents is None:
        return spark.createDataFrame([], "path string, document string")
    # Spark reads the text of a broken document only together with another column.
    broken = _broken() & F.coalesce(F.size("data") >= -1, F.lit(True))
    located = documents.withColumn("path", F.col("_metadata.file_path"))
    return located.where(broken).select("path", F.col("_bad").alias("document"))


def _documents(spark: SparkSession, root: str, glob: str, lines: bool) -> DataFrame | None:
    texts = StructType([StructField(f.name, StringType()) for f in PUBLISHED.fields])
    with_data = StructType([*texts.fields]).add("data", ArrayType(texts))
    reader = (
        spark.read.schema(with_data.add("_bad", "string"))
        .option("columnNameOfCorruptRecord", "_bad")
        # The first folder level is a bare series code, so folders are not partitions here.
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
    )
    if not lines:
        # With ``multiLine`` every number read as text would open its file once more.
        reader = reader.option("lineSep", _NEVER)
    # By default folders are listed by up to 10,000 tasks, one each.
    tasks = str(4 * spark.sparkContext.defaultParallelism)
    try:
        with settings(spark, spark__sql__sources__parallelPartitionDiscovery__parallelism=tasks):
            files = reader.json(root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return files


def _broken() -> Column:
    """Whether a document could not be read because it is no JSON at all."""
    return F.col("_bad").isNotNull() & F.try_parse_json("_bad").isNull()


def _rows_of(documents: DataFrame, on_broken: str) -> Column:
    names = PUBLISHED.fieldNames()
    own = F.array(F.struct(*names))
    holds_row = F.coalesce(*names).isNotNull()
    found = F.when(F.col("data").isNotNull(), F.col("data")).when(
        holds_row & F.col("_bad").isNull(), own
    )
    if on_broken == "skip":
        return found
    text = F.concat(F.lit("a published document is no JSON: "), F.substring("_bad", 1, 200))
    return F.when(_broken(), F.raise_error(text).cast(documents.schema["data"].dataType)).otherwise(found)


def published_rows(observations: DataFrame, **more: Column) -> DataFrame:
    """Observations with their times as ISO text: the zone's own offset, UTC for the run."""
    run = F.col("collection_date")
    return observations.select(
        iso_text(F.col("obs_local"), F.col("obs_time")).alias("obs_time"),
        "internal_series_code",
        "value",
        "unit",
        "frequency",
        iso_text(run.cast("timestamp_ntz"), run).alias("collection_date"),
        *[column.alias(name) for name, column in more.items()],
    )


def write_published(observations: DataFrame, path: str, mode: str = "error") -> None:
    """Write observations as JSON lines, one folder per series, year and month.

    The series code stays in the rows, so the folders are named by a column of their own.
    """
    rows = with_partition_columns(observations)
    _write_lines(published_rows(rows, **_folders()), path, mode)


def merge_published(spark: SparkSession, projection: str, incoming: str, path: str) -> None:
    """Merge two folders of published files into a new one; rows of ``projection`` win.

    Keys are compared as text, as published files do: one instant with two offsets is two
    keys.  Of one folder's rows with one key the first collected stays.  Neither input is
    changed, so a broken merge can be repeated.
    """
    first = F.struct("collection_date", "value", "unit", "frequency")
    old, new = (
        scan_published(spark, root).withColumn("_first", first) for root in (projection, incoming)
    )
    merged = merge_first_wins(old, new, order="_first").withColumn(
        "obs_local", drop_zone(F.col("obs_time"))
    )
    named = [column.alias(name) for name, column in _folders().items()]
    rows = with_partition_columns(merged).select(*PUBLISHED.fieldNames(), *named)
    _write_lines(rows, path, "error")


def _folders() -> dict[str, Column]:
    return {"series": F.col("internal_series_code"), "year": F.col("year"), "month": F.col("month")}


def _write_lines(rows: DataFrame, path: str, mode: str) -> None:
    write_folders(rows, path, list(_folders()), mode, "json")
