"""Session settings, the shared work folder and small table helpers."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

RUNTIME_SETTINGS = {
    # Wall clocks are timestamp_ntz and instants timestamp: the casts between the two
    # are only right in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A key repeated in a JSON document: the last one counts, as with other JSON readers.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Keeps month='01' a string when a partitioned folder is read.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


_AREA: ContextVar[str | None] = ContextVar("work_area", default=None)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings this library relies on to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    A temporary folder is made only in local mode with the setting absent (tests).
    """
    base = _AREA.get() or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="tidemark-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings for the actions inside the block ("__" stands for ".")."""
    names = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read a Parquet table; a table nobody has written yet is empty."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def staged(frame: DataFrame, label: str) -> DataFrame:
    """Write ``frame`` once to the shared work folder and return the written table.

    Used where several readers need one expensive result: unlike a cache it survives the
    loss of executors, and readers get column pruning and filter push-down.
    """
    spark = frame.sparkSession
    path = work_folder(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


@contextmanager
def work_area(spark: SparkSession, label: str) -> Iterator[str]:
    """A work folder for the block: what is staged inside it is removed when the block ends.

    For work whose results are written by then, since no frame may read the staged tables later.
    """
    path = work_folder(spark, label)
    before = _AREA.set(path)
    try:
        yield path
    finally:
        _AREA.reset(before)
        remove_path(spark, path)


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``file_path, bytes, modified`` of every data file below ``path``, as a written table.

    Nothing is opened.  No files, or no such folder: no rows.  Files and folders whose names begin
    with ``_`` or ``.`` are no data.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    try:
        found = reader.option("pathGlobFilter", pattern).load(path).select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_size").alias("bytes"),
            F.col("_metadata.file_modification_time").alias("modified"),
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "file_path string, bytes bigint, modified timestamp")
    # Names only are read, so the files' sizes must not decide how many tasks that takes.
    with settings(spark, spark__sql__files__maxPartitionBytes="1t", spark__sql__files__openCostInBytes="0"):
        return staged(found, "listing")


def folder_names(spark: SparkSession, path: str, pattern: str) -> list[str]:
    """Names directly below ``path`` that match the whole ``pattern``, hidden content or not."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(target):
        return []
    names = [status.getPath().getName() for status in system.listStatus(target)]
    return sorted(name for name in names if re.fullmatch(pattern, name))


def write_object(spark: SparkSession, path: str, text: str) -> None:
    """Write one small object; what was there is replaced."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.exists(target):
        system.delete(target, True)
    out = system.create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder this library wrote; one that is not there is fine."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
