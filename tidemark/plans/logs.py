"""Keeping the logs of a dataset short."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.incremental import latest_state_rows
from tidemark.plans.layout import DatasetLayout
from tidemark.schemas import COMMIT_LOG, PROJECTED_VERSIONS, PUBLISH_LOG, RUN_JOURNAL, STATE_LOG
from tidemark.session import read_table, remove_path

# Files a log may have before a run folds them into one.
LOG_FILES = 64


def compact_logs(spark: SparkSession, layout: DatasetLayout, most_files: int = LOG_FILES) -> int:
    """Fold every log of more than ``most_files`` files into one; how many were folded.

    Of the state only the last mark of each series is kept, of the other logs every row.  The
    new file is there before the old ones go, and a row that is there twice says what it says
    once, so a break in between does no harm.  It belongs to the dataset's one writer; a reader
    that listed the old files just before has to read again.
    """
    logs = [
        (layout.commit_log, COMMIT_LOG, DataFrame.distinct),
        (layout.projected_versions, PROJECTED_VERSIONS, DataFrame.distinct),
        (layout.publish_log, PUBLISH_LOG, DataFrame.distinct),
        (layout.state_log, STATE_LOG, latest_state_rows),
        (layout.run_journal, RUN_JOURNAL, DataFrame.distinct),
    ]
    folded = 0
    for path, schema, kept in logs:
        files = read_table(spark, path, schema).inputFiles()  # names of small files
        if len(files) > max(most_files, 1):
            rows = spark.read.schema(schema).parquet(*files).transform(kept)
            rows.write.mode("append").parquet(path)
            for file in files:
                remove_path(spark, file)
            folded += 1
    return folded
