"""Merging committed versions into the table consumers read."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.functions.events import update_event, update_subject
from tidemark.operators.enrich import instant_literal
from tidemark.operators.lookup import fits_broadcast
from tidemark.operators.merge import (
    added_rows,
    merge_as_published,
    merge_first_wins,
    merge_outcome,
    refused_rows,
    touched_only,
    unseen_rows,
)
from tidemark.operators.partitions import write_partitioned
from tidemark.plans.files import overlapping_rows, record_files
from tidemark.plans.layout import DatasetLayout
from tidemark.plans.versions import (
    current_version,
    load_manifest,
    read_file_index,
    read_stored,
    read_version,
    read_versions,
)
from tidemark.schemas import (
    COMMIT_LOG,
    FILE_INDEX,
    MANIFEST,
    PROJECTED_VERSIONS,
    PUBLISH_LOG,
    REFUSED,
    STORED_OBSERVATIONS,
)
from tidemark.session import read_table, remove_path, staged, work_area

# Versions read in one plan, which grows with them; more are projected in several passes.
PENDING_AT_ONCE = 32


def pending_versions(versions: DataFrame, projected: DataFrame) -> DataFrame:
    """Versions not yet projected."""
    keys = ["dataset_id", "version_id"]
    return versions.join(projected.select(*keys).distinct(), keys, "left_anti")


def projection_status(projected: DataFrame) -> DataFrame:
    """Per dataset: how many versions were projected, the last one and when.

    Of versions projected at one time the last committed one is the last, if rows tell.
    """
    ranks = ["projected_at", "commit_seq", "version_id"]
    order = F.struct(*[name for name in ranks if name in projected.columns])
    return projected.groupBy("dataset_id").agg(
        F.count_distinct("version_id").alias("projected_versions"),
        F.max("projected_at").alias("last_projection_date"),
        F.max_by("version_id", order).alias("last_projected_version"),
    )


def read_projection(spark: SparkSession, layout: DatasetLayout) -> DataFrame:
    """The consumer table, lazily; empty before the first projection."""
    return read_table(spark, layout.projections, STORED_OBSERVATIONS).select(
        *STORED_OBSERVATIONS.fieldNames()
    )


def read_refused(spark: SparkSession, layout: DatasetLayout) -> DataFrame:
    """Values that merges did not take, with the one that stayed and the version; empty at first."""
    schema = StructType([*REFUSED.fields, StructField("version_id", StringType())])
    return read_table(spark, layout.refused(), schema)


def project_version(
    spark: SparkSession,
    layout: DatasetLayout,
    version_id: str,
    projected_at: datetime,
    publish: str = "append",
    dedup_new_partitions: bool = True,
    bucket: str | None = None,
    report_refused: bool = False,
) -> bool:
    """Merge one version into the projection, once; True when it was newly projected.

    ``append`` adds the unseen rows: a first-write-wins merge never changes a stored row, so
    nothing is rewritten, and repeating a broken run adds only what is still missing.
    ``rewrite`` replaces the touched partitions with merged ones, which also compacts them.
    Partitions new to the projection are de-duplicated unless told otherwise (then rewrite).
    With ``report_refused`` (append) the values that were not taken are listed as well; see
    ``read_refused``.
    """
    if publish not in ("append", "rewrite"):
        raise ValueError(f"unknown way to publish: {publish}")
    if report_refused and (publish != "append" or not dedup_new_partitions):
        raise ValueError("refused values are listed by an appending merge that removes copies")
    projected = read_table(spark, layout.projected_versions, PROJECTED_VERSIONS)
    if not projected.where(F.col("version_id") == version_id).isEmpty():
        return False
    manifest = load_manifest(spark, layout, version_id)
    if manifest is None:
        raise ValueError(f"no manifest for version {version_id} of {layout.dataset_id}")
    facts = manifest.select("file_count", "unique_keys").first()
    if not facts["file_count"]:
        return False
    index = read_file_index(spark, layout, version_id)
    few = fits_broadcast(index)
    incoming = read_version(spark, layout, version_id, few)
    unique = bool(facts["unique_keys"])
    how = (publish, dedup_new_partitions, unique, few, report_refused)
    _merge_in(spark, layout, [version_id], incoming, index, "ord", projected_at, *how)
    if layout.track_files:
        record_files(spark, layout, [version_id])
    _record(spark, layout, [version_id], projected_at)
    if bucket:
        announce(spark, layout, [version_id], bucket)
    return True


def _merge_in(
    spark, layout, ids, incoming, index, order, projected_at, publish, dedup, unique, few, report=False
) -> None:
    """Bring the rows of the versions ``ids`` into the projection; ``order`` says which is first."""
    by = list(layout.partition_columns)
    finish_interrupted(spark, layout, projected_at)
    with work_area(spark, "projecting"):
        # Written and one row per file: `points > 0` is what lets it prune projection folders.
        touched = index.where("points > 0").select(*by).distinct()
        stored = read_projection(spark, layout)
        if layout.track_files and publish == "append" and dedup:
            # Only keys are compared; what replaces partitions needs all of their rows.
            stored = overlapping_rows(spark, layout, index, few)
        base = touched_only(stored, touched, by, ["obs_time"], few)
        if report:
            # Listed first: a broken merge that is repeated finds the same conflicts.
            outcome = staged(merge_outcome(base, incoming, order=order), "outcome")
            listed = refused_rows(outcome).select(*REFUSED.fieldNames())
            listed.write.mode("overwrite").parquet(layout.refused(ids[-1]))
            added = added_rows(outcome).select(*STORED_OBSERVATIONS.fieldNames())
            write_partitioned(added, layout.projections, "append", by)
            return
        if publish == "append" and dedup:
            # Stored rows always have both keys: the write checks them.
            unseen = unseen_rows(base, incoming, order=order, unique=unique, null_keys=False)
            rows = unseen.select(*STORED_OBSERVATIONS.fieldNames())
            write_partitioned(rows, layout.projections, "append", by)
            return
        if dedup:
            merged = merge_first_wins(base, incoming, order=order)
        else:
            merged = merge_as_published(base, incoming, by, order=order)
        staging = layout.staging(ids[-1], uuid.uuid4().hex)
        rows = merged.select(*STORED_OBSERVATIONS.fieldNames())
        write_partitioned(rows, staging, folders=by)
    _note(spark, layout, ids[-1], staging, "ready", projected_at)
    _publish_staging(spark, layout, ids[-1], staging, projected_at)


def _publish_staging(spark, layout, version_id, staging, noted_at) -> None:
    """Replace exactly the partitions present in a finished staging folder."""
    rows = read_stored(spark, staging).select(*STORED_OBSERVATIONS.fieldNames())
    write_partitioned(
        rows,
        layout.projections,
        "overwrite",
        layout.partition_columns,
        laid_out=True,
        partitionOverwriteMode="dynamic",
    )
    _note(spark, layout, version_id, staging, "done", noted_at)
    remove_path(spark, staging)


def finish_interrupted(spark: SparkSession, layout: DatasetLayout, noted_at: datetime) -> None:
    """Publish again from any staging folder whose publication did not finish.

    Replacing several partitions is not one atomic step; the staged copy is complete before
    it begins, so repeating the step brings the projection to the intended state.
    """
    log = read_table(spark, layout.publish_log, PUBLISH_LOG)
    if not log.inputFiles():
        return  # nothing was ever published by rewriting
    done = log.where("step = 'done'").select("staging")
    left = log.where("step = 'ready'").join(done, "staging", "left_anti")
    unfinished = left.groupBy("version_id", "staging").agg(F.min("noted_at").alias("noted_at"))
    for row in unfinished.orderBy("noted_at").collect():  # at most the one of the last run
        _publish_staging(spark, layout, row["version_id"], row["staging"], noted_at)


def _note(spark, layout, version_id, staging, step, noted_at) -> None:
    spark.range(1).select(
        F.lit(version_id).alias("version_id"),
        F.lit(staging).alias("staging"),
        F.lit(step).alias("step"),
        instant_literal(noted_at).alias("noted_at"),
    ).coalesce(1).write.mode("append").parquet(layout.publish_log)


def _version_rows(spark, layout, ids) -> DataFrame:
    return spark.range(1).select(
        F.lit(layout.dataset_id).alias("dataset_id"),
        F.explode(F.array(*[F.lit(version_id) for version_id in ids])).alias("version_id"),
    )


def _record(spark, layout, ids, projected_at) -> None:
    commits = read_table(spark, layout.commit_log, COMMIT_LOG).where(F.col("version_id").isin(ids))
    seqs = commits.groupBy("version_id").agg(F.max("commit_seq").alias("commit_seq"))
    rows = _version_rows(spark, layout, ids).withColumn(
        "projected_at", instant_literal(projected_at)
    )
    rows.join(seqs, "version_id", "left").select(*PROJECTED_VERSIONS.fieldNames()).coalesce(
        1
    ).write.mode("append").parquet(layout.projected_versions)


def update_events(versions: DataFrame, bucket: str) -> DataFrame:
    """Subject and JSON message for each (dataset_id, version_id) row."""
    event = update_event(F.col("dataset_id"), F.col("version_id"), F.lit(bucket))
    return versions.select(
        update_subject(F.col("dataset_id")).alias("subject"), F.to_json(event).alias("message")
    )


def announce(
    spark: SparkSession, layout: DatasetLayout, version_ids: list[str], bucket: str
) -> None:
    """Append the update events of newly projected versions to the dataset's event table."""
    versions = _version_rows(spark, layout, version_ids)
    update_events(versions, bucket).coalesce(1).write.mode("append").json(layout.update_events)


def announced_manifests(events: DataFrame, root: str) -> DataFrame:
    """``subject, bucket, projections_path`` and the manifest each update event points at.

    ``events`` have ``subject, message``; ``root`` is where the bucket's objects are found.  The
    paths (one per event nobody has taken yet) name the objects to read; a manifest that is not
    there fails the read, an event announced twice counts once, and a message that names no
    manifest is left out.  Without events there are no rows.
    """
    spark = events.sparkSession
    kind = "event string, dataset_id string, bucket string, version_manifest_path string, projections_path string"
    told = events.select("subject", F.from_json("message", kind).alias("told")).select("subject", "told.*")
    named = "/versions/([^/]+)/manifest[.]json$"
    told = told.where(F.col("version_manifest_path").rlike(named)).select(
        "subject", "bucket", "projections_path", "dataset_id", "version_manifest_path",
        F.regexp_extract("version_manifest_path", named, 1).alias("version_id"),
    ).distinct()
    paths = [r[0] for r in told.select("version_manifest_path").distinct().collect()]
    if not paths:
        found = spark.createDataFrame([], MANIFEST)
    else:
        found = spark.read.schema(MANIFEST).json([f"{root.rstrip('/')}/{one}" for one in paths])
    return told.drop("version_manifest_path").join(found, ["dataset_id", "version_id"])


def read_events(spark: SparkSession, layout: DatasetLayout) -> DataFrame:
    """``subject, message`` of the update events not yet taken; empty before the first."""
    try:
        return spark.read.schema("subject string, message string").json(layout.update_events)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "subject string, message string")


def project_current(
    spark: SparkSession, layout: DatasetLayout, projected_at: datetime, **how
) -> bool:
    """Project the version the dataset points at; False when there is none."""
    version_id = current_version(spark, layout)
    if version_id is None:
        return False
    return project_version(spark, layout, version_id, projected_at, **how)


def project_pending(
    spark: SparkSession,
    layout: DatasetLayout,
    projected_at: datetime,
    publish: str = "append",
    dedup_new_partitions: bool = True,
    bucket: str | None = None,
) -> int:
    """Project every committed version still missing; how many that were.

    They are merged ``PENDING_AT_ONCE`` in a pass: of rows with one key that of the oldest version
    stays, as if they came one by one.  Only without ``dedup_new_partitions`` they have to come
    so, since a partition is new only to the first version that has it.
    """
    if publish not in ("append", "rewrite"):
        raise ValueError(f"unknown way to publish: {publish}")
    commits = read_table(spark, layout.commit_log, COMMIT_LOG)
    projected = read_table(spark, layout.projected_versions, PROJECTED_VERSIONS)
    pending = pending_versions(commits.where(F.trim("version_id") != ""), projected)
    seqs = pending.groupBy("version_id").agg(F.min("commit_seq").alias("commit_seq"))
    # Ids only, one per run not projected yet: they name the folders to read.
    rows = seqs.orderBy("commit_seq").collect()
    if len(rows) < 2 or not dedup_new_partitions:
        how = {"publish": publish, "dedup_new_partitions": dedup_new_partitions, "bucket": bucket}
        return sum(project_version(spark, layout, r[0], projected_at, **how) for r in rows)
    for at in range(0, len(rows), PENDING_AT_ONCE):
        some = {r["version_id"]: r["commit_seq"] for r in rows[at : at + PENDING_AT_ONCE]}
        _project_together(spark, layout, some, projected_at, publish, bucket)
    return len(rows)


def _project_together(spark, layout, seqs, projected_at, publish, bucket) -> None:
    ids = list(seqs)
    found = spark.read.schema(MANIFEST).json([layout.manifest(one) for one in ids])
    if found.where("file_count > 0").count() != len(ids):
        raise ValueError(f"a pending version of {layout.dataset_id} has no manifest or no files")
    index = spark.read.schema(FILE_INDEX).parquet(*[layout.file_index(one) for one in ids])
    few = fits_broadcast(index)
    incoming = read_versions(spark, layout, seqs, few).withColumn(
        "turn", F.struct("commit_seq", "ord")
    )
    how = (publish, True, False, few)
    _merge_in(spark, layout, ids, incoming.drop("commit_seq"), index, "turn", projected_at, *how)
    if layout.track_files:
        record_files(spark, layout, ids)
    _record(spark, layout, ids, projected_at)
    if bucket:
        announce(spark, layout, ids, bucket)
