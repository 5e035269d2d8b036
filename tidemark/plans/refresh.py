"""A whole run: parse what is new, normalise, enrich, commit a version, project it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.enrich import enrich, instant_literal, within_window
from tidemark.operators.grid import extract_points
from tidemark.operators.incremental import (
    CODE,
    MARK,
    high_water_marks,
    latest_state,
    marks_for,
    merge_state,
    only_new,
    scan_floor,
)
from tidemark.operators.lookup import lookup_join
from tidemark.operators.normalize import normalize
from tidemark.plans.layout import DatasetLayout
from tidemark.plans.logs import compact_logs
from tidemark.plans.projection import project_current, project_version
from tidemark.plans.versions import commit_version, new_version_id, read_file_index
from tidemark.schemas import (
    COMMIT_LOG,
    LATE_ROWS,
    PARTITION_COLUMNS,
    POINTS,
    RUN_JOURNAL,
    STATE,
    STATE_LOG,
)
from tidemark.session import read_table, staged, work_area
from tidemark.sources.series import SeriesMap, series_map

Stage = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Stages:
    """What a run does to its rows; each stage is a function from DataFrame to DataFrame.

    ``parse`` also gets the marks of the configured series.  A stage left out is skipped;
    without ``parse`` there are no rows.
    """

    parse: Callable[[DataFrame, DataFrame], DataFrame] | None = None
    normalize: Stage | None = None
    transform: Stage | None = None
    unique_keys: bool = False  # no two rows share an instant and a code
    keeps_rows: bool = False  # transform neither drops rows nor changes their times


@dataclass(frozen=True)
class RunResult:
    version_id: str | None
    projected: bool


def grid_stages(
    series: SeriesMap, config: dict, run_ts: datetime, date_formats: tuple[str, ...] = ()
) -> Stages:
    """Stages for cells of worksheets; cells should be a written table."""

    def parse(cells: DataFrame, marks: DataFrame) -> DataFrame:
        return only_new(
            extract_points(cells, series, date_formats), marks, spread=["source_id", "pos"]
        )

    return Stages(parse, *_later_stages(series, config, run_ts, None))


def table_stages(
    series: SeriesMap,
    config: dict,
    run_ts: datetime,
    order: list[str],
    configured_only: bool = False,
) -> Stages:
    """Stages for rows that are points already; ``order`` says which duplicate is first.

    With ``configured_only`` other series are left out, and once all configured series have
    marks the scan itself skips what is older than the oldest of them.
    """

    def parse(points: DataFrame, marks: DataFrame) -> DataFrame:
        if configured_only:
            known = series.frame.where(F.col(CODE) != "").select(CODE).distinct()
            points = lookup_join(points, known, [CODE], "left_semi", order, series.small)
            floor = scan_floor(marks, series)
            if floor is not None:
                time = F.col("obs_ts")
                bound = F.lit(floor.isoformat(" ")).cast("timestamp_ntz")
                points = points.where(time.isNull() | (time > bound))
        return only_new(points, marks, spread=order)

    return Stages(parse, *_later_stages(series, config, run_ts, order))


def _later_stages(series, config, run_ts, order) -> tuple[Stage, Stage, bool, bool]:
    settings = config.get("normalize", {})
    zone = settings.get("timezone", "UTC")
    # The key list only switches de-duplication on or off; the key itself is fixed.
    dedup = bool(settings.get("primary_keys"))

    def normalized(points: DataFrame) -> DataFrame:
        return normalize(points, zone, dedup, order, describe=False)

    def enriched(observations: DataFrame) -> DataFrame:
        return enrich(observations, series, run_ts)

    return normalized, enriched, dedup, True


def load_state(spark: SparkSession, layout: DatasetLayout) -> DataFrame:
    log = read_table(spark, layout.state_log, STATE_LOG)
    return latest_state(log.where(F.col("dataset_id") == layout.dataset_id))


def save_state(
    marks: DataFrame, layout: DatasetLayout, saved_at: datetime, monotonic: bool = False
) -> None:
    """Append a batch's marks to the state log; series not in the batch keep theirs."""
    spark = marks.sparkSession
    batch = marks.select(F.lit(layout.dataset_id).alias("dataset_id"), CODE, MARK)
    if monotonic:
        batch_codes = batch.select("dataset_id", CODE)
        merged = merge_state(load_state(spark, layout), batch, monotonic=True)
        batch = merged.join(batch_codes, ["dataset_id", CODE], "left_semi")
    last = read_table(spark, layout.state_log, STATE_LOG).agg(F.max("seq")).first()[0]
    batch.select(
        *STATE.fieldNames(),
        instant_literal(saved_at).alias("saved_at"),
        F.lit((last or 0) + 1).cast("bigint").alias("seq"),
    ).write.mode("append").parquet(layout.state_log)


def observations_of(
    raw: DataFrame, stages: Stages, marks: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """The normalised and the final rows of a run, as lazy plans (before the window)."""
    if stages.parse is None:
        rows = raw.sparkSession.createDataFrame([], POINTS)
    else:
        rows = stages.parse(raw, marks)
    if stages.normalize:
        rows = rows.transform(stages.normalize)
    final = rows.transform(stages.transform) if stages.transform else rows
    return rows, final


def run_refresh(
    raw: DataFrame,
    config: dict,
    root: str,
    run_ts: datetime,
    stages: Stages | None = None,
    as_of: datetime | None = None,
    project: bool = True,
    publish: str = "append",
    monotonic_state: bool = False,
    bucket: str | None = None,
    late_rows: bool = False,
    version_id: str | None = None,
    frozen_marks: DataFrame | None = None,
) -> RunResult:
    """One run over ``raw`` for the dataset of ``config`` below ``root``.

    State is saved after the commit, so rows of a failed run are seen again.  It comes from
    the rows before the time window.  A repeated run (same ``version_id``, by default made from
    ``run_ts``) commits nothing twice, and what it staged is removed when it ends.

    A run that broke after its commit is finished first: its version is projected and its marks
    are saved, so the rows it committed are not taken for new ones (see ``unfinished_runs``).

    With ``late_rows`` no row is left out for its series' mark: merging alone decides what is
    new.  Those at or before their series' ``frozen_marks``, if given, are listed; see
    ``read_late_rows``.
    """
    spark = raw.sparkSession
    layout = layout_of(root, config)
    series = series_map(spark, config)
    stages = stages or grid_stages(series, config, run_ts)
    version_id = version_id or new_version_id(run_ts)
    with work_area(spark, "run"):
        finish_runs(spark, layout, run_ts, publish, bucket, monotonic_state)
        _note(spark, layout, version_id, "started", bool(project), run_ts)
        committed, seen = _commit(
            raw, config, layout, series, run_ts, stages, as_of, late_rows, version_id, frozen_marks
        )
        projected = project and project_current(
            spark, layout, run_ts, publish=publish, bucket=bucket
        )
        if seen is not None and stages.normalize:
            save_state(seen, layout, run_ts, monotonic_state)
        if committed:
            _note(spark, layout, version_id, "saved", bool(project), run_ts)
    compact_logs(spark, layout)
    return RunResult(version_id if committed else None, bool(projected))


def run_journal(spark: SparkSession, layout: DatasetLayout) -> DataFrame:
    """``version_id, phase, project, noted_at``: what the runs of a dataset have reached."""
    return read_table(spark, layout.run_journal, RUN_JOURNAL).distinct()


def unfinished_runs(spark: SparkSession, layout: DatasetLayout) -> DataFrame:
    """``version_id, commit_seq, project`` of runs that committed a version but saved no marks."""
    journal = run_journal(spark, layout)
    saved = journal.where("phase = 'saved'").select("version_id")
    open_runs = journal.where("phase = 'started'").groupBy("version_id").agg(F.bool_or("project").alias("project"))
    commits = read_table(spark, layout.commit_log, COMMIT_LOG).groupBy("version_id").agg(
        F.min("commit_seq").alias("commit_seq")
    )
    # A run that committed nothing has nothing to finish: its rows are seen again.
    left = open_runs.join(saved, "version_id", "left_anti").join(commits, "version_id")
    return left.select("version_id", "commit_seq", "project")


def finish_runs(
    spark: SparkSession,
    layout: DatasetLayout,
    run_ts: datetime,
    publish: str = "append",
    bucket: str | None = None,
    monotonic_state: bool = False,
) -> list[str]:
    """Do what is left of broken runs, in the order of their commits; the versions finished.

    Every step can be repeated: a version is projected once, marks saved again are the same, and
    the journal says that a run is done only after both.
    """
    # At most the run before this one, unless several broke while finishing it.
    left = unfinished_runs(spark, layout).orderBy("commit_seq").collect()
    for row in left:
        version_id = row["version_id"]
        if row["project"]:
            project_version(spark, layout, version_id, run_ts, publish=publish, bucket=bucket)
        save_state(version_marks(spark, layout, version_id), layout, run_ts, monotonic_state)
        _note(spark, layout, version_id, "saved", row["project"], run_ts)
    return [row["version_id"] for row in left]


def _note(spark, layout, version_id, phase, project, noted_at) -> None:
    spark.range(1).select(
        F.lit(version_id).alias("version_id"),
        F.lit(phase).alias("phase"),
        F.lit(project).alias("project"),
        instant_literal(noted_at).alias("noted_at"),
    ).coalesce(1).write.mode("append").parquet(layout.run_journal)


def read_late_rows(spark: SparkSession, layout: DatasetLayout) -> DataFrame:
    """Rows that came after their series' mark had passed them, with the batch that had them."""
    return read_table(spark, layout.late_rows(), LATE_ROWS)


def frozen_marks(spark: SparkSession, layout: DatasetLayout, catch_up: str) -> DataFrame:
    """The marks as they were when ``catch_up`` began, whatever its batches have saved since.

    The folder is written once, so a catch-up that is started again goes on with the same marks.
    """
    path = layout.frozen_marks(catch_up)
    known = read_table(spark, path, STATE)
    if not known.inputFiles():
        load_state(spark, layout).coalesce(1).write.mode("overwrite").parquet(path)
        known = read_table(spark, path, STATE)
    return known.select(CODE, MARK)


def _list_late(rows: DataFrame, layout: DatasetLayout, version_id: str, marks: DataFrame) -> None:
    """Write the batch's late rows; a repeated batch replaces them."""
    joined = lookup_join(rows, marks.where(F.col(MARK).isNotNull()), [CODE], "inner", ["obs_local"])
    late = joined.where(F.col("obs_local") <= F.col(MARK))
    columns = [
        (F.col(f.name) if f.name in late.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in LATE_ROWS.fields
        if f.name != "batch"
    ]
    late.select(*columns).write.mode("overwrite").parquet(layout.late_rows(version_id))


def layout_of(root: str, config: dict) -> DatasetLayout:
    """Where the dataset of ``config`` lives; ``partition_columns`` there name its folders."""
    dataset_id = config.get("dataset_id", "default")
    folders = tuple(config.get("partition_columns", PARTITION_COLUMNS))
    return DatasetLayout(root, dataset_id, folders, bool(config.get("track_files", False)))


def _commit(
    raw, config, layout, series, run_ts, stages, as_of, late_rows, version_id, frozen=None
) -> tuple[bool, DataFrame | None]:
    """Whether a version was committed, and the marks of the rows seen."""
    spark = raw.sparkSession
    # Staged: small, and the size check before the join would otherwise read the log twice.
    if late_rows:
        marks = spark.createDataFrame([], marks_for(load_state(spark, layout), series).schema)
    else:
        marks = staged(marks_for(load_state(spark, layout), series), "marks")
    rows, final = observations_of(raw, stages, marks)
    if frozen is not None and stages.normalize:
        # Both sinks read the normalised rows as they were written once.
        rows = staged(rows, "normalized")
        _list_late(rows, layout, version_id, frozen)
        final = rows.transform(stages.transform) if stages.transform else rows
    elif not stages.keeps_rows and stages.normalize:
        # Marks are those of the normalised rows, whatever the transform makes of them.
        rows = staged(rows, "normalized")
        final = rows.transform(stages.transform) if stages.transform else rows
    days = config.get("windowInDays")
    if days is None:
        seen = None
        if not stages.keeps_rows and stages.normalize:
            seen = _kept_marks(rows, layout, version_id)
        committed = commit_version(final, layout, version_id, run_ts, stages.unique_keys)
        if stages.keeps_rows:
            return committed, version_marks(spark, layout, version_id) if committed else None
        return committed, seen
    # Marks cover rows the window drops, so the rows are written once and read twice.
    final = staged(final, "observations")
    seen = _kept_marks(final if stages.keeps_rows else rows, layout, version_id)
    recent = within_window(final, days, as_of or run_ts)
    committed = commit_version(recent, layout, version_id, run_ts, stages.unique_keys)
    return committed, seen


def _kept_marks(rows: DataFrame, layout: DatasetLayout, version_id: str) -> DataFrame:
    """Marks that do not follow from the version's rows are written before its commit."""
    spark = rows.sparkSession
    high_water_marks(rows).coalesce(1).write.mode("overwrite").parquet(layout.marks(version_id))
    return version_marks(spark, layout, version_id)


def version_marks(spark: SparkSession, layout: DatasetLayout, version_id: str) -> DataFrame:
    """The marks of a version's run: those kept beside it, else those of its file index."""
    kept = read_table(spark, layout.marks(version_id), STATE).select(CODE, MARK)
    if kept.inputFiles():
        return kept
    index = read_file_index(spark, layout, version_id)
    return high_water_marks(index.select(CODE, F.col("max_obs_local").alias("obs_local")))
