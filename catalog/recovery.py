"""What changed, what was refused, what came late, and runs that broke."""

from __future__ import annotations

from contextlib import suppress
from datetime import timedelta
from unittest import mock

from pyspark.sql import functions as F

from catalog.registry import query, table
from catalog.shapes import CODE, OBS_SQL, RUN_TS, SERIES_CONFIG, ZONE, points, wall
from catalog.storage import _FINAL_SQL, _final, _final_rows
from tidemark.functions.paths import month_text
from tidemark.functions.times import iso_text
from tidemark.operators.enrich import enrich
from tidemark.operators.normalize import normalize
from tidemark.plans import changelog, projection, refresh, versions
from tidemark.plans.layout import DatasetLayout
from tidemark.session import work_folder
from tidemark.sources import published
from tidemark.sources.series import series_map
from tidemark.streaming.refresh_stream import refresh_stream

_TWO_SQL = f"""
WITH {OBS_SQL}, old AS (
  SELECT code, clk, arg_min(value, ord) AS v FROM obs WHERE ord % 4 <> 0 GROUP BY code, clk),
new AS (
  SELECT code, clk, arg_min(CASE WHEN ord % 3 = 0 THEN value + 1 ELSE value END, ord) AS v
  FROM obs WHERE ord % 4 <> 1 GROUP BY code, clk)"""


def _two_versions(spark, sf_dir):
    """Two versions that share most keys; a third of the second one's values are others."""
    layout = DatasetLayout(work_folder(spark, "recovery"), "events")
    rows = points(spark, sf_dir)
    other = F.when(F.col("ord") % 3 == 0, F.col("value") + 1).otherwise(F.col("value"))
    parts = (rows.where(F.col("ord") % 4 != 0), rows.where(F.col("ord") % 4 != 1).withColumn("value", other))
    for number, part in enumerate(parts):
        run_ts = RUN_TS + timedelta(hours=number)
        version_id = versions.new_version_id(run_ts)
        versions.commit_version(_final_rows(spark, sf_dir, part), layout, version_id, run_ts, unique_keys=True)
    return layout, version_id


@query(f"""{_TWO_SQL}
SELECT clk + INTERVAL 3 HOUR AS obs_time, code AS internal_series_code,
  CASE WHEN o.hit IS NULL THEN 'added' WHEN n.hit IS NULL THEN 'removed' ELSE 'changed' END AS change,
  o.v AS old_value, n.v AS new_value, false AS facts_changed
FROM (SELECT *, 1 AS hit FROM old) o FULL JOIN (SELECT *, 1 AS hit FROM new) n USING (code, clk)
WHERE o.hit IS NULL OR n.hit IS NULL OR o.v IS DISTINCT FROM n.v""")
def version_changelog(spark, sf_dir):
    layout, version_id = _two_versions(spark, sf_dir)
    found = changelog.version_changelog(spark, layout, version_id)
    return found.withColumn("obs_time", wall("obs_time"))


@query(f"""{_TWO_SQL}
SELECT clk + INTERVAL 3 HOUR AS obs_time, code AS internal_series_code, old.v AS stored_value,
  new.v AS refused_value, 1::BIGINT AS batch_rows, new.v AS least_value, new.v AS largest_value,
  true AS is_stored, 'v20240201_133015_250000' AS version_id
FROM old JOIN new USING (code, clk) WHERE old.v IS DISTINCT FROM new.v""")
def merge_conflicts(spark, sf_dir):
    layout, version_id = _two_versions(spark, sf_dir)
    ids = [versions.new_version_id(RUN_TS), version_id]
    for one in ids:
        projection.project_version(spark, layout, one, RUN_TS, report_refused=True)
    found = projection.read_refused(spark, layout)
    return found.withColumn("obs_time", wall("obs_time"))


def _lost(*args, **how):
    raise OSError("lost")


@query(f"""
WITH {_FINAL_SQL} SELECT *, 2::BIGINT AS commits, 0::BIGINT AS unfinished FROM final
WHERE internal_series_code IN (SELECT code FROM facts)""")
def refresh_resumed(spark, sf_dir):
    """One run breaks before its marks are saved, the next while projecting; the third finishes."""
    root = work_folder(spark, "resumed")
    rows = points(spark, sf_dir)
    series = series_map(spark, SERIES_CONFIG)
    sources = (rows.where(F.col("obs_ts") < "2024-01-16"), rows, rows)
    for number, (source, step) in enumerate(zip(sources, ("save_state", "project_current", None))):
        run_ts = RUN_TS + timedelta(days=number)
        stages = refresh.table_stages(series, SERIES_CONFIG, run_ts, ["ord"], configured_only=True)
        if step is None:
            refresh.run_refresh(source, SERIES_CONFIG, root, run_ts, stages)
            continue
        # The second run finishes the first before it breaks itself.
        with mock.patch.object(refresh, step, _lost), suppress(OSError):
            refresh.run_refresh(source, SERIES_CONFIG, root, run_ts, stages)
    layout = DatasetLayout(root, SERIES_CONFIG["dataset_id"])
    commits = versions.committed_versions(spark, layout).count()
    left = refresh.unfinished_runs(spark, layout).count()
    return _final(projection.read_projection(spark, layout)).withColumns(
        {"commits": F.lit(commits).cast("bigint"), "unfinished": F.lit(left).cast("bigint")}
    )


@query(f"""
WITH {OBS_SQL}
SELECT code AS internal_series_code, max(clk) AS last_obs_local,
  (SELECT count(*) FROM (SELECT code, clk, arg_min(value, ord) AS v FROM obs GROUP BY code, clk)
   WHERE v >= 50)::BIGINT AS stored
FROM obs GROUP BY code""")
def refresh_state(spark, sf_dir):
    """A transform drops rows: marks are those of the normalised ones, whatever is stored."""
    root = work_folder(spark, "state")
    rows = points(spark, sf_dir)
    series = series_map(spark, SERIES_CONFIG)
    for number, source in enumerate((rows.where(F.col("obs_ts") < "2024-01-16"), rows)):
        run_ts = RUN_TS + timedelta(days=number)
        given = refresh.table_stages(series, SERIES_CONFIG, run_ts, ["ord"])
        stages = refresh.Stages(
            given.parse,
            lambda points: normalize(points, ZONE, True, ["ord"], describe=False),
            lambda rows, at=run_ts: enrich(rows, series, at).where("value >= 50"),
            unique_keys=True,
        )
        refresh.run_refresh(source, SERIES_CONFIG, root, run_ts, stages)
    layout = DatasetLayout(root, SERIES_CONFIG["dataset_id"])
    stored = projection.read_projection(spark, layout).count()
    state = refresh.load_state(spark, layout)
    return state.select(CODE, "last_obs_local", F.lit(stored).cast("bigint").alias("stored"))


@query(f"""
WITH {OBS_SQL}, marks AS (SELECT code, max(clk) AS mark FROM obs WHERE clk < '2024-01-16' GROUP BY code)
SELECT clk + INTERVAL 3 HOUR AS obs_time, clk AS obs_local, code AS internal_series_code,
  arg_min(value, ord) AS value, mark AS last_obs_local
FROM obs JOIN marks USING (code) WHERE clk <= mark GROUP BY code, clk, mark""")
def stream_late_rows(spark, sf_dir):
    """Files in mixed order after a run: what was at or before its marks is merged and listed."""
    root = work_folder(spark, "late")
    rows = points(spark, sf_dir)
    series = series_map(spark, SERIES_CONFIG)
    first = refresh.table_stages(series, SERIES_CONFIG, RUN_TS, ["ord"])
    refresh.run_refresh(rows.where(F.col("obs_ts") < "2024-01-16"), SERIES_CONFIG, root, RUN_TS, first)
    part = F.pmod(F.dayofyear("obs_ts") * 3, F.lit(4))
    rows.withColumn("part", part).repartition(4, "part").write.partitionBy("part").parquet(f"{root}/in")
    files = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2)
    refresh_stream(
        files.option("recursiveFileLookup", True).parquet(f"{root}/in"),
        SERIES_CONFIG,
        root,
        RUN_TS + timedelta(days=1),
        f"{root}/checkpoint",
        lambda run_ts: refresh.table_stages(series, SERIES_CONFIG, run_ts, ["ord"]),
    ).awaitTermination()
    late = refresh.read_late_rows(spark, DatasetLayout(root, SERIES_CONFIG["dataset_id"]))
    return late.select(wall("obs_time"), "obs_local", CODE, "value", "last_obs_local")


@query("""
SELECT upper(event_type) AS series, year(ts)::INTEGER AS year, floor(event_id / 500)::BIGINT AS part
FROM events WHERE floor(event_id / 500)::BIGINT % 3 = 0 GROUP BY ALL""")
def published_rejects(spark, sf_dir):
    """Documents of which a third are cut off: those are listed, with their place."""
    clock = F.date_trunc("second", F.col("ts"))
    rows = table(spark, sf_dir, "events").select(
        iso_text(clock.cast("timestamp_ntz"), clock).alias("obs_time"),
        F.upper("event_type").alias(CODE),
        "value",
        F.upper("event_type").alias("series"),
        F.year("ts").alias("year"),
        F.floor(F.col("event_id") / 500).alias("part"),
        month_text(F.col("ts")).alias("month"),
    )
    documents = rows.groupBy("series", "year", "part").agg(
        F.to_json(F.collect_list(F.struct("obs_time", CODE, "value"))).alias("text")
    )
    cut = F.when(F.col("part") % 3 == 0, F.expr("substr(text, 1, length(text) - 5)")).otherwise(F.col("text"))
    root = work_folder(spark, "rejects")
    writer = documents.select("series", "year", "part", cut.alias("value")).write
    writer.option("maxRecordsPerFile", 1).partitionBy("series", "year", "part").text(root)
    found = published.published_rejects(spark, root, "*.txt")

    def named(name):
        return F.regexp_extract("path", f"/{name}=([^/]*)/", 1)

    return found.select(
        named("series").alias("series"), named("year").cast("int").alias("year"), named("part").cast("bigint").alias("part")
    )
