"""Tables on disk: published files, versions, projections, whole runs, the stream."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from catalog.registry import query, table
from catalog.shapes import (
    CODE,
    OBS_SQL,
    RUN_TS,
    SERIES_CONFIG,
    SERIES_SQL,
    ZONE,
    listings,
    events_as_points,
    orders_as_observations,
    points,
    wall,
)
from tidemark.functions.paths import month_text, partition_folder
from tidemark.functions.times import iso_text, to_instant
from tidemark.operators.enrich import enrich, instant_literal
from tidemark.operators.incremental import only_new
from tidemark.operators.normalize import normalize
from tidemark.operators.partitions import present_partitions, write_partitioned
from tidemark.plans import projection, versions
from tidemark.plans.layout import DatasetLayout
from tidemark.plans.refresh import Stages, run_refresh, table_stages
from tidemark.session import work_folder
from tidemark.sources import published
from tidemark.sources.series import series_map
from tidemark.streaming.refresh_stream import refresh_stream


@query("""
SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') AS obs_time, upper(event_type) AS internal_series_code,
       value, 'u' AS unit, NULL::VARCHAR AS frequency, '2024-02-01T00:00:00+00:00' AS collection_date
FROM events""")
def scan_published(spark, sf_dir):
    clock = F.date_trunc("second", F.col("ts"))
    wall_clock = clock.cast("timestamp_ntz")
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        iso_text(wall_clock, clock).alias("obs_time"),
        F.upper("event_type").alias(CODE),
        "value",
        F.lit("u").alias("unit"),
        F.lit(None).cast("string").alias("frequency"),
        F.lit("2024-02-01T00:00:00+00:00").alias("collection_date"),
        F.upper("event_type").alias("series"),
        F.year("ts").alias("year"),
        month_text(F.col("ts")).alias("month"),
    )
    row = F.struct("obs_time", CODE, "value", "unit", "frequency", "collection_date")
    # Documents of at most 10,000 rows: an id range is one document per series.
    documents = rows.groupBy(
        "series", "year", "month", F.floor(F.col("event_id") / 10_000).alias("part")
    ).agg(F.collect_list(row).alias("data"))
    text = (
        F.when(F.col("part") % 2 == 0, F.to_json("data"))
        .when(F.size("data") == 1, F.to_json(F.col("data")[0]))
        .otherwise(F.to_json(F.struct("data")))
    )
    root = work_folder(spark, "published")
    documents.select("series", "year", "month", text.alias("value")).write.option(
        "maxRecordsPerFile", 1
    ).partitionBy("series", "year", "month").text(root)
    return published.scan_published(spark, root, "*.txt")


@query(f"""
WITH {OBS_SQL}
SELECT strftime(clk, '%Y-%m-%dT%H:%M:%S-03:00') AS obs_time, code AS internal_series_code, value,
       'u' AS unit, NULL::VARCHAR AS frequency, '2024-02-01T12:30:15.250000+00:00' AS collection_date
FROM obs""")
def published_roundtrip(spark, sf_dir):
    rows = points(spark, sf_dir).select(
        to_instant(F.col("obs_ts"), ZONE).alias("obs_time"),
        F.col("obs_ts").alias("obs_local"),
        CODE,
        "value",
        F.lit("u").alias("unit"),
        F.lit(None).cast("string").alias("frequency"),
        instant_literal(RUN_TS).alias("collection_date"),
    )
    root = work_folder(spark, "published")
    published.write_published(rows, root)
    return published.scan_published(spark, root)


@query(f"""
WITH {OBS_SQL}, turns AS (SELECT *, CASE WHEN ord % 3 = 0 THEN 0 ELSE 1 END AS turn FROM obs),
ranked AS (SELECT *, row_number() OVER (PARTITION BY code, clk ORDER BY turn, value) AS rn FROM turns)
SELECT strftime(clk, '%Y-%m-%dT%H:%M:%S-03:00') AS obs_time, code AS internal_series_code, value,
       'u' AS unit, NULL::VARCHAR AS frequency, '2024-02-01T12:30:15.250000+00:00' AS collection_date
FROM ranked WHERE rn = 1""")
def merge_published(spark, sf_dir):
    """Two folders of published files merged on disk by their text keys."""
    root = work_folder(spark, "published")
    rows = points(spark, sf_dir).select(
        to_instant(F.col("obs_ts"), ZONE).alias("obs_time"),
        F.col("obs_ts").alias("obs_local"),
        CODE,
        "value",
        F.lit("u").alias("unit"),
        F.lit(None).cast("string").alias("frequency"),
        instant_literal(RUN_TS).alias("collection_date"),
        "ord",
    )
    old = F.col("ord") % 3 == 0
    published.write_published(rows.where(old), f"{root}/old")
    published.write_published(rows.where(~old), f"{root}/new")
    published.merge_published(spark, f"{root}/old", f"{root}/new", f"{root}/merged")
    return published.scan_published(spark, f"{root}/merged")


@query("""
SELECT o_orderstatus AS internal_series_code, year(o_orderdate)::INTEGER AS year,
       printf('%02d', month(o_orderdate)) AS month, o_orderdate AS obs_local,
       o_totalprice AS value, o_orderkey AS ord
FROM orders""")
def partitioned_write(spark, sf_dir):
    root = work_folder(spark, "partitioned")
    write_partitioned(orders_as_observations(spark, sf_dir), root)
    return (
        spark.read.schema(
            "obs_local timestamp_ntz, value double, ord bigint, "
            "internal_series_code string, year int, month string"
        )
        .parquet(root)
        .select(CODE, "year", "month", "obs_local", "value", "ord")
    )


def _final_rows(spark, sf_dir, source=None):
    source = points(spark, sf_dir) if source is None else source
    rows = normalize(source, ZONE, order=["ord"], describe=False)
    return enrich(rows, series_map(spark, SERIES_CONFIG), RUN_TS)


_FINAL_SQL = f"""{OBS_SQL}, {SERIES_SQL}, final AS (
  SELECT clk + INTERVAL 3 HOUR AS obs_time, clk AS obs_local, obs.code AS internal_series_code,
         arg_min(value, ord) AS value, any_value(unit) AS unit, any_value(frequency) AS frequency
  FROM obs LEFT JOIN facts ON facts.code = obs.code GROUP BY obs.code, clk)"""

def _final(rows):
    return rows.select(wall("obs_time"), "obs_local", CODE, "value", "unit", "frequency")



@query(f"WITH {_FINAL_SQL} SELECT * FROM final")
def version_roundtrip(spark, sf_dir):
    layout = DatasetLayout(work_folder(spark, "versions"), "events")
    version_id = versions.new_version_id(RUN_TS)
    versions.commit_version(_final_rows(spark, sf_dir), layout, version_id, RUN_TS)
    current = versions.current_version(spark, layout)
    return _final(versions.read_version(spark, layout, current))


@query(f"""
WITH {_FINAL_SQL}
SELECT 'v20240201_123015_250000' AS version_id, 'events' AS dataset_id,
  '2024-02-01T12:30:15Z' AS created_at, '2024-02-01T12:30:15Z' AS collection_date,
  count(*)::BIGINT AS data_points_count, count(DISTINCT internal_series_code) AS series_count,
  array_to_string(list_sort(list(DISTINCT internal_series_code)), ',') AS series_codes,
  strftime(min(obs_local), '%Y-%m-%dT%H:%M:%SZ') AS min_obs_time,
  strftime(max(obs_local), '%Y-%m-%dT%H:%M:%SZ') AS max_obs_time,
  array_to_string(list_sort(list(DISTINCT printf('%s/year=%d/month=%02d/', internal_series_code,
     year(obs_local), month(obs_local)))), ',') AS partitions,
  true AS files_in_partitions
FROM final""")
def version_manifest(spark, sf_dir):
    layout = DatasetLayout(work_folder(spark, "manifest"), "events")
    version_id = versions.new_version_id(RUN_TS)
    versions.commit_version(_final_rows(spark, sf_dir), layout, version_id, RUN_TS)
    manifest = versions.load_manifest(spark, layout, version_id)
    listed = listings(versions.read_file_index(spark, layout, version_id), version_id)
    return manifest.join(listed, "version_id").select(
        "version_id",
        "dataset_id",
        "created_at",
        "collection_date",
        "data_points_count",
        "series_count",
        "series_codes",
        "date_range.min_obs_time",
        "date_range.max_obs_time",
        "partitions",
        (F.col("folders") == F.col("partitions")).alias("files_in_partitions"),
    )


_TWO_VERSIONS_SQL = f"""
WITH {OBS_SQL}, turns AS (
  SELECT *, CASE WHEN ord % 3 = 0 AND clk < '2024-01-20' THEN 0 ELSE 1 END AS turn FROM obs),
ranked AS (SELECT *, row_number() OVER (PARTITION BY code, clk ORDER BY turn, ord) AS rn FROM turns)
SELECT clk + INTERVAL 3 HOUR AS obs_time, clk AS obs_local, code AS internal_series_code, value
FROM ranked WHERE rn = 1"""


def _project_two(spark, sf_dir, publish):
    """Two overlapping versions, projected in turn."""
    layout = DatasetLayout(work_folder(spark, "projection"), "events")
    rows = points(spark, sf_dir)
    old = (F.col("ord") % 3 == 0) & (F.col("obs_ts") < "2024-01-20")
    for number, part in enumerate((rows.where(old), rows.where(~old))):
        run_ts = RUN_TS + timedelta(hours=number)
        version_id = versions.new_version_id(run_ts)
        versions.commit_version(
            _final_rows(spark, sf_dir, part), layout, version_id, run_ts, unique_keys=True
        )
        projection.project_current(spark, layout, run_ts, publish=publish, bucket="b")
    return projection.read_projection(spark, layout).select(
        wall("obs_time"), "obs_local", CODE, "value"
    )


@query(_TWO_VERSIONS_SQL)
def projection_publish(spark, sf_dir):
    return _project_two(spark, sf_dir, "append")


@query(_TWO_VERSIONS_SQL)
def projection_rewrite(spark, sf_dir):
    return _project_two(spark, sf_dir, "rewrite")


def _project_pending(spark, sf_dir, folders, publish):
    """Three versions committed one after the other, then projected in one pass."""
    layout = DatasetLayout(work_folder(spark, "pending"), "events", folders)
    rows = points(spark, sf_dir)
    for number in range(3):
        run_ts = RUN_TS + timedelta(hours=number)
        part = _final_rows(spark, sf_dir, rows.where(F.col("ord") % 3 == number))
        versions.commit_version(part, layout, versions.new_version_id(run_ts), run_ts)
    projection.project_pending(spark, layout, RUN_TS, publish=publish, bucket="b")
    return layout


_PENDING_SQL = f"""
WITH {OBS_SQL},
ranked AS (SELECT *, row_number() OVER (PARTITION BY code, clk ORDER BY ord % 3, ord) AS rn FROM obs)
SELECT clk + INTERVAL 3 HOUR AS obs_time, clk AS obs_local, code AS internal_series_code, value
FROM ranked WHERE rn = 1"""


@query(_PENDING_SQL)
def projection_pending(spark, sf_dir):
    """Partitions by year alone."""
    layout = _project_pending(spark, sf_dir, ("year",), "append")
    return projection.read_projection(spark, layout).select(
        wall("obs_time"), "obs_local", CODE, "value"
    )


@query(f"""
WITH {OBS_SQL}, numbered AS (SELECT *, ord % 3 AS n FROM obs)
SELECT 'v20240201_1' || (2 + n) || '3015_250000' AS version_id, 'series_year' AS partition_strategy,
       count(DISTINCT (code, clk))::BIGINT AS points,
       count(DISTINCT (code, year(clk)))::BIGINT AS listed,
       count(DISTINCT (code, year(clk)))::BIGINT AS folders
FROM numbered GROUP BY n""")
def partition_columns(spark, sf_dir):
    """Manifests and folders of versions that are partitioned by series and year."""
    layout = _project_pending(spark, sf_dir, (CODE, "year"), "rewrite")
    ids = [r["version_id"] for r in versions.committed_versions(spark, layout).collect()]  # three
    manifests = [versions.load_manifest(spark, layout, one) for one in ids]
    found = []
    for one, manifest in zip(ids, manifests):
        stored = versions.read_stored(spark, layout.data(one))
        folders = present_partitions(stored, layout.partition_columns)
        counts = folders.agg(F.count("*").alias("folders")).withColumn("version_id", F.lit(one))
        found.append(
            manifest.join(counts, "version_id").select(
                "version_id",
                "partition_strategy",
                F.col("data_points_count").alias("points"),
                F.col("partition_count").alias("listed"),
                "folders",
            )
        )
    return found[0].unionAll(found[1]).unionAll(found[2])


@query(f"""
WITH {OBS_SQL}, numbered AS (SELECT *, ord % 3 AS n FROM obs)
SELECT 'v20240201_1' || (2 + n) || '3015_250000' AS version_id, code AS internal_series_code,
       year(clk)::INTEGER AS year, count(DISTINCT clk)::BIGINT AS points, true AS all_listed
FROM numbered GROUP BY ALL""")
def version_files(spark, sf_dir):
    """Points in the files that each version lists; every stored file is listed and none else."""
    layout = _project_pending(spark, sf_dir, (CODE, "year"), "append")
    ids = [r["version_id"] for r in versions.committed_versions(spark, layout).collect()]  # three
    found = []
    for one in ids:
        listed = versions.version_files(versions.read_file_index(spark, layout, one), layout.partition_columns)
        name = F.col("_metadata.file_name")
        folder = partition_folder(layout.partition_columns)
        stored = versions.read_stored(spark, layout.data(one)).withColumn("file", F.concat(folder, name))
        files = stored.groupBy("file", CODE, "year").agg(F.count("*").alias("points"))
        both = files.join(listed.withColumn("listed", F.lit(True)), "file", "full")
        ok = F.col("listed").isNotNull() & F.col("points").isNotNull()
        found.append(
            both.groupBy(F.lit(one).alias("version_id"), CODE, "year").agg(
                F.sum("points").alias("points"), F.bool_and(ok).alias("all_listed")
            )
        )
    return found[0].unionAll(found[1]).unionAll(found[2])


@query(f"""
WITH {OBS_SQL}
SELECT 'events' AS dataset_id, 'v20240201_1' || (2 + n) || '3015_250000' AS version_id,
       (3 - n)::BIGINT AS place
FROM (SELECT DISTINCT ord % 3 AS n FROM obs)""")
def list_committed(spark, sf_dir):
    """The committed versions, newest first; one without rows and one repeated add nothing."""
    layout = _project_pending(spark, sf_dir, (CODE, "year"), "append")
    rows = points(spark, sf_dir)
    again = _final_rows(spark, sf_dir, rows.where("ord % 3 = 0"))
    versions.commit_version(again, layout, versions.new_version_id(RUN_TS), RUN_TS)
    later = RUN_TS + timedelta(days=1)
    nothing = _final_rows(spark, sf_dir, rows.where("false"))
    versions.commit_version(nothing, layout, versions.new_version_id(later), later)
    listed = versions.committed_versions(spark, layout).collect()  # a row per version
    return spark.createDataFrame(
        [(r["dataset_id"], r["version_id"], n) for n, r in enumerate(listed, 1)],
        "dataset_id string, version_id string, place bigint",
    )


@query("""
SELECT DISTINCT o_orderstatus AS internal_series_code, year(o_orderdate)::INTEGER AS year,
       printf('%02d', month(o_orderdate)) AS month
FROM orders ORDER BY ALL""")
def partitions_present(spark, sf_dir):
    root = work_folder(spark, "partitions")
    rows = versions.as_observations(
        orders_as_observations(spark, sf_dir).drop("ord")
    )
    write_partitioned(rows, root)
    return present_partitions(versions.read_stored(spark, root))


@query(f"WITH {_FINAL_SQL} SELECT * FROM final")
def refresh_e2e(spark, sf_dir):
    """Two runs: the first half of the month, then everything (old rows fall to the marks)."""
    root = work_folder(spark, "refresh")
    rows = points(spark, sf_dir)
    series = series_map(spark, SERIES_CONFIG)
    for number, source in enumerate((rows.where(F.col("obs_ts") < "2024-01-16"), rows)):
        run_ts = RUN_TS + timedelta(days=number)
        stages = table_stages(series, SERIES_CONFIG, run_ts, ["ord"])
        run_refresh(source, SERIES_CONFIG, root, run_ts, stages, bucket="b")
    layout = DatasetLayout(root, SERIES_CONFIG["dataset_id"])
    return _final(projection.read_projection(spark, layout))


@query(f"WITH {_FINAL_SQL} SELECT *, 7::BIGINT AS commits FROM final")
def stream_many_batches(spark, sf_dir):
    """A file per micro-batch, days in mixed order: rows before a mark are merged, none is lost."""
    root = work_folder(spark, "batches")
    rows = points(spark, sf_dir)
    part = F.pmod(F.dayofyear("obs_ts") * 3, F.lit(7))
    rows.withColumn("part", part).repartition(7, "part").write.partitionBy("part").parquet(f"{root}/in")
    series = series_map(spark, SERIES_CONFIG)
    files = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1)
    source = files.option("recursiveFileLookup", True).parquet(f"{root}/in")
    refresh_stream(
        source,
        SERIES_CONFIG,
        root,
        RUN_TS,
        f"{root}/checkpoint",
        lambda run_ts: table_stages(series, SERIES_CONFIG, run_ts, ["ord"]),
        bucket="b",
    ).awaitTermination()
    layout = DatasetLayout(root, SERIES_CONFIG["dataset_id"])
    commits = spark.read.parquet(layout.commit_log).agg(F.count("*").alias("commits"))
    return _final(projection.read_projection(spark, layout)).withColumn(
        "commits", F.lit(commits.first()["commits"]).cast("bigint")
    )


@query(f"WITH {_FINAL_SQL} SELECT * FROM final")
def stream_incremental(spark, sf_dir):
    """The events table as a file stream, one refresh per micro-batch."""
    root = work_folder(spark, "stream")
    series = series_map(spark, SERIES_CONFIG)

    def stages_for(run_ts: datetime) -> Stages:
        later = table_stages(series, SERIES_CONFIG, run_ts, ["ord"])
        return Stages(
            lambda batch, marks: only_new(events_as_points(batch), marks, spread=["ord"]),
            later.normalize,
            later.transform,
            later.unique_keys,
        )

    schema = table(spark, sf_dir, "events").schema
    # The glob makes a single file and a folder of files equally good sources.
    source = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")
    refresh_stream(
        source, SERIES_CONFIG, root, RUN_TS, f"{root}/checkpoint", stages_for
    ).awaitTermination()
    layout = DatasetLayout(root, SERIES_CONFIG["dataset_id"])
    return _final(projection.read_projection(spark, layout))
