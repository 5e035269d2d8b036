"""Row operators: validity, de-duplication, increments, enrichment, merging, summaries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from catalog.registry import query, table
from catalog.shapes import (
    CODE,
    OBS_SQL,
    RAW_SQL,
    RUN_TS,
    SERIES_CONFIG,
    SERIES_SQL,
    ZONE,
    listings,
    observations,
    orders_as_observations,
    points,
    raw_points,
    wall,
)
from tidemark.functions.times import iso_text, to_instant
from tidemark.operators import dedup, enrich, incremental, merge, normalize as normalizing
from tidemark.operators import partitions, summary
from tidemark.plans.projection import pending_versions, projection_status
from tidemark.plans.versions import current_versions
from tidemark.plans.versions import list_versions as versions_in
from tidemark.plans.versions import manifest_of
from tidemark.session import staged
from tidemark.sources.series import series_map

_MIDDLE = "2024-01-16"


@query(f"""
WITH {OBS_SQL}
SELECT code AS internal_series_code, clk AS obs_local, arg_min(value, ord) AS value,
       min(ord) AS ord
FROM obs GROUP BY code, clk""")
def dedup_first(spark, sf_dir):
    rows = points(spark, sf_dir).withColumnRenamed("obs_ts", "obs_local")
    return dedup.keep_first(rows, [CODE, "obs_local"], ["ord"])


@query(f"""
WITH {RAW_SQL}
SELECT ord, code AS internal_series_code, clk AS obs_ts,
       try_cast(replace(txt, ',', '.') AS DOUBLE) AS value
FROM raw WHERE code <> '' AND clk IS NOT NULL
  AND try_cast(replace(txt, ',', '.') AS DOUBLE) IS NOT NULL""")
def validity_filter(spark, sf_dir):
    return normalizing.valid_points(raw_points(spark, sf_dir))


@query(f"""
WITH {RAW_SQL}, ok AS (
  SELECT ord, code, clk, try_cast(replace(txt, ',', '.') AS DOUBLE) AS value FROM raw
  WHERE code <> '' AND clk IS NOT NULL AND txt <> 'n/a')
SELECT timezone('UTC', timezone('{ZONE}', clk)) AS obs_time, clk AS obs_local,
       code AS internal_series_code, arg_min(value, ord) AS value,
       NULL::VARCHAR AS unit, NULL::VARCHAR AS frequency
FROM ok GROUP BY code, clk""")
def normalize(spark, sf_dir):
    rows = normalizing.normalize(raw_points(spark, sf_dir), ZONE, order=["ord"])
    return rows.withColumn("obs_time", wall("obs_time"))


@query(f"""
WITH {RAW_SQL}
SELECT clk AS obs_time, clk - INTERVAL 3 HOUR AS obs_local, code AS internal_series_code,
       try_cast(replace(txt, ',', '.') AS DOUBLE) AS value, ord
FROM raw WHERE code <> '' AND clk IS NOT NULL AND txt <> 'n/a'""")
def normalize_aware(spark, sf_dir):
    """Instants instead of wall clocks, duplicates kept."""
    raw = raw_points(spark, sf_dir).withColumn("obs_ts", F.col("obs_ts").cast("timestamp"))
    rows = normalizing.normalize(raw, ZONE, dedup=False, order=["ord"])
    return rows.select(
        wall("obs_time"), "obs_local", CODE, "value", F.col("ord.pos").alias("ord")
    )


@query(f"""
WITH {OBS_SQL}
SELECT code AS internal_series_code, max(clk) AS last_obs_local FROM obs GROUP BY code""")
def high_water_mark(spark, sf_dir):
    return incremental.high_water_marks(observations(spark, sf_dir))


def _saved_marks(spark, sf_dir, upper_codes=("ERROR", "SIGNUP", "PURCHASE")):
    """Marks of the first half, and those of the second half for some series."""
    rows = observations(spark, sf_dir)
    early = incremental.high_water_marks(rows.where(F.col("obs_local") < _MIDDLE))
    late = incremental.high_water_marks(
        rows.where((F.col("obs_local") >= _MIDDLE) & F.col(CODE).isin(*upper_codes))
    )
    dataset = F.lit("events").alias("dataset_id")
    return early.select(dataset, "*"), late.select(dataset, "*")


_MARKS_SQL = f"""{OBS_SQL},
early AS (SELECT code, max(clk) AS mark FROM obs WHERE clk < '{_MIDDLE}' GROUP BY code),
late AS (SELECT code, max(clk) AS mark FROM obs
         WHERE clk >= '{_MIDDLE}' AND code IN ('ERROR','SIGNUP','PURCHASE') GROUP BY code)"""


@query(f"""
WITH {_MARKS_SQL}, {SERIES_SQL}
SELECT 'events' AS dataset_id, early.code AS internal_series_code,
       coalesce(late.mark, early.mark) AS last_obs_local
FROM early LEFT JOIN late USING (code) WHERE code IN (SELECT code FROM facts)""")
def state_lookup(spark, sf_dir):
    early, late = _saved_marks(spark, sf_dir)
    log = early.withColumn("saved_at", F.lit("2024-02-01").cast("timestamp")).unionByName(
        late.withColumn("saved_at", F.lit("2024-02-02").cast("timestamp"))
    )
    return incremental.marks_for(incremental.latest_state(log), series_map(spark, SERIES_CONFIG))


@query(f"""
WITH {_MARKS_SQL}
SELECT 'events' AS dataset_id, coalesce(late.code, early.code) AS internal_series_code,
       coalesce(late.mark, early.mark) AS last_obs_local
FROM early FULL OUTER JOIN late ON early.code = late.code""")
def state_merge(spark, sf_dir):
    early, late = _saved_marks(spark, sf_dir)
    return incremental.merge_state(early, late)


@query(f"""
WITH {_MARKS_SQL}
SELECT 'events' AS dataset_id, early.code AS internal_series_code,
       greatest(late.mark, early.mark) AS last_obs_local
FROM early LEFT JOIN late ON early.code = late.code""")
def state_merge_monotonic(spark, sf_dir):
    early, late = _saved_marks(spark, sf_dir)
    return incremental.merge_state(late, early, monotonic=True)


@query("""
SELECT 'u' || user_id AS dataset_id, upper(event_type) AS internal_series_code,
       date_trunc('second', max(ts)) AS last_obs_local
FROM events GROUP BY ALL""")
def state_import(spark, sf_dir):
    """One JSON state document per user, with offsets that are to be ignored."""
    last = F.max("ts")
    marks = (
        table(spark, sf_dir, "events")
        .groupBy("user_id", F.upper("event_type").alias(CODE))
        .agg(F.date_format(last, "yyyy-MM-dd'T'HH:mm:ss'-03:00'").alias("iso"))
    )
    # At most one entry per event type.
    pairs = F.map_from_entries(F.collect_list(F.struct(CODE, "iso")))
    documents = marks.groupBy(F.concat(F.lit("u"), "user_id").alias("dataset_id")).agg(
        F.to_json(pairs).alias("state_json")
    )
    return incremental.state_from_json(documents)


@query("""
SELECT 'u' || user_id AS dataset_id, upper(event_type) AS internal_series_code,
       max(ts)::TIMESTAMP AS last_obs_local
FROM events GROUP BY ALL""")
def state_export(spark, sf_dir):
    """Marks written as JSON documents, one per user, and read again."""
    marks = (
        table(spark, sf_dir, "events")
        .groupBy(F.concat(F.lit("u"), "user_id").alias("dataset_id"), F.upper("event_type").alias(CODE))
        .agg(F.max("ts").cast("timestamp_ntz").alias("last_obs_local"))
    )
    return incremental.state_from_json(incremental.state_to_json(marks))


@query(f"""
WITH {OBS_SQL}, marks AS (
  SELECT code, max(clk) AS mark FROM obs
  WHERE clk < '{_MIDDLE}' AND code IN ('CLICK','VIEW','ERROR') GROUP BY code)
SELECT ord, code AS internal_series_code, clk AS obs_ts, value
FROM obs LEFT JOIN marks USING (code) WHERE mark IS NULL OR clk > mark""")
def incremental_filter(spark, sf_dir):
    early = observations(spark, sf_dir).where(
        (F.col("obs_local") < _MIDDLE) & F.col(CODE).isin("CLICK", "VIEW", "ERROR")
    )
    marks = staged(incremental.high_water_marks(early), "marks")
    return incremental.only_new(points(spark, sf_dir), marks, spread=["ord"]).select(
        "ord", CODE, "obs_ts", "value"
    )


@query(f"""
WITH {OBS_SQL}, {SERIES_SQL}
SELECT clk AS obs_time, clk AS obs_local, code AS internal_series_code, value, unit, frequency,
       TIMESTAMP '{RUN_TS}' AS collection_date, ord
FROM obs LEFT JOIN facts USING (code)""")
def enrich_metadata(spark, sf_dir):
    rows = enrich.enrich(observations(spark, sf_dir), series_map(spark, SERIES_CONFIG), RUN_TS)
    return rows.withColumn("obs_time", wall("obs_time")).withColumn(
        "collection_date", wall("collection_date")
    )


@query(f"""
WITH {OBS_SQL}
SELECT clk AS obs_time, clk AS obs_local, code AS internal_series_code, value, ord
FROM obs WHERE clk >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAY""")
def window_filter(spark, sf_dir):
    rows = enrich.within_window(observations(spark, sf_dir), 7, datetime(2024, 1, 31))
    return rows.withColumn("obs_time", wall("obs_time"))


@query("""
SELECT o_orderstatus AS internal_series_code, year(o_orderdate)::INTEGER AS year,
       printf('%02d', month(o_orderdate)) AS month, count(*) AS points
FROM orders GROUP BY ALL""")
def partition_counts(spark, sf_dir):
    return partitions.partition_counts(orders_as_observations(spark, sf_dir))


@query(f"""
WITH {OBS_SQL}
SELECT 'v1' AS version_id, 'events' AS dataset_id, '2024-02-01T12:30:15Z' AS created_at,
  '2024-02-01T12:30:15Z' AS collection_date, count(*)::BIGINT AS data_points_count,
  count(DISTINCT code) AS series_count,
  array_to_string(list_sort(list(DISTINCT code)), ',') AS series_codes,
  strftime(min(clk), '%Y-%m-%dT%H:%M:%SZ') AS min_obs_time,
  strftime(max(clk), '%Y-%m-%dT%H:%M:%SZ') AS max_obs_time,
  strftime(min(clk) + INTERVAL 3 HOUR, '%Y-%m-%dT%H:%M:%SZ') AS min_utc,
  array_to_string(list_sort(list(DISTINCT
    printf('%s/year=%d/month=%02d/', code, year(clk), month(clk)))), ',')
    AS partitions,
  'series_year_month' AS partition_strategy
FROM obs""")
def manifest_stats(spark, sf_dir):
    local = observations(spark, sf_dir).withColumn(
        "obs_time", to_instant(F.col("obs_local"), ZONE)
    )
    rows = enrich.enrich(local, series_map(spark, SERIES_CONFIG), RUN_TS)
    index = staged(
        partitions.partition_statistics(partitions.with_partition_columns(rows)), "index"
    )
    manifest = manifest_of(index, "v1", "events", RUN_TS)
    return manifest.join(listings(index, "v1"), "version_id").select(
        "version_id",
        "dataset_id",
        "created_at",
        "collection_date",
        "data_points_count",
        "series_count",
        "series_codes",
        "date_range.min_obs_time",
        "date_range.max_obs_time",
        F.col("date_range_utc.min_obs_time").alias("min_utc"),
        "partitions",
        "partition_strategy",
    )


_SIDES_SQL = f"""{OBS_SQL}, sides AS (
  SELECT *, CASE WHEN ord % 3 = 0 AND clk < '2024-01-20' THEN 0 ELSE 1 END AS turn,
         CAST(clk AS DATE) AS day FROM obs)"""


def _sides(spark, sf_dir):
    """A projection with older rows, and incoming rows that overlap it."""
    rows = observations(spark, sf_dir).withColumn("day", F.to_date("obs_local"))
    old = (F.col("ord") % 3 == 0) & (F.col("obs_local") < "2024-01-20")
    return rows.where(old), rows.where(~old)


@query(f"""
WITH {_SIDES_SQL}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY code, clk ORDER BY turn, ord) AS rn FROM sides)
SELECT code AS internal_series_code, clk AS obs_local, value, ord FROM ranked WHERE rn = 1""")
def merge_first_wins(spark, sf_dir):
    projection, incoming = _sides(spark, sf_dir)
    return merge.merge_first_wins(projection, incoming, order="ord").select(
        CODE, "obs_local", "value", "ord"
    )


@query(f"""
WITH {_SIDES_SQL}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY code, clk ORDER BY turn, ord) AS rn FROM sides)
SELECT code AS internal_series_code, clk AS obs_local, value, ord
FROM ranked WHERE rn = 1 AND turn = 1""")
def merge_unseen(spark, sf_dir):
    """What a first-write-wins merge adds to the projection."""
    projection, incoming = _sides(spark, sf_dir)
    return merge.unseen_rows(projection, incoming, order="ord").select(
        CODE, "obs_local", "value", "ord"
    )


@query(f"""
WITH {_SIDES_SQL}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY code, clk ORDER BY turn, ord) AS rn,
    count(*) FILTER (turn = 0) OVER (PARTITION BY code, day) AS olds,
    count(*) FILTER (turn = 1) OVER (PARTITION BY code, day) AS news FROM sides)
SELECT code AS internal_series_code, clk AS obs_local, value, ord
FROM ranked WHERE rn = 1 OR olds = 0 OR news = 0""")
def merge_parity(spark, sf_dir):
    projection, incoming = _sides(spark, sf_dir)
    return merge.merge_as_published(projection, incoming, [CODE, "day"], order="ord").select(
        CODE, "obs_local", "value", "ord"
    )


@query(f"""
WITH {OBS_SQL}, sides AS (
  SELECT *, CASE WHEN ord % 3 = 0 OR clk < '2024-01-18' THEN 0 ELSE 1 END AS turn,
         CAST(clk AS DATE) AS day FROM obs),
touched AS (SELECT DISTINCT code, day FROM sides WHERE turn = 1),
ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.code, s.clk ORDER BY turn, ord) AS rn
  FROM sides s JOIN touched t ON s.code = t.code AND s.day = t.day)
SELECT code AS internal_series_code, clk AS obs_local, value, ord FROM ranked WHERE rn = 1""")
def merge_touched(spark, sf_dir):
    rows = observations(spark, sf_dir).withColumn("day", F.to_date("obs_local"))
    old = (F.col("ord") % 3 == 0) | (F.col("obs_local") < "2024-01-18")
    incoming = rows.where(~old)
    days = staged(incoming.select(CODE, "day").distinct(), "touched")
    base = merge.touched_only(rows.where(old), days, [CODE, "day"], ["ord"])
    return merge.merge_first_wins(base, incoming, order="ord").select(
        CODE, "obs_local", "value", "ord"
    )


@query(f"""
WITH {OBS_SQL}, texts AS (
  SELECT ord, code, value, CASE WHEN ord % 2 = 0 THEN strftime(clk, '%Y-%m-%dT%H:%M:%S+00:00')
    ELSE strftime(clk - INTERVAL 3 HOUR, '%Y-%m-%dT%H:%M:%S-03:00') END AS obs_time,
    CASE WHEN ord % 3 = 0 THEN 0 ELSE 1 END AS turn FROM obs),
ranked AS (SELECT *, row_number() OVER (PARTITION BY code, obs_time ORDER BY turn, ord) AS rn
           FROM texts)
SELECT code AS internal_series_code, obs_time, value, ord FROM ranked WHERE rn = 1""")
def merge_iso_text(spark, sf_dir):
    """Published files are keyed by the text of the time: one instant, two offsets, two rows."""
    rows = observations(spark, sf_dir)
    behind = F.col("obs_local") - F.expr("INTERVAL 3 HOUR")
    text = F.when(F.col("ord") % 2 == 0, iso_text(F.col("obs_local"), F.col("obs_time"))).otherwise(
        iso_text(behind, to_instant(behind, ZONE))
    )
    texts = rows.select(CODE, text.alias("obs_time"), "value", "ord")
    old = F.col("ord") % 3 == 0
    return merge.merge_first_wins(texts.where(old), texts.where(~old), order="ord")


def _order_versions(spark, sf_dir):
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("dataset_id"),
        F.concat(
            F.lit("v"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_"), key.cast("string")
        ).alias("version_id"),
        key.alias("commit_seq"),
        F.col("o_orderdate").cast("timestamp").alias("projected_at"),
    )


_VERSIONS_SQL = """versions AS (
  SELECT o_orderstatus AS dataset_id, o_orderkey AS commit_seq, o_orderdate AS projected_at,
         'v' || strftime(o_orderdate, '%Y%m%d') || '_' || o_orderkey AS version_id
  FROM orders)"""


@query(f"""
WITH {_VERSIONS_SQL}
SELECT dataset_id, version_id FROM versions v WHERE NOT EXISTS (
  SELECT 1 FROM versions p WHERE p.commit_seq % 2 = 0
    AND p.dataset_id = v.dataset_id AND p.version_id = v.version_id)""")
def projected_skip(spark, sf_dir):
    versions = _order_versions(spark, sf_dir)
    return pending_versions(
        versions.select("dataset_id", "version_id"), versions.where("commit_seq % 2 = 0")
    )


@query(f"""
WITH {_VERSIONS_SQL}
SELECT dataset_id, count(DISTINCT version_id) AS projected_versions,
       max(projected_at) AS last_projection_date,
       arg_max(version_id, strftime(projected_at, '%Y%m%d') || printf('%020d', commit_seq))
         AS last_projected_version
FROM versions GROUP BY dataset_id""")
def projected_status(spark, sf_dir):
    versions = _order_versions(spark, sf_dir)
    twice = versions.unionByName(versions.where("commit_seq % 2 = 0"))
    return projection_status(twice).select(
        "dataset_id", "projected_versions", wall("last_projection_date"), "last_projected_version"
    )


@query(f"""
WITH {_VERSIONS_SQL}, pointers AS (
  SELECT dataset_id, commit_seq, version_id FROM versions
  UNION ALL SELECT 'blank', commit_seq, CASE WHEN commit_seq < 100 THEN version_id ELSE ' ' END
  FROM versions)
SELECT dataset_id, arg_max(version_id, commit_seq) AS version_id FROM pointers
GROUP BY dataset_id HAVING trim(arg_max(version_id, commit_seq)) <> ''""")
def current_version(spark, sf_dir):
    versions = _order_versions(spark, sf_dir).select("dataset_id", "commit_seq", "version_id")
    blank = versions.select(
        F.lit("blank").alias("dataset_id"),
        "commit_seq",
        F.when(F.col("commit_seq") < 100, F.col("version_id")).otherwise(" ").alias("version_id"),
    )
    return current_versions(versions.unionByName(blank))


@query(f"""
WITH {_VERSIONS_SQL},
paths AS (SELECT 'datasets/' || dataset_id || CASE
    WHEN commit_seq % 4 < 2 THEN '/versions/' || version_id || '/manifest.json'
    WHEN commit_seq % 4 = 2
      THEN '/versions/' || version_id || '/data/F/year=1997/month=05/data.json'
    ELSE '/versions/draft/manifest.json' END AS path FROM versions)
SELECT DISTINCT split_part(path, '/', 2) AS dataset_id, split_part(path, '/', 4) AS version_id
FROM paths WHERE path LIKE 'datasets/%/versions/v%/manifest.json'
ORDER BY dataset_id, version_id DESC""")
def list_versions(spark, sf_dir):
    turn = F.col("commit_seq") % 4
    version = F.concat(F.lit("/versions/"), "version_id")
    tail = (
        F.when(turn < 2, F.concat(version, F.lit("/manifest.json")))
        .when(turn == 2, F.concat(version, F.lit("/data/F/year=1997/month=05/data.json")))
        .otherwise(F.lit("/versions/draft/manifest.json"))
    )
    path = F.concat(F.lit("datasets/"), "dataset_id", tail)
    return versions_in(_order_versions(spark, sf_dir).select(path.alias("path")))


@query(f"""
WITH {OBS_SQL}
SELECT code AS internal_series_code, count(*) AS points, max(clk) AS max_obs_local
FROM obs GROUP BY code""")
def run_summary(spark, sf_dir):
    return summary.run_summary(observations(spark, sf_dir))


@query(f"""
WITH {OBS_SQL}, marks AS (
  SELECT code, max(clk) AS mark FROM obs WHERE clk < '{_MIDDLE}' AND code <> 'VIEW' GROUP BY code),
first AS (SELECT code, count(*) AS n FROM obs WHERE code <> 'ERROR' GROUP BY code),
second AS (SELECT obs.code, count(*) AS n FROM obs LEFT JOIN marks USING (code)
           WHERE mark IS NULL OR clk > mark GROUP BY obs.code)
SELECT second.code AS internal_series_code, coalesce(first.n, 0) AS points_before,
       second.n AS points_after, coalesce(first.n, 0) - second.n AS filtered
FROM second LEFT JOIN first USING (code)""")
def run_diff(spark, sf_dir):
    rows = observations(spark, sf_dir)
    early = rows.where((F.col("obs_local") < _MIDDLE) & (F.col(CODE) != "VIEW"))
    marks = staged(incremental.high_water_marks(early), "marks")
    second = incremental.only_new(rows, marks, "obs_local", ["ord"])
    return summary.run_difference(rows.where(F.col(CODE) != "ERROR"), second)
