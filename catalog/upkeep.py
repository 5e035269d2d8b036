"""What merges read and leave behind, announced manifests, and versions nobody committed."""

from __future__ import annotations

from contextlib import suppress
from datetime import timedelta
from unittest import mock

from pyspark.sql import functions as F

from catalog.recovery import _lost
from catalog.registry import query
from catalog.shapes import CODE, OBS_SQL, RUN_TS, points, wall
from catalog.storage import _final_rows
from tidemark.operators.normalize import normalize
from tidemark.plans import files, projection, upkeep, versions
from tidemark.plans.layout import DatasetLayout
from tidemark.session import work_folder

# Three parts in the order of their versions: early rows, late rows, and some days once more.
_PARTS = (
    "ord % 3 <> 1 AND {t} < TIMESTAMP '2024-01-11 00:00:00'",
    "ord % 3 <> 1 AND {t} >= TIMESTAMP '2024-01-11 00:00:00'",
    "ord % 4 <> 3 AND {t} >= TIMESTAMP '2024-01-12 00:00:00' AND {t} < TIMESTAMP '2024-01-14 00:00:00'",
)
_PARTS_SQL = f"""WITH {OBS_SQL}, parts AS (
  {" UNION ALL ".join(f"SELECT *, {n} AS n FROM obs WHERE {p.format(t='clk')}" for n, p in enumerate(_PARTS))}),
firsts AS (SELECT code, clk, min(n) AS n, arg_min(value, n * 100000000 + ord) AS value FROM parts GROUP BY code, clk),
named AS (SELECT n, 'v20240201_1' || (2 + n) || '3015_250000' AS version_id FROM range(3) t(n))"""


def _parts(spark, sf_dir):
    rows = points(spark, sf_dir)
    return [rows.where(p.format(t="obs_ts").replace("TIMESTAMP '", "TIMESTAMP_NTZ '")) for p in _PARTS]


def _tracked(spark, sf_dir, publish="append", copies=False):
    """The parts committed and projected one after the other, by year, with notes on the files."""
    layout = DatasetLayout(work_folder(spark, "tracked"), "events", ("year",), track_files=True)
    for number, part in enumerate(_parts(spark, sf_dir)):
        run_ts = RUN_TS + timedelta(hours=number)
        version_id = versions.new_version_id(run_ts)
        rows = _final_rows(spark, sf_dir, part)
        if copies:
            rows = normalize(part, "America/Argentina/Buenos_Aires", False, ["ord"], describe=False)
            rows = rows.withColumn("collection_date", F.lit(str(run_ts)).cast("timestamp"))
        versions.commit_version(rows, layout, version_id, run_ts, unique_keys=not copies)
        if number == 2:
            index = versions.read_file_index(spark, layout, version_id)
            looked_at = files.overlapping_rows(spark, layout, index).count()
            stored = projection.read_projection(spark, layout).count()
            skipped = stored - looked_at
        projection.project_version(spark, layout, version_id, run_ts, publish=publish, bucket="b")
    return layout, skipped


@query(f"""{_PARTS_SQL}
SELECT clk + INTERVAL 3 HOUR AS obs_time, code AS internal_series_code, value,
  (SELECT count(*) FROM firsts WHERE n = 0)::BIGINT AS not_read
FROM firsts""")
def merge_touched_files(spark, sf_dir):
    """The third merge reads only files that overlap its times: none of the first version's."""
    layout, skipped = _tracked(spark, sf_dir)
    stored = projection.read_projection(spark, layout)
    return stored.select(wall("obs_time"), CODE, "value", F.lit(skipped).cast("bigint").alias("not_read"))


@query(f"""{_PARTS_SQL}, keyed AS (SELECT n, code, clk, count(*) AS c FROM parts GROUP BY ALL)
SELECT version_id, (k.n + 1)::BIGINT AS turn, 1::BIGINT AS versions,
  sum(c)::BIGINT AS rows_in, sum(c - 1)::BIGINT AS repeated,
  count(*) FILTER (f.n < k.n)::BIGINT AS known, count(*) FILTER (f.n = k.n)::BIGINT AS added,
  true AS whole
FROM keyed k JOIN firsts f USING (code, clk) JOIN named ON named.n = k.n
GROUP BY version_id, k.n""")
def projection_audit(spark, sf_dir):
    layout, _ = _tracked(spark, sf_dir, copies=True)
    return upkeep.audit_merges(spark, layout)


@query(f"""{_PARTS_SQL}, cells AS (
  SELECT code, month(clk) AS m, year(clk) AS y, min(n) AS n FROM firsts GROUP BY ALL),
series AS (SELECT code, min(n) AS n FROM firsts GROUP BY code)
SELECT version_id, (n + 1)::BIGINT AS turn, 1::BIGINT AS versions,
  (SELECT count(*) FROM firsts WHERE firsts.n = named.n)::BIGINT AS points_added,
  (SELECT count(*) FROM cells WHERE cells.n = named.n)::BIGINT AS partitions_added,
  (SELECT count(*) FROM series WHERE series.n = named.n)::BIGINT AS series_added
FROM named""")
def projection_totals(spark, sf_dir):
    """Kept up merge by merge while partitions are rewritten; SQL counts everything again."""
    layout, _ = _tracked(spark, sf_dir, publish="rewrite")
    return files.projection_totals(spark, layout).drop("files_added", "files_removed")


@query(f"""{_PARTS_SQL}, damaged AS (
  SELECT code, year(clk)::INTEGER AS year, printf('%02d', month(clk)) AS month, n FROM firsts
  WHERE n < 2 GROUP BY ALL)
SELECT code AS internal_series_code, year, month,
  CASE n WHEN 0 THEN 'missing' ELSE 'changed' END AS damage
FROM damaged""")
def projection_damage(spark, sf_dir):
    """Files of the first merge are replaced by nothing, those of the second by other rows."""
    layout, _ = _tracked(spark, sf_dir)
    records = files.file_records(spark, layout).where("change = 1")
    # As many names as files of two merges.
    named = records.where("turn < 3").select("turn", "file").distinct().collect()
    rows = versions.read_stored(spark, layout.projections).where("obs_time < '1970-01-01'")
    rows.drop("year").coalesce(1).write.parquet(f"{layout.root}/other")
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    other = hadoop.Path(f"{layout.root}/other")
    system = other.getFileSystem(conf)
    parts = [s.getPath() for s in system.globStatus(hadoop.Path(f"{layout.root}/other/part-*"))]
    for turn, file in named:
        path = hadoop.Path(f"{layout.projections}/{file}")
        system.delete(path, False)
        if turn == 2:
            hadoop.FileUtil.copy(system, parts[0], system, path, False, conf)
    found = upkeep.damaged_files(spark, layout)
    return found.select(CODE, "year", "month", "damage").distinct()


@query(f"""WITH {OBS_SQL}
SELECT 'v20240131_123015_250000' AS version_id, TIMESTAMP '2024-01-31 12:30:15' AS started_at,
  count(DISTINCT (code, clk))::BIGINT AS points
FROM obs WHERE ord % 3 = 1 HAVING count(*) > 0""")
def orphan_versions(spark, sf_dir):
    """A committed run, one that broke before its commit, and one that broke just now."""
    layout = DatasetLayout(work_folder(spark, "orphans"), "events")
    rows = points(spark, sf_dir)
    for number, days in enumerate((2, 1, 0)):
        run_ts = RUN_TS - timedelta(days=days)
        part = _final_rows(spark, sf_dir, rows.where(F.col("ord") % 3 == number))
        given = (part, layout, versions.new_version_id(run_ts), run_ts)
        if not number:
            versions.commit_version(*given)
            continue
        with mock.patch.object(versions, "append_commit", _lost), suppress(OSError):
            versions.commit_version(*given)
    found = upkeep.orphan_versions(spark, layout, RUN_TS - timedelta(hours=12))
    reader = spark.read.schema("obs_time timestamp").option("recursiveFileLookup", True)
    stored = reader.parquet(f"{layout.versions}/*/data").groupBy(
        F.regexp_extract("_metadata.file_path", "/versions/([^/]+)/", 1).alias("version_id")
    ).agg(F.count("*").alias("points"))
    return found.join(stored, "version_id").select("version_id", wall("started_at"), "points")


@query(f"""{_PARTS_SQL}
SELECT 'projection_update:events' AS subject, 'b' AS bucket, 'datasets/events/projections/' AS projections_path,
  'events' AS dataset_id, version_id, count(DISTINCT (code, clk))::BIGINT AS data_points_count,
  count(DISTINCT code) AS series_count, strftime(min(clk), '%Y-%m-%dT%H:%M:%SZ') AS min_obs_time,
  strftime(max(clk), '%Y-%m-%dT%H:%M:%SZ') AS max_obs_time
FROM parts JOIN named USING (n) GROUP BY version_id""")
def announced_manifest(spark, sf_dir):
    """From the update events to the manifests they point at."""
    layout, _ = _tracked(spark, sf_dir)
    found = projection.announced_manifests(projection.read_events(spark, layout), layout.root)
    return found.select(
        "subject", "bucket", "projections_path", "dataset_id", "version_id", "data_points_count",
        "series_count", "date_range.min_obs_time", "date_range.max_obs_time",
    )
