"""Scalar functions over whole columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query, table
from catalog.shapes import ZONE
from tidemark.functions.events import update_event as event_of
from tidemark.functions.events import update_subject
from tidemark.functions.numbers import column_index, parse_decimal, parse_grid_decimal
from tidemark.functions.paths import (
    data_key,
    partition_parts,
    partition_path as path_of,
    swap_prefix,
    version_key,
)
from tidemark.functions.times import drop_zone, iso_text, manifest_text, to_instant
from tidemark.functions.times import version_id as version_of
from tidemark.operators.partitions import distinct_partitions
from tidemark.operators.routing import route_events as routed

_FORMS_SQL = """
  SELECT event_id, CASE event_id % 8
    WHEN 0 THEN printf('%.2f', value)
    WHEN 1 THEN replace(printf('%.2f', value), '.', ',')
    WHEN 2 THEN concat(' 1 ', replace(printf('%.2f', value), '.', ','), ' ')
    WHEN 3 THEN concat('1.', printf('%.2f', value))
    WHEN 4 THEN ''
    WHEN 5 THEN 'n/a'
    WHEN 6 THEN concat(printf('%.2f', value), 'd')
    ELSE concat('1_0', printf('%.2f', value), 'e-2') END AS txt
  FROM events"""


@query(f"""
WITH forms AS ({_FORMS_SQL})
SELECT event_id, txt,
  CASE event_id % 8 WHEN 3 THEN NULL WHEN 6 THEN NULL
    ELSE try_cast(replace(replace(replace(txt, ',', '.'), ' ', ''), '_', '') AS DOUBLE)
  END AS number,
  CASE event_id % 8 WHEN 2 THEN NULL WHEN 3 THEN NULL WHEN 6 THEN NULL
    ELSE try_cast(replace(replace(txt, ',', '.'), '_', '') AS DOUBLE)
  END AS grid_number
FROM forms""")
def decimal_parse(spark, sf_dir):
    forms = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        """CASE event_id % 8
           WHEN 0 THEN printf('%.2f', value)
           WHEN 1 THEN replace(printf('%.2f', value), '.', ',')
           WHEN 2 THEN concat(' 1 ', replace(printf('%.2f', value), '.', ','), ' ')
           WHEN 3 THEN concat('1.', printf('%.2f', value))
           WHEN 4 THEN ''
           WHEN 5 THEN 'n/a'
           WHEN 6 THEN concat(printf('%.2f', value), 'd')
           ELSE concat('1_0', printf('%.2f', value), 'e-2') END AS txt""",
    )
    return forms.select(
        "event_id",
        "txt",
        parse_decimal(F.col("txt")).alias("number"),
        parse_grid_decimal(F.col("txt")).alias("grid_number"),
    )


@query(f"""
WITH w AS (SELECT o_orderkey,
                  o_orderdate + (o_orderkey % 48) * INTERVAL 30 MINUTE AS clock FROM orders)
SELECT o_orderkey, clock,
       timezone('UTC', timezone('{ZONE}', clock)) AS south,
       timezone('UTC', timezone('America/New_York', clock)) AS north
FROM w""")
def localize_tz(spark, sf_dir):
    clock = F.col("o_orderdate") + (F.col("o_orderkey") % 48) * F.expr("INTERVAL 30 MINUTE")
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", clock.alias("clock"))
        .select(
            "o_orderkey",
            "clock",
            to_instant(F.col("clock"), ZONE).cast("timestamp_ntz").alias("south"),
            to_instant(F.col("clock"), "America/New_York").cast("timestamp_ntz").alias("north"),
        )
    )


@query("""
WITH c AS (SELECT p_partkey, substr(p_type, 1, CAST(p_partkey % 3 AS INTEGER) + 1) AS letters
           FROM part),
d AS (SELECT p_partkey,
             CASE WHEN p_partkey % 2 = 0 THEN letters ELSE lower(letters) END AS letters FROM c)
SELECT p_partkey, letters,
  CAST(CASE length(letters)
    WHEN 1 THEN ascii(upper(letters)) - 64
    WHEN 2 THEN (ascii(upper(letters)) - 64) * 26 + ascii(upper(letters[2])) - 64
    ELSE ((ascii(upper(letters)) - 64) * 26 + ascii(upper(letters[2])) - 64) * 26
         + ascii(upper(letters[3])) - 64 END - 1 AS INTEGER) AS idx
FROM d""")
def excel_column_index(spark, sf_dir):
    letters = F.substring("p_type", F.lit(1), (F.col("p_partkey") % 3).cast("int") + 1)
    return (
        table(spark, sf_dir, "part")
        .select(
            "p_partkey",
            F.when(F.col("p_partkey") % 2 == 0, letters).otherwise(F.lower(letters)).alias(
                "letters"
            ),
        )
        .select("p_partkey", "letters", column_index(F.col("letters")).alias("idx"))
    )


_PATH_SQL = "printf('%s/year=%d/month=%02d/', o_orderstatus, year(o_orderdate), month(o_orderdate))"


@query(f"""
WITH p AS (SELECT o_orderkey, {_PATH_SQL} AS partition FROM orders),
k AS (SELECT *, concat('datasets/d/staging/', rtrim(partition, '/'), '/data.json') AS staging_key
      FROM p)
SELECT o_orderkey, partition, staging_key,
       replace(staging_key, 'datasets/d/staging/', 'datasets/d/projections/') AS projection_key,
       concat('datasets/d/versions/v1/data/', partition, 'data.json') AS version_key
FROM k""")
def partition_path_keys(spark, sf_dir):
    keyed = table(spark, sf_dir, "orders").select(
        "o_orderkey", path_of(F.col("o_orderstatus"), F.col("o_orderdate")).alias("partition")
    )
    keyed = keyed.withColumn("staging_key", data_key(F.lit("d"), "staging", F.col("partition")))
    return keyed.select(
        "*",
        swap_prefix(F.col("staging_key"), "datasets/d/staging/", "datasets/d/projections/").alias(
            "projection_key"
        ),
        version_key(
            F.lit("d"), F.lit("v1"), F.concat("partition", F.lit("data.json"))
        ).alias("version_key"),
    )


@query("""
SELECT event_id,
  printf('%s/year=%d/month=%02d/', upper(event_type), year(ts), month(ts)) AS partition
FROM events""")
def partition_path(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", path_of(F.upper("event_type"), F.col("ts")).alias("partition")
    )


@query(f"""
WITH p AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'invalid/path'
    WHEN 1 THEN rtrim({_PATH_SQL}, '/') WHEN 2 THEN concat({_PATH_SQL}, 'data.json')
    ELSE {_PATH_SQL} END AS path FROM orders)
SELECT o_orderkey, path,
  nullif(regexp_extract(path, '^([^/]+)/year=(\\d+)/month=(\\d+)/?', 1), '') AS code,
  nullif(regexp_extract(path, '^([^/]+)/year=(\\d+)/month=(\\d+)/?', 2), '') AS year,
  nullif(regexp_extract(path, '^([^/]+)/year=(\\d+)/month=(\\d+)/?', 3), '') AS month
FROM p""")
def partition_parse(spark, sf_dir):
    full = F.format_string(
        "%s/year=%d/month=%02d/", "o_orderstatus", F.year("o_orderdate"), F.month("o_orderdate")
    )
    turn = F.col("o_orderkey") % 5
    path = (
        F.when(turn == 0, "invalid/path")
        .when(turn == 1, F.regexp_replace(full, "/$", ""))
        .when(turn == 2, F.concat(full, F.lit("data.json")))
        .otherwise(full)
    )
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", path.alias("path"))
        .withColumn("parts", partition_parts(F.col("path"), strict=False))
        .select(
            "o_orderkey",
            "path",
            F.col("parts.internal_series_code").alias("code"),
            F.col("parts.year").alias("year"),
            F.col("parts.month").alias("month"),
        )
    )


@query(f"""
WITH p AS (SELECT CASE o_orderkey % 3 WHEN 0 THEN concat('some/other/', o_orderkey, '/file.txt')
    ELSE concat('datasets/d/versions/v1/data/', {_PATH_SQL}, 'part-', o_orderkey) END AS path
  FROM orders)
SELECT DISTINCT regexp_extract(path, '([^/]+)/year=(\\d+)/month=(\\d+)/') AS partition
FROM p WHERE regexp_matches(path, '([^/]+)/year=(\\d+)/month=(\\d+)/')
ORDER BY 1""")
def partitions_distinct(spark, sf_dir):
    full = F.format_string(
        "%s/year=%d/month=%02d/", "o_orderstatus", F.year("o_orderdate"), F.month("o_orderdate")
    )
    path = F.when(
        F.col("o_orderkey") % 3 == 0,
        F.concat(F.lit("some/other/"), "o_orderkey", F.lit("/file.txt")),
    ).otherwise(F.concat(F.lit("datasets/d/versions/v1/data/"), full, F.lit("part-"), "o_orderkey"))
    return distinct_partitions(
        table(spark, sf_dir, "orders").select(path.alias("path")), "path"
    )


_ISO_SQL = """strftime({0}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN strftime({0}, '%f') = '000000'
   THEN '' ELSE '.' || strftime({0}, '%f') END"""


@query(f"""
WITH c AS (SELECT event_id,
   CASE WHEN event_id % 2 = 0 THEN ts ELSE date_trunc('second', ts) END AS clock FROM events)
SELECT event_id, {_ISO_SQL.format('clock')} || '-03:00' AS south,
       {_ISO_SQL.format('clock')} || '+05:30' AS east, clock AS back
FROM c""")
def iso_serialize(spark, sf_dir):
    clock = F.col("clock")
    return (
        table(spark, sf_dir, "events")
        .select(
            "event_id",
            F.when(F.col("event_id") % 2 == 0, F.col("ts"))
            .otherwise(F.date_trunc("second", F.col("ts")).cast("timestamp_ntz"))
            .alias("clock"),
        )
        .select(
            "event_id",
            iso_text(clock, to_instant(clock, ZONE)).alias("south"),
            iso_text(clock, to_instant(clock, "Asia/Kolkata")).alias("east"),
        )
        .withColumn("back", drop_zone(F.col("south")))
    )


@query("""
SELECT event_id, strftime(ts, 'v%Y%m%d_%H%M%S_%f') AS version_id,
       strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS manifest_time
FROM events""")
def version_id(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        version_of(F.col("ts")).alias("version_id"),
        manifest_text(F.col("ts")).alias("manifest_time"),
    )


@query("""
SELECT event_id, 'projection_update:' || event_type AS subject,
  '{"event":"projection_update","dataset_id":"' || event_type || '","bucket":"b","version_manifest_path":"datasets/'
   || event_type || '/versions/' || strftime(ts, 'v%Y%m%d_%H%M%S_%f')
   || '/manifest.json","projections_path":"datasets/' || event_type || '/projections/"}' AS message
FROM events""")
def update_event(spark, sf_dir):
    message = event_of(F.col("event_type"), version_of(F.col("ts")), F.lit("b"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        update_subject(F.col("event_type")).alias("subject"),
        F.to_json(message).alias("message"),
    )


# Trigger events in every envelope, built by the same SQL on both sides.
_ENVELOPES = """CASE event_id % 10
  WHEN 0 THEN concat('{"dataset_id":"', event_type, '"}')
  WHEN 1 THEN concat('{"detail":{"dataset_id":"', event_type, '"}}')
  WHEN 2 THEN concat('{"Records":[{"body":"{', chr(92), '"dataset_id', chr(92), '":', chr(92), '"',
                     event_type, chr(92), '"}"}]}')
  WHEN 3 THEN concat('{"Records":[{"body":"', chr(92), '"{', repeat(chr(92), 3), '"dataset_id',
                     repeat(chr(92), 3), '":', repeat(chr(92), 3), '"', event_type,
                     repeat(chr(92), 3), '"}', chr(92), '""}]}')
  WHEN 4 THEN '{"dataset_id":"","detail":{"dataset_id":0}}'
  WHEN 5 THEN concat('{"Records":[{"body":{"dataset_id":"', event_type, '"}}]}')
  WHEN 6 THEN concat('{"dataset_id":"', event_type)
  WHEN 7 THEN concat('{"dataset_id":"","detail":{"dataset_id":"d-', event_type, '"}}')
  WHEN 8 THEN '{"detail":"text","Records":[{"body":"not json"}]}'
  ELSE props END"""


@query(f"""
WITH e AS (SELECT event_id, {_ENVELOPES} AS event_json FROM events),
j AS (SELECT *, CASE WHEN json_valid(event_json) THEN event_json::JSON END AS doc FROM e),
b AS (SELECT *, CASE WHEN json_type(doc, '$.Records[0].body') = 'VARCHAR'
                     THEN json_extract_string(doc, '$.Records[0].body') END AS body FROM j),
c AS (SELECT *, CASE WHEN json_valid(body) THEN body::JSON END AS body_doc FROM b),
d AS (SELECT *, CASE WHEN json_type(body_doc) = 'VARCHAR'
                     THEN json_extract_string(body_doc, '$') END AS inner_text FROM c),
f AS (SELECT *, CASE WHEN json_valid(inner_text) THEN inner_text::JSON END AS inner_doc FROM d)
SELECT event_id, coalesce(
    nullif(nullif(json_extract_string(doc, '$.dataset_id'), ''), '0'),
    nullif(nullif(json_extract_string(doc, '$.detail.dataset_id'), ''), '0'),
    nullif(json_extract_string(body_doc, '$.dataset_id'), ''),
    nullif(json_extract_string(inner_doc, '$.dataset_id'), '')) AS dataset_id
FROM f""")
def route_events(spark, sf_dir):
    events = table(spark, sf_dir, "events").selectExpr("event_id", f"{_ENVELOPES} AS event_json")
    return routed(events).select("event_id", "dataset_id")

