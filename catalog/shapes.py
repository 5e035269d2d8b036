"""Observation-like views of the test tables, in Spark and in SQL."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.registry import table
from tidemark.functions.paths import partition_path_of

ZONE = "America/Argentina/Buenos_Aires"
RUN_TS = datetime(2024, 2, 1, 12, 30, 15, 250000)
CODE = "internal_series_code"

# `obs`: one observation per event, hourly clock, the event id as input order.
OBS_SQL = """obs AS (
  SELECT event_id AS ord, upper(event_type) AS code, date_trunc('hour', ts) AS clk, value
  FROM events)"""

# Raw points: every 7th without code, every 11th without time, every 13th without number.
RAW_SQL = """raw AS (
  SELECT event_id AS ord,
         CASE WHEN event_id % 7 = 0 THEN '' ELSE upper(event_type) END AS code,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE date_trunc('hour', ts) END AS clk,
         CASE WHEN event_id % 13 = 0 THEN 'n/a'
              ELSE replace(printf('%.2f', value), '.', ',') END AS txt
  FROM events)"""

SERIES_CONFIG = {
    "dataset_id": "events",
    "normalize": {
        "timezone": ZONE,
        "primary_keys": ["obs_time", "internal_series_code"],
    },
    "parse_config": {
        "series_map": [
            {"internal_series_code": "CLICK", "unit": "old", "frequency": "D"},
            {"internal_series_code": "VIEW", "unit": "views", "frequency": "H"},
            {"internal_series_code": "", "unit": "nobody", "frequency": "X"},
            {"internal_series_code": "SIGNUP", "unit": "people", "frequency": "M"},
            {"internal_series_code": "ERROR", "unit": None, "frequency": "H"},
            {"internal_series_code": "CLICK", "unit": "clicks", "frequency": "H"},
        ]
    },
}

SERIES_SQL = """smap AS (
  SELECT code, arg_max(n, ord) AS n, max(ord) AS ord
  FROM (VALUES (0,'CLICK',0),(1,'VIEW',1),(3,'SIGNUP',3),(4,'ERROR',4),(5,'CLICK',5))
       AS t(ord, code, n) GROUP BY code),
facts AS (
  SELECT smap.code, v.unit, v.frequency FROM smap JOIN
   (VALUES (0,'old','D'),(1,'views','H'),(3,'people','M'),(4,NULL,'H'),(5,'clicks','H'))
       AS v(n, unit, frequency) ON v.n = smap.n)"""


def events_as_points(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("ord"),
        F.upper("event_type").alias(CODE),
        F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("obs_ts"),
        "value",
    )


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_points(table(spark, sf_dir, "events"))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points as observations whose zone is UTC."""
    return points(spark, sf_dir).select(
        F.col("obs_ts").cast("timestamp").alias("obs_time"),
        F.col("obs_ts").alias("obs_local"),
        CODE,
        "value",
        "ord",
    )


def raw_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    text = F.replace(F.format_string("%.2f", "value"), F.lit("."), F.lit(","))
    return table(spark, sf_dir, "events").select(
        n.alias("ord"),
        F.when(n % 7 == 0, "").otherwise(F.upper("event_type")).alias(CODE),
        F.when(n % 11 != 0, F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz")).alias(
            "obs_ts"
        ),
        F.when(n % 13 == 0, "n/a").otherwise(text).alias("value"),
    )


def orders_as_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by status: three series over several years of months."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("timestamp").alias("obs_time"),
        F.col("o_orderdate").alias("obs_local"),
        F.col("o_orderstatus").alias(CODE),
        F.col("o_totalprice").alias("value"),
        F.col("o_orderkey").alias("ord"),
    )


def wall(name: str):
    """An instant as a UTC wall clock, the form SQL engines agree on."""
    return F.col(name).cast("timestamp_ntz").alias(name)


def listings(index, version_id):
    """One row of a manifest's lists as text, from the index's tables."""
    code, year = F.col("internal_series_code"), F.col("year").cast("string")
    folder = partition_path_of(code, year, F.col("month"))
    named = folder if "file_name" not in index.columns else F.regexp_extract(
        F.concat(folder, "file_name"), "^(.*/)", 1
    )

    def text(value):
        return F.array_join(F.array_sort(F.collect_set(value)), ",")

    return index.agg(
        F.lit(version_id).alias("version_id"),
        text(code).alias("series_codes"),
        text(folder).alias("partitions"),
        text(named).alias("folders"),
    )
