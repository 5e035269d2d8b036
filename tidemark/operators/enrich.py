"""Series metadata and the relative time window."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.lookup import lookup_join
from tidemark.sources.series import SeriesMap


def instant_literal(moment: datetime):
    """A literal instant; a moment without zone means UTC."""
    aware = moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
    return F.lit(aware.astimezone(timezone.utc).replace(tzinfo=None).isoformat(" ")).cast(
        "timestamp"
    )


def enrich(observations: DataFrame, series: SeriesMap, run_ts: datetime) -> DataFrame:
    """Unit and frequency from the configuration (null for unknown codes), one run time.

    A code configured twice takes its last entry.
    """
    code = "internal_series_code"
    facts = (
        series.frame.where(F.col(code) != "")
        .groupBy(code)
        .agg(F.max_by(F.struct("unit", "frequency"), "ord").alias("facts"))
        .select(code, "facts.unit", "facts.frequency")
    )
    bare = observations.drop("unit", "frequency", "collection_date")
    joined = lookup_join(bare, facts, [code], "left", ["obs_time"], series.small)
    return joined.select(
        "obs_time",
        "obs_local",
        code,
        "value",
        "unit",
        "frequency",
        instant_literal(run_ts).alias("collection_date"),
        *[name for name in ("ord",) if name in bare.columns],
    )


def within_window(observations: DataFrame, days: int | None, as_of: datetime) -> DataFrame:
    """Keep observations of the last ``days`` days before ``as_of`` (bounds included)."""
    if days is None:
        return observations
    return observations.where(F.col("obs_time") >= instant_literal(as_of - timedelta(days=days)))
