"""Run summaries and run-to-run comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CODE = "internal_series_code"


def run_summary(observations: DataFrame) -> DataFrame:
    """Points and latest observation per series."""
    return observations.groupBy(CODE).agg(
        F.count("*").alias("points"), F.max("obs_local").alias("max_obs_local")
    )


def run_difference(first: DataFrame, second: DataFrame) -> DataFrame:
    """Per series of the second run: how many points fewer than in the first run."""
    before = first.groupBy(CODE).agg(F.count("*").alias("points_before"))
    after = second.groupBy(CODE).agg(F.count("*").alias("points_after"))
    earlier = F.coalesce("points_before", F.lit(0))
    return before.join(after, CODE, "right").select(
        CODE,
        earlier.alias("points_before"),
        "points_after",
        (earlier - F.col("points_after")).alias("filtered"),
    )
