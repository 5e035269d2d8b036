"""Validity, time zone, decimals and de-duplication of parsed points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType, TimestampType

from tidemark.functions.numbers import parse_decimal
from tidemark.functions.times import to_instant, to_wall_clock
from tidemark.operators.dedup import keep_first
from tidemark.schemas import POINT_ORDER


def point_value(points: DataFrame) -> Column:
    """Number cells as they are, text through ``parse_decimal``, anything else null.

    Takes either the pair value_num / value_str or one column ``value``.
    """
    if "value" in points.columns:
        kind = points.schema["value"].dataType
        if isinstance(kind, StringType):
            return parse_decimal(F.col("value"))
        return F.col("value").cast("double") if isinstance(kind, NumericType) else F.lit(None)
    return F.coalesce("value_num", parse_decimal(F.col("value_str")))


def valid_points(points: DataFrame) -> DataFrame:
    """Points with a code, a real date and a number; adds the number as ``value``."""
    return points.withColumn("value", point_value(points)).where(
        (F.col("internal_series_code") != "")
        & F.col("obs_ts").isNotNull()
        & F.col("value").isNotNull()
    )


def normalize(
    points: DataFrame,
    zone: str = "UTC",
    dedup: bool = True,
    order: list[str] | None = None,
    describe: bool = True,
) -> DataFrame:
    """Valid points as observations: instant, wall clock, code, value, unit, frequency.

    A timestamp_ntz ``obs_ts`` is read in ``zone``; a timestamp ``obs_ts`` is converted to
    it.  Rows of one (instant, code) are reduced to the first by ``order``; without
    de-duplication the order is kept in ``ord`` for later merges.  With ``describe`` off,
    unit and frequency are left out (enrichment supplies them) and need no shuffling.
    """
    order = order or [name for name in POINT_ORDER if name in points.columns]
    aware = isinstance(points.schema["obs_ts"].dataType, TimestampType)
    clock = F.col("obs_ts")
    instant = clock if aware else to_instant(clock, zone)
    local = to_wall_clock(clock, zone) if aware else clock
    described = [
        F.col(name) if name in points.columns else F.lit(None).cast("string").alias(name)
        for name in (("unit", "frequency") if describe else ())
    ]
    rows = valid_points(points).select(
        instant.alias("obs_time"),
        local.alias("obs_local"),
        "internal_series_code",
        "value",
        *described,
        *order,
    )
    names = [name for name in rows.columns if name not in order]
    if dedup:
        return keep_first(rows, ["obs_time", "internal_series_code"], order, keep=names)
    return rows.select(*names, _order_struct(order).alias("ord"))


def _order_struct(order: list[str]) -> Column:
    kinds = {"source_id": "string", "series_ord": "int", "pos": "bigint"}
    if len(order) == 1 and order[0] not in kinds:
        source = {"pos": F.col(order[0])}
    else:
        source = {name: F.col(name) for name in order}
    return F.struct(
        *[source.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in kinds.items()]
    )
