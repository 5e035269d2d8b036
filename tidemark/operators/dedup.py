"""Keep-first de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    IntegralType,
    NumericType,
    TimestampNTZType,
    TimestampType,
)

_FIXED_WIDTH = (NumericType, BooleanType, DateType, TimestampType, TimestampNTZType)


def keep_first(
    frame: DataFrame, keys: list[str], order: list[str], keep: list[str] | None = None
) -> DataFrame:
    """One row per key, the lowest by ``order``; null keys are equal to each other.

    A grouping with ``min_by`` rather than a window: rows of a repeated key are reduced
    before the shuffle, so copies of one key never travel.  With one numeric order column
    and fixed-width columns to ``keep`` (all by default) Spark aggregates by hash; otherwise
    it sorts.
    """
    kinds = {f.name: f.dataType for f in frame.schema.fields}
    kept = frame.columns if keep is None else [n for n in frame.columns if n in {*keys, *keep}]
    rest = [name for name in kept if name not in keys]
    if not rest:
        return frame.select(*keys).distinct()
    if len(order) == 1 and isinstance(kinds[order[0]], IntegralType):
        # A null rank sorts first, as it does inside a struct; coalescing keeps it one number.
        lowest = F.lit(-(1 << 63)).cast("bigint")
        rank = F.coalesce(F.col(order[0]).cast("bigint"), lowest)
        if all(isinstance(kinds[name], _FIXED_WIDTH) for name in rest):
            firsts = [F.min_by(name, rank).alias(name) for name in rest]
            return frame.groupBy(*keys).agg(*firsts).select(*kept)
    else:
        rank = F.struct(*order)
    row = F.min_by(F.struct(*rest), rank).alias("_first")
    return frame.groupBy(*keys).agg(row).select(*keys, "_first.*").select(*kept)
