"""Worksheet cells -> long-form points, for vertical and horizontal layouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import column_index, not_nan, parse_grid_decimal
from tidemark.functions.times import parse_date_text
from tidemark.operators.lookup import BROADCAST_ROWS, lookup_join
from tidemark.schemas import POINTS
from tidemark.sources.series import SeriesMap

# Up to this many configured names are pushed to the scan as literals.
PUSHED_NAMES = 1000
_SERIES_FACTS = ["series_ord", "internal_series_code", "unit", "frequency", "drop_na"]


def _small(series: SeriesMap) -> bool:
    return series.size <= BROADCAST_ROWS and series.small


def _facts(series: SeriesMap) -> DataFrame:
    return series.frame.withColumnRenamed("ord", "series_ord").select(*_SERIES_FACTS)


def _describe(points: DataFrame, series: SeriesMap) -> DataFrame:
    """Add code, unit and frequency after the shuffle instead of carrying them through it."""
    return lookup_join(
        points, _facts(series), ["series_ord"], "inner", ["source_id", "pos"], _small(series)
    )


def _on_sheets(cells: DataFrame, series: SeriesMap) -> DataFrame:
    """Push the configured sheet names down to the scan."""
    if series.size > PUSHED_NAMES:
        return cells
    return cells.where(F.col("sheet").isin(series.sheets))


def extract_vertical(cells: DataFrame, series: SeriesMap) -> DataFrame:
    """Date and value columns side by side, from the first data row down.

    A pivot by conditional aggregation: only the two wanted cells of a row are shuffled, and once.
    Series that keep blanks also get a point for rows where both cells are absent.
    """
    layout = series.of_layout("vertical")
    places = layout.frame.select(
        F.col("ord").alias("series_ord"),
        "sheet",
        "drop_na",
        (F.col("header_row") + F.col("skip_rows_after_header")).alias("first_row"),
        F.inline(
            F.array(
                _role(column_index(F.col("date_col")).alias("col"), is_date=True),
                _role(column_index(F.col("value_col")).alias("col"), is_date=False),
            )
        ),
    )
    sheet_cells = _on_sheets(cells, layout)
    columns = ["source_id", "series_ord", "row", "is_date", "ts", "num", "str"]
    hits = (
        lookup_join(sheet_cells, places, ["sheet", "col"], "inner", ["row"], _small(layout))
        .where("row >= first_row")
        .select(*columns)
    )
    if any(not entry["drop_na"] for entry in layout.entries):
        hits = hits.unionByName(_blank_rows(sheet_cells, places, layout), allowMissingColumns=True)
    date_text = F.coalesce("str", F.col("num").cast("string"))
    value_text = F.coalesce("str", F.col("ts").cast("string"))
    is_value = ~F.col("is_date")
    # Texts are aggregated by sorting. Rows are dealt first, so that a part of the shuffle is sorted
    # and not all that one task reads, which may be a very large file.
    keys = ["source_id", "series_ord", "pos"]
    dealt = hits.withColumn("pos", F.col("row").cast("bigint")).drop("row").repartition(*keys)
    pivot = dealt.groupBy(*keys).agg(
        F.max(F.when(F.col("is_date"), F.col("ts"))).alias("obs_ts"),
        F.max(F.when(F.col("is_date"), date_text)).alias("obs_str"),
        F.max(F.when(is_value, F.col("num"))).alias("value_num"),
        F.max(F.when(is_value, value_text)).alias("value_str"),
    )
    has_date = F.col("obs_ts").isNotNull() | F.col("obs_str").isNotNull()
    has_value = F.col("value_num").isNotNull() | F.col("value_str").isNotNull()
    return (
        _describe(pivot, layout)
        .where(~F.col("drop_na") | (has_date & has_value))
        .select(*POINTS.fieldNames())
    )


def _role(*place: Column, is_date: bool) -> Column:
    return F.struct(*place, F.lit(is_date).alias("is_date"))


def _blank_rows(cells: DataFrame, places: DataFrame, layout: SeriesMap) -> DataFrame:
    """An empty hit for every sheet row a blank-keeping series covers."""
    extent = cells.groupBy("source_id", "sheet").agg(F.max("row").alias("last_row"))
    kept = places.where("is_date and not drop_na").select("series_ord", "sheet", "first_row")
    return (
        lookup_join(extent, kept, ["sheet"], "inner", ["source_id"], _small(layout))
        .where("first_row <= last_row")
        .select(
            "source_id",
            "series_ord",
            F.explode(F.sequence("first_row", "last_row")).alias("row"),
            F.lit(None).cast("boolean").alias("is_date"),
        )
    )


def extract_horizontal(
    cells: DataFrame, series: SeriesMap, date_formats: tuple[str, ...] = ()
) -> DataFrame:
    """Pair the k-th cell of the date row with the k-th cell of the value row.

    Reading stops at the first offset whose date is absent or no date.  The stop is an
    aggregate per source and series, joined back: a valid date at k asks for one at k + 1,
    so a gap shows up as an offset that was asked for and not found.  No group of cells is
    ever held together.  Reads ``cells`` twice; pass a written table.
    """
    layout = series.of_layout("horizontal")
    places = layout.frame.select(
        F.col("ord").alias("series_ord"),
        "sheet",
        F.inline(
            F.array(
                _role(
                    F.col("fecha_row").alias("row"),
                    column_index(F.col("fecha_start_col")).alias("start"),
                    is_date=True,
                ),
                _role(
                    F.col("valor_row").alias("row"),
                    column_index(F.col("valor_start_col")).alias("start"),
                    is_date=False,
                ),
            )
        ),
    )
    sheet_cells = _on_sheets(cells, layout)
    slots = _slots(sheet_cells, places, layout, date_formats)
    is_valid = F.col("obs_ts").isNotNull()
    stops = (
        slots.groupBy("source_id", "series_ord")
        .agg(
            F.min(F.when(is_valid, F.col("pos"))).alias("first_valid"),
            F.min(F.when(~is_valid, F.col("pos"))).alias("first_invalid"),
        )
        .select(
            "source_id",
            "series_ord",
            F.when(F.col("first_valid") == 0, F.col("first_invalid")).otherwise(0).alias("stop"),
        )
    )
    if any(not entry["drop_na"] for entry in layout.entries):
        stops = _stop_at_sheet_edge(stops, sheet_cells, places, layout)
    pairs = lookup_join(slots, stops, ["source_id", "series_ord"], "inner", ["pos"], small=False)
    return (
        _describe(pairs.where("pos < stop"), layout)
        .where(~F.col("drop_na") | F.col("value_num").isNotNull())
        # Dates and values are typed by now: their text forms stay empty.
        .withColumn("obs_str", F.lit(None).cast("string"))
        .withColumn("value_str", F.lit(None).cast("string"))
        .select(*POINTS.fieldNames())
    )


def _slots(cells, places, layout: SeriesMap, date_formats) -> DataFrame:
    """One row per (source, series, offset) that has or needs a date, with its value."""
    near = cells
    if layout.size <= PUSHED_NAMES:
        rows = {e[k] for e in layout.entries for k in ("fecha_row", "valor_row")}
        near = cells.where(F.col("row").isin(sorted(rows)))
    is_date = F.col("is_date")
    pos = (F.col("col") - F.col("start")).cast("bigint")
    date = F.coalesce("ts", parse_date_text(F.col("str"), date_formats))
    value = F.coalesce(not_nan(F.col("num")), parse_grid_decimal(F.col("str")))
    typed = (
        lookup_join(near, places, ["sheet", "row"], "inner", ["col"], _small(layout))
        .where("col >= start")
        .select(
            "source_id",
            "series_ord",
            pos.alias("pos"),
            F.when(is_date, date).alias("obs_ts"),
            F.when(~is_date, value).alias("value_num"),
        )
    )
    own = F.struct("pos", "obs_ts", "value_num")
    following = F.struct(
        (F.col("pos") + 1).alias("pos"),
        F.lit(None).cast("timestamp_ntz").alias("obs_ts"),
        F.lit(None).cast("double").alias("value_num"),
    )
    asked = F.when(F.col("obs_ts").isNotNull(), F.array(own, following)).otherwise(F.array(own))
    return (
        typed.select("source_id", "series_ord", F.inline(asked))
        .groupBy("source_id", "series_ord", "pos")
        .agg(F.max("obs_ts").alias("obs_ts"), F.max("value_num").alias("value_num"))
    )


def _stop_at_sheet_edge(stops, cells, places, layout: SeriesMap) -> DataFrame:
    """Pairs end where the value row runs past the sheet's last used column."""
    used = F.col("ts").isNotNull() | F.col("num").isNotNull() | F.col("str").isNotNull()
    edge = cells.where(used).groupBy("source_id", "sheet").agg(F.max("col").alias("last_col"))
    starts = places.where("not is_date").select("series_ord", "sheet", "start")
    limits = lookup_join(edge, starts, ["sheet"], "inner", ["source_id"], _small(layout)).select(
        "source_id",
        "series_ord",
        (F.col("last_col") - F.col("start") + 1).cast("bigint").alias("room"),
    )
    return stops.join(limits, ["source_id", "series_ord"], "left").select(
        "source_id", "series_ord", F.least("stop", "room").alias("stop")
    )


def extract_points(
    cells: DataFrame, series: SeriesMap, date_formats: tuple[str, ...] = ()
) -> DataFrame:
    """Both layouts of one configuration."""
    parts = []
    if series.of_layout("vertical").size:
        parts.append(extract_vertical(cells, series))
    if series.of_layout("horizontal").size:
        parts.append(extract_horizontal(cells, series, date_formats))
    if not parts:
        return cells.sparkSession.createDataFrame([], POINTS)
    points = parts[0]
    for part in parts[1:]:
        points = points.unionByName(part)
    return points


def missing_sheets(
    cells: DataFrame, series: SeriesMap, sources: DataFrame | None = None
) -> DataFrame:
    """``source_id, missing, sheets``: the configured sheets a source does not have, to report.

    One row per source with something missing.  ``sources`` (``source_id``) names sources that
    may have no cell at all; they miss everything.
    """
    rows = cells.select("source_id", "sheet")
    if sources is not None:
        rows = rows.unionByName(sources.select("source_id", F.lit(None).cast("string").alias("sheet")))
    configured = F.array(*[F.lit(name) for name in series.sheets]).cast("array<string>")
    # Only configured names are collected, so the set is as small as the configuration.
    known = F.when(F.col("sheet").isin(series.sheets), F.col("sheet"))
    return (
        rows.groupBy("source_id")
        .agg(F.collect_set(known).alias("present"))
        .select("source_id", F.array_except(configured, "present").alias("sheets"))
        .where(F.size("sheets") > 0)
        .select("source_id", F.size("sheets").cast("bigint").alias("missing"), "sheets")
    )
