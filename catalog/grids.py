"""Worksheet grids: landing zone, workbooks, vertical and horizontal layouts."""

from __future__ import annotations

from datetime import timedelta

import pandas as pd
from pyspark.sql import functions as F

from catalog.registry import query, table
from catalog.shapes import RUN_TS, ZONE, wall
from catalog.workbook_fixture import workbook_bytes
from tidemark.operators import grid
from tidemark.plans import projection
from tidemark.plans.layout import DatasetLayout
from tidemark.plans.refresh import run_refresh
from tidemark.session import staged, work_folder
from tidemark.sources import landing
from tidemark.sources.series import series_map

_ROWS = 2000  # events per workbook


def _build(group: pd.DataFrame) -> pd.DataFrame:
    name = group["workbook"].iloc[0]
    sheets = {}
    for sheet, rows in group.groupby("event_type"):
        lines = {1: ["ts", "value", "=note"]}
        for row in rows.itertuples():
            lines[int(row.line)] = [row.ts.to_pydatetime(), row.value, f"u{row.user_id}"]
        sheets[sheet] = lines
    return pd.DataFrame({"workbook": [name], "content": [workbook_bytes(sheets)]})


def _land_workbooks(spark, sf_dir) -> str:
    """One workbook per run of events, a sheet per event type, written by Spark."""
    events = _workbook_events(spark, sf_dir)
    books = _books(events, _build)
    root = work_folder(spark, "landing")
    books.select("workbook", F.col("content").cast("string").alias("value")).write.option(
        "maxRecordsPerFile", 1
    ).partitionBy("workbook").text(root)
    return root


def _books(rows, build):
    """Workbooks are dealt over all tasks: sizes of rows, which adaptive execution goes by, say little of the work."""
    spark = rows.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    dealt = rows.repartition(tasks, "workbook")
    return dealt.groupBy("workbook").applyInPandas(build, "workbook string, content binary")


def _workbook_events(spark, sf_dir):
    number = F.floor(F.col("event_id") / _ROWS).cast("bigint")
    return table(spark, sf_dir, "events").select(
        F.format_string("W%06d.xlsx", number).alias("workbook"),
        "event_type",
        (F.col("event_id") % _ROWS + 2).alias("line"),
        F.date_trunc("second", F.col("ts")).cast("timestamp_ntz").alias("ts"),
        "value",
        "user_id",
    )


def _workbook_name():
    return F.regexp_extract("path", "workbook=([^/]+)", 1)


@query(f"""
SELECT DISTINCT printf('W%06d.xlsx', event_id // {_ROWS}) AS workbook, true AS is_zip
FROM events""")
def scan_landing(spark, sf_dir):
    files = landing.scan_landing(spark, _land_workbooks(spark, sf_dir), "*.txt")
    return files.select(
        _workbook_name().alias("workbook"),
        (F.hex(F.substring("content", 1, 2)) == "504B").alias("is_zip"),
    )


@query(f"""
WITH e AS (SELECT printf('W%06d.xlsx', event_id // {_ROWS}) AS source_id, event_type AS sheet,
                  (event_id % {_ROWS} + 2)::INTEGER AS row, date_trunc('second', ts) AS ts,
                  value, 'u' || user_id AS note FROM events),
heads AS (SELECT DISTINCT source_id, sheet FROM e)
SELECT source_id, sheet, row, 0::INTEGER AS col, ts, NULL::DOUBLE AS num, NULL AS str FROM e
UNION ALL SELECT source_id, sheet, row, 1, NULL, value, NULL FROM e
UNION ALL SELECT source_id, sheet, row, 2, NULL, NULL, note FROM e
UNION ALL SELECT source_id, sheet, 1, 0, NULL, NULL, 'ts' FROM heads
UNION ALL SELECT source_id, sheet, 1, 1, NULL, NULL, 'value' FROM heads
UNION ALL SELECT source_id, sheet, 1, 2, NULL, NULL, '=note' FROM heads""")
def decode_workbooks(spark, sf_dir):
    files = landing.scan_landing(spark, _land_workbooks(spark, sf_dir), "*.txt")
    return landing.decode_workbooks(files, _workbook_name())


@query(f"""
WITH e AS (SELECT printf('W%06d.xlsx', event_id // {_ROWS}) AS source_id, event_type AS sheet,
                  (event_id % {_ROWS} + 2)::INTEGER AS row, date_trunc('second', ts) AS ts,
                  value, 'u' || user_id AS note FROM events WHERE event_type IN ('click', 'view')),
heads AS (SELECT DISTINCT source_id, sheet FROM e)
SELECT source_id, sheet, row, 0::INTEGER AS col, ts, NULL::DOUBLE AS num, NULL AS str FROM e
UNION ALL SELECT source_id, sheet, row, 1, NULL, value, NULL FROM e WHERE sheet = 'click'
UNION ALL SELECT source_id, sheet, row, 2, NULL, NULL, note FROM e WHERE sheet = 'view'
UNION ALL SELECT source_id, sheet, 1, 2, NULL, NULL, '=note' FROM heads""")
def decode_selected_sheets(spark, sf_dir):
    """Two columns of two sheets, and the corner that shows how wide each sheet is."""
    files = landing.scan_landing(spark, _land_workbooks(spark, sf_dir), "*.txt")
    wanted = [
        {"internal_series_code": "C", "sheet": "click", "header_row": 1, "date_col": "A", "value_col": "B"},
        {"internal_series_code": "V", "sheet": "view", "header_row": 1, "date_col": "a", "value_col": "C"},
        {"internal_series_code": "N", "sheet": "none", "fecha_row": 1, "valor_row": 2},
    ]
    series = series_map(spark, {"parse_config": {"series_map": wanted}})
    return landing.decode_selected(files, series, _workbook_name())


@query(f"""
SELECT DISTINCT printf('W%06d.xlsx', event_id // {_ROWS}) AS source_id, 'BadZipFile' AS kind
FROM events WHERE (event_id // {_ROWS}) % 2 = 1""")
def landing_rejects(spark, sf_dir):
    """Every second workbook is cut short on its way."""
    files = landing.scan_landing(spark, _land_workbooks(spark, sf_dir), "*.txt")
    number = F.regexp_extract("path", "workbook=W0*([0-9]+)", 1).cast("int")
    short = F.expr("substring(content, 1, 500)")
    cut = files.withColumn("content", F.when(number % 2 == 1, short).otherwise(F.col("content")))
    decoded = staged(landing.decode_isolated(cut, _workbook_name()), "decoded")
    return landing.rejected_workbooks(decoded).select(
        "source_id", F.regexp_extract("error", "^[A-Za-z]+", 0).alias("kind")
    )


def _build_both(group: pd.DataFrame) -> pd.DataFrame:
    """Sheets in columns (header, then a line per event), the sheet of errors in rows 6 and 10."""
    sheets = {}
    for sheet, rows in group.sort_values("line").groupby("event_type"):
        lines = {1: ["ts", "value"]}
        times, values = rows["ts"].to_numpy("datetime64[us]").tolist(), rows["value"].tolist()
        if sheet == "error":
            lines |= {6: [None, *times], 10: [None, None, *values]}
        else:
            lines |= {int(n): list(pair) for n, *pair in zip(rows["line"], times, values)}
        sheets[sheet] = lines
    return pd.DataFrame(
        {"workbook": [group["workbook"].iloc[0]], "content": [workbook_bytes(sheets)]}
    )


_BOTH = {
    "dataset_id": "books",
    "windowInDays": 20,
    "normalize": {"timezone": ZONE, "primary_keys": ["obs_time", "internal_series_code"]},
    "parse_config": {
        "series_map": [
            {"internal_series_code": "CLICK", "sheet": "click", "header_row": 1, "unit": "clicks",
             "date_col": "A", "value_col": "B", "drop_na": True},
            {"internal_series_code": "VIEW", "sheet": "view", "header_row": 1, "frequency": "D",
             "date_col": "A", "value_col": "B"},
            {"internal_series_code": "ERROR", "sheet": "error", "fecha_row": 6,
             "fecha_start_col": "B", "valor_row": 10, "valor_start_col": "C", "drop_na": True},
        ]
    },
}


@query(f"""
WITH e AS (
  SELECT event_id, event_id // {_ROWS} AS book, upper(event_type) AS code,
    date_trunc('second', ts) AS clk, value FROM events
  WHERE event_type IN ('click', 'view', 'error')),
early AS (SELECT * FROM e WHERE book % 2 = 0 AND clk < '2024-01-20'),
marks AS (SELECT code, max(clk) AS mark FROM early GROUP BY code),
late AS (SELECT e.* FROM e LEFT JOIN marks USING (code) WHERE mark IS NULL OR clk > mark),
both_runs AS (SELECT 0 AS run, * FROM early UNION ALL SELECT 1, * FROM late),
ranked AS (SELECT *, row_number() OVER (PARTITION BY code, clk ORDER BY run, event_id) AS rn
  FROM both_runs WHERE clk + INTERVAL 3 HOUR >= TIMESTAMP '2024-02-01 12:30:15.25' - INTERVAL 20 DAY)
SELECT clk + INTERVAL 3 HOUR AS obs_time, clk AS obs_local, code AS internal_series_code, value,
  CASE code WHEN 'CLICK' THEN 'clicks' END AS unit, CASE code WHEN 'VIEW' THEN 'D' END AS frequency
FROM ranked WHERE rn = 1""")
def refresh_workbooks(spark, sf_dir):
    """Workbooks in both layouts, twice: some early ones, then all; old rows fall to marks and window."""
    root = work_folder(spark, "books")
    events = _workbook_events(spark, sf_dir)
    number = F.regexp_extract("workbook", "W0*([0-9]+)", 1).cast("int")
    early = events.where((number % 2 == 0) & (F.col("ts") < "2024-01-20"))
    for run, rows in enumerate((early, events)):
        payloads = _books(rows, _build_both).select(F.col("workbook").alias("path"), "content")
        cells = landing.good_cells(staged(landing.decode_isolated(payloads), "decoded"))
        run_refresh(cells, _BOTH, root, RUN_TS + timedelta(days=run), as_of=RUN_TS)
    layout = DatasetLayout(root, _BOTH["dataset_id"])
    return projection.read_projection(spark, layout).select(
        wall("obs_time"), "obs_local", "internal_series_code", "value", "unit", "frequency"
    )


_SOURCE = "concat('W', CAST(event_id div 1000 AS STRING))"

_VERTICAL_CELLS = """vcells AS (
  SELECT concat('W', event_id // 1000) AS source_id, event_type AS sheet,
         (event_id % 1000 + 2)::INTEGER AS row, ts,
         CASE WHEN event_id % 5 = 0 OR event_id % 7 = 0 THEN NULL ELSE value END AS num,
         CASE WHEN event_id % 5 <> 0 AND event_id % 7 = 0 THEN '1,5' END AS str,
         event_id % 9 = 0 AS dateless
  FROM events)"""

_VERTICAL = {
    "parse_config": {
        "series_map": [
            {"internal_series_code": "CLICK_A", "sheet": "click", "header_row": 1,
             "date_col": "A", "value_col": "C", "drop_na": True},
            {"internal_series_code": "CLICK_B", "sheet": "click", "header_row": 1,
             "skip_rows_after_header": 0, "date_col": "A", "value_col": "C"},
            {"internal_series_code": "VIEW_A", "sheet": "view", "header_row": 1,
             "date_col": "A", "value_col": "C", "drop_na": False},
            {"internal_series_code": "GONE", "sheet": "nowhere", "header_row": 1,
             "date_col": "A", "value_col": "C"},
            {"internal_series_code": "ERROR_A", "sheet": "error", "header_row": 100,
             "skip_rows_after_header": 2, "date_col": "a", "value_col": "c", "drop_na": True},
        ]
    }
}


def _vertical_cells(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr(
        f"{_SOURCE} AS source_id",
        "event_type AS sheet",
        "CAST(event_id % 1000 + 2 AS INT) AS row",
        """inline(filter(array(
             if(event_id % 9 = 0, null, named_struct(
               'col', 0, 'ts', ts, 'num', cast(null as double), 'str', cast(null as string))),
             named_struct('col', 1, 'ts', cast(null as timestamp_ntz),
               'num', cast(user_id as double), 'str', cast(null as string)),
             if(event_id % 5 = 0, null, named_struct('col', 2, 'ts', cast(null as timestamp_ntz),
               'num', if(event_id % 7 = 0, null, value),
               'str', if(event_id % 7 = 0, '1,5', null)))
           ), c -> c is not null))""",
    )


@query(f"""
WITH {_VERTICAL_CELLS},
ext AS (SELECT source_id, sheet, max(row) AS last_row FROM vcells GROUP BY ALL),
smap(code, sheet, first_row, drop_na) AS (VALUES ('CLICK_A', 'click', 2, true),
  ('CLICK_B', 'click', 1, false), ('VIEW_A', 'view', 2, false), ('ERROR_A', 'error', 102, true)),
lines AS (SELECT e.source_id, s.code, s.sheet, s.drop_na,
            unnest(generate_series(s.first_row, e.last_row))::BIGINT AS pos
          FROM smap s JOIN ext e ON e.sheet = s.sheet)
SELECT l.source_id, l.code AS internal_series_code, l.pos,
       CASE WHEN NOT c.dateless THEN c.ts END AS obs_ts,
       NULL::VARCHAR AS obs_str, c.num AS value_num, c.str AS value_str
FROM lines l LEFT JOIN vcells c ON c.source_id = l.source_id AND c.sheet = l.sheet AND c.row = l.pos
WHERE NOT l.drop_na OR (NOT c.dateless AND (c.num IS NOT NULL OR c.str IS NOT NULL))""")
def extract_vertical(spark, sf_dir):
    cells = staged(_vertical_cells(spark, sf_dir), "cells")
    return grid.extract_vertical(cells, series_map(spark, _VERTICAL)).select(
        "source_id", "internal_series_code", "pos", "obs_ts", "obs_str", "value_num", "value_str"
    )


@query("""
WITH has AS (SELECT DISTINCT concat('W', event_id // 1000) AS source_id, event_type FROM events),
sources AS (SELECT DISTINCT source_id FROM has
            UNION SELECT concat('EMPTY', event_id // 5000) FROM events),
wanted(sheet) AS (VALUES ('click'), ('view'), ('nowhere'), ('error'))
SELECT s.source_id, count(*)::BIGINT AS missing, string_agg(sheet, ',' ORDER BY sheet) AS sheets
FROM sources s CROSS JOIN wanted w
WHERE NOT EXISTS (SELECT 1 FROM has WHERE has.source_id = s.source_id AND event_type = sheet)
GROUP BY s.source_id""")
def missing_sheets(spark, sf_dir):
    """A row per workbook; some workbooks have no cell at all."""
    empty = F.concat(F.lit("EMPTY"), F.expr("event_id div 5000").cast("string"))
    sources = table(spark, sf_dir, "events").select(empty.alias("source_id")).distinct()
    cells, series = _vertical_cells(spark, sf_dir), series_map(spark, _VERTICAL)
    return grid.missing_sheets(cells, series, sources).withColumn(
        "sheets", F.array_join("sheets", ",")
    )


# Dates in row 6 from column B, values in row 10 from column C, one offset per event.
_HORIZONTAL = {
    "parse_config": {
        "series_map": [
            {"internal_series_code": name.upper(), "sheet": name, "fecha_row": 6,
             "fecha_start_col": "B", "valor_row": 10, "valor_start_col": "C",
             "drop_na": name in ("click", "view", "error")}
            for name in ("click", "view", "purchase", "signup", "error")
        ]
    }
}


def _horizontal_cells(spark, sf_dir):
    ranked = table(spark, sf_dir, "events").selectExpr(
        "*",
        f"{_SOURCE} AS source_id",
        "CAST(row_number() OVER (PARTITION BY event_id div 1000, event_type ORDER BY event_id) - 1"
        " AS INT) AS k",
        "CAST(date_trunc('hour', ts) AS timestamp_ntz) AS clock",
    )
    return ranked.selectExpr(
        "source_id",
        "event_type AS sheet",
        """inline(filter(array(
             CASE WHEN event_id % 307 = 7 THEN NULL
                  WHEN event_id % 211 = 100 THEN named_struct('row', 6, 'col', k + 1,
                    'ts', cast(null as timestamp_ntz), 'num', cast(null as double), 'str', 'n/d')
                  WHEN event_id % 17 = 5 THEN named_struct('row', 6, 'col', k + 1,
                    'ts', cast(null as timestamp_ntz), 'num', cast(null as double),
                    'str', date_format(clock, 'yyyy-MM-dd HH:mm'))
                  ELSE named_struct('row', 6, 'col', k + 1, 'ts', clock,
                    'num', cast(null as double), 'str', cast(null as string)) END,
             CASE event_id % 6 WHEN 0 THEN NULL
                  WHEN 1 THEN named_struct('row', 10, 'col', k + 2,
                    'ts', cast(null as timestamp_ntz), 'num', cast(null as double),
                    'str', replace(printf('%.2f', value), '.', ','))
                  WHEN 2 THEN named_struct('row', 10, 'col', k + 2,
                    'ts', cast(null as timestamp_ntz), 'num', cast(null as double), 'str', '1 234')
                  ELSE named_struct('row', 10, 'col', k + 2, 'ts', cast(null as timestamp_ntz),
                    'num', value, 'str', cast(null as string)) END
           ), c -> c is not null))""",
    )


@query("""
WITH e AS (SELECT event_id, concat('W', event_id // 1000) AS source_id, event_type AS sheet,
    row_number() OVER (PARTITION BY event_id // 1000, event_type ORDER BY event_id) - 1 AS k,
    date_trunc('hour', ts) AS clock, value FROM events),
slots AS (SELECT source_id, sheet, k,
    CASE WHEN event_id % 307 = 7 OR event_id % 211 = 100 THEN NULL ELSE clock END AS clock,
    event_id % 307 <> 7 AS date_cell, event_id % 6 <> 0 AS value_cell,
    CASE WHEN event_id % 6 IN (0, 2) THEN NULL ELSE round(value, 2) END AS value FROM e),
stops AS (SELECT source_id, sheet, coalesce(min(k) FILTER (clock IS NULL), max(k) + 1) AS stop,
    greatest(coalesce(max(k + 1) FILTER (date_cell), 0),
             coalesce(max(k + 2) FILTER (value_cell), 0)) - 1 AS room
  FROM slots GROUP BY ALL)
SELECT source_id, upper(sheet) AS internal_series_code, k::BIGINT AS pos, clock AS obs_ts,
       value AS value_num
FROM slots JOIN stops USING (source_id, sheet)
WHERE k < stop AND (value IS NOT NULL OR (sheet IN ('purchase', 'signup') AND k < room))""")
def extract_horizontal(spark, sf_dir):
    cells = staged(_horizontal_cells(spark, sf_dir), "cells")
    return grid.extract_horizontal(
        cells, series_map(spark, _HORIZONTAL), ("yyyy-MM-dd HH:mm",)
    ).select("source_id", "internal_series_code", "pos", "obs_ts", "value_num")
