from datetime import datetime, timedelta

import pytest
from rows import CODE, grid_cells, tuples

from pyspark.sql import functions as F
from tidemark.operators.grid import extract_horizontal, extract_points, extract_vertical
from tidemark.operators.grid import missing_sheets
from tidemark.operators.incremental import only_new
from tidemark.operators.lookup import lookup_join
from tidemark.operators import grid, lookup
from tidemark.sources.series import series_map

DAYS = [datetime(2025, 1, 1) + timedelta(days=n) for n in range(10)]
SHEET = {1: ["Date", "Value"], **{n + 2: [day, 10.5 * (n + 1)] for n, day in enumerate(DAYS)}}


def vertical(code="TEST", **changes):
    entry = {
        CODE: code, "sheet": "S", "header_row": 1, "skip_rows_after_header": 0,
        "date_col": "A", "value_col": "B", "drop_na": False,
    }
    return {**entry, **changes}


def horizontal(code="TEST", **changes):
    entry = {
        CODE: code, "sheet": "S", "fecha_row": 6, "fecha_start_col": "B",
        "valor_row": 10, "valor_start_col": "B", "drop_na": True,
    }
    return {**entry, **changes}


def config(spark, *entries):
    return series_map(spark, {"parse_config": {"series_map": list(entries)}})


@pytest.mark.parametrize(
    "entry, count",
    [
        (vertical(), 11),
        (vertical(drop_na=True), 11),  # header text is not a blank
        (vertical(skip_rows_after_header=2), 9),
        (vertical(skip_rows_after_header=None), 10),
        (vertical(sheet="NONEXISTENT"), 0),
    ],
)
def test_vertical_counts(spark, entry, count):
    assert extract_vertical(grid_cells(spark, "S", SHEET), config(spark, entry)).count() == count


def test_two_series_on_the_same_columns(spark):
    points = extract_vertical(
        grid_cells(spark, "S", SHEET), config(spark, vertical("A"), vertical("B"))
    )
    assert points.count() == 22
    assert points.where(F.col("obs_str") == "Date").count() == 2


def test_marks_drop_old_dates_and_let_text_through(spark):
    points = extract_vertical(grid_cells(spark, "S", SHEET), config(spark, vertical()))
    marks = spark.createDataFrame(
        [("TEST", DAYS[4])], f"{CODE} string, last_obs_local timestamp_ntz"
    )
    for small in (True, False):
        kept = only_new(points, marks, spread=["pos"], small=small)
        assert kept.where("obs_ts is not null").count() == 5
        assert kept.where("obs_ts is null").count() == 1
        assert kept.agg(F.min("obs_ts")).first()[0] == DAYS[5]


def test_vertical_blanks(spark):
    sheet = {1: ["Date", "Value"], 2: [DAYS[0], 100.5], 3: [None, 200.5], 4: [DAYS[2]],
             5: [DAYS[3], 300.5], 8: [None, None, "only elsewhere"]}
    cells = grid_cells(spark, "S", sheet)
    dropped = extract_vertical(cells, config(spark, vertical(drop_na=True)))
    assert tuples(dropped, "pos") == [(1,), (2,), (5,)]
    kept = extract_vertical(cells, config(spark, vertical()))
    assert tuples(kept, "pos") == [(n,) for n in range(1, 9)]  # rows 6 and 7 are blank lines


def test_one_column_for_date_and_value(spark):
    points = extract_vertical(
        grid_cells(spark, "S", {1: [5.0]}), config(spark, vertical(value_col="A"))
    )
    assert tuples(points, "obs_str", "value_num") == [("5.0", 5.0)]


WIDE = {
    6: [None, datetime(2024, 1, 1), datetime(2024, 2, 1), "2024-03-01", "nota", datetime(2024, 5, 1)],
    10: [None, "20,6", 13.2, None, 8.8, 4.2],
}


def test_horizontal_stops_at_the_first_non_date(spark):
    cells = grid_cells(spark, "S", WIDE)
    got = extract_horizontal(cells, config(spark, horizontal()))
    assert tuples(got, "pos", "value_num") == [(0, 20.6), (1, 13.2)]
    blanks = extract_horizontal(cells, config(spark, horizontal(drop_na=False)))
    assert [tuple(r) for r in blanks.select("pos", "value_num").orderBy("pos").collect()] == [
        (0, 20.6), (1, 13.2), (2, None)
    ]


def test_horizontal_pairs_by_position(spark):
    sheet = {6: WIDE[6], 10: [None, None, "20,6", 13.2, None, 8.8, 4.2]}
    got = extract_horizontal(
        grid_cells(spark, "S", sheet), config(spark, horizontal(valor_start_col="C"))
    )
    assert tuples(got, "pos", "value_num") == [(0, 20.6), (1, 13.2)]


@pytest.mark.parametrize(
    "dates, kept",
    [
        ([None, DAYS[0], DAYS[1]], 2),
        ([None, None, DAYS[1]], 0),  # the first date is missing
        ([None, DAYS[0], None, DAYS[2]], 1),  # a gap ends the scan
        ([None, DAYS[0], 45000.0, DAYS[2]], 1),  # a number is no date
        ([None], 0),
    ],
)
def test_horizontal_gaps(spark, dates, kept):
    sheet = {6: dates, 10: [None, 1, 2, 3, 4]}
    cells = grid_cells(spark, "S", sheet)
    assert extract_horizontal(cells, config(spark, horizontal())).count() == kept


def test_horizontal_ends_at_the_sheet_edge(spark):
    sheet = {6: [None, DAYS[0], DAYS[1], DAYS[2]], 10: [None, None, 1.0]}
    shifted = horizontal(valor_start_col="C", drop_na=False)
    got = extract_horizontal(grid_cells(spark, "S", sheet), config(spark, shifted))
    # The sheet has columns A to D, so only two value cells can follow column C.
    assert [r["pos"] for r in got.orderBy("pos").collect()] == [0, 1]


def test_layouts_together_and_missing_sheets(spark):
    cells = grid_cells(spark, "S", SHEET).unionByName(
        grid_cells(spark, "H", WIDE, source="other")
    )
    series = config(spark, vertical(drop_na=True), horizontal("H", sheet="H"))
    got = extract_points(cells, series)
    assert got.groupBy("source_id").count().count() == 2
    assert got.count() == 13
    assert tuples(missing_sheets(cells, series), "source_id", "missing", "sheets") == [
        ("book", 1, ["H"]), ("other", 1, ["S"])
    ]
    sources = spark.createDataFrame([("empty",), ("book",)], "source_id string")
    assert tuples(missing_sheets(cells, series, sources), "source_id", "sheets") == [
        ("book", ["H"]), ("empty", ["H", "S"]), ("other", ["S"])
    ]
    assert extract_points(cells, config(spark)).count() == 0


def test_large_configurations_are_shuffled_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(grid, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(grid, "PUSHED_NAMES", 0)
    cells = grid_cells(spark, "S", SHEET)
    plain = extract_vertical(cells, config(spark, vertical(), vertical("B", drop_na=True)))
    assert plain.count() == 22
    wide = extract_horizontal(grid_cells(spark, "S", WIDE), config(spark, horizontal()))
    assert wide.count() == 2


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_broadcast_join(spark, monkeypatch, how):
    facts = spark.range(5000).selectExpr("if(id % 3 = 0, 'hot', concat('k', id % 50)) AS k", "id")
    table = spark.range(0, 40).selectExpr("concat('k', id) AS k", "id AS extra").unionByName(
        spark.sql("SELECT 'hot' AS k, -1L AS extra")
    )
    fast = lookup_join(facts, table, ["k"], how, ["id"])
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 10)
    salted = lookup_join(facts, table, ["k"], how, ["id"])
    assert fast.columns == salted.columns
    key = [str(tuple(r)) for r in fast.collect()]
    assert sorted(key) == sorted(str(tuple(r)) for r in salted.collect())


def test_cells_are_shuffled_before_they_are_sorted(spark, folder):
    """A task that reads a large file must not sort all of its cells."""
    grid_cells(spark, "S", SHEET).write.parquet(folder + "/cells")
    points = extract_vertical(spark.read.parquet(folder + "/cells"), config(spark, vertical(drop_na=True)))
    plan = points._jdf.queryExecution().executedPlan().toString().split("\n")
    found = [line for line in plan if "Exchange hash" in line or "Sort [" in line]
    assert found and "Exchange hash" in found[-1], found
