"""Raw payloads from a landing zone and their decoding to cells."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.operators.lookup import lookup_join
from tidemark.schemas import CELLS
from tidemark.sources.series import SeriesMap
from tidemark.sources.workbook import Unit, Wanted, column_number, cut_units, read_cells, unit_cells

_CELLS_PER_BATCH = 50_000
WORKBOOKS = "*.[xX][lL][sS][xXmM]"
DECODED = StructType([*CELLS.fields, StructField("error", StringType())])
_CELL_COLUMNS = pa.schema(
    {"source_id": pa.string(), "sheet": pa.string(), "row": pa.int32(), "col": pa.int32(),
     "ts": pa.timestamp("us"), "num": pa.float64(), "str": pa.string()}
)
_ERROR = pa.field("error", pa.string())
_PART = "struct<packed: binary, deflated: boolean, crc: bigint>"
UNITS = (
    f"source_id string, unit int, sheets array<struct<sheet: string, part: {_PART}>>, "
    f"strings {_PART}, styles {_PART}, calendar int, error string"
)


def scan_landing(spark: SparkSession, root: str, glob: str = WORKBOOKS) -> DataFrame:
    """All files below ``root`` whose name fits ``glob``, one row each (lazy content)."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(root)
    )


def landing_skipped(spark: SparkSession, root: str, glob: str = WORKBOOKS) -> DataFrame:
    """(path) of the files below ``root`` that ``scan_landing`` leaves out, such as ``.xls``."""
    every = scan_landing(spark, root, "*").select("path")
    return every.join(scan_landing(spark, root, glob).select("path"), "path", "left_anti")


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, "([^/]+)/?$", 1)


def decode_workbooks(payloads: DataFrame, source_id: Column | None = None) -> DataFrame:
    """Decode each workbook once into cells; a file is one unit of work.

    Spark packs files into tasks by size (``spark.sql.files.maxPartitionBytes``), so a task
    holds that many bytes of content, or one larger file.  Cells leave in batches.
    """
    named = payloads.select(
        (source_id if source_id is not None else file_name(F.col("path"))).alias("source_id"),
        "content",
    )
    return named.mapInArrow(_decode, CELLS)


def wanted_cells(series: SeriesMap) -> dict[str, Wanted]:
    """By sheet, the cells that the configured series are made of, in either layout."""
    wanted: dict[str, Wanted] = {}
    for entry in series.entries:
        if entry["sheet"] is None:
            continue
        sheet = wanted.setdefault(entry["sheet"], Wanted())
        if entry["layout"] == "vertical":
            header, skipped = entry["header_row"], entry["skip_rows_after_header"]
            for letters in (entry["date_col"], entry["value_col"]):
                if None not in (letters, header):
                    sheet.add_column(column_number(letters), header + skipped)
        else:
            for kind in ("fecha", "valor"):
                row, letters = entry[f"{kind}_row"], entry[f"{kind}_start_col"]
                if None not in (row, letters):
                    sheet.add_row(row, column_number(letters))
    return wanted


def workbook_units(
    payloads: DataFrame,
    names: list[str] | None = None,
    source_id: Column | None = None,
    isolated: bool = False,
) -> DataFrame:
    """Workbooks cut to units of some worksheets, still packed; sheets without one of ``names`` go.

    Only the archive's directory and its list of sheets are read.  What cannot be read fails, or
    if ``isolated`` is a unit without sheets that has the ``error``.
    """
    named = payloads.select(
        (source_id if source_id is not None else file_name(F.col("path"))).alias("source_id"),
        "content",
    )
    kept = set(names) if names is not None else None
    return named.mapInPandas(lambda batches: _cut(batches, kept, isolated), UNITS)


def decode_selected(
    payloads: DataFrame,
    series: SeriesMap,
    source_id: Column | None = None,
    tasks: int | None = None,
    isolated: bool = False,
) -> DataFrame:
    """The cells that ``series`` needs: other sheets stay packed, other cells are not converted.

    Both grid layouts give the same points from these cells as from all, and
    ``missing_sheets`` the same sheets: a sheet's corners are among them.  Work is dealt by unit
    (``workbook_units``), so a workbook of many sheets keeps several tasks busy; what is
    shuffled is packed, at most twice the wanted part of the files.  A sheet is read in one
    task, as a stream.  ``tasks`` is by default the number of shuffle partitions or cores,
    whichever is larger.  No payloads, no sheets or no series: no cells.

    A broken workbook fails the job; if ``isolated`` it gives rows with its ``error`` as in
    ``decode_isolated``, for ``good_cells`` and ``rejected_workbooks``.  Sheets that no series
    names are not looked at, so damage to them is not noticed.
    """
    spark = payloads.sparkSession
    wanted = wanted_cells(series)
    units = workbook_units(payloads, sorted(wanted), source_id, isolated)
    if tasks is None:
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    dealt = units.repartition(tasks, "source_id", "unit")
    decode = _decode_units_isolated if isolated else _decode_units
    return dealt.mapInArrow(lambda batches: decode(batches, wanted), DECODED if isolated else CELLS)


def decode_isolated(payloads: DataFrame, source_id: Column | None = None) -> DataFrame:
    """Like ``decode_workbooks``, but a broken file gives a row with its ``error`` instead of failing.

    Write the result once; ``good_cells`` and ``rejected_workbooks`` read it.
    """
    named = payloads.select(
        (source_id if source_id is not None else file_name(F.col("path"))).alias("source_id"),
        "content",
    )
    return named.mapInArrow(_decode_isolated, DECODED)


def rejected_workbooks(decoded: DataFrame) -> DataFrame:
    """(source_id, error) of every file that could not be read to its end."""
    return decoded.where(F.col("error").isNotNull()).select("source_id", "error")


def good_cells(decoded: DataFrame) -> DataFrame:
    """The cells of whole files; what a broken file gave before it broke is left out."""
    broken = rejected_workbooks(decoded).select("source_id").distinct()
    cells = decoded.where(F.col("error").isNull()).select(*CELLS.fieldNames())
    return lookup_join(cells, broken, ["source_id"], "left_anti", ["sheet", "row", "col"])


def _decode_isolated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for source, content in _files(batches):
        yield from _reported(source, _in_batches(source, read_cells(content)))


def _files(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    for batch in batches:
        for source, content in zip(batch["source_id"], batch["content"]):
            yield source.as_py(), content.as_py()


def _reported(source: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    try:
        for batch in batches:
            yield batch.append_column(_ERROR, pa.nulls(batch.num_rows, pa.string()))
    except Exception as error:  # whatever is wrong with the file, its name is reported
        yield _error_batch(source, _named_error(error))


def _named_error(error: Exception) -> str:
    return f"{type(error).__name__}: {error}"


def _error_batch(source: str, error: str) -> pa.RecordBatch:
    row = _batch(source, [(None, 0, 0, None, None, None)])
    return row.append_column(_ERROR, pa.array([error], pa.string()))


def _cut(batches: Iterator[pd.DataFrame], names: set[str] | None, isolated: bool) -> Iterator[pd.DataFrame]:
    columns = ["source_id", "unit", "sheets", "strings", "styles", "calendar", "error"]
    for batch in batches:
        for source, content in zip(batch["source_id"], batch["content"]):
            try:
                for number, unit in enumerate(cut_units(content, names)):
                    sheets = [{"sheet": name, "part": _part_row(part)} for name, part in unit.sheets]
                    shared = (_part_row(unit.strings), _part_row(unit.styles))
                    yield pd.DataFrame([(source, number, sheets, *shared, unit.calendar, None)], columns=columns)
            except Exception as error:
                if not isolated:
                    raise
                yield pd.DataFrame([(source, -1, [], None, None, 0, _named_error(error))], columns=columns)


def _part_row(part: tuple[bytes, bool, int] | None) -> dict | None:
    return None if part is None else dict(zip(("packed", "deflated", "crc"), part))


def _part(row) -> tuple[bytes, bool, int] | None:
    return None if row is None else (row["packed"], row["deflated"], row["crc"])


def _decode_units(batches: Iterator[pa.RecordBatch], wanted: dict[str, Wanted]) -> Iterator[pa.RecordBatch]:
    for row in _units(batches):
        yield from _in_batches(row["source_id"], _cells_of(row, wanted))


def _decode_units_isolated(
    batches: Iterator[pa.RecordBatch], wanted: dict[str, Wanted]
) -> Iterator[pa.RecordBatch]:
    for row in _units(batches):
        source = row["source_id"]
        if row["error"]:
            yield _error_batch(source, row["error"])
        else:
            yield from _reported(source, _in_batches(source, _cells_of(row, wanted)))


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for number in range(batch.num_rows):
            yield batch.slice(number, 1).to_pylist()[0]


def _cells_of(row: dict, wanted: dict[str, Wanted]) -> Iterator[tuple]:
    sheets = [(sheet["sheet"], _part(sheet["part"])) for sheet in row["sheets"]]
    return unit_cells(Unit(sheets, _part(row["strings"]), _part(row["styles"]), row["calendar"]), wanted)


def _in_batches(source: str, cells: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    while rows := list(islice(cells, _CELLS_PER_BATCH)):
        yield _batch(source, rows)


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for source, content in _files(batches):
        yield from _in_batches(source, read_cells(content))


def _batch(source: str, cells: list[tuple]) -> pa.RecordBatch:
    columns = [[source] * len(cells), *zip(*cells)]
    # As from pandas: a number that is none is null.
    arrays = [pa.array(c, field.type, from_pandas=True) for c, field in zip(columns, _CELL_COLUMNS)]
    return pa.RecordBatch.from_arrays(arrays, schema=_CELL_COLUMNS)
