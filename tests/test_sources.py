import io
import json
import sys
import zipfile
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from rows import CODE

import catalog
from catalog import grids
from catalog.workbook_fixture import workbook_bytes
from tidemark.session import staged
from tidemark.sources import landing
from tidemark.sources.landing import decode_workbooks, scan_landing
from tidemark.sources.published import scan_published
from tidemark.sources.series import series_map
from tidemark.sources.workbook import cut_units, read_cells, unit_cells

WHEN = datetime(2024, 3, 1, 10, 30)


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def row(at, value=1.5, code="A"):
    return {"obs_time": at, CODE: code, "value": value, "unit": "u", "frequency": "D",
            "collection_date": "2024-01-31T00:00:00+00:00"}


def test_published_forms(spark, folder):
    root = Path(folder)
    write(root / "A/year=2024/month=01/data.json", json.dumps([row("t1"), row("t2")], indent=2))
    write(root / "A/year=2024/month=02/data.json", json.dumps({"data": [row("t3")], "x": 1}))
    write(root / "B/year=2024/month=01/data.json", json.dumps(row("t4", code="Ñandú")))
    write(root / "B/year=2024/month=02/data.json", "[]")
    write(root / "C/year=2024/month=01/data.json", "17")
    write(root / "C/year=2024/month=02/data.json", json.dumps({"data": []}))
    write(root / "D/year=2024/month=01/other.json", json.dumps([row("no")]))
    got = {(r["obs_time"], r[CODE], r["value"]) for r in scan_published(spark, folder).collect()}
    assert got == {("t1", "A", 1.5), ("t2", "A", 1.5), ("t3", "A", 1.5), ("t4", "Ñandú", 1.5)}


def test_published_nothing(spark, folder):
    assert scan_published(spark, folder + "/absent").count() == 0


def test_landing_and_decoding(spark, folder):
    sheets = {
        "One & two": {1: ["Date", "Valor", "=inline"], 3: [WHEN, 1.25, None, True], 5: [None, "x"]},
        "Empty line": {1: [None], 2: [2.0]},
    }
    (Path(folder) / "sub").mkdir()
    (Path(folder) / "a.xlsx").write_bytes(workbook_bytes(sheets))
    (Path(folder) / "sub" / "b.xlsm").write_bytes(workbook_bytes({"S": {1: [7]}}))
    (Path(folder) / "notes.txt").write_text("not a workbook")
    files = scan_landing(spark, folder)
    assert files.count() == 2
    cells = decode_workbooks(files)
    got = {tuple(r) for r in cells.collect()}
    assert got == {
        ("a.xlsx", "One & two", 1, 0, None, None, "Date"),
        ("a.xlsx", "One & two", 1, 1, None, None, "Valor"),
        ("a.xlsx", "One & two", 1, 2, None, None, "=inline"),
        ("a.xlsx", "One & two", 3, 0, WHEN, None, None),
        ("a.xlsx", "One & two", 3, 1, None, 1.25, None),
        ("a.xlsx", "One & two", 3, 3, None, 1.0, None),
        ("a.xlsx", "One & two", 5, 1, None, None, "x"),
        ("a.xlsx", "Empty line", 1, 0, None, None, None),
        ("a.xlsx", "Empty line", 2, 0, None, 2.0, None),
        ("b.xlsm", "S", 1, 0, None, 7.0, None),
    }


@pytest.mark.parametrize(
    "serial, flag, expected",
    [
        ("45352.4375", "0", WHEN),
        ("1", "0", datetime(1900, 1, 1)),
        ("59", "0", datetime(1900, 2, 28)),
        ("61", "0", datetime(1900, 3, 1)),
        ("0.5", "0", "12:00:00"),  # a time of day is no date
        ("1", "1", datetime(1904, 1, 2)),
    ],
)
def test_date_serials(serial, flag, expected):
    raw = workbook_bytes({"S": {1: [WHEN]}})
    assert _first(_changed(raw, "45352.4375", serial, flag)) == expected


def _changed(raw, old, new, flag):
    source, out = zipfile.ZipFile(io.BytesIO(raw)), io.BytesIO()
    with zipfile.ZipFile(out, "w") as target:
        for name in source.namelist():
            body = source.read(name).decode()
            if name.endswith("sheet1.xml"):
                body = body.replace(f"<v>{old}</v>", f"<v>{new}</v>")
            if name == "xl/workbook.xml":
                body = body.replace("<sheets>", f'<workbookPr date1904="{flag}"/><sheets>')
            target.writestr(name, body)
    return out.getvalue()


def _first(raw):
    _, _, _, ts, num, text = next(read_cells(raw))
    return ts or text or num


def test_series_map_defaults(spark):
    series = series_map(spark, {"parse_config": {"series_map": [
        {CODE: 7, "sheet": "S", "header_row": 3},
        {CODE: "H", "sheet": "S", "fecha_row": 6, "valor_row": 10, "drop_na": True},
    ]}})
    first, second = series.frame.orderBy("ord").collect()
    assert (first[CODE], first["layout"], first["skip_rows_after_header"], first["drop_na"]) == (
        "7", "vertical", 1, False
    )
    assert (second["layout"], second["drop_na"]) == ("horizontal", True)
    assert series.of_layout("vertical").size == 1
    assert series_map(spark, {}).size == 0


def test_ill_typed_values_cost_no_row_and_broken_files_are_listed(spark, folder):
    from tidemark.sources.published import published_rejects

    row = '{{"obs_time": "2024-01-0{}", "internal_series_code": "S", "value": {}}}'
    documents = {
        "a": f'[{row.format(1, 1.5)}, {row.format(2, chr(34) + "2.5" + chr(34))}, {row.format(3, "{}")}]',
        "b": f'{{"data": [{row.format(4, "true")}]}}',
        "c": f"[{row.format(5, 1)}, ",
    }
    for name, text in documents.items():
        (Path(folder) / name).mkdir()
        (Path(folder) / name / "data.json").write_text(text)
    with pytest.raises(Exception, match="no JSON"):  # a cut-off document is not taken for an empty one
        scan_published(spark, folder).collect()
    read = scan_published(spark, folder, on_broken="skip")
    got = {r["obs_time"]: r["value"] for r in read.collect()}
    assert {k: got.get(k) for k in ("2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04")} == {
        "2024-01-01": 1.5, "2024-01-02": 2.5, "2024-01-03": None, "2024-01-04": None,
    }
    assert [r["path"][-11:] for r in published_rejects(spark, folder).collect()] == ["c/data.json"]


@pytest.mark.parametrize(
    "code, expected",
    [("0.00", False), ("[h]", True), ("[Red]0.0", False), ('"day"0', False), ("0;yyyy", False), ("dd/mm/yy", True)],
)
def test_format_codes(code, expected):
    from tidemark.sources.workbook import _shows_date

    assert _shows_date(code) == expected


def test_broken_workbooks_are_reported_and_skipped_names_listed(spark, folder):
    Path(folder).mkdir(parents=True, exist_ok=True)
    whole = workbook_bytes({"s": {1: ["a", 1.0]}})
    for name, content in (("a.xlsx", whole), ("B.XLSX", whole), ("c.xlsm", whole[:200]), ("d.xls", whole)):
        Path(folder, name).write_bytes(content)
    files = landing.scan_landing(spark, folder)
    decoded = staged(landing.decode_isolated(files), "decoded")
    assert [r.source_id for r in landing.rejected_workbooks(decoded).collect()] == ["c.xlsm"]
    assert {r.source_id for r in landing.good_cells(decoded).collect()} == {"a.xlsx", "B.XLSX"}
    skipped = landing.landing_skipped(spark, folder).collect()
    assert [r.path.rsplit("/", 1)[-1] for r in skipped] == ["d.xls"]


SELECTED = [
    {CODE: "V", "sheet": "down", "header_row": 2, "date_col": "A", "value_col": "C", "drop_na": True},
    {CODE: "B", "sheet": "down", "header_row": 3, "date_col": "b", "value_col": "D"},
    {CODE: "H", "sheet": "across", "fecha_row": 2, "fecha_start_col": "B", "valor_row": 4, "valor_start_col": "C"},
    {CODE: "I", "sheet": "across", "fecha_row": 2, "fecha_start_col": "B", "valor_row": 5, "valor_start_col": "B",
     "drop_na": True},
    {CODE: "M", "sheet": "absent", "header_row": 1, "date_col": "A", "value_col": "B"},
]


def many_sheets(number):
    down = {n: [WHEN, None if n % 3 else WHEN, f"{n},5", n / 2, "more", n] for n in range(1, 12)}
    down |= {13: [], 14: [None, None, None, None, None, None, "wide"], 15: [None, None, None, None, "low"], 17: []}
    across = {1: ["x"] * 9, 2: [None, WHEN, WHEN, WHEN], 4: ["=v", None, 1.0, "2,5"], 5: [None, 4, 5], 9: [None, "end"]}
    return {"first": {1: [number]}, "down": down, "across": across, "empty": {}, "last": {1: ["text", WHEN]}}


def test_selected_cells_give_the_same_points(spark, folder):
    from tidemark.operators.grid import extract_points, missing_sheets

    for n in range(3):
        (Path(folder) / f"{n}.xlsx").write_bytes(workbook_bytes(many_sheets(n)))
    (Path(folder) / "4.xlsx").write_bytes(workbook_bytes({"down": {1: ["a"]}, "absent": {}}))
    series = series_map(spark, {"parse_config": {"series_map": SELECTED}})
    files = scan_landing(spark, folder)
    every = staged(decode_workbooks(files), "every")
    some = staged(landing.decode_selected(files, series, tasks=8), "some")
    assert some.exceptAll(every).isEmpty() and some.count() < 0.7 * every.count()
    for build in (lambda cells: extract_points(cells, series), lambda cells: missing_sheets(cells, series)):
        ours, theirs = build(some), build(every)
        assert ours.count() > 3
        assert ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty()
    no_series = series_map(spark, {})
    assert landing.decode_selected(files, no_series).isEmpty()
    assert landing.decode_selected(files.where("false"), series).isEmpty()


def test_one_workbook_is_spread_over_tasks(spark, folder):
    from pyspark.sql import functions as F

    sheets = {f"s{n}": {row: [WHEN, row + n / 7] for row in range(1, 60)} for n in range(40)}
    (Path(folder) / "one.xlsx").write_bytes(workbook_bytes(sheets))
    entries = [{CODE: f"c{n}", "sheet": f"s{n}", "header_row": 1, "date_col": "A", "value_col": "B"} for n in range(40)]
    series = series_map(spark, {"parse_config": {"series_map": entries}})
    files = scan_landing(spark, folder)
    assert landing.workbook_units(files).select(F.explode("sheets")).count() == 40
    cells = landing.decode_selected(files, series, tasks=8)
    by_task = cells.groupBy(F.spark_partition_id().alias("task")).agg(F.count_distinct("sheet").alias("sheets")).collect()
    assert len(by_task) >= 6 and sum(r.sheets for r in by_task) == 40
    # Shared texts go along only until the sheets weigh as much.
    words = workbook_bytes({f"s{n}": {1: [f"text {n} {k} {n * k * 7919}" for k in range(50)]} for n in range(30)})
    units = list(cut_units(words))
    assert sum(len(u.strings[0]) for u in units) <= len(words) and len(units) > 1


def test_other_sheets_stay_packed_and_damage_is_found():
    raw = workbook_bytes({"bad": {n: [n, "x"] for n in range(1, 50)}, "good": {1: [1.0, 2.0, "t"]}})
    with zipfile.ZipFile(io.BytesIO(raw)) as book:
        info = book.getinfo("xl/worksheets/sheet1.xml")
    at = info.header_offset + 30 + len(info.filename) + info.compress_size // 2
    broken = raw[:at] + bytes([raw[at] ^ 255]) + raw[at + 1 :]
    with pytest.raises(Exception):
        list(read_cells(broken))
    good = [c for u in cut_units(broken, {"good"}) for c in unit_cells(u)]
    assert good == [c for c in read_cells(raw) if c[0] == "good"]
    with pytest.raises(Exception):
        [c for u in cut_units(broken, {"bad"}) for c in unit_cells(u)]
    stored = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(raw)) as book, zipfile.ZipFile(stored, "w") as plain:
        for name in book.namelist():
            plain.writestr(name, book.read(name))
    assert [c for u in cut_units(stored.getvalue()) for c in unit_cells(u)] == list(read_cells(raw))
    # A member that is whole by its lengths but not by its checksum.
    unit = next(cut_units(stored.getvalue(), {"good"}))
    (name, (packed, deflated, crc)), = unit.sheets
    unit.sheets = [(name, (packed.replace(b"<v>2.0</v>", b"<v>3.0</v>"), deflated, crc))]
    with pytest.raises(zipfile.BadZipFile, match="checksum"):
        list(unit_cells(unit))


def test_selected_cells_of_broken_workbooks(spark, folder):
    series = series_map(spark, {"parse_config": {"series_map": SELECTED}})
    whole = workbook_bytes(many_sheets(1))
    with zipfile.ZipFile(io.BytesIO(whole)) as book:
        places = {name: book.getinfo(name) for name in book.namelist()}

    def damaged(part):
        info = places[f"xl/{part}.xml"]
        at = info.header_offset + 30 + len(info.filename) + info.compress_size // 2
        return whole[:at] + bytes([whole[at] ^ 255]) + whole[at + 1 :]

    contents = {"good": whole, "cut": whole[:300], "no zip": b"", "unread": damaged("worksheets/sheet1"),
                "sheet": damaged("worksheets/sheet2"), "texts": damaged("sharedStrings")}
    files = spark.createDataFrame([(f"{k}.xlsx", bytearray(v)) for k, v in contents.items()], "path string, content binary")
    decoded = staged(landing.decode_selected(files, series, tasks=4, isolated=True), "decoded")
    broken = {r.source_id for r in landing.rejected_workbooks(decoded).collect()}
    assert broken == {"cut.xlsx", "no zip.xlsx", "sheet.xlsx", "texts.xlsx"}
    cells = landing.good_cells(decoded)
    every = decode_workbooks(files.where("path = 'good.xlsx'"))
    assert {r.source_id for r in cells.collect()} == {"good.xlsx", "unread.xlsx"}
    assert cells.where("source_id = 'good.xlsx'").exceptAll(every).isEmpty()
    with pytest.raises(Exception, match="zip"):
        landing.decode_selected(files, series, tasks=4).collect()


@pytest.mark.parametrize("split", ["128m", "1k"])
def test_a_published_document_is_read_once_and_whole(spark, folder, split):
    from tidemark.session import settings

    rows = [{"obs_time": f"t{n}", "internal_series_code": "S", "value": n / 8} for n in range(3000)]
    texts = {"a": json.dumps(rows), "b": json.dumps({"data": rows}, indent=1), "c": "", "d": "\n"}
    for name, text in texts.items():
        (Path(folder) / name).mkdir()
        (Path(folder) / name / "data.json").write_text(text)

    def bytes_read():
        return sum(s.getBytesRead() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())

    before = bytes_read()
    with settings(spark, spark__sql__files__maxPartitionBytes=split, spark__sql__files__openCostInBytes="0"):
        got = sorted((r["obs_time"], r["value"]) for r in scan_published(spark, folder, "data.json").collect())
    assert got == sorted((r["obs_time"], r["value"]) for r in rows for _ in "ab")
    if split == "128m":  # smaller splits look for the end of the document they begin in
        assert bytes_read() - before < 8 * sum(map(len, texts.values()))


def test_dates_beyond_nanoseconds(spark, folder):
    far = datetime(9999, 12, 31)
    (Path(folder) / "a.xlsx").write_bytes(workbook_bytes({"S": {1: [far, 1.0]}}))
    cells = decode_workbooks(scan_landing(spark, folder))
    assert {tuple(r)[3:6] for r in cells.collect()} == {(0, far, None), (1, None, 1.0)}


def test_text_in_pieces_and_second_values():
    sheet = (
        '<x:worksheet xmlns:x="m"><x:row r="3"><x:c r="A3" t="str"><x:f>1</x:f><x:v>a &amp; <![CDATA[<b>]]></x:v></x:c>'
        '<x:c r="AB3"><x:v/><x:v>2</x:v></x:c><x:c><x:v>4</x:v><x:v>5</x:v></x:c><x:c r="B3" t="inlineStr"><x:v>no</x:v>'
        "<x:is><x:r><x:t>p</x:t></x:r> <x:rPh><x:t>no</x:t></x:rPh><x:t>q</x:t></x:is></x:c></x:row><x:row/></x:worksheet>"
    )
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as book:
        book.writestr("xl/workbook.xml", '<w xmlns:r="r"><sheet name="S" r:id="1"/></w>')
        book.writestr("xl/_rels/workbook.xml.rels", '<w><Relationship Id="1" Target="s.xml"/></w>')
        book.writestr("xl/s.xml", sheet)
    assert list(read_cells(raw.getvalue())) == [
        ("S", 3, 0, None, None, "a & <b>"), ("S", 3, 28, None, 4.0, None), ("S", 3, 1, None, None, "pq"),
        ("S", 4, 0, None, None, None),
    ]


def test_reading_a_cell_takes_few_calls():
    raw = workbook_bytes({"S": {n: [WHEN, 1.5] for n in range(1, 2001)}})
    calls = []
    sys.setprofile(lambda frame, event, arg: calls.append(event) if event in ("call", "c_call") else None)
    try:
        cells = list(read_cells(raw))
    finally:
        sys.setprofile(None)
    assert len(cells) == 4000
    assert len(calls) < 25 * len(cells)


def test_refresh_workbooks_deals_them_and_writes_cells_once(spark, monkeypatch):
    written, tasks, decode = [], [], landing.decode_isolated

    def noted(frame, label):
        written.append(label)
        return staged(frame, label)

    def dealt(payloads):
        tasks.append(payloads.select(F.spark_partition_id()).distinct().count())
        return decode(payloads)

    monkeypatch.setattr(grids, "staged", noted)
    monkeypatch.setattr(landing, "decode_isolated", dealt)
    catalog.QUERIES["refresh_workbooks"](spark, "/root/testdata/sf0.01")
    assert written == ["decoded", "decoded"]
    assert min(tasks) > 1
