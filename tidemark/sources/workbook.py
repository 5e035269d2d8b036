"""Cells of one ``.xlsx`` / ``.xlsm`` file (a zip of XML parts), standard library only."""

from __future__ import annotations

import io
import re
import struct
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from functools import lru_cache
from xml.etree.ElementTree import XMLParser, iterparse

# Fixed values of the file format: built-in number formats that mean a date or time, and for
# either calendar from which day on serial numbers count from which date.  (The older calendar
# has a 29 February 1900, day 60, that never was, so its first days count from a day later.)
_DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
_FROM_1900 = ((60, datetime(1899, 12, 30)), (1, datetime(1899, 12, 31)))
_FROM_1904 = ((1, datetime(1904, 1, 1)),)
_DAY = 86_400_000  # milliseconds
_MILLISECOND = timedelta(milliseconds=1)
# Fixed values of the format: parts that cells refer to, and where a local header of a zip file
# has the lengths of the name and of the extra field that follow it.
STRINGS, STYLES = "xl/sharedStrings.xml", "xl/styles.xml"
_NAME_LENGTHS = 26
_READ = 1 << 16
# Pieces of a format code: quoted text, a character after an escape, a bracket, or a character.
_PIECE = re.compile(r'"[^"]*"|[\\_*].|\[[^\]]*\]|.', re.DOTALL)
_ELAPSED = re.compile(r"\[(h+|m+|s+)\]", re.IGNORECASE)

Cell = tuple[str, int, int, datetime | None, float | None, str | None]


def read_cells(content: bytes) -> Iterator[Cell]:
    """(sheet, row 1-based, col 0-based, ts, num, str) in sheet, row, column order.

    A row without any value yields one empty cell in column 0, which keeps its place.
    """
    with zipfile.ZipFile(io.BytesIO(bytes(content))) as book:
        sheets, calendar = _contents(book)
        parts = set(book.namelist())
        strings = _shared_strings(book.open(STRINGS)) if STRINGS in parts else []
        dates = _date_styles(book.open(STYLES)) if STYLES in parts else set()
        for name, part in sheets:
            for cell in _sheet_cells(book.open(part), strings, dates, calendar):
                yield (name, *cell)


@dataclass
class Wanted:
    """Cells of a sheet: columns from a row on, and rows from a column on."""

    columns: dict[int, int] = field(default_factory=dict)
    rows: dict[int, int] = field(default_factory=dict)

    def add_column(self, column: int, first_row: int) -> None:
        self.columns[column] = min(first_row, self.columns.get(column, first_row))

    def add_row(self, row: int, first_column: int) -> None:
        self.rows[row] = min(first_column, self.rows.get(row, first_column))

    def has(self, row: int, column: int) -> bool:
        if column in self.columns and row >= self.columns[column]:
            return True
        return row in self.rows and column >= self.rows[row]


@dataclass
class Unit:
    """Some worksheets of one workbook, as its archive holds them, with what their cells refer to.

    Every part is the bytes of the archive's member, with whether they are deflated and the
    checksum of what they hold.
    """

    sheets: list[tuple[str, Part]]
    strings: Part | None
    styles: Part | None
    calendar: int  # first year of the day numbers


Part = tuple[bytes, bool, int]


def cut_units(content: bytes, names: set[str] | None = None) -> Iterator[Unit]:
    """The worksheets with one of the ``names`` (all without names), nothing of them unpacked.

    A unit takes the sheets that follow each other until they weigh as much as the shared texts
    that go with it, so all units together are at most twice the file.
    """
    with zipfile.ZipFile(io.BytesIO(bytes(content))) as book:
        sheets, calendar = _contents(book)
        parts = set(book.namelist())
        strings = _packed(book, STRINGS) if STRINGS in parts else None
        styles = _packed(book, STYLES) if STYLES in parts else None
        along = sum(len(part[0]) for part in (strings, styles) if part)
        held: list[tuple[str, Part]] = []
        for name, part in sheets:
            if names is None or name in names:
                held.append((name, _packed(book, part)))
                if sum(len(packed[0]) for _, packed in held) >= along:
                    yield Unit(held, strings, styles, calendar[-1][1].year)
                    held = []
        if held:
            yield Unit(held, strings, styles, calendar[-1][1].year)


def unit_cells(unit: Unit, wanted: dict[str, Wanted] | None = None) -> Iterator[Cell]:
    """The cells of a unit like ``read_cells``; with ``wanted`` those and the sheets' corners.

    Corners are the first cell of the last row and the first one in the last used column, so
    that a sheet's extent stays known.  Shared texts are only read for a cell that has one.
    """
    calendar = _FROM_1904 if unit.calendar == _FROM_1904[-1][1].year else _FROM_1900
    dates = _date_styles(_Member(*unit.styles)) if unit.styles else set()
    strings = _Strings(unit.strings)
    for name, part in unit.sheets:
        only = wanted.get(name, Wanted()) if wanted is not None else None
        for cell in _sheet_cells(_Member(*part), strings, dates, calendar, only):
            yield (name, *cell)


def _contents(book) -> tuple[list[tuple[str, str]], tuple]:
    """(name, part) of the worksheets in their order, and the calendar of day numbers."""
    parts = set(book.namelist())
    targets = {
        rel.get("Id"): rel.get("Target", "")
        for rel in _elements(book.open("xl/_rels/workbook.xml.rels"), "Relationship")
    }
    sheets, calendar = [], _FROM_1900
    for item in _elements(book.open("xl/workbook.xml"), "workbookPr", "sheet"):
        if _tag(item) == "workbookPr":
            if item.get("date1904") in ("1", "true"):
                calendar = _FROM_1904
            continue
        link = next((v for k, v in item.items() if k.endswith("}id")), None)
        target = targets.get(link, "")
        part = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
        if part in parts:
            sheets.append((item.get("name", ""), part))
    return sheets, calendar


def _packed(book, name: str) -> Part:
    """A member's bytes as they lie in the archive, behind its local header."""
    info = book.getinfo(name)
    if info.compress_type not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
        return book.read(name), False, info.CRC
    book.fp.seek(info.header_offset + _NAME_LENGTHS)
    lengths = struct.unpack("<HH", book.fp.read(4))
    book.fp.seek(sum(lengths), io.SEEK_CUR)
    packed = book.fp.read(info.compress_size)
    return packed, info.compress_type == zipfile.ZIP_DEFLATED, info.CRC


class _Member:
    """A packed member as a stream; it fails at its end if it is not what was packed."""

    def __init__(self, packed: bytes, deflated: bool, crc: int):
        self.left = io.BytesIO(packed)
        self.inflate = zlib.decompressobj(-zlib.MAX_WBITS) if deflated else None
        self.crc, self.seen = crc, 0

    def __enter__(self) -> _Member:
        return self

    def __exit__(self, *_) -> None:
        self.left.close()

    def read(self, size: int) -> bytes:
        out = self._next(size)
        self.seen = zlib.crc32(out, self.seen)
        if not out and self.seen != self.crc:
            raise zipfile.BadZipFile("a member does not have its checksum")
        return out

    def _next(self, size: int) -> bytes:
        if self.inflate is None:
            return self.left.read(size)
        while not self.inflate.eof:
            packed = self.inflate.unconsumed_tail or self.left.read(_READ)
            out = self.inflate.decompress(packed, size)
            if out or not packed:
                return out
        return b""


class _Strings:
    """Shared texts, read when the first one is asked for."""

    def __init__(self, part: Part | None):
        self.part, self.texts = part, None

    def __getitem__(self, number: int) -> str:
        if self.texts is None:
            self.texts = _shared_strings(_Member(*self.part)) if self.part else []
        return self.texts[number]


def _tag(element) -> str:
    return element.tag.rsplit("}", 1)[-1]


def _elements(stream, *names):
    """Elements with one of the names; each is let go of, so memory does not grow with them."""
    with stream:
        parents: list = []
        for event, element in iterparse(stream, ("start", "end")):
            if event == "start":
                parents.append(element)
                continue
            parents.pop()
            if _tag(element) in names:
                yield element
                element.clear()
                if parents:
                    parents[-1].remove(element)


def _shared_strings(stream) -> list[str]:
    return [_plain_text(item) for item in _elements(stream, "si")]


def _plain_text(item) -> str:
    # Phonetic runs (rPh) are reading aids, not part of the text.
    return "".join(
        piece.text or ""
        for child in item
        if _tag(child) in ("t", "r")
        for piece in child.iter()
        if _tag(piece) == "t"
    )


def _date_styles(stream) -> set[int]:
    """Positions of the cell styles whose number format shows a date."""
    dates, styles = set(_DATE_FORMATS), set()
    for item in _elements(stream, "numFmt", "cellXfs"):
        if _tag(item) == "numFmt":
            if _shows_date(item.get("formatCode", "")):
                dates.add(int(item.get("numFmtId")))
        else:
            formats = [int(style.get("numFmtId", 0)) for style in item]
            styles = {n for n, number in enumerate(formats) if number in dates}
    return styles


def _shows_date(code: str) -> bool:
    """Whether the format for positive numbers has a part of a date, or an elapsed time."""
    for piece in _PIECE.findall(code):
        if piece == ";":
            return False
        if piece.lower() in ("d", "m", "y", "h", "s") or _ELAPSED.fullmatch(piece):
            return True
    return False


class _OpenRow:
    """Target of an XML parser: the rows of a worksheet that have ended, without a tree of elements.

    ``rows`` has a row's attributes and its cells: the attributes, and the pieces of the first
    value and of the first inline text (None without one).
    """

    def __init__(self):
        self.rows: list[tuple[dict, list]] = []
        self.row, self.cells, self.depth = None, [], 0
        self.pieces = None  # of the text that is being read
        self.inline = self.shown = False

    def start(self, tag: str, attributes: dict) -> None:
        if self.row is None:
            if _local(tag) == "row":
                self.row, self.cells, self.depth = attributes, [], 0
            return
        self.depth = depth = self.depth + 1
        self.pieces = None  # an element's text ends where its first child begins
        if depth == 1:
            self.cells.append([attributes, None, None])
        elif depth == 2:
            cell, name = self.cells[-1], _local(tag)
            self.inline = name == "is" and cell[2] is None
            if self.inline:
                cell[2] = []
            elif name == "v" and cell[1] is None:
                self.pieces = cell[1] = []
        elif self.inline:
            name = _local(tag)
            if depth == 3:
                self.shown = name in ("t", "r")
            if self.shown and name == "t":
                self.pieces = self.cells[-1][2]

    def data(self, text: str) -> None:
        if self.pieces is not None:
            self.pieces.append(text)

    def end(self, tag: str) -> None:
        if self.row is None:
            return
        self.pieces = None
        if self.depth == 0:
            self.rows.append((self.row, self.cells))
            self.row = None
        self.depth -= 1


@lru_cache(maxsize=1024)
def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _rows(stream) -> Iterator[tuple[dict, list]]:
    """The rows of a worksheet, as many at a time as a piece of the stream ends."""
    target = _OpenRow()
    parser = XMLParser(target=target)
    with stream:
        while piece := stream.read(_READ):
            parser.feed(piece)
            yield from target.rows
            target.rows.clear()
    parser.close()


def _sheet_cells(stream, strings, dates, calendar, wanted=None):
    row_number = 0
    last = widest = None  # corners of the sheet: (row, column, cell), and whether it was given
    for row, cells in _rows(stream):
        row_number = int(row.get("r", row_number + 1))
        column, seen = -1, False
        for cell in cells:
            named = _named_column(cell[0].get("r", "").rstrip("0123456789"))
            column = column + 1 if named is None else named
            given = wanted is None or wanted.has(row_number, column)
            if not given and _is_blank(cell):
                continue
            value = _value(cell, strings, dates, calendar) if given else ()
            if value is None:
                continue
            if wanted is not None:
                if not seen and (last is None or row_number >= last[0]):
                    last = (row_number, column, cell, given)
                if widest is None or column > widest[1]:
                    widest = (row_number, column, cell, given)
            seen = True
            if given:
                yield (row_number, column, *value)
        if not seen and wanted is None:
            yield (row_number, 0, None, None, None)
        elif not seen and (last is None or row_number >= last[0]):
            last = (row_number, 0, None, False)
    corners = {corner[:2]: corner for corner in (widest, last) if corner and not corner[3]}
    for row_number, column, cell, _ in corners.values():
        value = (None, None, None) if cell is None else _value(cell, strings, dates, calendar)
        yield (row_number, column, *value)


def _is_blank(cell) -> bool:
    attributes, pieces, inline = cell
    if attributes.get("t") == "inlineStr":
        return inline is None
    return not pieces


def column_number(letters: str) -> int:
    return _column(letters.upper())


@lru_cache(maxsize=32768)
def _named_column(reference: str) -> int | None:
    """The column a cell's reference begins with (its row number may be left out)."""
    letters = re.match("[A-Z]+", reference)
    return _column(letters.group()) if letters else None


def _column(letters: str) -> int:
    number = 0
    for letter in letters:
        number = number * 26 + ord(letter) - 64
    return number - 1


def _value(cell, strings, dates, calendar):
    """(ts, num, str) of a cell, or None when it is blank.  Formulas give their cached result."""
    attributes, pieces, inline = cell
    kind = attributes.get("t", "n")
    if kind == "inlineStr":
        return (None, None, "".join(inline)) if inline is not None else None
    if not pieces:
        return None
    raw = "".join(pieces)
    if kind == "s":
        return None, None, strings[int(raw)]
    if kind in ("str", "e"):
        return None, None, raw
    if kind == "b":
        return None, float(raw), None
    if kind == "d":
        return datetime.fromisoformat(raw).replace(tzinfo=None), None, None
    number = float(raw)
    if int(attributes.get("s", 0)) not in dates:
        return None, number, None
    return _moment(number, calendar)


def _moment(serial: float, calendar):
    """A serial number as a date, as the text of a time of day (day 0), or as the number it is."""
    whole = round(serial * _DAY)
    if 0 <= whole < _DAY:
        return None, None, str((datetime.min + timedelta(milliseconds=whole)).time())
    for first_day, origin in calendar:
        if whole >= first_day * _DAY:
            return origin + whole * _MILLISECOND, None, None
    return None, serial, None
