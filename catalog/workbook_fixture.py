"""Small ``.xlsx`` files made from rows, to have workbooks to decode (stdlib only)."""

from __future__ import annotations

import io
import zipfile
from datetime import datetime
from functools import lru_cache
from xml.sax.saxutils import escape

_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE_REL = "http://schemas.openxmlformats.org/package/2006/relationships"
_DAY_ZERO = datetime(1899, 12, 30)


def workbook_bytes(sheets: dict[str, dict[int, list]]) -> bytes:
    """``{sheet: {row number: values from column A on}}`` -> file content.

    Text goes to the shared strings, except text starting with "=", written inline.
    """
    strings: dict[str, int] = {}
    parts = {}
    for number, rows in enumerate(sheets.values(), 1):
        lines = [_row_xml(n, rows[n], strings) for n in sorted(rows)]
        parts[f"xl/worksheets/sheet{number}.xml"] = (
            f'<worksheet xmlns="{_MAIN}"><sheetData>{"".join(lines)}</sheetData></worksheet>'
        )
    names = "".join(
        f'<sheet name="{escape(name)}" sheetId="{n}" r:id="rId{n}"/>'
        for n, name in enumerate(sheets, 1)
    )
    links = "".join(
        f'<Relationship Id="rId{n}" Type="{_REL}/worksheet" Target="worksheets/sheet{n}.xml"/>'
        for n in range(1, len(sheets) + 1)
    )
    texts = "".join(f"<si><t>{escape(text)}</t></si>" for text in strings)
    parts["xl/workbook.xml"] = (
        f'<workbook xmlns="{_MAIN}" xmlns:r="{_REL}"><sheets>{names}</sheets></workbook>'
    )
    parts["xl/_rels/workbook.xml.rels"] = (
        f'<Relationships xmlns="{_PACKAGE_REL}">{links}</Relationships>'
    )
    parts["xl/sharedStrings.xml"] = f'<sst xmlns="{_MAIN}">{texts}</sst>'
    parts["xl/styles.xml"] = (
        f'<styleSheet xmlns="{_MAIN}"><numFmts><numFmt numFmtId="164" '
        'formatCode="yyyy\\-mm\\-dd hh:mm:ss"/></numFmts><cellXfs><xf numFmtId="0"/>'
        '<xf numFmtId="164"/><xf numFmtId="4"/></cellXfs></styleSheet>'
    )
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as book:
        for name, body in parts.items():
            book.writestr(name, '<?xml version="1.0" encoding="UTF-8"?>' + body)
    return buffer.getvalue()


def _row_xml(number: int, values: list, strings: dict[str, int]) -> str:
    cells = []
    for column, value in enumerate(values):
        if value is None:
            continue
        place = f'r="{_letters(column)}{number}"'
        if type(value) is float:
            cells.append(f'<c {place} s="2"><v>{value!r}</v></c>')
        elif isinstance(value, datetime):
            serial = (value - _DAY_ZERO).total_seconds() / 86400
            cells.append(f'<c {place} s="1"><v>{serial!r}</v></c>')
        elif isinstance(value, bool):
            cells.append(f'<c {place} t="b"><v>{int(value)}</v></c>')
        elif isinstance(value, str) and value.startswith("="):
            cells.append(f'<c {place} t="inlineStr"><is><t>{escape(value)}</t></is></c>')
        elif isinstance(value, str):
            index = strings.setdefault(value, len(strings))
            cells.append(f'<c {place} t="s"><v>{index}</v></c>')
        else:
            cells.append(f'<c {place} s="2"><v>{float(value)!r}</v></c>')
    return f'<row r="{number}">{"".join(cells)}</row>'


@lru_cache(maxsize=16384)
def _letters(column: int) -> str:
    text = ""
    column += 1
    while column:
        column, rest = divmod(column - 1, 26)
        text = chr(65 + rest) + text
    return text
