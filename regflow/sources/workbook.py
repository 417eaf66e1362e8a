"""Small helpers that run inside Spark tasks and turn XLSX bytes into rows of text.

Spark has no XLSX source. These functions see one file at a time and use only the
standard library; everything around them (listing, splitting, projection) is Spark's.
"""

from __future__ import annotations

import io
import posixpath
import re
import string
import struct
import zipfile
import zlib
from collections.abc import Iterator
from itertools import product
from xml.etree import ElementTree
from xml.sax.saxutils import unescape

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_ROW, _CELL, _INLINE, _TEXT, _RUN = (f"{_MAIN}{tag}" for tag in ("row", "c", "is", "t", "r"))
_REQUIRED_PARTS = {"[Content_Types].xml", "xl/workbook.xml"}

# Cell texts that count as empty (the default set of the pandas readers).
_EMPTY_TEXT = frozenset(
    [
        "",
        "#N/A",
        "#N/A N/A",
        "#NA",
        "-1.#IND",
        "-1.#QNAN",
        "-NaN",
        "-nan",
        "1.#IND",
        "1.#QNAN",
        "<NA>",
        "N/A",
        "NA",
        "NULL",
        "NaN",
        "None",
        "n/a",
        "nan",
        "null",
    ]
)


# Layouts of a part's own header, its entry in the directory, and the end of an archive.
_LOCAL, _ENTRY, _END = "<4s5H3L2H", "<4s6H3L5H2L", "<4s4H2LH"
_LOCAL_SIZE, _ENTRY_SIZE, _END_SIZE = map(struct.calcsize, (_LOCAL, _ENTRY, _END))
#: Flags of parts that are neither encrypted nor patched: deflate level, sizes behind the part, UTF-8.
_PLAIN_FLAGS = 0x0E | 0x800


def _plain_directory(content: bytes) -> dict[str, tuple[int, ...]] | None:
    """Name -> (method, check sum, packed size, size, begin, end) of the parts of a zip without
    comments, extra fields, encryption, 64-bit sizes or gaps in its directory; None for any other."""
    last = len(content) - _END_SIZE
    if last < 0:
        return None
    mark, disk, first, here, count, size, begin, noted = struct.unpack_from(_END, content, last)
    if mark != b"PK\x05\x06" or disk or first or noted or here != count or begin + size != last:
        return None
    found, at, before = {}, begin, []
    while at + _ENTRY_SIZE <= last:
        mark, _, needed, flags, method, _, _, check, packed, length, named, extra, noted, disk, _, _, offset = (
            struct.unpack_from(_ENTRY, content, at)
        )
        at += _ENTRY_SIZE + named
        name = content[at - named : at]
        plain = mark == b"PK\x01\x02" and method in (0, 8) and needed <= 20 and name.isascii() and 0 not in name
        if not plain or flags & ~_PLAIN_FLAGS or extra or noted or disk or max(packed, length, offset) == 0xFFFFFFFF:
            return None
        before.append(offset)
        found[name.decode()] = (method, check, packed, length, offset)
    if at != last or len(found) != count or before != sorted(set(before)) or count and before[-1] >= begin:
        return None
    return {name: (*held, end) for (name, held), end in zip(found.items(), [*before[1:], begin])}


class Parts:
    """Parts of a zip by name. `zipfile` spends more time on opening a small archive than on reading
    it, so plain ones, as exporters write them, are read here and all others by `zipfile`."""

    def __init__(self, content: bytes):
        self.content = content
        self.plain = _plain_directory(content)
        if self.plain is None:
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                self.sizes = {info.filename: info.file_size for info in archive.infolist()}
        else:
            self.sizes = {name: held[3] for name, held in self.plain.items()}

    def read(self, name: str) -> bytes:
        if self.plain and name in self.plain:
            method, check, packed, size, begin, end = self.plain[name]
            mark, _, _, _, _, _, _, _, _, named, extra = struct.unpack_from(_LOCAL, self.content, begin)
            begin += _LOCAL_SIZE
            same = mark == b"PK\x03\x04" and self.content[begin : begin + named] == name.encode()
            begin += named + extra
            if same and begin + packed <= end:
                body = self.content[begin : begin + packed]
                try:
                    body = zlib.decompressobj(-zlib.MAX_WBITS).decompress(body, size + 1) if method else body
                except zlib.error:
                    body = b""
                if len(body) == size and zlib.crc32(body) == check:
                    return body
        with self.open(name) as stream:
            return stream.read()

    def open(self, name: str):
        return zipfile.ZipFile(io.BytesIO(self.content)).open(name)


def open_workbook(content: bytes | None) -> Parts | None:
    """The parts of a non-empty zip that holds the content types and the workbook part."""
    if not content:
        return None
    try:
        parts = Parts(content)
    except (OSError, zipfile.BadZipFile):
        return None
    return parts if _REQUIRED_PARTS <= parts.sizes.keys() else None


def is_workbook(content: bytes | None) -> bool:
    return open_workbook(content) is not None


def _part(archive: Parts, name: str):
    return ElementTree.fromstring(archive.read(name))


def _sheet_part(archive: Parts, sheet: str | None) -> str:
    """Archive name of the named sheet, or of the first one."""
    sheets = _part(archive, "xl/workbook.xml").iter(f"{_MAIN}sheet")
    for node in sheets:
        if sheet is None or node.get("name") == sheet:
            wanted = node.get(f"{_REL}id")
            break
    else:
        raise ValueError(f"Worksheet named {sheet!r} not found")
    for link in _part(archive, "xl/_rels/workbook.xml.rels"):
        if link.get("Id") == wanted:
            target = link.get("Target")
            return target.lstrip("/") if target.startswith("/") else posixpath.normpath(
                posixpath.join("xl", target)
            )
    raise ValueError(f"Worksheet part {wanted!r} not found")


def _runs(node) -> str:
    """Text of a string item; phonetic runs are left out."""
    if len(node) == 1 and node[0].tag == _TEXT:
        return node[0].text or ""
    pieces = []
    for child in node:
        if child.tag == _TEXT:
            pieces.append(child.text or "")
        elif child.tag == _RUN:
            pieces.extend(t.text or "" for t in child.iter(_TEXT))
    return "".join(pieces)


def _shared_strings(archive: Parts) -> list[str]:
    if "xl/sharedStrings.xml" not in archive.sizes:
        return []
    return [_runs(item) for item in _part(archive, "xl/sharedStrings.xml")]


def _column_index(reference: str) -> int:
    index = 0
    for letter in reference:
        if not "A" <= letter <= "Z":
            break
        index = index * 26 + ord(letter) - 64
    if not index:
        raise ValueError(f"not a cell reference: {reference}")
    return index - 1


def _number_text(text: str) -> str:
    """Whole numbers without a decimal point, as a spreadsheet reader shows them."""
    if re.fullmatch(r"-?\d+", text):
        return text
    value = float(text)
    return str(int(value)) if value.is_integer() else repr(value)


def _cell_text(cell, shared: list[str]) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        inline = next((child for child in cell if child.tag == _INLINE), None)
        return None if inline is None else _runs(inline)
    node = cell.find(f"{_MAIN}v")
    return _value_text(kind, None if node is None else node.text, shared)


def _value_text(kind: str, value: str | None, shared: list[str]) -> str | None:
    if not value or kind == "e":
        return None
    if kind == "s":
        return shared[int(value)]
    if kind == "b":
        return "True" if value == "1" else "False"
    return _number_text(value) if kind == "n" else value


def sheet_rows(
    archive: Parts, sheet: str | None = None
) -> Iterator[tuple[int, dict[int, str]]]:
    """Yield (zero-based sheet row, {zero-based column: text}) for rows that are stored."""
    shared = _shared_strings(archive)
    name = _sheet_part(archive, sheet)
    if archive.sizes[name] > _WHOLE_SHEET:
        with archive.open(name) as stream:
            yield from _element_rows(_streamed(stream), shared)
        return
    xml = archive.read(name)
    plain = _plain_rows(xml, shared)
    yield from _element_rows(ElementTree.fromstring(xml).iter(_ROW), shared) if plain is None else plain


#: Sheets up to this size are held whole; larger ones give their rows one at a time.
_WHOLE_SHEET = 1 << 20


def _streamed(stream) -> Iterator:
    for _, node in ElementTree.iterparse(stream):
        if node.tag == _ROW:
            yield node
            node.clear()


def _element_rows(nodes: Iterator, shared: list[str]) -> Iterator[tuple[int, dict[int, str]]]:
    position = -1
    for node in nodes:
        position = int(node.get("r", position + 2)) - 1
        cells: dict[int, str] = {}
        column = -1
        for cell in node.iter(_CELL):
            reference = cell.get("r")
            column = _column_index(reference) if reference else column + 1
            text = _cell_text(cell, shared)
            if text is not None:
                cells[column] = text
        yield position, cells


# Rows and cells as exporters write them: known attributes in their usual order, and characters of
# which an XML parser changes none.
_CHARS = r"([^<>\x00-\x08\x0B-\x1F\uFFFE\uFFFF]*+)"
_PLAIN_ROW = (
    r'<row r="(\d+)"(?: spans="[\d:]+")?(?: s="\d+")?(?: customFormat="\d")?(?: ht="[\d.]+")?'
    r'(?: customHeight="\d")?>'
)
# What stands between the cells of one row and those of the next: rows without cells may.
_PLAIN_BREAK = re.compile(rf"</row>(?:{_PLAIN_ROW}</row>)*{_PLAIN_ROW}", re.ASCII)
_PLAIN_NUMBERS = re.compile(_PLAIN_ROW, re.ASCII)
_PLAIN_CELL = re.compile(
    r'<c r="([A-Z]{1,2}+)\d++"(?: s="\d++")?+'
    rf'(?: t="inlineStr"><is><t(?: xml:space="preserve")?+>{_CHARS}</t></is></c>'
    rf'|(?: t="([a-z]++)")?+(?:><v>{_CHARS}</v></c>|/>))',
    re.ASCII,
)
_PLAIN_START = re.compile(
    rb'(?:<\?xml version="1\.0"(?: encoding="(?i:UTF-8)")?(?: standalone="(?:yes|no)")?\?>\s*)?<worksheet\b'
)
_REFERENCE = re.compile(r"&(?!(?:amp|lt|gt|quot|apos);)")
_QUOTES = {"&quot;": '"', "&apos;": "'"}
_COLUMNS = {
    "".join(name): index
    for index, name in enumerate(
        [*product(string.ascii_uppercase), *product(string.ascii_uppercase, repeat=2)]
    )
}


def _plain_rows(xml: bytes, shared: list[str]) -> list[tuple[int, dict[int, str]]] | None:
    """Rows of a sheet that holds nothing but plain rows and cells, without an element for each; None
    for any other sheet. What surrounds the rows is left to the XML parser."""
    start, end = xml.find(b"<sheetData>") + len(b"<sheetData>"), xml.rfind(b"</sheetData>")
    if end < start or not _PLAIN_START.match(xml):
        return None
    around = xml[:start] + xml[end:]
    if b"<!" in around:
        return None
    try:
        root = ElementTree.fromstring(around)
        body = xml[start:end].decode()
    except (ElementTree.ParseError, UnicodeDecodeError):
        return None
    if "\uFFFE" in body or "\uFFFF" in body or "&" in body and _REFERENCE.search(body):
        return None
    if root.find(f"{_MAIN}sheetData") is None or next(root.iter(_ROW), None) is not None:
        return None
    # Split at its cells, with a row closed before and one opened behind, the sheet leaves breaks and
    # empty text between the cells of a row.
    parts = _PLAIN_CELL.split(f'</row>{body}<row r="0">')
    breaks = [(end, gap) for end, gap in enumerate(parts[::5]) if gap]
    if not all(_PLAIN_BREAK.fullmatch(gap) for _, gap in breaks):
        return None
    columns, texts, kinds, values = (parts[i::5] for i in range(1, 5))
    if "&" in body:
        texts, values = ([t and unescape(t, _QUOTES) for t in held] for held in (texts, values))
    if None in texts:
        texts = [
            _value_text(kind or "n", value, shared) if text is None else text
            for text, kind, value in zip(texts, kinds, values)
        ]
    rows, position, begin = [], None, 0
    for end, gap in breaks:
        if position is not None:
            cells = zip(map(_COLUMNS.__getitem__, columns[begin:end]), texts[begin:end])
            rows.append((position, {c: t for c, t in cells if t is not None}))
        *empty, following = _PLAIN_NUMBERS.findall(gap)
        rows += [(int(number) - 1, {}) for number in empty]
        position, begin = int(following) - 1, end
    return rows


def _headers(cells: dict[int, str], width: int) -> list[str]:
    """Header names: a blank one is named by its position, a repeated one gets a suffix."""
    names = [cells.get(column) or f"Unnamed: {column}" for column in range(width)]
    if len(set(names)) == width:
        return names
    seen: dict[str, int] = {}
    for column, name in enumerate(names):
        if name in seen:
            seen[name] += 1
            names[column] = f"{name}.{seen[name]}"
        else:
            seen[name] = 0
    return names


def table(
    archive: Parts, sheet: str | None, skip: int, drop_first: bool
) -> tuple[str, list[str], list[dict[int, str]]]:
    """Title (text of the first sheet row), headers and data rows of the table whose header
    follows `skip` sheet rows; a row holds its texts by the place of their header.

    Blank rows between data rows count; blank rows after the last value do not.
    """
    stored = dict(sheet_rows(archive, sheet))
    title = " ".join(stored.get(0, {}).values())
    filled = [row for row, cells in stored.items() if cells and row >= skip]
    if not filled:
        return title, [], []
    width = max(max(stored[row]) for row in filled) + 1
    headers = _headers(stored.get(skip, {}), width)[drop_first:]
    rows = []
    for row in range(skip + 1, max(filled) + 1):
        cells = stored.get(row, {}).items()
        rows.append({c - drop_first: t for c, t in cells if t not in _EMPTY_TEXT and c >= drop_first})
    return title, headers, rows


def named(headers: list[str], cells: dict[int, str]) -> dict[str, str | None]:
    """A row by header; of headers with one name the last counts."""
    return {header: cells.get(place) for place, header in enumerate(headers)}


def table_rows(
    content: bytes, sheet: str | None, skip: int, drop_first: bool
) -> tuple[str, list[dict[str, str | None]]]:
    """Title and data rows by header."""
    title, headers, rows = table(Parts(content), sheet, skip, drop_first)
    return title, [named(headers, cells) for cells in rows]
