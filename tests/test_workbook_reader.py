import io
import zipfile
from datetime import datetime

import pytest
from helpers import MOTOR_CAR, mapping_frame, plan_text, report

from regflow.catalog import adapter
from regflow.catalog.adapter import workbook_bytes
from regflow.catalog.queries import QUERIES
from regflow.operators import conform
from regflow.plans import monthly
from regflow.schema import RTO
from regflow.sources import reports, workbook

SHEET = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
BOOK = {
    "[Content_Types].xml": "<Types/>",
    "xl/workbook.xml": f'<workbook xmlns="{SHEET}" xmlns:r="http://schemas.openxmlformats.org/officeDocument/'
    '2006/relationships"><sheets><sheet name="S" r:id="r1"/></sheets></workbook>',
    "xl/_rels/workbook.xml.rels": '<R><x Id="r1" Target="worksheets/s.xml"/></R>',
    "xl/sharedStrings.xml": f'<sst xmlns="{SHEET}"><si><t>H</t></si><si><t>A &amp; B</t></si></sst>',
}


def book(rows, start=f'<worksheet xmlns="{SHEET}">', end="</worksheet>", **options):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", **options) as archive:
        for name, body in BOOK.items():
            archive.writestr(name, body)
        archive.writestr("xl/worksheets/s.xml", f"{start}<sheetData>{rows}</sheetData>{end}")
    return buffer.getvalue()


def inline(text):
    return f'<c r="B2" t="inlineStr"><is><t xml:space="preserve">{text}</t></is></c>'


HEAD = '<row r="1" spans="1:3"><c r="A1" s="2" t="s"><v>0</v></c><c r="C1" t="inlineStr"><is><t>I</t></is></c></row>'
PLAIN = [
    inline("5,001"),
    inline("A &amp;lt; &quot;B&quot; &gt; é\U0001f600"),
    inline(""),
    inline("NA"),
    inline(" two\n\tlines "),
    '<c r="A2" t="s"><v>1</v></c><c r="B2"><v>5.0</v></c><c r="C2" s="3"/><c r="E2" t="b"><v>1</v></c>',
    '<c r="A2" t="e"><v>#N/A</v></c><c r="B2" t="str"><v>f &amp; g</v></c><c r="C2" t="n"><v></v></c>',
    '<c r="B2"><v>1e3</v></c><c r="B2"><v>2.5</v></c><c r="AB2"><v>-7</v></c>',
    "",
]
OTHER = [
    inline("a &#38; b"),
    inline("a > b"),
    inline("<![CDATA[a < b]]>"),
    inline("a\r\nb"),
    "<!-- nothing -->" + inline("a"),
    '<c r="A2"><f>1+1</f><v>2</v></c>',
    '<c t="inlineStr"><is><r><t>1,</t></r><r><t>234</t></r></is></c>',
    '<c r="A2" t="inlineStr"><v>2</v></c>',
    ' <c  r="B2"><v>3</v></c> ',
    '<c r="AAB2"><v>3</v></c>',
    '</row><row r="3" hidden="1">' + inline("a"),
    '</row><row>' + inline("a"),
    '</row><row r="7"/><row r="8">' + inline("a"),
]


def rows_of(content):
    return list(workbook.sheet_rows(workbook.Parts(content)))


@pytest.mark.parametrize("cells", PLAIN + OTHER)
def test_plain_sheets_need_no_elements_and_read_the_same(cells, monkeypatch):
    content = book(f'{HEAD}<row r="2">{cells}</row>')
    found = rows_of(content)
    table = workbook.table_rows(content, "S", 0, False)
    assert (workbook._plain_rows(workbook.Parts(content).read("xl/worksheets/s.xml"), ["H", "A & B"]) is not None) == (
        cells in PLAIN
    )
    monkeypatch.setattr(workbook, "_plain_rows", lambda *_: None)
    assert rows_of(content) == found
    assert workbook.table_rows(content, "S", 0, False) == table


@pytest.mark.parametrize(
    "start, end",
    [
        (f'<?xml version="1.0" encoding="utf-8" standalone="yes"?>\n<worksheet xmlns="{SHEET}"><cols/>', "<x/></worksheet>"),
        (f'\ufeff<worksheet xmlns="{SHEET}">', "</worksheet>"),
        (f'<worksheet xmlns="{SHEET}"><!-- <sheetData> -->', "</worksheet>"),
        ('<worksheet xmlns="other">', "</worksheet>"),
        (f'<a><worksheet xmlns="{SHEET}">', "</worksheet></a>"),
    ],
)
def test_what_surrounds_the_rows(start, end, monkeypatch):
    content = book(f'{HEAD}<row r="2">{inline("a")}</row>', start, end)
    found = rows_of(content)
    monkeypatch.setattr(workbook, "_plain_rows", lambda *_: None)
    assert rows_of(content) == found


@pytest.mark.parametrize("rows, end", [(inline("\x01"), "</worksheet>"), (inline("a & b"), "</worksheet>"), ("", "</sheet>")])
def test_sheets_that_are_no_xml_still_fail(rows, end):
    with pytest.raises(Exception, match="not well-formed|mismatched tag"):
        rows_of(book(f'{HEAD}<row r="2">{rows}</row>', end=end))


def streamed():
    class Pipe(io.RawIOBase):
        held = b""

        def writable(self):
            return True

        def write(self, more):
            self.held += bytes(more)
            return len(more)

    pipe = Pipe()
    with zipfile.ZipFile(pipe, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, body in BOOK.items():
            archive.writestr(name, body)
    return pipe.held


def test_parts_are_those_that_zipfile_reads(monkeypatch):
    plain = [book(HEAD), book(HEAD, compression=zipfile.ZIP_DEFLATED), streamed(), workbook_bytes([["x"]])]
    noted = io.BytesIO(book(HEAD))
    with zipfile.ZipFile(noted, "a") as archive:
        archive.comment = b"note"
    lzma = book(HEAD, compression=zipfile.ZIP_LZMA)
    for content in [*plain, noted.getvalue(), b"before" + plain[0], lzma]:
        assert (workbook._plain_directory(content) is not None) == (content in plain)
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            expected = {name: archive.read(name) for name in archive.namelist()}
        parts = workbook.Parts(content)
        assert {name: parts.read(name) for name in parts.sizes} == expected
        assert workbook.is_workbook(content)
    monkeypatch.setattr(workbook.zipfile, "ZipFile", None)
    assert all(map(workbook.is_workbook, plain))


def test_damaged_parts_still_fail():
    whole = book(HEAD)
    for at in (whole.index(b"<sheetData>") + 3, whole.index(b"PK\x03\x04", 9)):
        content = whole[:at] + b"?" + whole[at + 1 :]
        with pytest.raises(zipfile.BadZipFile):
            for name in BOOK | {"xl/worksheets/s.xml": ""}:
                workbook.Parts(content).read(name)
    for cut in range(0, len(whole), 7):
        assert not workbook.is_workbook(whole[:cut])


def test_without_empty_cells_the_wide_rows_are_the_same(spark):
    files = [
        ("reports/rto/Goa/Margao_GA02/2026/JUN/reportTable.xlsx", workbook_bytes(report(["MOTOR CAR", "BUS"]))),
        ("reports/rto/Goa/Panaji_GA01/2026/JUN/reportTable.xlsx", workbook_bytes(report(["MOTOR CAR"], gap=False))),
        ("reports/rto/Goa/Empty_GA03/2026/JUN/reportTable.xlsx", workbook_bytes(report([]))),
        # A repeated header that meets a real one of its new name; the last counts, though it is empty.
        ("reports/rto/Goa/Twice_GA04/2026/JUN/reportTable.xlsx", workbook_bytes(
            [["Report"], [], [], [None, None, "DIESEL", "DIESEL", "DIESEL.1", "CNG ONLY"], ["1", "BUS", "1", "2", None, "3"]]
        )),
    ]
    frame = spark.createDataFrame(files, "path string, content binary")
    every = reports.read_workbooks(frame).collect()
    filled = reports.read_workbooks(frame, empty_cells=False).collect()
    assert len(every) == 5 and [r[:3] for r in every] == [r[:3] for r in filled]
    for whole, some in zip(every, filled):
        assert some.cells == (whole.cells and {k: v for k, v in whole.cells.items() if v is not None})
    assert every[-1].cells["DIESEL.1"] is None and len(every[0].cells) == 38
    mapping = mapping_frame(spark, [MOTOR_CAR])
    wide = [
        monthly.preprocess_rows(reports.read_workbooks(frame, empty_cells=e), mapping, RTO).collect() for e in (True, False)
    ]
    assert wide[0] == wide[1] and len(wide[0]) == 4


def tables(spark, root, lines):
    day = datetime(1999, 12, 5)
    data = {
        "nation": [(0, "N0", 0), (1, "N1", 4)],
        "supplier": [(1, "S#1", 0, 5.0), (2, "S#2", 1, -5.0), (3, "S#2", 1, -6.0)],
        "part": [(1, "B", "LARGE & CO <X>"), (2, "B", "PROMO"), (3, "B", None), (4, "B", "SMALL")],
        "lineitem": [(i, part, supplier, 1, price, "A", "F", day) for i, (part, supplier, price) in enumerate(lines)],
    }
    for name, rows in data.items():
        schema = adapter.TABLES[name].replace("timestamp_ntz", "timestamp")
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")
    return str(root)


def test_reports_are_built_whole_across_batches(spark, tmp_path):
    lines = [(p, s, 1000.0 * p + s) for p in (1, 2, 3, 4) for s in (1, 2, 3)] + [(1, 1, 99999.5)]
    sf = tables(spark, tmp_path, lines)
    expected = sorted(map(str, adapter.raw_reports(spark, sf, RTO).collect()))
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "1")
    try:
        files = adapter.workbooks(spark, sf, damaged=False).collect()
        read = QUERIES["read_workbooks"](spark, sf)
        assert sorted(map(str, read.select("path", *(f"`{h}`" for h in adapter.RAW_HEADERS)).collect())) == expected
        # Two offices without a code have one folder, so that their reports are one.
        assert len(files) == len({f.path for f in files}) == 2
        numbers = sorted((r.path, r.row_no) for r in read.collect())
        assert numbers == sorted((f.path, n) for f in files for n in range(4 if "_R1" in f.path else 8))
        valid = {r.path: r.valid for r in QUERIES["valid_workbooks"](spark, sf).collect()}
        assert valid == {f.path: "_R1" in f.path for f in files}
    finally:
        spark.conf.set(key, before)
    plan = plan_text(read)
    assert "ObjectHashAggregate" not in plan and "ArrowEvalPython" not in plan


def test_rows_of_a_report_are_in_order(spark, tmp_path):
    sf = tables(spark, tmp_path, [(p, 1, 1000.0 * p) for p in (4, 2, 3, 1)])
    rows = conform.skip_empty_reports(reports.read_workbooks(adapter.workbooks(spark, sf, damaged=False)))
    labels = [r.cells["Unnamed: 1"] for r in sorted(rows.collect(), key=lambda r: r.row_no)]
    assert labels == [None, "CLASS-LARGE & CO <X>(LMV)", "CLASS-PROMO(LMV)", "CLASS-SMALL(LMV)"]
