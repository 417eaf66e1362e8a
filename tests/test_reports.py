import io
import zipfile

import pytest
from helpers import ABSENT, FIVE_ABSENT_COLUMNS, MOTOR_CAR, mapping_frame, plan_text, report, save

from regflow.catalog.adapter import workbook_bytes
from regflow.operators import conform
from regflow.plans import monthly
from regflow.schema import GRAINS, MEASURES, OEM, RTO, STATE
from regflow.sources import dimensions, reports
from regflow.sources.tree import list_reports
from regflow.sources.workbook import is_workbook, table_rows

SHEET = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"


def zip_of(**parts):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        for name, body in parts.items():
            archive.writestr(name.replace("__", "/"), body)
    return buffer.getvalue()


def test_validity_rules():
    assert is_workbook(workbook_bytes([["x"]]))
    assert not is_workbook(b"")
    assert not is_workbook(None)
    assert not is_workbook(b"not a zip")
    assert not is_workbook(workbook_bytes([["x"]], whole=False))


def test_cells_of_every_kind():
    sheet = (
        f'<worksheet xmlns="{SHEET}"><sheetData>'
        '<row r="1"><c r="B1" t="s"><v>0</v></c><c r="D1" t="s"><v>0</v></c></row>'
        '<row r="2"><c r="A2"><v>5</v></c><c r="B2" t="s"><v>1</v></c><c r="C2"><v>5.0</v></c>'
        '<c r="D2" t="b"><v>1</v></c><c r="AB2" t="str"><v>f</v></c></row>'
        '<row r="4"><c r="A4"><v>2.5</v></c><c r="B4" t="e"><v>#N/A</v></c>'
        '<c r="C4" t="inlineStr"><is><t>NA</t></is></c></row>'
        '<row r="9"/></sheetData></worksheet>'
    )
    strings = (
        f'<sst xmlns="{SHEET}"><si><t>H</t></si>'
        "<si><r><t>1,</t></r><r><t>234</t></r><rPh><t>no</t></rPh></si></sst>"
    )
    book = (
        f'<workbook xmlns="{SHEET}" xmlns:r="http://schemas.openxmlformats.org/officeDocument/'
        '2006/relationships"><sheets><sheet name="S" r:id="r9"/></sheets></workbook>'
    )
    links = '<R><x Id="r9" Target="/xl/worksheets/s.xml"/></R>'
    content = zip_of(**{
        "xl__workbook.xml": book,
        "xl___rels/workbook.xml.rels": links,
        "xl__worksheets/s.xml": sheet,
        "xl__sharedStrings.xml": strings,
    })
    _, rows = table_rows(content, "S", 0, False)
    first, blank, last = rows
    # Blank headers are named by position and a repeated one gets a suffix.
    assert first["Unnamed: 0"] == "5" and first["H"] == "1,234"
    assert first["Unnamed: 2"] == "5" and first["H.1"] == "True" and first["Unnamed: 27"] == "f"
    # A blank row between rows counts, one behind the last value does not.
    assert set(blank.values()) == {None}
    assert last["Unnamed: 0"] == "2.5" and last["H"] is None and last["Unnamed: 2"] is None
    with pytest.raises(ValueError):
        table_rows(content, "Other", 0, False)


TREES = {
    "state": "Test State/2026/JUN",
    "rto": "Test State/TestRto_TS01/2026/JUN",
    "oem": "Test State/MOTOR CAR/2026/JUN",
}


@pytest.mark.parametrize("grain", GRAINS.values(), ids=lambda g: g.name)
def test_preprocess_tree(spark, tmp_path, grain):
    label = "Test Maker" if grain is OEM else "MOTOR CAR"
    save(tmp_path, TREES[grain.name], report([label]))
    save(tmp_path, TREES[grain.name].replace("JUN", "MAY"), report([label]))
    mapping = mapping_frame(spark, [MOTOR_CAR])
    frame = monthly.preprocess_tree(spark, str(tmp_path), mapping, grain, "JUN", "2026")
    assert frame.columns == grain.columns
    [row] = frame.collect()
    assert (row.year, row.month, row.day, row.date) == ("2026", 6, 1, "01/06/2026")
    assert (row.vehicle_type, row.vehicle_category, row.vehicle_use_type) == MOTOR_CAR[1:]
    assert row.state == "Test State" and row.total == "1,032"
    assert {m for m in MEASURES if row[m] is None} == FIVE_ABSENT_COLUMNS
    if grain is RTO:
        assert (row.rto_name, row.rto_code) == ("TestRto", "TS01")
    if grain is OEM:
        assert (row.vehicle_class, row.maker) == ("MOTOR CAR", "Test Maker")


def test_total_on_another_position_is_not_guessed(spark, tmp_path):
    save(tmp_path, TREES["state"], report(["MOTOR CAR"], gap=False))
    rows = reports.read_listed(list_reports(spark, str(tmp_path), STATE), str(tmp_path))
    [row] = monthly.preprocess_rows(rows, mapping_frame(spark, [MOTOR_CAR]), STATE).collect()
    assert row.total is None
    assert [r.header for r in conform.unexpected_columns(rows, STATE).collect()] == ["Unnamed: 33"]


def test_states_months_and_absent_trees(spark, tmp_path):
    for folders in ("Telangana/Hyderabad_TG01", "Andhra Pradesh/Adoni_AP01", "A{b},c/X_1"):
        save(tmp_path, f"{folders}/2026/JUN", report(["MOTOR CAR"]))
    root = str(tmp_path)

    def found(**wanted):
        frame = reports.discover(spark, root, RTO, **wanted).select("State", "rto_name", "rto_code")
        return sorted(map(tuple, frame.collect()))

    assert len(found(month="JUN", year="2026")) == 3
    assert found(states=["Telangana"]) == [("Telangana", "Hyderabad", "TG01")]
    assert found(states=["A{b},c", "Telangana"])[0] == ("A{b},c", "X", "1")
    assert found(month="JUL", year="2026") == []
    mapping = mapping_frame(spark, [MOTOR_CAR])
    empty = monthly.preprocess_tree(spark, root, mapping, RTO, "JUL", "2026")
    assert empty.columns == RTO.columns and empty.count() == 0


def test_empty_invalid_and_drifting_reports(spark, tmp_path):
    save(tmp_path, "A/2026/JUN", report(["MOTOR CAR", "BUS"], extra=["NEW FUEL"]))
    save(tmp_path, "B/2026/JUN", report([], extra=["ONLY IN EMPTY"]))
    files = list_reports(spark, str(tmp_path), STATE, ["2026"], ["JUN"])
    rows = reports.read_listed(files, str(tmp_path))
    blanks = {f"Unnamed: {i}" for i in range(33, 38)}
    headers = {r.header for r in conform.unexpected_columns(rows, STATE).collect()}
    assert headers - blanks == {"NEW FUEL"}
    [summary] = conform.preprocess_summary(reports.path_dimensions(rows, STATE), ["Year"]).collect()
    assert tuple(summary) == ("2026", 2, 1, 2)

    save(tmp_path, "C/2026/JUN", b"")
    files = list_reports(spark, str(tmp_path), STATE, ["2026"], ["JUN"])
    valid = reports.check_listed(files, str(tmp_path)).select("valid").collect()
    assert sorted(v.valid for v in valid) == [False, True, True]
    with pytest.raises(Exception, match="Invalid Excel report file"):
        reports.read_listed(files, str(tmp_path)).collect()


def test_drift_of_headers(spark, tmp_path):
    save(tmp_path, "A/2026/JUN", report(["MOTOR CAR", "BUS"], extra=["NEW FUEL"]))
    save(tmp_path, "B/2026/JUN", report(["MOTOR CAR"], gap=False))
    save(tmp_path, "C/2026/JUN", report([], extra=["ONLY IN EMPTY"]))
    root = str(tmp_path)
    rows = reports.path_dimensions(reports.read_listed(list_reports(spark, root, STATE), root), STATE)
    drift = {tuple(r) for r in conform.header_drift(rows, STATE).collect()}
    assert {d for d in drift if d[0] != "absent"} == {("unknown", "NEW FUEL", 1), ("moved total", "Unnamed: 33", 1)}
    assert {d for d in drift if d[0] == "absent"} == {
        *(("absent", h, 2) for h in ABSENT), ("absent", "Unnamed: 38", 1),
    }
    by_state = conform.header_drift(rows, STATE, ["State"]).filter("kind = 'unknown'").collect()
    assert [tuple(r) for r in by_state] == [("A", "unknown", "NEW FUEL", 1)]
    plan = plan_text(conform.header_drift(rows, STATE)).split("== Initial Plan ==")[0]
    # The exchange of the counts, and that which deals the files to tasks.
    assert plan.count("MapInArrow") == 1 and plan.count("Exchange hashpartitioning") == 2


def test_mapping_workbook_and_office_map(spark, tmp_path):
    rows = [["Vehicle Class", "Vehicle Type", "Vehicle Category", "Vehicle Use Type"], list(MOTOR_CAR)]
    path = tmp_path / "mapping.xlsx"
    path.write_bytes(workbook_bytes(rows, sheet="Mapping"))
    assert [tuple(r) for r in dimensions.load_mapping(spark, str(path)).collect()] == [MOTOR_CAR]
    path.write_bytes(workbook_bytes(rows[:1], sheet="Mapping"))
    with pytest.raises(Exception, match="no rows in sheet Mapping"):
        dimensions.load_mapping(spark, str(path)).collect()

    offices = tmp_path / "offices.json"
    offices.write_text('{\n "A": ["x - A1(", "y"],\n "B": []\n}')
    found = dimensions.load_office_map(spark, str(offices)).collect()
    assert sorted(map(tuple, found)) == [("A", "x - A1("), ("A", "y")]
    offices.write_text("{broken")
    assert dimensions.load_office_map(spark, str(offices)).count() == 0
    assert dimensions.load_office_map(spark, str(tmp_path / "none.json")).count() == 0


def test_legacy_history_tree(spark, tmp_path):
    head = [None, None, "DIESEL", "ELECTRIC(BOV)", *[None] * 19, None]
    title = "Vehicle Class Wise Fuel Data  of Andaman & Nicobar Island (JUN,2015)"
    body = ["1", "MOTOR CAR", "7", "3", *[None] * 19, "10"]
    (tmp_path / "one.xlsx").write_bytes(workbook_bytes([[title], [], [], head, body]))
    mapping = mapping_frame(spark, [MOTOR_CAR])
    [row] = monthly.history_state_tree(spark, str(tmp_path), mapping).collect()
    assert (row.state, row.year, row.month, row.date) == (
        "Andaman and Nicobar", "2015", 6, "01/06/2015",
    )
    assert (row.diesel, row.electric_vehicles, row.pure_ev, row.ethanol) == ("7", "3", "0", None)
    # The total sat at position 23 before three EV columns were added.
    assert row.total == "10" and row.vehicle_type == "Passenger"
    (tmp_path / "two.xlsx").write_bytes(b"")
    with pytest.raises(Exception, match="Invalid Excel report file"):
        monthly.history_state_tree(spark, str(tmp_path), mapping).collect()
