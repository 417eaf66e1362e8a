"""Listing of report trees, and CSV read in ranges."""

import csv
import tracemalloc

import numpy as np
import pytest
from helpers import plan_text, save
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from regflow.schema import OEM, RTO, STATE
from regflow.sources import csv_split, staging, tree
from regflow.sources.store import Store, open_store


@pytest.fixture
def root(tmp_path):
    for place in ("Goa/Panaji_GA1", "Goa/Mapusa_GA3", "A{b},c d/X=1"):
        for year in ("2025", "2026"):
            for month in ("MAY", "JUN"):
                save(tmp_path, f"{place}/{year}/{month}", b"x" if month == "JUN" else b"")
                save(tmp_path, f"{place}/{year}/{month}", b"yy", "reportTable (1).xlsx")
    save(tmp_path, "Goa/Panaji_GA1/notes", b"z", "reportTable.xlsx")
    save(tmp_path, "_work/Panaji_GA1/2026/JUN", b"z")
    return str(tmp_path)


def paths(frame):
    return sorted(r.path for r in frame.collect())


def test_all_files_with_their_folders(spark, root):
    found = tree.list_reports(spark, root, RTO)
    rows = found.collect()
    assert len(rows) == 12 and {r.length for r in rows} == {0, 1}
    assert {(r.State, r.folder) for r in rows} == {("Goa", "Panaji_GA1"), ("Goa", "Mapusa_GA3"), ("A{b},c d", "X=1")}
    assert all(r.path == f"{root}/{r.State}/{r.folder}/{r.Year}/{r.Month}/reportTable.xlsx" for r in rows)
    assert tree.list_reports(spark, root, RTO, pattern="*.xlsx").count() == 24
    assert tree.list_reports(spark, f"{root}/none", RTO).count() == 0
    assert tree.list_reports(spark, f"{root}/Goa", STATE).count() == 8


def test_filters_decide_what_is_listed(spark, root):
    some = tree.list_reports(spark, root, RTO, ["2026"], ["JUN", "JUL"], ["Goa", "Kerala"])
    assert paths(some) == [f"{root}/Goa/{o}/2026/JUN/reportTable.xlsx" for o in ("Mapusa_GA3", "Panaji_GA1")]
    whole = tree.list_reports(spark, root, RTO)
    again = whole.filter("State = 'Goa' and Year in ('2026') and Month in ('JUN', 'JUL')")
    assert paths(again) == paths(some)
    # All three are the source's own work: what is left to Spark tests no value.
    assert "Goa" not in plan_text(again).replace("report_tree", "")
    assert whole.filter("State = 'Goa' and State = 'Kerala'").count() == 0
    assert whole.filter("State is null").count() == 0
    assert whole.filter("length > 0 and State = 'Goa'").count() == 4
    reader = tree.TreeReader({"path": root, "inner": "true"})
    reader.names = {"State": {"Goa"}, "Year": {"2026"}, "Month": {"JUN", "MAY"}}
    assert sorted(w for part in reader.partitions() for w in part.wanted) == [("Goa", "2026", "JUN"), ("Goa", "2026", "MAY")]


def test_roots_are_spelled_as_given(spark, root):
    for spelling in (root, f"{root}/", f"file://{root}", f"file:{root}/"):
        found = tree.list_reports(spark, spelling, OEM, ["2026"], ["JUN"], ["Goa"])
        wanted = f"{spelling.rstrip('/')}/Goa/Panaji_GA1/2026/JUN/reportTable.xlsx"
        assert wanted in paths(found) and Store(spelling).read(wanted) == b"x"
    with pytest.raises(ValueError, match="is not below"):
        Store(root).read("/etc/hostname")
    assert open_store("file:///a%20b")[1] == "/a b"


def test_months_of_a_range(spark, root):
    listed = tree.list_reports(spark, root, RTO, ["2025", "2026"], ["MAY", "JUN"])
    kept = tree.in_months(listed, [("2025", "JUN"), ("2026", "MAY")])
    assert {(r.Year, r.Month) for r in kept.collect()} == {("2025", "JUN"), ("2026", "MAY")}


# CSV


def whole(spark, path):
    """Spark's reader, which takes each file as one piece."""
    return spark.read.options(header=True, quote='"', escape='"', multiLine=True, inferSchema=False).csv(path)


def rows_of(frame):
    return sorted(map(str, (tuple(r) for r in frame.collect())))


def csv_text(rows, end="\n", last=True):
    def cell(value):
        quoted = '"' + value.replace('"', '""') + '"'
        return quoted if any(c in value for c in '",\r\n') or value != value.strip() else value

    text = end.join(",".join(cell(v) for v in row) for row in rows)
    return text + end if last else text


ROWS = [
    ["a", "b c", "d"], ["1", "two\nlines", "x"], ["", "", "\n\n\n"], ['"', 'say ""hi""', ","], ["é東", "end\r\nof", "\n"],
    ["plain", "plain", "plain"], ['\n"\n', "", "z" * 300], ["t", "u\n" * 40, "w"],
]


@pytest.mark.parametrize("end, last", [("\n", True), ("\n", False), ("\r\n", True)])
def test_any_range_gives_the_rows_of_the_whole_file(spark, tmp_path, end, last):
    (tmp_path / "t.csv").write_bytes(csv_text(ROWS, end, last).encode())
    # Spark's reader turns breaks inside quotes to those it knows if lines end in two characters.
    wanted = rows_of(whole(spark, str(tmp_path / "t.csv"))) if end == "\n" else [
        str(tuple(v or None for v in row)) for row in ROWS[1:]
    ]
    wanted.sort()
    assert len(wanted) == len(ROWS) - 1
    for size in (1, 2, 3, 7, 16, 50, 200, 10_000):
        got = staging.read_csv_stage(spark, str(tmp_path / "t.csv"), split=size)
        assert got.columns == ROWS[0] and rows_of(got) == wanted


def test_ragged_and_blank_lines_as_spark_has_them(spark, tmp_path):
    text = 'a,b\n\n1\n2,3,4\n,\n"",""\n\n5,"6\n\n7"\n'
    (tmp_path / "t.csv").write_text(text)
    wanted = rows_of(whole(spark, str(tmp_path / "t.csv")))
    for size in (1, 5, 1000):
        assert rows_of(staging.read_csv_stage(spark, str(tmp_path / "t.csv"), split=size)) == wanted


def test_many_files_folders_and_given_columns(spark, tmp_path):
    frame = spark.range(500).select(
        F.concat(F.lit("m "), F.col("id") % 3).alias("file"),
        F.concat(F.lit('q"\n'), F.col("id")).alias("text"), F.col("id").cast("string").alias("n"),
    )
    goal = str(tmp_path / "many")
    frame.repartition(4).write.options(**staging.CSV_WRITE).partitionBy("file").csv(goal)
    wanted = rows_of(frame.select("text", "n", "file"))
    for size in (40, 1000, staging.RANGE):
        assert rows_of(staging.read_csv_stage(spark, goal, split=size)) == wanted
    named = staging.read_csv_stage(spark, goal, columns=["x", "y"], split=100)
    assert named.columns == ["x", "y", "file"] and {t for _, t in named.dtypes} == {"string"}
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "a.csv").write_text("")
    assert staging.read_csv_stage(spark, str(tmp_path / "empty"), columns=["x"]).collect() == []
    with pytest.raises(FileNotFoundError, match="no CSV at"):
        staging.read_csv_stage(spark, str(tmp_path / "no*.csv"))


class _Bytes:
    def __init__(self, data):
        self.data, self.at = data, 0

    def seek(self, at):
        self.at = at

    def read(self, size):
        return self.data[self.at : self.at + size]


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.lists(st.text(alphabet='a",\n', max_size=9), min_size=2, max_size=2), min_size=1, max_size=9),
    st.integers(1, 40),
    st.booleans(),
)
def test_ranges_cut_at_true_records(rows, size, last):
    quoted = [["x" + v for v in row] for row in rows]
    data = csv_text(quoted, last=last).encode()
    found, odd = [], 0
    for offset in range(0, len(data), size):
        held, ends = csv_split._records(_Bytes(data), offset, size, odd & 1)
        odd += data[offset : offset + size].count(b'"')
        found += [held[a:b].decode() for a, b in zip(np.r_[0, ends], ends, strict=False)]
    assert "".join(found) == data.decode()
    assert [row for text in found for row in csv.reader([text])] == quoted or [
        next(csv.reader(text.splitlines(keepends=True))) for text in found
    ] == quoted


def test_memory_of_a_range_is_that_of_its_bytes():
    """What a task holds besides the bytes of its range does not grow with them."""
    line = b'"a ""b""\nc",d\n'
    data = np.frombuffer(line * ((8 << 20) // len(line)), np.uint8)
    tracemalloc.start()
    breaks, inside = csv_split._outer_breaks(data, 0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert inside == 0 and (breaks == np.arange(len(line) - 1, len(data), len(line))).all()
    assert peak < 3 * breaks.nbytes + 16 * csv_split.BLOCK


def test_batch_that_would_begin_in_the_last_record(spark, tmp_path):
    texts = ["x" * ((4 << 20) - 20), "y" * 100]
    (tmp_path / "t.csv").write_text("a,b\n" + "".join(f"{i},{t}\n" for i, t in enumerate(texts)))
    rows = staging.read_csv_stage(spark, str(tmp_path / "t.csv")).collect()
    assert sorted((r.a, r.b) for r in rows) == [(str(i), t) for i, t in enumerate(texts)]
