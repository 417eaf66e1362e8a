import hashlib

import pytest
from helpers import as_dicts, plan_text, save
from pyspark.sql import functions as F

from regflow.operators import archive, logs
from regflow.schema import RTO, STATE
from regflow.sources.tree import list_reports


def test_object_names_and_copy(spark, tmp_path):
    source, target = tmp_path / "src", tmp_path / "dst"
    bodies = {"reportTable.xlsx": b"x" * (2 * archive.CHUNK + 7), "reportTable (1).xlsx": b"y", "zero.xlsx": b""}
    for name, body in bodies.items():
        save(source, "Goa/A_G1/2026/JUN", body, name)
    files = list_reports(spark, str(source), RTO, pattern="*.xlsx")
    names = {r["object_name"] for r in as_dicts(archive.archive_manifest(files, str(source)))}
    assert names == {f"Goa/A_G1/2026/JUN/{n}" for n in bodies}
    for _ in range(2):  # copying again overwrites
        copies = archive.copy_listed(files, str(source), f"file://{target}")
        assert "content" not in plan_text(copies)
        found = {r.object_name: (r.length, r.sha256) for r in copies.collect()}
        assert found == {
            f"Goa/A_G1/2026/JUN/{n}": (len(b), hashlib.sha256(b).hexdigest()) for n, b in bodies.items()
        }
    assert {p.name: p.read_bytes() for p in target.rglob("*.xlsx")} == bodies


def test_copy_that_differs_fails(spark, tmp_path):
    save(tmp_path / "src", "Goa/2026/JUN", b"x")
    files = list_reports(spark, str(tmp_path / "src"), STATE)
    # Writing to this device loses everything.
    (tmp_path / "dst" / "Goa" / "2026" / "JUN").mkdir(parents=True)
    (tmp_path / "dst" / "Goa" / "2026" / "JUN" / "reportTable.xlsx").symlink_to("/dev/null")
    with pytest.raises(Exception, match="differs"):
        archive.copy_listed(files, str(tmp_path / "src"), str(tmp_path / "dst")).collect()


def test_object_names_of_other_paths(spark):
    slashed = spark.createDataFrame([("C:\\root\\Goa\\f.xlsx",)], "path string")
    assert slashed.select(archive.object_name(F.col("path"), "C:/root")).first()[0] == "Goa/f.xlsx"


def test_history_and_csv_pick(spark):
    paths = [f"r/Goa/A_G1/{y}/{m}/reportTable.xlsx" for y in (2012, 2013, 2024, 2025) for m in ("JAN", "Q1")]
    files = spark.createDataFrame([(p,) for p in paths], "path string")
    kept = archive.history_manifest(files, "r", 2013, 2024)
    assert sorted(r.object_name[9:13] for r in kept.collect()) == ["2013", "2024"]
    listed = spark.createDataFrame(
        [("d", "p_JUN_2.csv"), ("d", "p_JUN_1.csv"), ("d", "p_JUN_0.txt"), ("e", "q.csv")], "folder string, name string"
    )
    picked = archive.pick_csv(listed, F.lit("p_JUN"), "folder")
    assert dict(map(tuple, picked.collect())) == {"d": "p_JUN_1.csv", "e": None}


def excerpt(spark, lines, **options):
    frame = spark.createDataFrame([("log", i, line) for i, line in enumerate(lines)], "log string, n int, line string")
    rows = logs.flagged_tail(frame, ["log"], ["n"], **options).collect()
    return rows[0].excerpt if rows else None


def reference_excerpt(lines, max_lines=8, max_chars=1500):
    kept = [line.rstrip() for line in lines if line.strip()]
    marked = [line for line in kept if any(m in line for m in logs.LOG_MARKERS)]
    joined = "\n".join((marked or kept)[-max_lines:]).strip()
    return joined if len(joined) <= max_chars else "...\n" + joined[-max_chars:].lstrip()


def test_log_excerpt(spark):
    lines = [
        "INFO - start", "INFO - next", "ERROR - element lookup failed",
        "Traceback (most recent call last):", "ValueError: File is not a zip file",
    ]
    assert excerpt(spark, lines) == "\n".join(lines[2:])
    plain = ["  a  ", "", " ", *[f"line {i} " for i in range(20)]]
    assert excerpt(spark, plain) == reference_excerpt(plain)
    many = [f"ERROR {i}" for i in range(30)] + ["ok"]
    assert excerpt(spark, many) == reference_excerpt(many)
    long = ["ERROR " + "x " * 400 for _ in range(5)]
    assert excerpt(spark, long) == reference_excerpt(long)
    assert excerpt(spark, ["  ", ""]) is None
