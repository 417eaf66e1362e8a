from datetime import date
from pathlib import Path

import pytest
from helpers import MOTOR_CAR, fact_rows, report, save

from pyspark.sql import functions as F

from regflow import jobs, session
from regflow.catalog.adapter import workbook_bytes
from regflow.operators import load, versions
from regflow.plans import tables
from regflow.schema import GRAINS, OEM, RTO
from regflow.sources import dimensions, reports


@pytest.fixture
def paths(spark, tmp_path):
    rows = [["Vehicle Class", "Vehicle Type", "Vehicle Category", "Vehicle Use Type"], list(MOTOR_CAR)]
    (tmp_path / "mapping.xlsx").write_bytes(workbook_bytes(rows, sheet="Mapping"))
    (tmp_path / "offices.json").write_text('{"Goa": ["Panaji - GA1( x )", "Mapusa - GA3( x )"]}')
    spark.createDataFrame([("ga1", "North Goa")], "rto_code string, district string").write.parquet(
        str(tmp_path / "districts")
    )
    names = ("reports", "csv", "fact", "curated", "archive", "districts")
    options = {name: str(tmp_path / name) for name in names}
    options |= {n: str(tmp_path / f"{n}.{e}") for n, e in (("mapping", "xlsx"), ("offices", "json"))}
    return tmp_path, [part for name, path in options.items() for part in (f"--{name}", path)]


def test_month_defaults():
    assert jobs.previous_month(date(2026, 7, 17)) == ("JUN", "2026")
    assert jobs.previous_month(date(2026, 1, 31)) == ("DEC", "2025")
    args = jobs.parser().parse_args(["load", "--grain", "rto", "--month", "jul", "--year", "2025"])
    assert jobs.month_and_year(args) == ("JUL", "2025")


def test_monthly_run_from_files(spark, paths, capsys):
    root, options = paths
    save(root / "reports", "Goa/Panaji_GA1/2026/JUN", report(["MOTOR CAR", "BUS"]))
    month = ["--grain", "rto", "--month", "jun", "--year", "2026", "--as-of", "2026-07-02", *options]
    for _ in range(2):  # a second run replaces, and adds nothing
        jobs.main(["run", *month], spark)
        fact = load.read_fact(spark, str(root / "fact"), RTO)
        curated = tables.read_curated(spark, str(root / "curated"), RTO)
        assert fact.count() == 2 and curated.count() == 2
        assert {(r.district, r.total, str(r.date)) for r in curated.collect()} == {
            ("North Goa", 1032, "2026-06-01")
        }
    assert len(list((root / "archive").rglob("*.xlsx"))) == 1
    assert list((root / "archive").glob("rto_level_ev_data_JUN_2026.csv/*.csv"))
    jobs.main(["curate", "--full-refresh", *month], spark)
    assert tables.read_curated(spark, str(root / "curated"), RTO).count() == 2
    args = jobs.parser().parse_args(["missing", *month])
    gone = [r.path for r in jobs.missing(spark, args, RTO).collect()]
    assert gone == [f"{root}/reports/Goa/Mapusa_GA3/2026/JUN/reportTable.xlsx"]
    capsys.readouterr()


def test_curated_window_keeps_older_months(spark, paths):
    root, options = paths
    month = ["--grain", "oem", "--year", "2026", *options]
    for name, as_of in (("MAR", "2026-04-02"), ("JUN", "2026-07-02")):
        save(root / "reports", f"Goa/MOTOR CAR/2026/{name}", report(["Maker A", "Maker B"]))
        jobs.main(["run", "--month", name, "--as-of", as_of, *month], spark)
    curated = tables.read_curated(spark, str(root / "curated"), OEM)
    assert curated.groupBy("date").count().count() == 2 and curated.count() == 4
    assert load.read_fact(spark, str(root / "fact"), OEM).count() == 4


def month_options(options, grain="rto"):
    return ["--grain", grain, "--month", "jun", "--year", "2026", *options]


def lines_of(folder):
    return sorted(x for f in folder.glob("*.csv") for x in f.read_text().splitlines() if x != "path")


def test_missing_list_is_whole(spark, paths, capsys):
    root, options = paths
    save(root / "reports", "Goa/2026/JUN", report(["MOTOR CAR"]))
    month = month_options(options, "state") + ["--out", str(root / "out")]
    jobs.main(["missing", *month], spark)
    assert "missing reports: 35" in capsys.readouterr().out
    gone = lines_of(root / "out" / "missing")
    assert len(gone) == 35 and not any("/Goa/" in x for x in gone)
    for spelling in (f"{root}/reports/", f"file://{root}/reports", f"file:{root}/reports/"):
        args = jobs.parser().parse_args(["missing", *month, "--reports", spelling])
        assert jobs.missing(spark, args, GRAINS["state"]).count() == 35
    args = jobs.parser().parse_args(["missing", *month, "--states", "Goa"])
    assert jobs.missing(spark, args, GRAINS["state"]).count() == 0
    label = "Andaman & Nicobar Island"
    args = jobs.parser().parse_args(["missing", *month, "--states", label])
    assert jobs.missing(spark, args, GRAINS["state"]).count() == 1


def test_oem_classes_come_from_the_mapping(spark, paths):
    root, options = paths
    save(root / "reports", "Goa/MOTOR CAR/2026/JUN", report(["Maker A"]))
    args = jobs.parser().parse_args(["missing", *month_options(options, "oem")])
    assert jobs.missing(spark, args, OEM).count() == 35
    args.mapping = None
    with pytest.raises(ValueError, match="--classes or --mapping"):
        jobs.missing(spark, args, OEM)


def test_absent_inputs_are_errors(spark, paths):
    root, options = paths
    save(root / "reports", "Goa/Panaji_GA1/2026/JUN", report(["MOTOR CAR"]))
    month = month_options(options)
    with pytest.raises(FileNotFoundError, match="mapping"):
        jobs.main(["preprocess", *month, "--mapping", str(root / "typo.xlsx")], spark)
    args = jobs.parser().parse_args(["missing", *month, "--offices", str(root / "typo.json")])
    with pytest.raises(FileNotFoundError, match="office"):
        jobs.missing(spark, args, RTO)
    (root / "bad.json").write_text("{not json")
    args = jobs.parser().parse_args(["missing", *month, "--offices", str(root / "bad.json")])
    with pytest.raises(Exception, match="office file is not"):
        jobs.missing(spark, args, RTO).collect()
    for extra in (["--month", "JUN"], ["--year", "2026"], ["--month", "JUNE", "--year", "2026"]):
        with pytest.raises(ValueError, match="--month"):
            jobs.month_and_year(jobs.parser().parse_args(["load", "--grain", "rto", *extra]))
    with pytest.raises(ValueError, match="unknown states: Atlantis"):
        jobs.main(["preprocess", *month, "--states", "Atlantis"], spark)


def test_work_folders_are_removed(spark, paths, monkeypatch):
    root, options = paths
    made = []
    plain = session.work_path
    monkeypatch.setattr(load, "work_path", lambda s, label: made.append(plain(s, label)) or made[-1])
    save(root / "reports", "Goa/Panaji_GA1/2026/JUN", report(["MOTOR CAR"]))
    month = month_options(options) + ["--as-of", "2026-07-02"]
    jobs.main(["run", *month], spark)
    jobs.main(["curate", "--full-refresh", *month], spark)
    assert len(made) > 2 and not any(Path(p).exists() for p in made)
    made.clear()
    save(root / "reports", "Goa/Broken_GA9/2026/JUN", b"no workbook")
    with pytest.raises(Exception, match="Invalid Excel report file"):
        jobs.main(["run", *month], spark)
    assert made and not any(Path(p).exists() for p in made)


def test_run_reports_drift(spark, paths):
    root, options = paths
    save(root / "reports", "Goa/Panaji_GA1/2026/JUN", report(["MOTOR CAR", "BUS"], extra=["FLYING"]))
    save(root / "reports", "Goa/Mapusa_GA3/2026/JUN", report([]))
    jobs.main(["run", *month_options(options), "--as-of", "2026-07-02", "--out", str(root / "out")], spark)
    lists = {n: spark.read.option("header", True).csv(str(root / "out" / n)) for n in ("summary", "unexpected_columns")}
    assert [tuple(r) for r in lists["summary"].collect()] == [("Goa", "2026", "2", "1", "2")]
    # The blank headers of the fuels that the report leaves out are reported as well.
    headers = {r.header for r in lists["unexpected_columns"].collect()}
    assert {h for h in headers if not h.startswith("Unnamed: ")} == {"FLYING"}


def test_no_shared_folder_on_a_cluster():
    class Spark:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(RuntimeError, match="checkpoint.dir"):
        session.work_path(Spark, "x")


def test_merge_reads_only_the_touched_periods(spark, tmp_path):
    path = str(tmp_path / "fact")
    months = [(y, m) for y in range(2010, 2015) for m in (1, 6, 12)]
    old = fact_rows(spark, RTO, [{"date": f"01/{m:02d}/{y}", "state": "Goa"} for y, m in months] + [{"state": "x"}])
    load.load_fact(path, old, RTO)
    stage = load.with_period(fact_rows(spark, RTO, [{"date": d} for d in ("01/01/2010", "01/12/2014")]))
    touched = load.touched_partitions(stage, load.PERIOD)
    assert sorted(touched) == ["period=2010-01-01", "period=2014-12-01"]
    current = versions.read(spark, path, load.PERIOD, load.fact_schema(RTO), only=touched)
    # Other partitions are not even listed.
    assert len(current.inputFiles()) == 2 and current.count() == 2
    load.load_fact(path, fact_rows(spark, RTO, [{"date": "01/06/2012", "state": "Goa"}, {"state": None}]), RTO)
    after = load.read_fact(spark, path, RTO)
    assert after.count() == len(months) + 1 + 2
    assert after.filter("period is null").count() == 2


HISTORY = ["--first", "2014-11", "--last", "2015-02"]


def test_history_of_a_tree(spark, paths, capsys):
    root, options = paths
    for year, months in {"2014": ("OCT", "NOV", "DEC"), "2015": ("JAN", "FEB", "MAR")}.items():
        for month in months:
            inside = month not in ("OCT", "MAR")
            body = report(["MOTOR CAR", "BUS"]) if inside else b"broken"
            save(root / "reports", f"Goa/Panaji_GA1/{year}/{month}", body)
    save(root / "reports", "Goa/Panaji_GA1/2014/FEB", b"between the years and not in the range")
    save(root / "reports", "Bihar/Patna_BR1/2014/DEC", b"of a state that is not asked for")
    command = ["history", "--grain", "rto", *options, *HISTORY]
    jobs.main([*command, "--states", "Goa"], spark)
    assert "state months: 4, rows: 8" in capsys.readouterr().out
    fact = load.read_fact(spark, str(root / "fact"), RTO)
    assert fact.groupBy("period").count().count() == 4 and fact.count() == 8
    number = versions.current(spark, str(root / "fact"), load.PERIOD).number
    assert number == 1
    # Finished months are left out; a changed one is loaded again.
    jobs.main([*command, "--states", "Goa"], spark)
    assert "state months: 0, rows: 0" in capsys.readouterr().out
    save(root / "reports", "Goa/Panaji_GA1/2015/FEB", report(["MOTOR CAR", "BUS", "TRAM"]))
    jobs.main([*command, "--states", "Goa"], spark)
    assert "state months: 1, rows: 3" in capsys.readouterr().out
    assert load.read_fact(spark, str(root / "fact"), RTO).count() == 9
    # A month that fails is not noted, nor are others of its run.
    with pytest.raises(Exception, match="Invalid Excel report file"):
        jobs.main(command, spark)
    save(root / "reports", "Bihar/Patna_BR1/2014/DEC", report(["BUS"]))
    jobs.main(command, spark)
    assert "state months: 1, rows: 1" in capsys.readouterr().out
    with pytest.raises(ValueError, match="before it starts"):
        jobs.main([*command, "--last", "2013-01"], spark)
    with pytest.raises(ValueError, match="--first"):
        jobs.main([*command, "--first", "2013-13"], spark)


def test_archive_of_a_range(spark, paths, capsys):
    root, options = paths
    for place in ("2014/NOV", "2015/JAN", "2015/MAR", "2013/NOV"):
        save(root / "reports", f"Goa/Panaji_GA1/{place}", b"any bytes")
    command = ["archive", "--grain", "rto", *options, *HISTORY, "--out", str(root / "out")]
    jobs.main(command, spark)
    assert capsys.readouterr().out.strip() == "2"
    copied = sorted(str(p.relative_to(root / "archive")) for p in (root / "archive").rglob("*.xlsx"))
    assert copied == [f"Goa/Panaji_GA1/{m}/reportTable.xlsx" for m in ("2014/NOV", "2015/JAN")]
    listed = spark.read.option("header", True).csv(str(root / "out" / "archived"))
    assert sorted(r.object_name for r in listed.collect()) == copied


def test_offices_are_merged_or_refused(spark, paths, capsys):
    root, options = paths
    fresh = root / "fresh.json"
    fresh.write_text('{"Goa": ["New - GA9( x )"], "Kerala": ["K - KL1( x )"]}')
    command = ["offices", "--grain", "rto", *options, "--fresh-offices", str(fresh), "--out", str(root / "map")]
    with pytest.raises(ValueError, match="states without offices: .*Telangana"):
        jobs.main(command, spark)
    assert not (root / "map").exists()
    jobs.main([*command, "--force"], spark)
    assert "states without offices: 34" in capsys.readouterr().out
    merged = dimensions.load_office_map(spark, str(root / "map"), strict=True)
    assert sorted(map(tuple, merged.collect())) == [("Goa", "New - GA9( x )"), ("Kerala", "K - KL1( x )")]


def test_every_file_is_checked_once_for_all_lists(spark, paths, monkeypatch):
    root, options = paths
    save(root / "reports", "Goa/Panaji_GA1/2026/JUN", report(["MOTOR CAR"]))
    seen = []
    plain = reports.check_listed
    monkeypatch.setattr(reports, "check_listed", lambda *a: seen.append(plain(*a)) or seen[-1])
    jobs.main(["missing", *month_options(options), "--out", str(root / "out")], spark)
    assert len(seen) == 1 and lines_of(root / "out" / "plan")


def test_quarantine_and_duplicates_of_the_curated_refresh(spark, paths, capsys):
    root, options = paths
    save(root / "reports", "Goa/Panaji_GA1/2026/JUN", report(["MOTOR CAR", "BUS", "BUS"]))
    month = [*month_options(options), "--as-of", "2026-07-02"]
    jobs.main(["run", *month, "--duplicates", str(root / "twice")], spark)
    assert "facts read: 3, curated: 3, in quarantine: 0, rows with a repeated key: 2" in capsys.readouterr().out
    [twice] = spark.read.parquet(str(root / "twice")).collect()
    assert (twice.vehicle_class, twice.rows) == ("BUS", 2)
    before = versions.current(spark, str(root / "curated"), tables.DAY)
    with pytest.raises(tables.DuplicateKeys, match="2 rows share"):
        jobs.main(["curate", *month, "--duplicates", "refuse"], spark)
    assert versions.current(spark, str(root / "curated"), tables.DAY) == before
    bad = fact_rows(spark, RTO, [
        {"date": "01/06/2026", "state": "Goa", "rto_code": "X", "rto_name": "N", "vehicle_class": "CAR", "total": t}
        for t in ("5.0", "12")
    ]).withColumn("rto_code", F.concat("rto_code", "total"))
    load.load_fact(str(root / "fact"), bad, RTO)
    with pytest.raises(Exception, match="5.0"):
        jobs.main(["curate", *month], spark)
    assert versions.current(spark, str(root / "curated"), tables.DAY) == before
    jobs.main(["curate", *month, "--quarantine", str(root / "bad")], spark)
    assert "facts read: 5, curated: 4, in quarantine: 1" in capsys.readouterr().out
    [row] = spark.read.parquet(str(root / "bad")).collect()
    assert (row.total, row.bad_columns, row.vehicle_class) == ("5.0", ["total"], "CAR")
    assert tables.read_curated(spark, str(root / "curated"), RTO).count() == 4
