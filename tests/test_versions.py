"""Stored tables: loads are seen whole or not at all, and only what changes is written."""

import pytest
from helpers import as_dicts, fact_rows, plan_text
from pyspark.sql import functions as F
from test_load import KEYS
from test_migrate import full, legacy

from regflow.operators import curate, load, migrate, versions
from regflow.operators.load import PERIOD
from regflow.plans import migration
from regflow.schema import GRAINS, OEM, RTO, STATE

MONTHS = ("01/04/2026", "01/05/2026", "01/06/2026")


def months(spark, grain=STATE, **more):
    return fact_rows(spark, grain, [full(grain, date=d, **more) for d in MONTHS])


def totals(spark, path, grain=STATE):
    return sorted((r.date, r.total) for r in load.read_fact(spark, path, grain).collect())


def files_of(folder):
    return {p: p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def test_a_load_that_fails_between_periods_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "fact")
    load.load_fact(path, months(spark, total="1"), STATE)
    before, held = versions.current(spark, path, PERIOD), files_of(tmp_path / "fact")

    def broken(old, new):
        # The first period can be written, the last one cannot.
        bad = F.when(F.col("date") == MONTHS[2], F.raise_error(F.lit("lost")).cast("string"))
        return load.upsert_fact(old, new, STATE).withColumn("total", F.coalesce(bad, "total"))

    staged = load.with_period(months(spark, total="2"))
    with pytest.raises(Exception, match="lost"):
        load.merge_partitions(path, staged, PERIOD, broken)
    assert versions.current(spark, path, PERIOD) == before and files_of(tmp_path / "fact") == held
    assert totals(spark, path) == [(d, "1") for d in MONTHS]
    load.load_fact(path, months(spark, total="2"), STATE)
    assert totals(spark, path) == [(d, "2") for d in MONTHS]


def test_of_two_loads_from_one_version_the_second_fails(spark, tmp_path):
    path = str(tmp_path / "fact")
    load.load_fact(path, months(spark, total="1"), STATE)
    base = versions.current(spark, path, PERIOD)
    load.load_fact(path, months(spark, total="2"), STATE)
    late = load.with_period(months(spark, total="3"))
    with pytest.raises(versions.TableChanged):
        versions.replace(late, path, PERIOD, base)
    assert totals(spark, path) == [(d, "2") for d in MONTHS]


def test_a_reader_keeps_its_version_through_the_next_load(spark, tmp_path):
    path = str(tmp_path / "fact")
    load.load_fact(path, months(spark, total="1"), STATE)
    reader = load.read_fact(spark, path, STATE)
    load.load_fact(path, months(spark, total="2"), STATE)
    assert {r.total for r in reader.collect()} == {"1"}
    load.load_fact(path, months(spark, total="3"), STATE)
    # Now the first load is superseded twice, and gone.
    assert len(list((tmp_path / "fact").glob("load=*"))) == 2
    assert totals(spark, path) == [(d, "3") for d in MONTHS]


def test_a_plain_folder_of_partitions_is_the_first_version(spark, tmp_path):
    path = str(tmp_path / "fact")
    load.with_period(months(spark, total="1")).write.partitionBy(PERIOD).parquet(path)
    assert totals(spark, path) == [(d, "1") for d in MONTHS]
    june = months(spark, total="2").filter(F.col("date") == MONTHS[2])
    load.load_fact(path, june, STATE)
    assert totals(spark, path) == [(MONTHS[0], "1"), (MONTHS[1], "1"), (MONTHS[2], "2")]
    assert versions.current(spark, path, PERIOD).number == 1


def test_sweep_removes_what_killed_jobs_left(spark, tmp_path):
    path = str(tmp_path / "fact")
    load.load_fact(path, months(spark, total="1"), STATE)
    left = versions.new_load()
    versions.write_load(load.with_period(months(spark)), path, PERIOD, left)
    assert totals(spark, path) == [(d, "1") for d in MONTHS]
    assert versions.sweep(spark, path) == []
    assert versions.sweep(spark, path, hours=0) == [left]
    assert totals(spark, path) == [(d, "1") for d in MONTHS]
    assert versions.sweep(spark, str(tmp_path / "none")) == []


def test_changed_partitions_ignore_order_and_see_every_value(spark):
    rows = [(1, "a", None), (1, "b", 2), (2, "c", 3), (2, "c", 3), (None, "d", 4)]
    frame = spark.createDataFrame(rows, "part int, name string, n int")
    same = spark.createDataFrame(rows[::-1], frame.schema).repartition(3)
    assert versions.changed_partitions(frame, same, "part") == []
    assert versions.changed_partitions(frame, frame.distinct(), "part") == [2]
    moved = frame.withColumn("n", F.when(F.col("name") == "a", 2).when(F.col("name") == "b", None).otherwise(F.col("n")))
    assert versions.changed_partitions(frame, moved, "part") == [1]
    assert versions.changed_partitions(frame, frame.fillna({"part": 2}), "part") != []
    assert versions.changed_partitions(frame, frame.limit(0), "part").count(None) == 1


@pytest.mark.parametrize("grain", GRAINS.values(), ids=lambda g: g.name)
def test_backfill_rewrites_only_periods_that_change(spark, tmp_path, grain):
    path, backup = str(tmp_path / "fact"), str(tmp_path / "backup")
    load.load_fact(path, months(spark, grain), grain)
    old = fact_rows(spark, grain, [
        full(grain, date=MONTHS[1], diesel=" 7 "), full(grain, date=MONTHS[2], state="elsewhere", diesel="8"),
        full(grain, date=MONTHS[0], diesel="  "),
    ])
    old.withColumn("electric_vehicles", F.col("diesel")).drop("electric_bov").write.parquet(backup)
    before = files_of(tmp_path / "fact")
    assert migration.backfill_table(spark, path, grain, backup) == ["period=2026-05-01"]
    got = {(r.date, r.electric_bov) for r in load.read_fact(spark, path, grain).collect()}
    assert got == {(MONTHS[0], None), (MONTHS[1], "7"), (MONTHS[2], None)}
    after = files_of(tmp_path / "fact")
    assert before.items() <= after.items()
    assert {p.parent.name for p in after.keys() - before.keys()} == {"period=2026-05-01"}
    # A second run writes nothing, not even a version.
    number = versions.current(spark, path, PERIOD).number
    assert migration.backfill_table(spark, path, grain, backup) == []
    assert files_of(tmp_path / "fact") == after and versions.current(spark, path, PERIOD).number == number
    months(spark, grain).write.parquet(str(tmp_path / "newer"))
    assert migration.backfill_table(spark, path, grain, str(tmp_path / "newer")) == []


def test_repair_of_a_stored_table(spark, tmp_path):
    path, backup = str(tmp_path / "fact"), str(tmp_path / "backup")
    rows = [full(STATE, date=MONTHS[0]), full(STATE, date=MONTHS[1], electric_bov="4", ethanol_e100="5")]
    load.load_fact(path, fact_rows(spark, STATE, rows), STATE)
    legacy(spark, STATE, ["1"]).write.parquet(backup)
    assert migration.repair_table(spark, path, STATE, backup) == ["period=2026-05-01"]
    assert migrate.repair_check({"t": load.read_fact(spark, path, STATE)}).first().non_null_rows == 0
    assert migration.repair_table(spark, path, STATE, backup) == []
    rows = fact_rows(spark, STATE, [full(STATE, electric_bov="4")])
    rows.write.parquet(str(tmp_path / "newer"))
    load.load_fact(path, rows, STATE)
    assert migration.repair_table(spark, path, STATE, str(tmp_path / "newer")) == []


def old_table(spark, path, grain=STATE, values=("4", "5")):
    frame = legacy(spark, grain, list(values)).withColumn("insert_date", F.expr("timestamp'2020-01-01 00:00:00'"))
    load.with_period(frame).write.partitionBy(PERIOD).parquet(path)
    return frame


@pytest.mark.parametrize("grain", GRAINS.values(), ids=lambda g: g.name)
def test_migration_switches_the_table_once(spark, tmp_path, grain):
    path, backup = str(tmp_path / "fact"), str(tmp_path / "backup")
    old_table(spark, path, grain)
    assert migration.migrate_table(spark, path, grain, backup) == list(migration.STEPS)
    found = load.read_fact(spark, path, grain)
    assert sorted(r.diesel for r in found.collect()) == ["4", "5"] and found.first().inserted_at.year == 2020
    assert "electric_vehicles" in migrate.read_backup(spark, backup).columns
    # A second run does nothing and changes no row.
    held, number = files_of(tmp_path / "fact"), versions.current(spark, path, PERIOD)
    assert migration.migrate_table(spark, path, grain, backup) == []
    assert files_of(tmp_path / "fact") == held and versions.current(spark, path, PERIOD) == number


@pytest.mark.parametrize("stopped", migration.STEPS)
def test_a_stopped_migration_goes_on(spark, tmp_path, monkeypatch, stopped):
    path, backup = str(tmp_path / "fact"), str(tmp_path / "backup")
    old_table(spark, path)
    plain = versions.write_json

    def fail(spark, goal, value):
        if goal.endswith(f"_journal/{stopped}.json"):
            raise RuntimeError("stopped")
        plain(spark, goal, value)

    monkeypatch.setattr(versions, "write_json", fail)
    with pytest.raises(RuntimeError, match="stopped"):
        migration.migrate_table(spark, path, STATE, backup)
    if stopped != "switch":
        assert versions.current(spark, path, PERIOD).number == 0
    monkeypatch.setattr(versions, "write_json", plain)
    left = list(migration.STEPS[migration.STEPS.index(stopped) :])
    assert migration.migrate_table(spark, path, STATE, backup) == left
    assert versions.current(spark, path, PERIOD).number == 1
    assert load.read_fact(spark, path, STATE).count() == 2


def test_counts_that_differ_stop_every_run(spark, tmp_path, monkeypatch):
    path, backup = str(tmp_path / "fact"), str(tmp_path / "backup")
    old_table(spark, path)
    plain = migrate.project_if_exists
    monkeypatch.setattr(migrate, "project_if_exists", lambda b, g: plain(b, g).filter("diesel <> '4'"))
    for _ in range(2):
        with pytest.raises(migration.CountsDiffer, match="01/06/2026: 2 and 1"):
            migration.migrate_table(spark, path, STATE, backup)
    assert versions.current(spark, path, PERIOD).number == 0


def test_a_table_loaded_after_its_backup_is_not_switched(spark, tmp_path, monkeypatch):
    path, backup = str(tmp_path / "fact"), str(tmp_path / "backup")
    load.load_fact(path, months(spark, total="1"), STATE)
    plain = migration.date_counts_differ

    def loaded_meanwhile(before, after):
        load.load_fact(path, months(spark, total="2"), STATE)
        return plain(before, after)

    monkeypatch.setattr(migration, "date_counts_differ", loaded_meanwhile)
    with pytest.raises(versions.TableChanged):
        migration.migrate_table(spark, path, STATE, backup)
    assert totals(spark, path) == [(d, "2") for d in MONTHS]


def test_a_backup_of_something_else_is_refused(spark, tmp_path):
    path, backup = str(tmp_path / "fact"), str(tmp_path / "backup")
    old_table(spark, path)
    legacy(spark, STATE, ["1", "2", "3"]).write.parquet(backup)
    with pytest.raises(migration.CountsDiffer, match="is not one of"):
        migration.migrate_table(spark, path, STATE, backup)


@pytest.mark.parametrize("grain", GRAINS.values(), ids=lambda g: g.name)
def test_counted_merge_equals_the_upsert(spark, grain):
    lookup = spark.createDataFrame([("g1", "North")], "rto_code string, district string")
    parts = {"year": "2026", "month": "6", "day": "1"}
    old = [full(grain, **parts, total=str(n), vehicle_type=f"t{n % 40}") for n in range(60)]
    new = [full(grain, **parts, total=str(100 + n), vehicle_type=f"T{n % 30} ") for n in range(45)]
    alone = [full(grain, **parts, vehicle_type=None, total=str(n)) for n in range(3)]
    current = curate.curate(fact_rows(spark, grain, old + alone), grain, lookup)
    fresh = curate.curate(fact_rows(spark, grain, new + alone), grain, lookup)
    merged = curate.merge_counted(current, fresh, grain)
    wanted = curate.upsert_curated(current, fresh, grain)
    assert sorted(map(str, merged.drop("copies").collect())) == sorted(map(str, wanted.collect()))
    got = sorted((r.vehicle_type or "", r.copies) for r in merged.collect())
    counts = {k: sum((v or "").rstrip().lower() == k for v, _ in got) for k in {v.rstrip().lower() for v, _ in got}}
    assert all(c == (1 if not v else counts[v.rstrip().lower()]) for v, c in got)


def test_counted_merge_has_one_exchange(spark, tmp_path):
    frame = curate.curate(months(spark, OEM, year="2026", month="6", day="1"), OEM)
    frame.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    plan = plan_text(curate.merge_counted(stored, stored, OEM)).split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1


def test_json_files_appear_whole_and_once(spark, tmp_path):
    goal = str(tmp_path / "notes" / "a.json")
    versions.write_json(spark, goal, {"é": [1, None]})
    assert versions.read_json(spark, goal) == {"é": [1, None]}
    with pytest.raises(FileExistsError):
        versions.write_json(spark, goal, {})
    assert versions.read_json(spark, goal) == {"é": [1, None]}
    assert [p.name for p in (tmp_path / "notes").iterdir() if not p.name.endswith(".crc")] == ["a.json"]


def test_keys_of_every_grain_have_a_period(spark, tmp_path):
    path = str(tmp_path / "fact")
    load.load_fact(path, fact_rows(spark, RTO, [KEYS["rto"]]), RTO)
    assert as_dicts(load.read_fact(spark, path, RTO), "rto_code") == [{"rto_code": "G1"}]
