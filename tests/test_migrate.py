import pytest
from helpers import as_dicts, fact_rows
from pyspark.sql import functions as F
from test_load import KEYS

from regflow.operators import migrate
from regflow.plans import migration
from regflow.schema import GRAINS, STATE

CLASSES = {"vehicle_type": "t", "vehicle_category": "c", "vehicle_use_type": "u"}


def full(grain, **more):
    return KEYS[grain.name] | CLASSES | more


def legacy(spark, grain, values, drop=("electric_bov", "ethanol_e100")):
    frame = fact_rows(spark, grain, [full(grain, diesel=v) for v in values]).drop(*drop, "inserted_at")
    return frame.withColumns({"electric_vehicles": F.col("diesel"), "ethanol": F.lit("1")})


def test_backup_is_never_overwritten(spark, tmp_path):
    path = str(tmp_path / "b")
    frame = fact_rows(spark, STATE, [full(STATE)])
    assert migrate.snapshot_backup(frame, path).count() == 1
    with pytest.raises(Exception, match="(?i)already exists"):
        migrate.snapshot_backup(frame, path)
    with pytest.raises(FileNotFoundError):
        migrate.read_backup(spark, str(tmp_path / "none"))


@pytest.mark.parametrize("grain", GRAINS.values(), ids=lambda g: g.name)
def test_migration_and_resume(spark, tmp_path, grain):
    old = legacy(spark, grain, ["4"]).withColumn("insert_date", F.expr("timestamp'2020-01-01 00:00:00'"))
    result = migration.migrate_schema(old, grain, str(tmp_path / "b"))
    assert result.fact.columns == [*grain.columns, "inserted_at"]
    row = result.fact.first()
    assert row.electric_bov is None and row.diesel == "4" and row.inserted_at.year == 2020
    assert [r["row_count"] for r in as_dicts(result.counts)] == [1, 1]
    again = migration.resume_from_backup(spark, grain, str(tmp_path / "b"))
    assert again.fact.collect() == result.fact.collect()
    with pytest.raises(ValueError, match="diesel"):
        migrate.project_if_exists(old.drop("diesel"), grain)


def test_timestamp_choice_is_by_column(spark):
    frame = spark.createDataFrame([(None, 1)], "inserted_at timestamp, insert_date int")
    assert frame.select(migrate.first_existing_timestamp(frame)).first()[0] is None
    assert frame.drop("inserted_at").select(migrate.first_existing_timestamp(frame.drop("inserted_at"))).first()[0] == 1
    assert frame.select(migrate.first_existing_timestamp(frame.select(F.lit(1)))).first()[0] is not None


def test_null_repair_needs_the_older_column_only(spark):
    fact = fact_rows(spark, STATE, [full(STATE, electric_bov="1", ethanol_e100="2")])
    [row] = as_dicts(migrate.null_repair(fact, legacy(spark, STATE, ["1"])), "electric_bov", "ethanol_e100")
    assert row == {"electric_bov": None, "ethanol_e100": None}
    [row] = as_dicts(migrate.null_repair(fact, fact), "electric_bov", "ethanol_e100")
    assert row == {"electric_bov": "1", "ethanol_e100": "2"}
    checked = migrate.repair_check({"a": fact, "b": migrate.null_repair(fact, legacy(spark, STATE, ["1"]))})
    assert as_dicts(checked) == [{"table_name": "a", "non_null_rows": 1}, {"table_name": "b", "non_null_rows": 0}]


@pytest.mark.parametrize("grain", GRAINS.values(), ids=lambda g: g.name)
def test_backfill(spark, grain):
    rows = [full(grain), full(grain, state="GOA "), full(grain, electric_bov="9"), full(grain, state=None)]
    fact = fact_rows(spark, grain, rows)
    backup = legacy(spark, grain, ["  8 ", "30", "   ", None])
    nulls = legacy(spark, grain, ["1"]).withColumn("state", F.lit(None).cast("string"))
    backup = backup.unionByName(nulls)
    done = migrate.backfill_electric(fact, backup, grain)
    got = sorted((str(r.electric_bov), r.backfilled) for r in done.collect())
    assert got == [("30", True), ("30", True), ("9", False), ("None", False)]
    counts = as_dicts(migrate.backfill_counts({"t": done}))
    assert counts == [{"table_name": "t", "electric_bov_rows_updated": 2}]
    second = migrate.backfill_electric(done.drop("backfilled"), backup, grain)
    assert second.filter("backfilled").count() == 0
    assert not migrate.backfill_electric(fact, fact, grain).filter("backfilled").count()
    assert [r.date for r in migrate.backfill_dates(backup).collect()] == ["01/06/2026"]
