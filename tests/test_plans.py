"""Shape of the physical plans: what makes the jobs hold at a much larger scale."""

import pytest
from helpers import fact_rows, plan_text
from pyspark.sql import functions as F

from regflow.catalog import adapter
from regflow.catalog.queries import QUERIES
from regflow.operators import load, logs, migrate
from regflow.schema import OEM, RTO, STATE

SF = "/root/testdata/sf0.001"
# Reading and checking files, and cutting CSV into records, is the only work done in Python.
PYTHON = {
    "valid_workbooks", "read_workbooks", "mapping_dim", "preprocess_workbooks_rto",
    "csv_stage_scan", "csv_ranges_scan", "csv_monthly_sink",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name not in PYTHON:
        assert "Python" not in plan and "Pandas" not in plan and "InArrow" not in plan


@pytest.fixture
def skew_settings(spark):
    """Sizes at which AQE treats a test-sized partition as a large one."""
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot_fact(spark, grain, rows=40000):
    """Facts of which a third share one key; every row has its own text to keep them large."""
    state = F.when(F.col("id") % 3 == 0, F.lit("Hot")).otherwise(F.concat(F.lit("S"), F.col("id") % 500))
    columns = {c: F.lit(None).cast("string") for c in grain.columns}
    columns |= {k: F.lit("k") for k in (*grain.load_key, *grain.backfill_key)}
    columns |= {"date": F.lit("01/06/2026"), "state": state, "diesel": F.sha2(F.col("id").cast("string"), 256)}
    frame = spark.range(0, rows, 1, 8).select(*[v.alias(c) for c, v in columns.items()])
    return frame.withColumn("inserted_at", F.current_timestamp())


@pytest.mark.parametrize("grain", [STATE, RTO, OEM], ids=lambda g: g.name)
def test_hot_keys_are_split(spark, skew_settings, grain, tmp_path):
    hot_fact(spark, grain).write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    kept = load.delete_staged(fact, fact.filter("state in ('S1', 'S2')"), grain)
    assert "skew=true" in plan_text(kept).lower()
    backup = fact.select(*grain.backfill_key, F.lit(" 5 ").alias("electric_vehicles"))
    filled = migrate.backfill_electric(fact, backup, grain)
    assert "skew=true" in plan_text(filled).lower()
    assert filled.filter("backfilled").count() == fact.count()


def test_log_tail_limits_before_the_shuffle(spark):
    lines = spark.range(1000).selectExpr("concat('log', id % 2) as log", "id as n", "concat('ERROR ', id) as line")
    plan = plan_text(logs.flagged_tail(lines, ["log"], ["n"]))
    assert plan.count("WindowGroupLimit") >= 2 and ", Partial" in plan


def test_scan_reads_only_what_it_needs(spark):
    plan = adapter.raw_reports(spark, SF, STATE)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert not any("l_linenumber" in line or "s_name" in line for line in scans)
    late = adapter.raw_reports(spark, SF, STATE, "min", "2000-01-01")
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in plan


def test_one_row_fact_has_all_columns(spark):
    assert len(fact_rows(spark, OEM, [{}]).columns) == 48
