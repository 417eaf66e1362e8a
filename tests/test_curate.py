import re

import pytest
from helpers import as_dicts, fact_rows, plan_text
from pyspark.sql import functions as F
from test_load import KEYS

from regflow.catalog.queries import QUERIES
from regflow.operators import curate, load
from regflow.schema import GRAINS, MEASURES, OEM, RTO, STATE

DATED = {"year": "2026", "month": "6", "day": "1"}


def districts(spark, *rows):
    return spark.createDataFrame(list(rows), "rto_code string, district string")


@pytest.mark.parametrize("grain", GRAINS.values(), ids=lambda g: g.name)
def test_types_and_order(spark, grain):
    row = KEYS[grain.name] | DATED | {"total": "1,234", "state": "x" * 150}
    done = curate.curate(fact_rows(spark, grain, [row]), grain, districts(spark, ("g1 ", "North")))
    lead = {
        "state": ["state"], "rto": ["state", "district", "rto_name", "rto_code"],
        "oem": ["state", "oem_name"],
    }[grain.name]
    classes = ["vehicle_type", "vehicle_category", "vehicle_use_type", "vehicle_class"]
    assert done.columns == ["year", "month", "day", "date", *lead, *classes, *MEASURES, "inserted_at"]
    assert dict(done.dtypes)["date"] == "date" and dict(done.dtypes)["total"] == "int"
    got = done.first()
    assert got.total == 1234 and len(got.state) == 100 and str(got.date) == "2026-06-01"
    if grain is RTO:
        assert got.district == "North"
    if grain is OEM:
        assert got.oem_name == "M"


def test_district_join(spark):
    fact = fact_rows(spark, RTO, [KEYS["rto"] | {"rto_code": c} for c in ("G1", "G2", None)])
    lookup = districts(spark, ("g1", "N"), ("G1 ", "S"), (None, "no"))
    got = sorted(map(str, (tuple(r) for r in curate.join_district(fact, lookup).select("rto_code", "district").collect())))
    assert got == ["('G1', 'N')", "('G1', 'S')", "('G2', None)", "(None, None)"]


def test_strict_and_quarantine(spark):
    rows = [KEYS["state"] | DATED | {"total": t} for t in ("1", "5.0")]
    rows.append(KEYS["state"] | DATED | {"date": "31/02/2026", "diesel": "x"})
    fact = fact_rows(spark, STATE, rows)
    with pytest.raises(Exception):
        curate.curate(fact, STATE).collect()
    good, bad = curate.quarantine(fact)
    assert [r.total for r in curate.curate(good, STATE).collect()] == [1]
    assert sorted(r.bad_columns for r in bad.collect()) == [["date", "diesel"], ["total"]]


def test_strict_needs_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(RuntimeError):
            curate.curate(fact_rows(spark, STATE, [KEYS["state"]]), STATE)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_window_and_incremental_equal_full_refresh(spark):
    dates = ["30/04/2026", "01/05/2026", "01/06/2026", "01/07/2026"]
    fact = fact_rows(spark, STATE, [KEYS["state"] | DATED | {"date": d, "total": d[3:5]} for d in dates])
    as_of = F.lit("2026-06-15").cast("date")
    window = curate.incremental_window(fact, as_of)
    assert sorted(r.date for r in window.collect()) == ["01/05/2026", "01/06/2026", "01/07/2026"]
    classes = {k: "c" for k in ("vehicle_type", "vehicle_category", "vehicle_use_type")}
    inside = fact_rows(spark, STATE, [KEYS["state"] | DATED | classes | {"total": t} for t in "7"])
    full = curate.curate(inside, STATE)
    again = curate.upsert_curated(full, curate.curate(curate.incremental_window(inside, as_of), STATE), STATE)
    assert sorted(map(str, again.collect())) == sorted(map(str, full.collect()))


def test_window_prunes_partitions_of_a_stored_fact(spark, tmp_path):
    rows = [KEYS["state"] | DATED | {"date": d} for d in ("01/01/2026", "01/06/2026")]
    load.load_fact(str(tmp_path / "f"), fact_rows(spark, STATE, rows), STATE)
    stored = load.read_fact(spark, str(tmp_path / "f"), STATE)
    window = curate.incremental_window(stored, F.lit("2026-06-15").cast("date"))
    plan = plan_text(window)
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "PartitionFilters: [((period" in scan and window.count() == 1
    bad = fact_rows(spark, STATE, [KEYS["state"] | DATED | {"date": "31/02/2026"}])
    load.load_fact(str(tmp_path / "f"), bad, STATE)
    with pytest.raises(Exception):
        curate.curate(curate.incremental_window(load.read_fact(spark, str(tmp_path / "f"), STATE), F.lit("2026-06-15").cast("date")), STATE).collect()


def test_duplicate_keys_are_reported(spark):
    classes = {k: "c" for k in ("vehicle_type", "vehicle_category", "vehicle_use_type")}
    fact = fact_rows(spark, STATE, [KEYS["state"] | DATED | classes] * 2)
    [row] = as_dicts(curate.duplicate_keys(curate.curate(fact, STATE), STATE.curated_key), "rows")
    assert row == {"rows": 2}


@pytest.mark.parametrize("name", ["quarantine_rto", "curated_upsert_rto", "delete_staged_rto", "history_backfill"])
def test_filters_do_not_compute_columns_again(spark, name):
    """Months are read from paths in projections only, never in a filter or a join condition."""
    frame = QUERIES[name](spark, "/root/testdata/sf0.001")
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    lines = [x for x in plan.splitlines() if re.match(r"^[\s:+-]*(Filter|Join) ", x)]
    assert lines and not [x for x in lines if "d/MMM/yyyy" in x and "split(path" not in x]
    assert not [x for x in lines if "arrayfilter" in x or "concat_ws(/, reports" in x]


def test_faults_in_order_and_odd_date_parts(spark):
    rows = fact_rows(spark, STATE, [
        {"year": "2026L", "month": " 6", "day": "1.5", "date": "1/6/2026", "total": "5.0"},
        {"year": "2026", "month": "\t6\n", "day": "+1", "date": "1/6/2026", "total": "5"},
    ])
    good, bad = curate.quarantine(rows)
    assert good.count() == 1 and bad.first().bad_columns == ["year", "day", "total"]
    assert curate.parse(rows).schema["bad_columns"].dataType.simpleString() == "array<string>"
