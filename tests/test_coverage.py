import pytest
from helpers import as_dicts
from pyspark.sql import functions as F

from regflow.operators import coverage
from regflow.schema import OEM, RTO, STATE, STATES

def june():
    return F.expr("array(date'2026-06-01')")


def states(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "state string")


def files(spark, *rows):
    return spark.createDataFrame(list(rows), "path string, valid boolean")


def offices(spark, *rows):
    return spark.createDataFrame(list(rows), "state string, office_label string")


def test_missing_state_and_oem_reports(spark):
    two = states(spark, "Andhra Pradesh", "Telangana")
    expected = coverage.expected_grid_state(two, june(), STATE, "r")
    have = files(spark, ("r/Andhra Pradesh/2026/JUN/reportTable.xlsx", True),
                 ("r/Telangana/2026/JUN/reportTable.xlsx", False))
    assert as_dicts(coverage.missing_reports(expected, have), "state", "year", "month") == [
        {"state": "Telangana", "year": "2026", "month": "JUN"}
    ]
    classes = F.array(F.lit("MOTOR CAR"), F.lit("BUS"))
    grid = coverage.expected_grid_oem(states(spark, "Andhra Pradesh"), classes, june(), OEM, "o")
    have = files(spark, ("o/Andhra Pradesh/MOTOR CAR/2026/JUN/reportTable.xlsx", True))
    assert as_dicts(coverage.missing_reports(grid, have), "vehicle_class") == [{"vehicle_class": "BUS"}]


def test_offices_malformed_missing_and_plan(spark):
    listed = offices(spark, ("Goa", "A - G1( x )"), ("Goa", "B - G2( x )"), ("Goa", "Bad Label"), ("Atlantis", "C - X1("))
    grid = coverage.expected_grid_rto(states(spark, "Goa"), listed, june(), RTO, "r")
    have = files(spark, ("r/Goa/A_G1/2026/JUN/reportTable.xlsx", True))
    assert as_dicts(coverage.missing_reports(grid, have), "office_label") == [{"office_label": "B - G2( x )"}]
    assert as_dicts(coverage.malformed_labels(listed), "office_label") == [{"office_label": "Bad Label"}]
    assert as_dicts(coverage.coverage_summary(grid, have)) == [
        {"state": "Goa", "expected": 2, "existing": 1, "missing": 1, "malformed": 1}
    ]

    def plan(force):
        rows = as_dicts(coverage.redownload_plan(grid, have, force), "office_label", "action")
        return sorted((r["office_label"][:1], r["action"]) for r in rows)

    assert sorted(plan(False)) == [("B", "download"), ("B", "malformed")]
    assert sorted(plan(True)) == [("A", "download"), ("B", "download"), ("B", "malformed")]


def test_office_map_merge(spark):
    previous = offices(spark, ("AP", "Old AP"), ("Telangana", "Old TS"))
    fresh = offices(spark, ("AP", "New AP"))
    merged = coverage.merge_office_maps(previous, fresh)
    assert sorted(map(tuple, merged.collect())) == [("AP", "New AP"), ("Telangana", "Old TS")]
    without = coverage.states_without_offices(states(spark, "AP", "Telangana", "Kerala"), fresh)
    assert sorted(r.state for r in without.collect()) == ["Kerala", "Telangana"]
    assert coverage.state_list(spark).count() == len(STATES) == 36


def test_month_windows(spark):
    ranges = spark.createDataFrame([("2013-11-05", "2014-02-01")], "a string, b string")
    ranges = ranges.selectExpr("date(a) as a", "date(b) as b")
    rows = coverage.month_windows(ranges, "a", "b").select("month", "year").collect()
    assert [tuple(r) for r in rows] == [("NOV", "2013"), ("DEC", "2013"), ("JAN", "2014"), ("FEB", "2014")]
    with pytest.raises(Exception, match="cannot end before"):
        coverage.month_windows(ranges, "b", "a").collect()
