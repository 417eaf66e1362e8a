"""Expected reports against the files that exist.

Lists of expected members are columns: a literal array, or a scalar subquery over a
table. They are exploded per state, so no join is needed to build the grid.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regflow.functions import dates, text
from regflow.schema import STATES, Grain


def state_list(spark: SparkSession) -> DataFrame:
    """All states, as a plan whose small size Catalyst can see."""
    names = "array(" + ", ".join(f"'{state}'" for state in STATES) + ")"
    return spark.range(1).select(F.explode(F.expr(names)).alias("state"))


def month_sequence(first: Column, last: Column) -> Column:
    """Months from `first` to `last`, both included; a reversed range raises."""
    start = F.to_date(F.trunc(first, "month"))
    end = F.to_date(F.trunc(last, "month"))
    months = F.sequence(start, end, F.expr("interval 1 month"))
    message = "a range of months cannot end before it starts"
    return F.when(start > end, F.raise_error(F.lit(message)).cast("array<date>")).otherwise(
        months
    )


def month_windows(ranges: DataFrame, first: str, last: str) -> DataFrame:
    """One row per month of each range, with its label and year."""
    exploded = ranges.withColumn(
        "month_start", F.explode(month_sequence(F.col(first), F.col(last)))
    )
    return exploded.withColumns(
        {
            "month": dates.month_of(F.col("month_start")),
            "year": F.date_format("month_start", "yyyy"),
        }
    )


def _dated(grid: DataFrame) -> DataFrame:
    return grid.withColumns(
        {
            "month": dates.month_of(F.col("month_start")),
            "year": F.date_format("month_start", "yyyy"),
        }
    )


def expected_grid_state(states: DataFrame, months: Column, grain: Grain, root: str) -> DataFrame:
    grid = _dated(states.select("state", F.explode(months).alias("month_start")))
    path = text.report_path(grain, root, F.col("state"), F.col("year"), F.col("month"))
    return grid.withColumn("path", path)


def expected_grid_oem(
    states: DataFrame, classes: Column, months: Column, grain: Grain, root: str
) -> DataFrame:
    """Every state with every vehicle class and month."""
    members = states.select("state", F.explode(classes).alias("vehicle_class"))
    grid = _dated(members.select("*", F.explode(months).alias("month_start")))
    path = text.report_path(
        grain, root, F.col("state"), F.col("year"), F.col("month"), F.col("vehicle_class")
    )
    return grid.withColumn("path", path)


def expected_grid_rto(
    states: DataFrame, offices: DataFrame, months: Column, grain: Grain, root: str
) -> DataFrame:
    """Every office of a listed state with every month; `path` is NULL for a malformed label."""
    listed = offices.join(states.select("state"), "state", "left_semi")
    grid = _dated(
        listed.select("state", "office_label", F.explode(months).alias("month_start"))
    )
    path = text.report_path(
        grain, root, F.col("state"), F.col("year"), F.col("month"), F.col("office_label")
    )
    return grid.withColumn("path", path)


def valid_paths(files: DataFrame) -> DataFrame:
    return files.filter("valid").select("path")


def missing_reports(expected: DataFrame, files: DataFrame) -> DataFrame:
    """Expected reports without a valid file; malformed labels are not among them."""
    return expected.filter(F.col("path").isNotNull()).join(
        valid_paths(files), "path", "left_anti"
    )


def malformed_labels(offices: DataFrame) -> DataFrame:
    return offices.filter(text.office_folder(F.col("office_label")).isNull())


def coverage_summary(expected: DataFrame, files: DataFrame, by: str = "state") -> DataFrame:
    """Expected, existing, missing and malformed counts per group."""
    present = valid_paths(files).distinct().withColumn("found", F.lit(True))
    checked = expected.join(present, "path", "left")
    has_path = F.col("path").isNotNull()
    return checked.groupBy(by).agg(
        F.count_if(has_path).alias("expected"),
        F.count_if(F.col("found")).alias("existing"),
        F.count_if(has_path & F.col("found").isNull()).alias("missing"),
        F.count_if(~has_path).alias("malformed"),
    )


def redownload_plan(expected: DataFrame, files: DataFrame, force: bool = False) -> DataFrame:
    """Reports to fetch: all with `force`, else those without a valid file.

    Malformed labels come along with action `malformed`.
    """
    present = valid_paths(files).distinct().withColumn("found", F.lit(True))
    wanted = F.lit(force) | F.col("found").isNull()
    action = F.when(F.col("path").isNull(), F.lit("malformed")).when(wanted, F.lit("download"))
    return (
        expected.join(present, "path", "left")
        .withColumn("action", action)
        .filter(F.col("action").isNotNull())
        .drop("found")
    )


def merge_office_maps(previous: DataFrame, fresh: DataFrame) -> DataFrame:
    """A state's fresh offices if it has any, else its previous ones (rows per office)."""
    kept = previous.join(fresh.select("state").distinct(), "state", "left_anti")
    return kept.unionByName(fresh)


def states_without_offices(states: DataFrame, offices: DataFrame) -> DataFrame:
    return states.select("state").join(offices.select("state"), "state", "left_anti")
