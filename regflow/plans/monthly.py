"""Reports to facts to curated tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regflow.functions import dates, text
from regflow.operators import conform, curate, load
from regflow.schema import (
    LABEL_HEADER,
    LEGACY_FUEL_HEADERS,
    LEGACY_STATE_SPELLINGS,
    LEGACY_TOTAL_HEADER,
    MEASURE_HEADERS,
    MONTHS,
    STATE,
    Grain,
    snake,
)
from regflow.sources.reports import (
    path_piece,
    read_listed,
    widen,
)
from regflow.sources.tree import in_months, list_folder, list_reports


def preprocess(reports: DataFrame, mapping: DataFrame, grain: Grain) -> DataFrame:
    """Raw report rows with their `path` -> the fixed columns of the grain."""
    return conform.finalize(conform.tag_metadata(reports, grain), mapping, grain)


def preprocess_rows(rows: DataFrame, mapping: DataFrame, grain: Grain) -> DataFrame:
    """The same from workbook sheet rows (path, row_no, cells)."""
    wide = widen(conform.skip_empty_reports(rows), (LABEL_HEADER,) + MEASURE_HEADERS)
    return preprocess(wide, mapping, grain)


def preprocess_tree(
    spark: SparkSession,
    root: str,
    mapping: DataFrame,
    grain: Grain,
    month: str,
    year: str,
    states: Sequence[str] | None = None,
) -> DataFrame:
    """One month of a report tree. Without reports the frame is empty, with all columns."""
    files = list_reports(spark, root, grain, [year], [month], states)
    return preprocess_rows(read_listed(files, root, empty_cells=False), mapping, grain)


@dataclass(frozen=True)
class MonthlyRun:
    stage: DataFrame
    fact: DataFrame
    curated: DataFrame | None


def monthly_run(
    preprocessed: DataFrame,
    fact: DataFrame,
    curated: DataFrame | None,
    grain: Grain,
    as_of: Column,
    districts: DataFrame | None = None,
    inserted_at: Column | None = None,
) -> MonthlyRun:
    """Stage, replace staged keys and refresh the curated window, as one lazy plan.

    Without a curated table the run stops after the facts.
    """
    stage = load.stage_load(preprocessed, grain.columns, inserted_at)
    facts = load.upsert_fact(fact, stage, grain)
    if curated is None:
        return MonthlyRun(stage, facts, None)
    window = curate.incremental_window(facts, as_of)
    fresh = curate.curate(window, grain, districts)
    return MonthlyRun(stage, facts, curate.upsert_curated(curated, fresh, grain))


def month_range_reports(reports: DataFrame, first: Column, last: Column) -> DataFrame:
    """Reports whose path falls in a range of months, both included."""
    path = F.col("path")
    start = F.try_to_date(
        F.concat_ws("/", F.lit("1"), path_piece(path, 2), path_piece(path, 3)), "d/MMM/yyyy"
    )
    known = path_piece(path, 2).isin(*MONTHS)
    return reports.filter(known & start.between(F.trunc(first, "month"), F.trunc(last, "month")))


def history_backfill(
    reports: DataFrame,
    mapping: DataFrame,
    fact: DataFrame,
    grain: Grain,
    states: Sequence[str],
    first: Column,
    last: Column,
    inserted_at: Column | None = None,
) -> DataFrame:
    """Reload all months of a range for some states in one job.

    Months do not run one after another: the load key holds the date, so one upsert
    over all of them gives the same facts.
    """
    ranged = conform.tag_metadata(month_range_reports(reports, first, last), grain)
    chosen = conform.filter_states(ranged, states)
    frame = conform.finalize(chosen, mapping, grain)
    stage = load.stage_load(frame, grain.columns, inserted_at)
    return load.upsert_fact(fact, stage, grain)


def full_refresh(
    fact: DataFrame, grain: Grain, districts: DataFrame | None = None
) -> DataFrame:
    """Curated table from all facts, without a date filter."""
    return curate.curate(fact, grain, districts)


LEGACY_HEADERS = (LABEL_HEADER,) + LEGACY_FUEL_HEADERS + (LEGACY_TOTAL_HEADER,)


def legacy_columns() -> dict[str, str]:
    """Header -> output column of the legacy state history."""
    fuels = {header: snake(header) for header in LEGACY_FUEL_HEADERS}
    fuels["ELECTRIC(BOV)"] = "electric_vehicles"
    return dict(STATE.lead) | fuels | {LEGACY_TOTAL_HEADER: "total"}


def history_state_preprocess(rows: DataFrame, mapping: DataFrame) -> DataFrame:
    """Legacy state sheet rows, whose dimensions come from the title of each file."""
    wide = conform.history_defaults(conform.skip_empty_reports(rows), LEGACY_HEADERS)
    title = F.col("title")
    tagged = wide.withColumns(
        {
            "State": text.history_title(title, "state"),
            "Month": text.history_title(title, "month"),
            "Year": text.history_title(title, "year"),
            "Day": F.lit(1),
        }
    )
    dated = tagged.withColumn("Date", F.concat_ws("/", F.lit("1"), "Month", "Year"))
    enriched = conform.default_dimensions(conform.enrich_class(dated, mapping, STATE))
    named = conform.normalize_state(enriched, LEGACY_STATE_SPELLINGS)
    renamed = named.select(
        [F.col(source).alias(column) for source, column in legacy_columns().items()]
    )
    return renamed.withColumns(
        {
            "date": dates.report_date_text(F.col("date")),
            "month": dates.month_number(F.col("month")),
        }
    )


def history_state_tree(
    spark: SparkSession, root: str, mapping: DataFrame, pattern: str = "*.xlsx"
) -> DataFrame:
    """The legacy state files below a folder; an invalid one, such as one of zero length, fails."""
    return history_state_preprocess(read_listed(list_folder(spark, root, pattern), root), mapping)


_UNIT = ["State", "Year", "Month"]


def load_history(
    spark: SparkSession,
    root: str,
    mapping: DataFrame,
    fact_path: str,
    grain: Grain,
    months: Sequence[tuple[str, str]],
    states: Sequence[str] | None = None,
    journal: str | None = None,
) -> tuple[int, int]:
    """Load the reports of a range of (year, month label) pairs in one upsert; returns the numbers of
    state months and of rows loaded.

    Only folders of the range are listed and only their files are opened, so that broken ones elsewhere
    do no harm. With a journal, a folder, state months whose files have the same
    paths, lengths and times as when they were loaded are left out; months that fail are not noted,
    and run again.
    """
    listed = list_reports(spark, root, grain, sorted({y for y, _ in months}), sorted({m for _, m in months}), states)
    listed = in_months(listed, months)
    mark = F.xxhash64("path", "length", "modified").cast("decimal(20,0)")
    with load.set_aside(listed, "listed") as files:
        units = files.groupBy(*_UNIT).agg(F.count("*").alias("files"), F.sum(mark).alias("mark"))
        todo = units.withColumn("grain", F.lit(grain.name))
        if journal:
            done = _read_journal(spark, journal, todo.schema)
            todo = todo.join(done, todo.columns, "left_anti")
        with load.set_aside(todo, "todo") as chosen:
            count = chosen.count()
            if not count:
                return 0, 0
            wanted = files.join(chosen, _UNIT, "left_semi")
            frame = preprocess_rows(read_listed(wanted, root, empty_cells=False), mapping, grain)
            rows = load.load_fact(fact_path, load.stage_load(frame, grain.columns), grain)
            if journal:
                chosen.coalesce(1).write.mode("append").parquet(journal)
    return count, rows


def _read_journal(spark: SparkSession, path: str, schema) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
