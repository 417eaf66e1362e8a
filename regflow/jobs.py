"""Command line of the jobs: `python -m regflow.jobs <job> --grain rto ...`

The month defaults to the one before the current date.
"""

from __future__ import annotations

import argparse
import re
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regflow.functions import text
from regflow.operators import archive, conform, coverage, load, versions
from regflow.plans import migration, monthly, tables
from regflow.schema import GRAINS, MONTHS, OEM, STATE, Grain
from regflow.session import get_session
from regflow.sources import dimensions, reports, staging
from regflow.sources.tree import in_months, list_folder, list_reports


def previous_month(today: date) -> tuple[str, str]:
    last = today.replace(day=1) - timedelta(days=1)
    return MONTHS[last.month - 1], str(last.year)


def month_and_year(args: argparse.Namespace) -> tuple[str, str]:
    """The month of the arguments, or the previous one when they name none."""
    if not args.month and not args.year:
        return previous_month(date.today())
    month, year = str(args.month or "").strip().upper(), str(args.year or "").strip()
    if month not in MONTHS or not re.fullmatch("[0-9]{4}", year):
        raise ValueError(f"give --month as one of {' '.join(MONTHS)} together with a --year")
    return month, year


def month_range(args: argparse.Namespace) -> list[tuple[str, str]]:
    """(year, month label) of every month from --first to --last, both included."""
    ends = []
    for name in ("first", "last"):
        found = re.fullmatch("([0-9]{4})-(0[1-9]|1[0-2])", str(getattr(args, name) or ""))
        if not found:
            raise ValueError(f"give --{name} as a month such as 2013-01")
        ends.append(int(found[1]) * 12 + int(found[2]) - 1)
    if ends[0] > ends[1]:
        raise ValueError("a range of months cannot end before it starts")
    return [(str(n // 12), MONTHS[n % 12]) for n in range(ends[0], ends[1] + 1)]


def state_folders(spark: SparkSession, args: argparse.Namespace) -> list[str] | None:
    """The folders of the states asked for, which may be named by label or by folder."""
    if not args.states:
        return None
    listed = coverage.state_list(spark)
    rows = listed.select("state", text.state_folder(F.col("state")).alias("folder")).collect()
    folders = {name: row.folder for row in rows for name in (row.state, row.folder)}
    unknown = [name for name in args.states if name not in folders]
    if unknown:
        raise ValueError(f"unknown states: {', '.join(unknown)}")
    return [folders[name] for name in args.states]


@contextmanager
def month_rows(
    spark: SparkSession, args: argparse.Namespace, grain: Grain
) -> Iterator[DataFrame]:
    """Sheet rows of a month's reports, parsed once and set aside for all that use them."""
    month, year = month_and_year(args)
    listed = list_reports(spark, args.reports, grain, [year], [month], state_folders(spark, args))
    rows = reports.read_listed(listed, args.reports)
    with load.set_aside(rows, "rows") as kept:
        yield kept


def write_month(
    spark: SparkSession, args: argparse.Namespace, grain: Grain, rows: DataFrame
) -> tuple[str, DataFrame]:
    """Monthly CSV of the rows, and below `--out` the run's summary and unknown headers.
    Returns the CSV's path and the preprocessed frame."""
    month, year = month_and_year(args)
    frame = monthly.preprocess_rows(rows, dimensions.load_mapping(spark, args.mapping), grain)
    path = staging.write_monthly_csv(frame, args.csv, grain, month, year)
    if args.out:
        tagged = reports.path_dimensions(rows, grain)
        lists = {
            "summary": conform.preprocess_summary(tagged, ["State", "Year"]),
            "unexpected_columns": conform.unexpected_columns(rows, grain),
            "drift": conform.header_drift(tagged, grain, ["State", "Year", "Month"]),
        }
        for name, found in lists.items():
            target = f"{args.out.rstrip('/')}/{name}"
            found.write.mode("overwrite").option("header", True).csv(target)
    return path, frame


def preprocess(spark: SparkSession, args: argparse.Namespace, grain: Grain) -> str:
    """Reports of a month -> monthly CSV; returns its path."""
    with month_rows(spark, args, grain) as rows:
        return write_month(spark, args, grain, rows)[0]


def load_csv(spark: SparkSession, args: argparse.Namespace, grain: Grain) -> int:
    """Monthly CSV -> fact table; returns the number of staged rows."""
    path = f"{args.csv.rstrip('/')}/{staging.csv_name(grain, *month_and_year(args))}"
    hint = f"the {grain.name} preprocess job"
    rows = staging.read_csv_stage(spark, path, hint, grain.columns)
    return load.load_fact(args.fact, load.stage_load(rows, grain.columns), grain)


def curate(spark: SparkSession, args: argparse.Namespace, grain: Grain) -> None:
    districts = spark.read.parquet(args.districts) if args.districts else None
    today = F.lit(args.as_of).cast("date") if args.as_of else F.current_date()
    done = tables.refresh_curated(
        spark,
        args.fact,
        args.curated,
        grain,
        today,
        districts,
        args.full_refresh,
        args.quarantine,
        args.duplicates,
    )
    print(
        f"facts read: {done.read}, curated: {done.curated}, in quarantine: {done.quarantined}, "
        f"rows with a repeated key: {done.repeated}"
    )


def expected_reports(spark: SparkSession, args: argparse.Namespace, grain: Grain) -> DataFrame:
    month, year = month_and_year(args)
    months = F.expr(f"array(date'{year}-{MONTHS.index(month) + 1:02d}-01')")
    states = coverage.state_list(spark)
    wanted = state_folders(spark, args)
    if wanted:
        states = states.filter(text.state_folder(F.col("state")).isin(wanted))
    root = args.reports.rstrip("/")
    if grain is STATE:
        return coverage.expected_grid_state(states, months, grain, root)
    if grain is OEM:
        return coverage.expected_grid_oem(states, expected_classes(spark, args), months, grain, root)
    offices = dimensions.load_office_map(spark, args.offices, strict=True)
    return coverage.expected_grid_rto(states, offices, months, grain, root)


def expected_classes(spark: SparkSession, args: argparse.Namespace) -> Column:
    """The vehicle classes of the arguments, else those of the mapping."""
    if args.classes:
        return F.array(*[F.lit(name) for name in args.classes])
    if not args.mapping:
        raise ValueError("the oem grain needs --classes or --mapping to know what to expect")
    mapping = dimensions.load_mapping(spark, args.mapping)
    return mapping.agg(F.array_sort(F.collect_set("Vehicle Class"))).scalar()


def found_reports(spark: SparkSession, args: argparse.Namespace, grain: Grain) -> DataFrame:
    """A month's files with their validity; paths begin with the root as it was given."""
    month, year = month_and_year(args)
    listed = list_reports(spark, args.reports, grain, [year], [month], state_folders(spark, args))
    return reports.check_listed(listed, args.reports)


def missing(spark: SparkSession, args: argparse.Namespace, grain: Grain) -> DataFrame:
    """Expected reports of a month without a valid file."""
    return coverage.missing_reports(
        expected_reports(spark, args, grain), found_reports(spark, args, grain)
    )


def report_missing(spark: SparkSession, args: argparse.Namespace, grain: Grain) -> None:
    """Write the whole list of missing reports, the counts per state and the malformed labels
    below `--out`, and print their number."""
    if not args.out:
        raise ValueError("give --out, the folder of the lists")
    out = args.out.rstrip("/")
    expected = expected_reports(spark, args, grain)
    # Every file is opened and checked once, for all lists.
    with load.set_aside(found_reports(spark, args, grain), "found") as found:
        written = {
            "missing": coverage.missing_reports(expected, found).select("path"),
            "summary": coverage.coverage_summary(expected, found),
            "plan": coverage.redownload_plan(expected, found, args.force).select("path", "action"),
        }
        if "office_label" in expected.columns:
            written["malformed"] = coverage.malformed_labels(expected).select("state", "office_label")
        for name, frame in written.items():
            frame.write.mode("overwrite").option("header", True).csv(f"{out}/{name}")
    count = spark.read.option("header", True).schema("path string").csv(f"{out}/missing").count()
    print(f"missing reports: {count}, listed in {out}/missing")


def archive_month(spark: SparkSession, args: argparse.Namespace, grain: Grain) -> int:
    """Copy raw reports below the archive and return their number: those of a month and its CSV, or
    with --first and --last those of a range of months. With --out, the list of copies is written."""
    if args.first or args.last:
        months = month_range(args)
    else:
        month, year = month_and_year(args)
        months = [(year, month)]
    years, names = sorted({y for y, _ in months}), sorted({m for _, m in months})
    listed = list_reports(spark, args.reports, grain, years, names, state_folders(spark, args), "*.xlsx")
    copies = archive.copy_listed(in_months(listed, months), args.reports, args.archive)
    with load.set_aside(copies, "copies") as copied:
        if args.out:
            target = f"{args.out.rstrip('/')}/archived"
            copied.write.mode("overwrite").option("header", True).csv(target)
        count = copied.count()
    if args.csv and len(months) == 1:
        folder = f"{args.csv.rstrip('/')}/{staging.csv_name(grain, months[0][1], months[0][0])}"
        parts = list_folder(spark, folder, "*.csv")
        archive.copy_listed(parts, args.csv, args.archive).write.format("noop").mode("overwrite").save()
    return count


def history(spark: SparkSession, args: argparse.Namespace, grain: Grain) -> str:
    """Load a range of months from the tree in one upsert; months that the journal beside the
    fact table lists as loaded, with the same files, are left out."""
    mapping = dimensions.load_mapping(spark, args.mapping)
    journal = f"{args.fact.rstrip('/')}_history"
    units, rows = monthly.load_history(
        spark,
        args.reports,
        mapping,
        args.fact,
        grain,
        month_range(args),
        state_folders(spark, args),
        None if args.force else journal,
    )
    return f"state months: {units}, rows: {rows}"


def migrate(spark: SparkSession, args: argparse.Namespace, grain: Grain) -> str:
    """Bring the fact table to the current columns, by way of a backup."""
    done = migration.migrate_table(spark, args.fact, grain, args.backup)
    return f"steps done: {', '.join(done) or 'none'}"


def backfill(spark: SparkSession, args: argparse.Namespace, grain: Grain) -> str:
    return _rewritten(migration.backfill_table(spark, args.fact, grain, args.backup))


def repair(spark: SparkSession, args: argparse.Namespace, grain: Grain) -> str:
    return _rewritten(migration.repair_table(spark, args.fact, grain, args.backup))


def _rewritten(periods: list[str]) -> str:
    return "\n".join([f"periods rewritten: {len(periods)}", *periods])


def merge_offices(spark: SparkSession, args: argparse.Namespace, grain: Grain) -> str:
    """Merge freshly collected office labels into the known ones and write both as one JSON document
    per state below --out; a state that no file covers is an error, and nothing is written."""
    if not args.out:
        raise ValueError("give --out, the folder of the merged office map")
    fresh = dimensions.load_office_map(spark, args.fresh_offices, strict=True)
    merged = coverage.merge_office_maps(dimensions.load_office_map(spark, args.offices), fresh)
    bare = coverage.states_without_offices(coverage.state_list(spark), merged)
    # At most as many as there are states.
    names = sorted(row.state for row in bare.collect())
    if names and not args.force:
        raise ValueError(f"states without offices: {', '.join(names)}")
    dimensions.write_office_map(merged, args.out)
    return f"states without offices: {len(names)}"


def sweep(spark: SparkSession, args: argparse.Namespace, grain: Grain) -> str:
    """Remove what stopped jobs left in the stored tables more than two days ago."""
    gone = [name for path in (args.fact, args.curated) if path for name in versions.sweep(spark, path)]
    return f"folders removed: {len(gone)}"


def run(spark: SparkSession, args: argparse.Namespace, grain: Grain) -> None:
    """A month from reports to the curated table; the state grain stops at the facts."""
    with month_rows(spark, args, grain) as rows:
        _, frame = write_month(spark, args, grain, rows)
        staged = load.load_fact(args.fact, load.stage_load(frame, grain.columns), grain)
    print(f"staged rows: {staged}")
    if args.archive:
        print(f"archived reports: {archive_month(spark, args, grain)}")
    if args.curated and grain is not STATE:
        curate(spark, args, grain)


JOBS = {
    "preprocess": preprocess,
    "load": load_csv,
    "curate": curate,
    "archive": archive_month,
    "history": history,
    "migrate": migrate,
    "backfill": backfill,
    "repair": repair,
    "offices": merge_offices,
    "sweep": sweep,
}


def parser() -> argparse.ArgumentParser:
    options = argparse.ArgumentParser(description=__doc__)
    options.add_argument("job", choices=[*JOBS, "missing", "run"])
    options.add_argument("--grain", choices=list(GRAINS), required=True)
    options.add_argument("--month", help="label such as JUN")
    options.add_argument("--year")
    options.add_argument("--states", nargs="*", help="only these states, by label or folder")
    options.add_argument(
        "--classes", nargs="*", default=[], help="expected vehicle classes; default: the mapping's"
    )
    options.add_argument("--reports", help="root of the report tree")
    options.add_argument("--mapping", help="workbook with the vehicle-class mapping")
    options.add_argument("--offices", help="JSON file of office labels per state")
    options.add_argument("--csv", help="folder of the monthly CSV files")
    options.add_argument("--fact", help="path of the fact table")
    options.add_argument("--curated", help="path of the curated table")
    options.add_argument("--districts", help="parquet table (rto_code, district)")
    options.add_argument("--archive", help="URI below which raw reports are copied")
    options.add_argument("--out", help="folder of the lists: missing reports, or a run's summary")
    options.add_argument("--first", help="first month of a range, such as 2013-01")
    options.add_argument("--last", help="last month of a range")
    options.add_argument("--backup", help="path of the copy of a fact table from before a migration")
    options.add_argument("--fresh-offices", help="JSON file of newly collected office labels")
    options.add_argument("--quarantine", help="folder for facts that do not parse; default: they fail the job")
    options.add_argument(
        "--duplicates", help="`refuse`, or a folder that lists unique keys that occur more than once"
    )
    options.add_argument(
        "--force",
        action="store_true",
        help="plan to fetch every report again; load months again; write offices that leave out states",
    )
    options.add_argument("--as-of", help="reference date of the curated window")
    options.add_argument("--full-refresh", action="store_true")
    return options


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    spark = spark or get_session()
    grain = GRAINS[args.grain]
    if args.job == "run":
        run(spark, args, grain)
    elif args.job == "missing":
        report_missing(spark, args, grain)
    else:
        result = JOBS[args.job](spark, args, grain)
        if result is not None:
            print(result)


if __name__ == "__main__":
    main()
