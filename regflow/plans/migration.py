"""Schema migration of a fact table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regflow.functions.dates import try_report_date
from regflow.operators import load, migrate, versions
from regflow.operators.load import PERIOD
from regflow.schema import REPLACED_MEASURES, Grain


@dataclass(frozen=True)
class Migration:
    backup: DataFrame
    fact: DataFrame
    counts: DataFrame


def _evolve(backup: DataFrame, grain: Grain) -> Migration:
    fact = migrate.project_if_exists(backup, grain)
    counts = migrate.reconcile_counts(
        {f"{grain.fact_table}_backup": backup, grain.fact_table: fact}
    )
    return Migration(backup, fact, counts)


def migrate_schema(legacy: DataFrame, grain: Grain, backup_path: str) -> Migration:
    """Back up, project to the current columns and count both; stops if a backup exists.

    The caller makes `fact` current after checking `counts`, so a failure leaves the
    old table as it was.
    """
    return _evolve(migrate.snapshot_backup(legacy, backup_path), grain)


def resume_from_backup(spark: SparkSession, grain: Grain, backup_path: str) -> Migration:
    """Rebuild a fact table from a backup that is already there."""
    return _evolve(migrate.read_backup(spark, backup_path), grain)


class CountsDiffer(RuntimeError):
    """A migrated table does not have the rows of its backup; the old table stays current."""


STEPS = ("backup", "project", "count", "switch")


def migrate_table(spark: SparkSession, path: str, grain: Grain, backup_path: str) -> list[str]:
    """Bring a stored fact table to the current columns; returns the steps that this run did.

    The steps are a backup, the projection into a load that nobody reads yet, the comparison
    of row counts for every date, and the switch of the table to that load. Each step leaves a
    note in `<backup_path>_journal` when it is done, and a run goes on after the last note. So a run that
    was stopped is continued by the next, counts that differ stop every run, and a run after
    the switch does nothing. A table that was loaded after its backup is not switched.
    """
    journal, done, notes = f"{backup_path.rstrip('/')}_journal", [], {}

    def step(name: str, work: Callable[[], dict]) -> None:
        if f"{name}.json" in versions.names_in(spark, journal):
            notes[name] = versions.read_json(spark, f"{journal}/{name}.json")
            return
        notes[name] = work()
        versions.write_json(spark, f"{journal}/{name}.json", notes[name])
        done.append(name)

    def back_up() -> dict:
        base = versions.current(spark, path, PERIOD)
        table = versions.read(spark, path, PERIOD, version=base)
        # Spark marks a folder that it wrote to the end.
        whole = "_SUCCESS" in versions.names_in(spark, backup_path)
        if not whole:
            table.write.mode("overwrite").parquet(backup_path)
        rows = migrate.read_backup(spark, backup_path).count()
        if whole and rows != table.count():
            raise CountsDiffer(f"the backup at {backup_path} is not one of {path}")
        return {"rows": rows, "version": base.number}

    def project() -> dict:
        fact = migrate.project_if_exists(migrate.read_backup(spark, backup_path), grain)
        name = versions.new_load()
        parts = versions.write_load(load.with_period(fact), path, PERIOD, name)
        return {"load": name, "parts": parts}

    def new_version() -> versions.Version:
        parts = dict.fromkeys(notes["project"]["parts"], notes["project"]["load"])
        return versions.Version(notes["backup"]["version"] + 1, parts)

    def count() -> dict:
        new = versions.read(spark, path, PERIOD, load.fact_schema(grain), new_version())
        differ = date_counts_differ(migrate.read_backup(spark, backup_path), new)
        found = differ.limit(20).collect()
        if found:
            shown = ", ".join(f"{r.date}: {r.before} and {r.after}" for r in found)
            raise CountsDiffer(f"rows by date, backup and migrated: {shown}")
        return {"rows": new.count()}

    def switch() -> dict:
        base, wanted = versions.current(spark, path, PERIOD), new_version()
        # A run that stopped between the switch and its note has already switched.
        if base != wanted:
            if base.number != notes["backup"]["version"]:
                raise versions.TableChanged(f"{path} was loaded after its backup; migrate again with a new one")
            versions.commit(spark, path, wanted, base)
        return {"version": wanted.number}

    for name, work in zip(STEPS, (back_up, project, count, switch), strict=True):
        step(name, work)
    return done


def date_counts_differ(before: DataFrame, after: DataFrame) -> DataFrame:
    """Dates with different numbers of rows: date, before, after."""

    def signed(frame: DataFrame, old: int, new: int) -> DataFrame:
        return frame.select("date", F.lit(old).alias("old"), F.lit(new).alias("new"))

    both = signed(before, 1, 0).unionByName(signed(after, 0, 1))
    counts = both.groupBy("date").agg(F.sum("old").alias("before"), F.sum("new").alias("after"))
    return counts.filter("before <> after")


def backfill_table(spark: SparkSession, path: str, grain: Grain, backup_path: str) -> list[str]:
    """Fill `electric_bov` of a stored fact table from its backup; returns the periods rewritten.

    Only periods with a usable value in the backup are read, and of these only those in which
    a row changes are written, all in one step. A second run writes nothing.
    """
    backup = migrate.read_backup(spark, backup_path)
    if "electric_vehicles" not in backup.columns:
        return []
    periods = migrate.backfill_dates(backup).select(try_report_date(F.col("date")).alias("period")).distinct()
    only = [versions.part_name(PERIOD, row.period) for row in periods.collect()]
    return versions.rewrite_changed(
        spark,
        path,
        PERIOD,
        load.fact_schema(grain),
        lambda fact: migrate.backfill_electric(fact, backup, grain).drop("backfilled"),
        only,
    )


def repair_table(spark: SparkSession, path: str, grain: Grain, backup_path: str) -> list[str]:
    """Empty the replaced measures of a stored fact table, as `migrate.null_repair` does; returns
    the periods rewritten, which are those that held a value. A second run writes nothing."""
    backup = migrate.read_backup(spark, backup_path).limit(0)
    rewritten = versions.rewrite_changed(
        spark, path, PERIOD, load.fact_schema(grain), lambda fact: migrate.null_repair(fact, backup)
    )
    left = migrate.repair_check({grain.fact_table: load.read_fact(spark, path, grain)}).first()
    known = set(backup.columns)
    emptied = all(m not in known and old in known for m, old in REPLACED_MEASURES.items())
    if emptied and left.non_null_rows:
        raise RuntimeError(f"{left.non_null_rows} rows of {path} still hold a repaired measure")
    return rewritten
