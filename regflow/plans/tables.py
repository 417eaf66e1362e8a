"""Refreshing stored curated tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from regflow.operators import curate, load, versions
from regflow.schema import MEASURES, Grain
from regflow.session import require_ansi

#: Partition column of stored curated tables.
DAY = "date"


class DuplicateKeys(ValueError):
    """A refresh was refused because of repeated unique keys; the table is as it was."""


@dataclass(frozen=True)
class Refresh:
    """Facts read, of these curated and set apart, and curated rows whose key occurs again."""

    read: int
    curated: int
    quarantined: int
    repeated: int


def read_curated(spark: SparkSession, path: str, grain: Grain) -> DataFrame:
    """A stored curated table as its newest refresh left it; empty before the first."""
    return versions.read(spark, path, DAY, curate.curated_schema(grain))


def refresh_curated(
    spark: SparkSession,
    fact_path: str,
    curated_path: str,
    grain: Grain,
    as_of: Column,
    districts: DataFrame | None = None,
    full: bool = False,
    quarantine: str | None = None,
    duplicates: str | None = None,
) -> Refresh:
    """Bring a stored curated table, partitioned by date, up to its stored facts.

    The incremental run reads the fact periods of its window only and rewrites the
    curated dates found there. `full` rebuilds the table from all facts. Either
    becomes visible in one step.

    A fact that does not parse fails the run; with `quarantine`, a folder, such facts are
    written there with the names of their bad columns, and the others go on: each fact is then
    parsed once, and one scan writes both kinds. `duplicates` is `refuse`, to leave the table as it was when a unique
    key would occur twice, or a folder where the keys that do are listed.
    """
    require_ansi(spark)
    fact = load.read_fact(spark, fact_path, grain)
    rows = fact if full else curate.incremental_window(fact, as_of)
    numbers = Observation()
    if quarantine:
        parsed = curate.parse(rows).withColumn("good", F.size("bad_columns") == 0)
        # Text that has been parsed is not written again.
        spared = {c: F.expr(f"if(good, null, `{c}`)") for c in (*MEASURES, "year", "month", "day")}
        parsed = parsed.withColumns(spared).observe(
            numbers, F.count("*").alias("read"), F.count_if("good").alias("good")
        )
        with load.set_aside(parsed, "parsed") as checked:
            bad = checked.filter("not good").drop("typed", "good", load.PERIOD)
            bad.write.mode("overwrite").parquet(quarantine)
            fresh = curate.curate_parsed(checked.filter("good"), grain, districts)
            repeated = _publish(spark, curated_path, fresh, grain, full, duplicates)
        seen = numbers.get
        return Refresh(seen["read"], seen["good"], seen["read"] - seen["good"], repeated)
    fresh = curate.curate(rows.observe(numbers, F.count("*").alias("read")), grain, districts)
    if full and not duplicates:
        _publish(spark, curated_path, fresh, grain, full, duplicates)
        repeated = 0
    else:
        with load.set_aside(fresh, "curated") as kept:
            repeated = _publish(spark, curated_path, kept, grain, full, duplicates)
    read = numbers.get["read"]
    return Refresh(read, read, 0, repeated)


def _publish(
    spark: SparkSession, path: str, rows: DataFrame, grain: Grain, full: bool, duplicates: str | None
) -> int:
    base = versions.current(spark, path, DAY)
    touched = [] if full else load.touched_partitions(rows, DAY)
    if not full and not touched:
        return 0
    old = versions.read(spark, path, DAY, curate.curated_schema(grain), base, touched).select(rows.columns)
    if duplicates:
        return _publish_counted(path, old, rows, grain, base, None if full else touched, duplicates)
    merged = rows if full else curate.upsert_curated(old, rows, grain)
    versions.replace(merged, path, DAY, base, None if full else touched)
    return 0


def _publish_counted(path, old, rows, grain, base, touched, duplicates: str) -> int:
    numbers = Observation()
    merged = curate.merge_counted(old, rows, grain).observe(
        numbers, F.count_if(F.col("copies") > 1).alias("repeated")
    )

    def check(load_path: str) -> None:
        """Looks at the keys only when the merge has seen repeated ones."""
        repeated = numbers.get["repeated"]
        if duplicates == "refuse":
            if repeated:
                raise DuplicateKeys(f"{repeated} rows share unique keys; {path} is unchanged")
            return
        written = rows.sparkSession.read.schema(rows.schema).parquet(load_path)
        listed = curate.duplicate_keys(written if repeated else written.limit(0), grain.curated_key)
        listed.write.mode("overwrite").parquet(duplicates)

    versions.replace(merged.drop("copies"), path, DAY, base, touched, check)
    return numbers.get["repeated"]
