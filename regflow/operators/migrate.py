"""Backup, schema evolution, repair, backfill and reconciliation."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regflow.functions.text import blank_to_null
from regflow.operators.keys import key_parts, match_key
from regflow.schema import ADDED_MEASURES, REPLACED_MEASURES, Grain


def snapshot_backup(table: DataFrame, path: str) -> DataFrame:
    """Copy a table to `path` and return the copy; an existing backup is never overwritten."""
    table.write.mode("errorifexists").parquet(path)
    return read_backup(table.sparkSession, path)


def read_backup(spark: SparkSession, path: str) -> DataFrame:
    """A backup that must exist."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"nothing to restore from: no backup at {path}") from error


def project_if_exists(legacy: DataFrame, grain: Grain) -> DataFrame:
    """Current columns from an older table: added measures it lacks become NULL.

    Any other column must be there.
    """
    present = set(legacy.columns)
    absent = [c for c in grain.columns if c not in present and c not in ADDED_MEASURES]
    if absent:
        raise ValueError(f"backup of {grain.fact_table} lacks required columns: {absent}")
    stamped = legacy.withColumn("inserted_at", first_existing_timestamp(legacy))
    return stamped.selectExpr(
        *[c if c in present else f"cast(null as string) as {c}" for c in grain.columns],
        "inserted_at",
    )


def first_existing_timestamp(legacy: DataFrame, now: Column | None = None) -> Column:
    """`inserted_at`, else `insert_date`, else now: by presence of the column, not per row."""
    for name in ("inserted_at", "insert_date"):
        if name in legacy.columns:
            return F.col(name)
    return F.current_timestamp() if now is None else now


def null_repair(fact: DataFrame, backup: DataFrame) -> DataFrame:
    """Empty a measure when the backup knew only the older column it replaced."""
    columns = set(backup.columns)
    emptied = {
        measure: F.lit(None).cast("string")
        for measure, older in REPLACED_MEASURES.items()
        if measure not in columns and older in columns
    }
    return fact.withColumns(emptied) if emptied else fact


def repair_check(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table that still hold a value in a repaired measure."""
    held = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in REPLACED_MEASURES])
    return _stack(
        frame.filter(held).agg(F.count("*").alias("non_null_rows")).select(
            F.lit(name).alias("table_name"), "non_null_rows"
        )
        for name, frame in tables.items()
    )


def reconcile_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table."""
    return _stack(
        frame.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, frame in tables.items()
    )


def _stack(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _legacy_values(backup: DataFrame, grain: Grain) -> DataFrame:
    """Smallest usable legacy value per key. Rows with a NULL key part match nothing."""
    parts = key_parts(backup, grain.backfill_key)
    usable = backup.selectExpr(
        *[f"{part} as k{i}" for i, part in enumerate(parts.values())],
        "nullif(trim(electric_vehicles), '') as value",
    ).dropna()
    names = [f"k{i}" for i in range(len(parts))]
    smallest = usable.groupBy(*names).agg(F.min("value").alias("legacy_value"))
    return smallest.select(F.struct(*names).alias("legacy_key"), "legacy_value")


def backfill_electric(fact: DataFrame, backup: DataFrame, grain: Grain) -> DataFrame:
    """Fill NULL `electric_bov` from the backup's older column; adds `backfilled`.

    A second run changes nothing. Of several backup rows with one key the smallest
    value is taken, so that results repeat.

    The aggregation is partitioned by the key parts and the join by the whole key. So
    the join has an exchange of its own on both sides, and AQE can split a hot key.
    """
    if "electric_vehicles" not in backup.columns:
        return fact.withColumn("backfilled", F.lit(False))
    keyed = fact.withColumn("fact_key", match_key(fact, grain.backfill_key))
    values = _legacy_values(backup, grain)
    joined = keyed.join(values, F.col("fact_key") == F.col("legacy_key"), "left")
    filled = F.col("electric_bov").isNull() & F.col("legacy_value").isNotNull()
    value = F.coalesce("electric_bov", "legacy_value")
    flagged = joined.withColumns({"backfilled": filled, "electric_bov": value})
    return flagged.select(*fact.columns, "backfilled")


def backfill_counts(results: dict[str, DataFrame]) -> DataFrame:
    """Rows changed per table by `backfill_electric`."""
    return _stack(
        frame.agg(F.count_if("backfilled").alias("electric_bov_rows_updated")).select(
            F.lit(name).alias("table_name"), "electric_bov_rows_updated"
        )
        for name, frame in results.items()
    )


def backfill_dates(backup: DataFrame) -> DataFrame:
    """Dates with a usable legacy value: the partitions a backfill rewrites."""
    usable = blank_to_null(F.col("electric_vehicles")).isNotNull()
    return backup.filter(usable).select("date").distinct()
