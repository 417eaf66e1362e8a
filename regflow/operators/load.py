"""Staging and replacing fact rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from regflow.functions.dates import try_report_date
from regflow.operators import versions
from regflow.operators.keys import anti_join
from regflow.schema import Grain
from regflow.session import remove_path, work_path

# Partition column of stored fact tables: the report date as a DATE.
PERIOD = "period"


def stage_load(
    rows: DataFrame, columns: Sequence[str], inserted_at: Column | None = None
) -> DataFrame:
    """All columns as text, empty text as NULL, plus the load time."""
    stamp = F.current_timestamp() if inserted_at is None else inserted_at
    kinds = {field.name: field.dataType for field in rows.schema}
    # Plain conditionals: `nullif` would add a second projection of every column.
    texts = [
        f"if(`{c}` = '', null, `{c}`) as `{c}`"
        if isinstance(kinds[c], StringType)
        else f"cast(`{c}` as string) as `{c}`"
        for c in columns
    ]
    return rows.selectExpr(texts).withColumn("inserted_at", stamp)


def delete_staged(fact: DataFrame, stage: DataFrame, grain: Grain) -> DataFrame:
    """Fact rows whose load key is not staged. Rows with a NULL key part always stay."""
    return anti_join(fact, stage, grain.load_key)


def upsert_fact(fact: DataFrame, stage: DataFrame, grain: Grain) -> DataFrame:
    """New fact contents: staged keys replaced, all staged rows appended."""
    return delete_staged(fact, stage, grain).unionByName(stage)


def with_period(frame: DataFrame) -> DataFrame:
    return frame.withColumn(PERIOD, try_report_date(F.col("date")))


def fact_schema(grain: Grain) -> str:
    text = ", ".join(f"`{c}` string" for c in grain.columns)
    return f"{text}, inserted_at timestamp, {PERIOD} date"


def read_fact(spark: SparkSession, path: str, grain: Grain) -> DataFrame:
    """A stored fact table as its newest load left it; empty before the first."""
    return versions.read(spark, path, PERIOD, fact_schema(grain))


@contextmanager
def set_aside(frame: DataFrame, label: str) -> Iterator[DataFrame]:
    """The frame, written to the shared work folder and read back. The folder goes when the
    block ends."""
    spark = frame.sparkSession
    path = work_path(spark, label)
    try:
        frame.write.parquet(path)
        yield spark.read.schema(frame.schema).parquet(path)
    finally:
        remove_path(spark, path)


def merge_partitions(
    path: str,
    fresh: DataFrame,
    partition: str,
    merge: Callable[[DataFrame, DataFrame], DataFrame],
) -> int:
    """Merge rows into a stored table, partition by partition; returns their number.

    `fresh` decides which partitions are read and rewritten. All of them change in one step
    (`versions`), so a reader or a job that fails half way sees the old table whole. Merged with
    nothing, the new rows stay as they are: a first load writes them once, and does not merge.
    """
    spark = fresh.sparkSession
    if not versions.current(spark, path, partition).parts:
        return _first_load(path, fresh, partition)
    with set_aside(fresh, "fresh") as rows:
        return _merge_stored(path, rows, partition, merge)


def _first_load(path: str, fresh: DataFrame, partition: str) -> int:
    numbers = Observation()
    base = versions.current(fresh.sparkSession, path, partition)
    versions.replace(fresh.observe(numbers, F.count("*").alias("rows")), path, partition, base)
    return numbers.get["rows"]


def touched_partitions(fresh: DataFrame, partition: str) -> list[str]:
    """The partition folders that rows belong to. There are no more of them than partitions to
    rewrite, which the driver lists in any case."""
    values = fresh.select(partition).distinct().collect()
    return [versions.part_name(partition, row[0]) for row in values]


def _merge_stored(
    path: str,
    fresh: DataFrame,
    partition: str,
    merge: Callable[[DataFrame, DataFrame], DataFrame],
) -> int:
    spark = fresh.sparkSession
    rows = fresh.count()
    if rows == 0:
        return 0
    base = versions.current(spark, path, partition)
    touched = touched_partitions(fresh, partition)
    old = versions.read(spark, path, partition, fresh.schema, base, touched)
    versions.replace(merge(old, fresh), path, partition, base, touched)
    return rows


def load_fact(path: str, stage: DataFrame, grain: Grain) -> int:
    """Upsert a stage into a stored fact table, partitioned by period.

    Every load key holds the date, so no other period can change.
    """
    staged = with_period(stage.select(*grain.columns, "inserted_at"))
    return merge_partitions(path, staged, PERIOD, lambda old, new: upsert_fact(old, new, grain))
