"""Typed tables derived from the facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regflow.functions import dates, numbers
from regflow.operators.keys import anti_join, computed_once, match_key, text_key
from regflow.operators.load import PERIOD
from regflow.schema import MEASURES, Grain
from regflow.session import require_ansi

_DATE_PARTS = ("year", "month", "day")


def incremental_window(fact: DataFrame, as_of: Column) -> DataFrame:
    """Rows dated on or after the first day of the month before `as_of`.

    A stored fact table filters on its partition column, so older months are not read.
    Rows stored without a period but with a date have a bad one: they are kept, so that
    curating them fails as it does elsewhere.
    """
    start = dates.previous_month_start(as_of)
    if PERIOD not in fact.columns:
        return fact.filter(dates.report_date(F.col("date")) >= start)
    unread = F.col(PERIOD).isNull() & F.col("date").isNotNull()
    return fact.filter((F.col(PERIOD) >= start) | unread)


def join_district(fact: DataFrame, districts: DataFrame) -> DataFrame:
    """Left join to (rto_code, district); a code listed twice doubles the row."""
    lookup = districts.select(text_key(F.col("rto_code")).alias("district_key"), "district")
    keyed = fact.withColumn("office_key", text_key(F.col("rto_code")))
    joined = keyed.join(lookup, F.col("office_key") == F.col("district_key"), "left")
    return joined.drop("office_key", "district_key")


def curate(fact: DataFrame, grain: Grain, districts: DataFrame | None = None) -> DataFrame:
    """Typed projection; a value that does not parse fails the job."""
    require_ansi(fact.sparkSession)
    if grain.name == "rto":
        fact = join_district(fact, districts)
    columns = [f"cast({c} as int) as {c}" for c in _DATE_PARTS]
    columns.append(f"{dates.REPORT_DATE_SQL} as date")
    columns += [f"substring({c}, 1, {width}) as {name}" for c, name, width in grain.curated_text]
    columns += [f"{numbers.parse_count_sql(c)} as {c}" for c in MEASURES]
    return fact.selectExpr(*columns, "inserted_at")


def _parsed() -> tuple[dict[str, str], str]:
    """SQL of each typed value, NULL where it does not parse, and of the names of those columns, joined by commas."""
    # Text with a letter is no number: a failed cast makes an exception, which costs more than the cast.
    parsed = {c: f"case when not {c} rlike '[A-Za-z]' then try_cast({c} as int) end" for c in _DATE_PARTS}
    parsed["date"] = dates.TRY_REPORT_DATE_SQL
    parsed |= {c: numbers.try_parse_count_sql(c) for c in MEASURES}
    checks = [f"if({c} is not null and typed.{c} is null, '{c}', null)" for c in parsed]
    return parsed, f"concat_ws(',', {', '.join(checks)})"


def parse(fact: DataFrame) -> DataFrame:
    """Facts with `typed`, a struct of the parsed values, and `bad_columns`, those that do not."""
    parsed, faults = _parsed()
    typed = ", ".join(f"'{c}', {sql}" for c, sql in parsed.items())
    checked = fact.withColumn("typed", F.expr(f"named_struct({typed})")).withColumn("bad_columns", F.expr(faults))
    # Both are used in filters: `array_compact` has no generated code, and with it all of its input is interpreted.
    listed = F.expr("if(bad_columns = '', array(), split(bad_columns, ','))")
    return computed_once(checked, ["typed", "bad_columns"]).withColumn("bad_columns", listed)


def quarantine(fact: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split into rows that `curate` accepts and rows it would fail on, with the reason."""
    checked = parse(fact).drop("typed")
    good = F.size("bad_columns") == 0
    return checked.filter(good).drop("bad_columns"), checked.filter(~good)


def curate_parsed(good: DataFrame, grain: Grain, districts: DataFrame | None = None) -> DataFrame:
    """What `curate` gives, from rows of `parse` without bad columns."""
    if grain.name == "rto":
        good = join_district(good, districts)
    columns = [f"typed.{c} as {c}" for c in (*_DATE_PARTS, "date")]
    columns += [f"substring({c}, 1, {width}) as {name}" for c, name, width in grain.curated_text]
    columns += [f"typed.{c} as {c}" for c in MEASURES]
    return good.selectExpr(*columns, "inserted_at")


def curated_schema(grain: Grain) -> str:
    names = [f"{c} int" for c in _DATE_PARTS] + ["date date"]
    names += [f"{name} string" for _, name, _ in grain.curated_text]
    return ", ".join([*names, *(f"{c} int" for c in MEASURES), "inserted_at timestamp"])


def duplicate_keys(curated: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Unique-key values that occur more than once, with their count."""
    return (
        curated.groupBy(*keys).agg(F.count("*").alias("rows")).filter(F.col("rows") > 1)
    )


def upsert_curated(curated: DataFrame, new_rows: DataFrame, grain: Grain) -> DataFrame:
    """Rows of `curated` with the unique key of a new row give way to the new rows."""
    return anti_join(curated, new_rows, grain.curated_key).unionByName(new_rows)


def merge_counted(curated: DataFrame, new_rows: DataFrame, grain: Grain) -> DataFrame:
    """What `upsert_curated` gives, with `copies`, the number of rows that share a row's key.

    Old and new rows meet in one exchange by key, which replaces the rows and counts them. A key
    with a NULL part equals no other, so such rows are spread by a number of their own.
    """
    both = curated.withColumn("fresh", F.lit(0)).unionByName(new_rows.withColumn("fresh", F.lit(1)))
    keyed = both.withColumn("merge_key", match_key(both, grain.curated_key)).withColumn(
        "alone", F.when(F.col("merge_key").isNull(), F.monotonically_increasing_id())
    )
    same = Window.partitionBy("merge_key", "alone")
    newest = keyed.withColumns({"newest": F.max("fresh").over(same), "added": F.sum("fresh").over(same), "all": F.count("*").over(same)})
    copies = F.when(F.col("newest") == 1, F.col("added")).otherwise(F.col("all"))
    return newest.filter("fresh = newest").withColumn("copies", copies).select(*curated.columns, "copies")
