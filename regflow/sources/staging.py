"""Monthly CSV hand-off: write, pick and read back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regflow.functions.dates import month_name
from regflow.schema import Grain
from regflow.sources.csv_split import RANGE, read_csv

# Doubled quotes inside quoted text, blanks kept as they are, empty text for NULL.
_CSV = {"header": True, "quote": '"', "escape": '"'}
CSV_WRITE = _CSV | {
    "nullValue": "",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def csv_name(grain: Grain, month: str, year: str) -> str:
    return f"{grain.csv_prefix}_{month}_{year}.csv"


def write_monthly_csv(
    frame: DataFrame, folder: str, grain: Grain, month: str, year: str
) -> str:
    """Write one month; the name is a folder of part files, each with a header."""
    path = f"{folder.rstrip('/')}/{csv_name(grain, month, year)}"
    frame.select(grain.columns).write.mode("overwrite").options(**CSV_WRITE).csv(path)
    return path


def write_monthly_csvs(frame: DataFrame, folder: str, grain: Grain) -> str:
    """Write every month of the frame in one job, one `file=<name>` folder per month.

    The rebalance hint gathers a month's rows into few files and lets AQE split a
    month that is too large for one task.
    """
    name = F.concat_ws(
        "_", F.lit(grain.csv_prefix), month_name(F.col("month").cast("int")), F.col("year")
    )
    (
        frame.select(*grain.columns, F.concat(name, F.lit(".csv")).alias("file"))
        .hint("rebalance", "file")
        .write.mode("overwrite")
        .options(**CSV_WRITE)
        .partitionBy("file")
        .csv(folder)
    )
    return folder


def read_csv_stage(
    spark: SparkSession,
    path: str,
    hint: str = "preprocessing",
    columns: Sequence[str] | None = None,
    split: int = RANGE,
) -> DataFrame:
    """Every column as text, blanks as NULL. Values may hold line breaks, and files are
    read in ranges of `split` bytes; `columns` spares looking at a header."""
    found = read_csv(spark, path, {k: v for k, v in _CSV.items() if k != "header"}, columns, split)
    if found is None:
        raise FileNotFoundError(f"no CSV at {path}; {hint} writes it")
    return found
