"""Log excerpts and page checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regflow.functions import text

# Texts that flag a log line.
LOG_MARKERS = (
    "ERROR",
    "Error",
    "Traceback",
    "Exception",
    "FAILED",
    "Failed",
    "Access Forbidden",
    "blocked",
    "Timeout",
    "KeyError",
    "FileNotFoundError",
    "ValueError",
)


def has_marker(line: Column, markers: Sequence[str] = LOG_MARKERS) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(line, F.lit(m)) for m in markers])


def flagged_tail(
    lines: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    line: str = "line",
    flagged: Column | None = None,
    max_lines: int = 8,
    max_chars: int = 1500,
) -> DataFrame:
    """Per log the last flagged lines, else the last lines, as one excerpt.

    The row_number filter becomes a group limit that runs before the shuffle too, so
    each task sends at most `max_lines` lines of a log, however large the log is.
    """
    flag = has_marker(F.col(line)) if flagged is None else flagged
    marked = lines.filter(text.strip(F.col(line)) != "").select(
        *by, *order, text.strip_right(F.col(line)).alias("line"), flag.alias("flagged")
    )
    latest = Window.partitionBy(*by).orderBy(
        F.desc("flagged"), *[F.desc(c) for c in order]
    )
    last = marked.withColumn("nth", F.row_number().over(latest)).filter(
        F.col("nth") <= max_lines
    )
    entry = F.struct(F.col("nth"), F.col("line"))
    excerpt = last.groupBy(*by).agg(
        F.max("flagged").alias("any_flagged"),
        F.collect_list(F.when(F.col("flagged"), entry)).alias("marked_lines"),
        F.collect_list(entry).alias("all_lines"),
    )
    chosen = F.when(F.col("any_flagged"), F.col("marked_lines")).otherwise(F.col("all_lines"))
    # `nth` counts from the newest line, so reading order is descending.
    ordered = F.transform(F.reverse(F.array_sort(chosen)), lambda e: e["line"])
    joined = text.strip(F.array_join(ordered, "\n"))
    tail = F.regexp_replace(F.right(joined, F.lit(max_chars)), r"(?U)^[\s\x1C-\x1F]+", "")
    cut = F.when(F.length(joined) <= max_chars, joined).otherwise(
        F.concat(F.lit("...\n"), tail)
    )
    return excerpt.select(*by, cut.alias("excerpt"))


def blocked_pages(
    pages: DataFrame,
    title: Column,
    blocked_title: str = text.BLOCKED_TITLE,
    markers: Sequence[str] = text.BLOCKED_MARKERS,
) -> DataFrame:
    """Add `blocked_reason` to fetched pages."""
    return pages.withColumn(
        "blocked_reason", text.blocked_reason(title, F.col("html"), blocked_title, markers)
    )
