"""Places of rows in a global order, without gathering them in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regflow.llm.common import stored

#: `monotonically_increasing_id` keeps the partition above this bit and the row's place below.
_PLACE_BITS = 33


def positions(frame: DataFrame, *order: Column) -> DataFrame:
    """The frame with `position`, from 0 on, in the given order.

    Ranges of the order are sorted apart from each other; only the number of rows of each range,
    one row a partition, meets in a single task. The row's place in the input is the last
    sort key, so that rows that agree in all others are spread over ranges too; the input must be
    read from a table, so that a repeated task sees the same places. The frame must not have columns
    named `_at` or `_row`.
    """
    order = (*order, F.col("_row"))
    ranged = (
        frame.withColumn("_row", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
        .drop("_row")
    )
    ranged = stored(ranged, "ranges")
    part = F.shiftright("_at", _PLACE_BITS)
    place = F.col("_at").bitwiseAND((1 << _PLACE_BITS) - 1)
    counts = ranged.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return (
        ranged.withColumn("_part", part)
        # One row for each range.
        .join(F.broadcast(starts), "_part")
        .withColumn("position", F.col("_start") + place)
        .drop("_part", "_start", "_at")
    )
