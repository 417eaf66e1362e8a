"""Connected components of a link table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regflow.llm.common import checkpointed


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in `links` (a, b); component is the smallest id reachable.

    In a round every id points at its smallest neighbour or itself, pointers are followed to
    their ends by doubling, and the links are drawn anew between those ends. Each round at
    least halves the ids that still have links, and a chain of n pointers ends after log n
    doublings.
    Counts are combined before each shuffle; nothing but row counts reaches the driver.
    """
    links = checkpointed(
        links.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a <> b").distinct()
    )
    labels = checkpointed(
        links.select(F.col("a").alias("id")).union(links.select("b")).distinct()
    ).select("id", F.col("id").alias("component"))
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        point = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("to"))
        point = checkpointed(point.select(F.col("a").alias("at"), "to"))
        while True:
            on = point.select(F.col("at").alias("mid"), F.col("to").alias("far"))
            point = checkpointed(
                point.join(on, F.col("to") == F.col("mid")).select(
                    "at", F.col("far").alias("to"), (F.col("far") != F.col("to")).alias("moved")
                )
            )
            if point.filter("moved").isEmpty():
                break
            point = point.drop("moved")
        labels = checkpointed(
            labels.join(point, F.col("component") == F.col("at"), "left").select(
                "id", F.coalesce("to", "component").alias("component")
            )
        )
        left = point.select(F.col("at").alias("a"), F.col("to").alias("x"))
        right = point.select(F.col("at").alias("b"), F.col("to").alias("y"))
        links = checkpointed(
            links.join(left, "a")
            .join(right, "b")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .filter("a <> b")
            .distinct()
        )
    return labels
