"""Mixing sources to target weights by fitting each source's word budget as a subset sum.

1. Targets. Every source's size is summed, sources get their weight by rank, and the total is
   shared out by weight; a source stops at `limit` times its size, and the excess goes to the
   others by weight until nothing is left over.
2. Fit. Documents are counted by exact length, and each may be taken `limit` times. A budget
   is first met in proportion: of the c documents of a length, floor(c * budget / size) copies
   are taken. What remains is closed by taking single further copies, longest first, and the
   last gap by a bounded-knapsack dynamic programme over the lengths that are left.
3. Copies. The copies of a length are dealt evenly over its documents: n copies of c documents
   are n div c for each and one more for n mod c of them.
4. Selection. These are the documents with the smallest seeded hashes. They
   are found through counts by hash bucket, so that only the one bucket that is cut is sorted.

The work of step 2 depends on a source's distinct lengths and not on its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regflow.llm.common import checkpointed, whole_text
from regflow.session import ship_by_value

ship_by_value(__name__)

#: Gaps up to this many words go to the dynamic programme.
GAP = 20_000
#: The dynamic programme uses up to this many distinct lengths, the shortest and evenly spread
#: others; with a length of one word among them any gap can be met.
LENGTHS = 400
#: Hash buckets for each (source, length).
BUCKETS = 4096

_WORD = r"[^\x20\x09-\x0D]+"


def word_count(column):
    """Number of words: starts of runs of characters other than white space."""
    plain = F.regexp_replace(column, r"[\x20\x09-\x0D]+", " ")
    plain = F.trim(plain)
    return F.when(plain == "", F.lit(0).cast("long")).otherwise(
        (F.length(plain) - F.length(F.replace(plain, F.lit(" "), F.lit(""))) + 1).cast("long")
    )


def subset_sum(counts: dict[int, int], gap: int) -> dict[int, int]:
    """How many of each length to take so that the sum is as near to `gap` from below as the
    lengths allow. `counts` bounds how often each may be taken. Sums are bits of an integer;
    each length is added in pieces of 1, 2, 4, ... documents."""
    if gap <= 0:
        return {}
    mask = (1 << (gap + 1)) - 1
    reach, steps = 1, []
    for length in sorted(counts):
        left = min(counts[length], gap // length)
        part = 1
        while left > 0:
            part = min(part, left)
            grown = (reach | reach << (length * part)) & mask
            steps.append((reach, length, part))
            reach, left, part = grown, left - part, part * 2
    at = reach.bit_length() - 1
    taken: dict[int, int] = {}
    for before, length, part in reversed(steps):
        if not before >> at & 1:
            at -= length * part
            taken[length] = taken.get(length, 0) + part
    return taken


def fit(counts: dict[int, int], budget: float, limit: int = 1) -> dict[int, int]:
    """How many copies of each length to take so that their words come near `budget`, with at
    most `limit` for each of the documents that `counts` holds of a length."""
    counts = {length: n for length, n in counts.items() if length > 0 and n > 0}
    total = sum(length * n for length, n in counts.items())
    budget = min(int(budget + 0.5), total * limit)
    if not counts or budget <= 0:
        return {}
    taken = {length: n * budget // total for length, n in counts.items()}
    free = {length: n * limit - taken[length] for length, n in counts.items()}
    gap = budget - sum(length * n for length, n in taken.items())

    def take(length: int, n: int) -> None:
        nonlocal gap
        taken[length] += n
        free[length] -= n
        gap -= n * length

    # Leave a gap that can be met in several ways; go below it only if documents are so long
    # that the programme could not reach it otherwise.
    for leave in (GAP // 2, 0):
        if gap > GAP or leave:
            for length in sorted(counts, reverse=True):
                take(length, min(free[length], max(0, gap - leave) // length))
    left = sorted(length for length in counts if free[length] and length <= gap)
    if len(left) > LENGTHS:
        half = LENGTHS // 2
        rest = left[half:]
        left = left[:half] + rest[:: max(1, len(rest) // half)]
    for length, n in subset_sum({x: free[x] for x in left}, gap).items():
        take(length, n)
    # One document too many may be nearer than none.
    over = min((length for length in counts if free[length] and length > gap), default=0)
    if gap and over and over - gap < gap:
        take(over, 1)
    return {length: n for length, n in taken.items() if n}


def source_key(column: Column) -> Column:
    """A text that is never null, equal for equal sources, and sorts nulls after all others."""
    return F.coalesce(F.concat(F.lit("0"), column.cast("string")), F.lit("1"))


def targets(
    sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, limit: float = 2.0
) -> DataFrame:
    """Adds `target` to rows of (key, source_size), one row per source key (see `source_key`).

    Sources rank by code point with null last, and weigh `weights` in turn. The ranks come from
    a range-partitioned sort with one offset per partition, so no task holds all sources.
    """
    parts = sizes.sparkSession.conf.get("spark.sql.shuffle.partitions")
    ordered = checkpointed(
        sizes.repartitionByRange(int(parts), "key")
        .sortWithinPartitions("key")
        .withColumn("place", F.monotonically_increasing_id())
    )
    part = F.shiftright("place", 33)
    offsets, seen = [], 0
    for row in ordered.groupBy(part.alias("part")).count().orderBy("part").collect():
        offsets += [F.lit(row["part"]), F.lit(seen)]
        seen += row["count"]
    if not seen:
        return ordered.drop("place").withColumn("target", F.lit(0.0))
    rank = F.col("place").bitwiseAND((1 << 33) - 1) + F.element_at(F.create_map(*offsets), part)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (rank % len(weights) + 1).cast("int"))
    weighed = checkpointed(
        ordered.select(
            "key",
            "source_size",
            weight.alias("weight"),
            (F.col("source_size") * limit).cast("double").alias("most"),
        )
    )
    total = weighed.agg(F.sum("source_size")).first()[0] * share
    level = 0.0
    while True:
        # Sources that the present level fills stay at their most; the rest share what is left.
        capped = (F.col("weight") * level >= F.col("most")) & F.lit(level > 0)
        got = weighed.agg(
            F.sum(F.when(capped, F.col("most")).otherwise(0.0)).alias("full"),
            F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if not got["open"]:
            break
        raised = (total - got["full"]) / got["open"]
        if raised <= level * (1 + 1e-15):
            break
        level = raised
    target = F.least(F.col("most"), F.col("weight") * F.lit(level))
    return weighed.select("key", "source_size", target.alias("target"))


def _fitter(limit: int):
    def fit_source(lengths: pd.DataFrame) -> pd.DataFrame:
        counts = dict(zip(lengths["size"].tolist(), lengths["docs"].tolist(), strict=True))
        taken = fit(counts, float(lengths["target"].iloc[0]), limit)
        copies = [divmod(taken.get(length, 0), n) for length, n in counts.items()]
        return pd.DataFrame(
            {
                "key": lengths["key"].iloc[0],
                "size": pd.Series(list(counts), dtype="int64"),
                "whole": pd.Series([w for w, _ in copies], dtype="int32"),
                "quota": pd.Series([q for _, q in copies], dtype="int64"),
            }
        )

    return fit_source


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    limit: int = 2,
    seed: int = 17,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    row_col: str | None = None,
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, copies, taken, and the column
    `row_col`, if named, which tells rows apart that repeat an id.

    `size` counts words (0 for a null text), `copies` is 0 to `limit`, and `taken` is
    size * copies. A source without words has target 0, and its documents take 0 words. A null
    source is a source of its own, ranked last. The choice among documents of one length goes
    by a hash of the id and the seed, so reruns agree; rows that repeat an id share its hash,
    and which of such equal rows is taken makes no difference. An empty table gives an empty
    result; columns other than those named are not read.
    """
    salted = F.xxhash64(F.lit(seed), F.col("doc_id"))
    row = [row_col] if row_col else []
    rows = checkpointed(
        docs.select(
            F.col(f"`{id_col}`").cast("long").alias("doc_id"),
            source_key(F.col(f"`{source_col}`")).alias("key"),
            word_count(whole_text(f"`{text_col}`")).alias("size"),
            *row,
        ).withColumn("bucket", F.pmod(salted, F.lit(BUCKETS)).cast("int"))
    )
    cell = ["key", "size", "bucket"]
    by_bucket = checkpointed(rows.groupBy(*cell).agg(F.count("*").alias("docs")))
    by_length = checkpointed(by_bucket.groupBy("key", "size").agg(F.sum("docs").alias("docs")))
    sizes = by_length.groupBy("key").agg(F.sum(F.col("size") * F.col("docs")).alias("source_size"))
    goals = checkpointed(targets(sizes, weights, share, float(limit)))
    quotas = (
        by_length.join(goals, "key")
        .select("key", "size", "docs", "target")
        .groupBy("key")
        .applyInPandas(_fitter(limit), "key string, size long, whole int, quota long")
    )
    # How many of each bucket: all of the buckets before the cut, some of the one at it.
    up_to = Window.partitionBy("key", "size").orderBy("bucket")
    before = F.sum("docs").over(up_to) - F.col("docs")
    room = F.greatest(F.col("quota") - before, F.lit(0))
    cut = checkpointed(
        by_bucket.join(quotas, ["key", "size"]).select(
            *cell, "docs", "whole", F.least(room, "docs").alias("n")
        )
    )
    # Buckets of which more than none and fewer than all is taken: one per length at most.
    at_cut = rows.join(cut.filter("n > 0 AND n < docs"), cell)
    order = Window.partitionBy(*cell).orderBy(salted, "doc_id", *row)
    at_cut = at_cut.withColumn("extra", (F.row_number().over(order) <= F.col("n")).cast("int"))
    clear = rows.join(cut.filter("n = 0 OR n = docs"), cell)
    clear = clear.withColumn("extra", (F.col("n") > 0).cast("int"))
    columns = ["doc_id", "key", "size", "whole", "extra", *row]
    chosen = clear.select(columns).union(at_cut.select(columns))
    copies = (F.col("whole") + F.col("extra")).cast("int")
    return chosen.join(goals, "key").select(
        "doc_id",
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (F.col("size") * copies).cast("long").alias("taken"),
        *row,
    )
