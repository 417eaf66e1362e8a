"""A Merkle tree over a table: proofs for every row, found through nested intervals.

Rows are leaves. Within a group (a language) they are ranked by id, and every `RUN` consecutive
nodes of a level become their digest, until one is left, the group's subroot. Subroots make the same kind of tree over the
groups, whose top is the root of the manifest.

1. Labels. A node carries the interval of leaf ranks that it covers and the interval of its parent.
2. Buckets. `TIER` levels at a time, the nodes below one node of the next tier make up one row, so that
   a row has a bounded number of nodes and a tree of n leaves takes log n / TIER rounds.
3. Ancestors. An item joins the bucket of its tier that contains it. Of the nodes there, those whose parent's interval
   contains the item and whose own does not are the siblings on its way: the difference of the
   intervals within a parent. Those of the tiers above follow by joining bucket to bucket, from the top.

A digest is that of its inputs' lower-case hex text; tables hold it as bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regflow.llm.common import checkpointed, stored
from regflow.llm.ranks import positions

RUN = 2
#: Levels of a tree that are built in one round; a bucket holds RUN ** TIER items.
TIER = 4

_PATH = "array<struct<level:int,lo:bigint,digest:binary>>"


def field(column: Column) -> Column:
    """A value as it enters a leaf: `-` for null, else its UTF-8 length, a colon and the value."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def hex_text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def joined_digests(digests: Column) -> Column:
    return F.concat_ws("", F.transform(digests, hex_text))


def leaf_digest(columns: list[Column]) -> Column:
    return digest_of(F.concat(*(field(c) for c in columns)))


def _power(run: int, level: int) -> int:
    return min(run**level, (1 << 62))


def _height(n: Column, run: int) -> Column:
    """Levels above n leaves until one node is left."""
    steps, level = [], 0
    while run**level < 1 << 62:
        steps.append((n > F.lit(run**level)).cast("int"))
        level += 1
    total = steps[0]
    for step in steps[1:]:
        total = total + step
    return total


def _next_level(row: Column, run: int) -> Column:
    """The digests of every `run` consecutive digests."""
    starts = F.sequence(F.lit(1), F.size(row), F.lit(run))
    return F.transform(starts, lambda i: digest_of(joined_digests(F.slice(row, i, F.lit(run)))))


def _tiers(leaves: DataFrame, run: int, depth: int) -> tuple[list[DataFrame], DataFrame]:
    """The tiers of all trees and their tops, from `leaves` (tree, rank, n, height, digest).

    A tier has a row for each bucket: tree, bucket and `nodes`, structs of level, interval
    [lo, hi), parent's interval [up_lo, up_hi) and digest, without the top of a tree. Tops are
    (tree, digest).
    """
    most = leaves.agg(F.max("height")).first()[0]
    items, tiers, tops = leaves.select("tree", "rank", "n", "height", "digest"), [], None
    size = run**depth
    for tier in range(0, 1 + max(0, (most or 0) - 1) // depth):
        level = tier * depth
        grouped = items.groupBy("tree", F.expr(f"rank div {size}").alias("bucket")).agg(
            F.first("n").alias("n"),
            F.first("height").alias("height"),
            F.sort_array(F.collect_list(F.struct("rank", "digest"))).alias("held"),
        )
        grouped = grouped.withColumn("row0", F.transform("held", lambda h: h["digest"]))
        for k in range(depth):
            above = _next_level(F.col(f"row{k}"), run)
            # Beyond the top of a tree nothing is hashed any more.
            grouped = grouped.withColumn(
                f"row{k + 1}", F.when(F.col("height") > level + k, above).otherwise(F.col(f"row{k}"))
            )

        def labelled(k: int, level: int = level) -> Column:
            span, up = _power(run, level + k), _power(run, level + k + 1)

            def node(digest: Column, i: Column) -> Column:
                index = F.col("bucket") * _power(run, depth - k) + i
                parent = ((index - F.pmod(index, F.lit(run))) / run).cast("long")
                lo, up_lo = index * span, parent * up
                return F.struct(
                    F.lit(level + k).alias("level"),
                    lo.alias("lo"),
                    F.least(lo + span, F.col("n")).alias("hi"),
                    up_lo.alias("up_lo"),
                    F.least(up_lo + up, F.col("n")).alias("up_hi"),
                    digest.alias("digest"),
                )

            nodes = F.transform(f"row{k}", node)
            return F.when(F.col("height") > level + k, nodes).otherwise(F.filter(nodes, lambda _: F.lit(False)))

        made = stored(
            grouped.select(
                "tree",
                "bucket",
                "n",
                "height",
                F.concat(*(labelled(k) for k in range(depth))).alias("nodes"),
                F.element_at(f"row{depth}", 1).alias("digest"),
            ),
            "tier",
        )
        tiers.append(made.select("tree", "bucket", "nodes"))
        ended = made.filter(F.col("height") <= level + depth).select("tree", "digest")
        tops = ended if tops is None else tops.unionByName(ended)
        items = made.filter(F.col("height") > level + depth).select(
            "tree", F.col("bucket").alias("rank"), "n", "height", "digest"
        )
    return tiers, tops


def _siblings(nodes: Column, at: Column) -> Column:
    """Of the nodes in an item's bucket, those that its ancestors' parents cover beside them."""
    beside = F.filter(
        nodes,
        lambda s: (s["up_lo"] <= at) & (at < s["up_hi"]) & ~((s["lo"] <= at) & (at < s["hi"])),
    )
    return F.transform(beside, lambda s: F.struct(s["level"], s["lo"], s["digest"]))


def _with_paths(items: DataFrame, tiers: list[DataFrame], run: int, depth: int) -> DataFrame:
    """`items` (tree, rank, ...) with `path`: the siblings on the way to the top, as structs of
    level, lo and digest, from the lowest level on, left to right."""
    size = run**depth
    above = None
    for tier in range(len(tiers) - 1, -1, -1):
        held = tiers[tier]
        if above is None:
            held = held.withColumn("upper", F.array().cast(_PATH))
        else:
            held = held.join(
                above.select("tree", F.col("rank").alias("bucket"), F.col("path").alias("upper")),
                ["tree", "bucket"],
                "left",
            ).withColumn("upper", F.coalesce("upper", F.array().cast(_PATH)))
        wanted = items if tier == 0 else tiers[tier - 1].select("tree", F.col("bucket").alias("rank"))
        # An item of this tier covers leaves from here on.
        lo = F.col("rank") * _power(run, tier * depth)
        above = (
            wanted.withColumn("bucket", F.expr(f"rank div {size}"))
            .join(held, ["tree", "bucket"])
            .withColumn("path", F.concat(F.array_sort(_siblings(F.col("nodes"), lo)), F.col("upper")))
            .drop("bucket", "nodes", "upper")
        )
        if tier:
            above = checkpointed(above)
    return above


def folded(leaf: Column, path: Column, rank: Column, height: Column) -> Column:
    """The top of a tree, from a leaf and its path."""

    def step(acc: Column, level: Column) -> Column:
        here = F.filter(path, lambda s: s["level"] == level)
        left = F.filter(here, lambda s: s["lo"] < rank)
        right = F.filter(here, lambda s: s["lo"] > rank)
        return digest_of(
            F.concat(
                joined_digests(F.transform(left, lambda s: s["digest"])),
                hex_text(acc),
                joined_digests(F.transform(right, lambda s: s["digest"])),
            )
        )

    levels = F.filter(F.sequence(F.lit(0), height), lambda l: l < height)
    return F.aggregate(levels, leaf, step)


def manifest(
    docs: DataFrame,
    group_col: str = "lang",
    id_col: str = "doc_id",
    columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    run: int = RUN,
    depth: int = TIER,
) -> DataFrame:
    """One row per row of `docs`: id, grp, leaf, rank, height, subroot, path, and the same of the
    tree over groups: top_rank, top_height, top_path, root. `altered` is the leaf with n_chars, if among
    `columns`, raised by 1. Digests are bytes.

    Null groups come first, then groups by their bytes; within a group null ids come first, rows that repeat
    an id follow each other by digest. A group of one row is its own subroot. An empty table gives an empty result;
    columns that are not named are not read, whatever they are called.
    """

    def value(name: str, raised: bool = False) -> Column:
        column = F.col(f"`{name}`")
        # Wider than a long, so that the largest one can be raised.
        return (column.cast("decimal(20,0)") + 1) if raised and name == "n_chars" else column

    leaves = stored(
        docs.select(
            F.col(f"`{id_col}`").cast("long").alias("id"),
            F.col(f"`{group_col}`").cast("string").alias("grp"),
            leaf_digest([value(c) for c in columns]).alias("digest"),
            leaf_digest([value(c, True) for c in columns]).alias("altered"),
        ),
        "leaves",
    )
    placed = positions(leaves, F.asc_nulls_first("grp"), F.asc_nulls_first("id"), F.col("digest"))
    # A tree goes by the place of its first leaf, which also orders the trees.
    # Written as a table, whose size is known to the joins with it.
    groups = stored(
        placed.groupBy("grp").agg(F.min("position").alias("tree"), F.count("*").alias("n")), "groups"
    ).withColumn("height", _height(F.col("n"), run))
    own = groups.withColumnRenamed("grp", "own")
    items = placed.join(own, F.col("grp").eqNullSafe(F.col("own"))).select(
        "id", "grp", "digest", "altered", "tree", (F.col("position") - F.col("tree")).alias("rank"), "n", "height"
    )
    tiers, subroots = _tiers(items, run, depth)
    tops = positions(checkpointed(subroots), F.col("tree")).select(
        F.lit(0).cast("long").alias("tree"), F.col("position").alias("rank"), F.col("tree").alias("member"), "digest"
    )
    tops = checkpointed(tops)
    tops = tops.withColumn("n", F.lit(tops.count())).withColumn("height", _height(F.col("n"), run))
    top_tiers, root = _tiers(tops, run, depth)
    over = _with_paths(tops.select("tree", "rank", "member", "digest", "height"), top_tiers, run, depth)
    over = stored(
        over.join(root.select("tree", F.col("digest").alias("root")), "tree").select(
            F.col("member").alias("tree"),
            F.col("digest").alias("subroot"),
            F.col("rank").alias("top_rank"),
            F.col("height").alias("top_height"),
            F.col("path").alias("top_path"),
            "root",
        ),
        "tops",
    )
    paths = _with_paths(items.drop("n"), tiers, run, depth)
    return paths.join(over, "tree").withColumnRenamed("digest", "leaf").drop("tree")


def proof_digest() -> Column:
    """The digest of all siblings of a row of `manifest`, from its leaf to the root."""
    both = F.concat("path", "top_path")
    return F.sha2(joined_digests(F.transform(both, lambda s: s["digest"])), 256)


def folded_root(leaf: Column) -> Column:
    """The root that `leaf` leads to with the siblings of a row of `manifest`."""
    subroot = folded(leaf, F.col("path"), F.col("rank"), F.col("height"))
    return folded(subroot, F.col("top_path"), F.col("top_rank"), F.col("top_height"))
