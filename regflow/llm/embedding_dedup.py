"""Near-duplicate embeddings by a dual traversal of cover trees.

Vectors are scaled to length 1, where cosine and distance are one: cos >= t exactly when
|v - w| <= sqrt(2 - 2t). One tree spans all vectors. Its top level is a net of a bounded sample: every
vector belongs to the cell of its nearest centre, and a cell has the exact covering radius of all
its vectors. A cell is cut into blocks of bounded size, and each block becomes a cover
tree once: nested levels whose radius halves, the centres of a level farther apart than its radius and every vector
within that radius of its centre, each centre with the exact covering radius of what lies below.

Nodes of two trees are followed only where their centres are within both covering radii plus the
threshold distance, from the cells on: blocks of other cells never meet. Trees are dealt to
tiles of a few blocks, and a task traverses the trees of two tiles pair by pair, so that a tree is sent once for each
tile that it can reach. Where single vectors meet, their cosine in double precision decides. A task gives each vector's
number of partners and the links of a spanning forest, never the pairs, so a group of n close vectors
costs n rows a tile.

Pruning needs data with low-dimensional or clustered structure. Vectors that are far from each
other in all directions leave as many nodes as vectors on the upper levels, and their cells all reach
each other, so that such data cost the square of their number in (vectorised) distances.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regflow.llm.common import checkpointed, pieces, stored
from regflow.llm.components import components
from regflow.session import ship_by_value

ship_by_value(__name__)

#: Vectors in a block, on average.
BLOCK = 4096
#: The top level has at most so many centres, a net of at most so many vectors, and cells of a
#: quarter of a block on average where the data are few. None of these changes a result.
CENTRES, SAMPLE = 512, 8192
#: Blocks in a tile, on average.
TILE = 4
#: A node of so few vectors gets no further level.
LEAF = 64
#: Levels end at this radius.
FINEST = 1e-3
#: Room for the rounding of single-precision cosines and of distances made from them. It only
#: loosens bounds; links are decided in double precision.
ROUGH, SLACK = 1e-4, 0.02
_ROWS = 512

# A node is (centres, radii, kids): row numbers, covering radii, and the node below each
# centre, or -1 for a single vector. A tree is (vectors, nodes, root).


def _distance(cosines: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2 - 2 * cosines))


def net(vectors: np.ndarray, members: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Centres about `radius` apart, and for each member the number of a centre within it."""
    enough = 1 - radius * radius / 2
    centres: list[int] = []
    owner = np.full(len(members), -1)
    for start in range(0, len(members), _ROWS):
        part = members[start : start + _ROWS]
        own = owner[start : start + _ROWS]
        if centres:
            cosines = vectors[part] @ vectors[centres].T
            best = cosines.argmax(axis=1)
            near = cosines[np.arange(len(part)), best] >= enough
            own[near] = best[near]
        left = np.flatnonzero(own < 0)
        between = vectors[part[left]] @ vectors[part[left]].T >= enough
        free = np.ones(len(left), bool)
        for k in range(len(left)):
            if free[k]:
                taken = between[k] & free
                taken[k] = True
                own[left[taken]] = len(centres)
                free &= ~taken
                centres.append(int(part[left[k]]))
    return np.array(centres), owner


def cover_tree(vectors: np.ndarray, near: float = 0.3) -> tuple:
    """Levels above `near` that leave most vectors apart bound nothing and are left out."""
    nodes: list[tuple] = []
    rough = vectors.astype(np.float32)

    def grow(members: np.ndarray, radius: float) -> int:
        centres, owner = members, None
        if len(members) > LEAF:
            while radius >= FINEST:
                centres, owner = net(rough, members, radius)
                if 1 < len(centres) and (radius <= near or 2 * len(centres) <= len(members)):
                    break
                radius /= 2
        if owner is None or len(centres) == 1:
            nodes.append((members, np.zeros(len(members)), np.full(len(members), -1)))
            return len(nodes) - 1
        order = np.argsort(owner, kind="stable")
        ends = np.searchsorted(owner[order], np.arange(len(centres) + 1))
        radii, kids = np.zeros(len(centres)), np.full(len(centres), -1)
        for k in range(len(centres)):
            own = members[order[ends[k] : ends[k + 1]]]
            if len(own) > 1:
                radii[k] = _distance(vectors[own] @ vectors[centres[k]]).max()
                kids[k] = grow(own, radius / 2)
        nodes.append((centres, radii, kids))
        return len(nodes) - 1

    root = grow(np.arange(len(vectors)), 1.0) if len(vectors) else -1
    return vectors, nodes, root


def _single(row: int) -> tuple:
    return np.array([row]), np.zeros(1), np.full(1, -1)


def traverse(a: tuple, b: tuple, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of a, rows of b) of linked pairs, each pair once; for a tree with itself in one
    order, and no vector with itself."""
    same = a is b
    near = float(_distance(np.float64(cosine))) + SLACK
    rough_a = a[0].astype(np.float32)
    rough_b = rough_a if same else b[0].astype(np.float32)
    if a[2] < 0 or b[2] < 0:
        return
    todo = [(a[1][a[2]], b[1][b[2]])]
    while todo:
        one, two = todo.pop()
        centres_b, radii_b, kids_b = two
        single_b, inner_b = kids_b < 0, np.flatnonzero(kids_b >= 0)
        for start in range(0, len(one[0]), _ROWS):
            centres, radii, kids = (x[start : start + _ROWS] for x in one)
            single, inner = kids < 0, np.flatnonzero(kids >= 0)
            rough = rough_a[centres] @ rough_b[centres_b].T
            place = np.arange(start, start + len(centres))
            if same and one is two:
                todo += [(a[1][k], a[1][k]) for k in kids[inner]]
            # Single vectors: rough cosines pick candidates, exact ones decide.
            x, y = np.nonzero(rough >= cosine - ROUGH)
            keep = single[x] & single_b[y]
            if same and one is two:
                keep &= place[x] < y
            x, y = x[keep], y[keep]
            for at in range(0, len(x), 1 << 16):
                rows, columns = centres[x[at : at + (1 << 16)]], centres_b[y[at : at + (1 << 16)]]
                hit = np.einsum("ij,ij->i", a[0][rows], b[0][columns]) >= cosine
                if hit.any():
                    yield rows[hit], columns[hit]
            # Nodes: followed where the covering radii and the threshold reach each other.
            opened = []
            if len(inner):
                bound = radii[inner, None] + radii_b + near
                i, j = np.nonzero(_distance(rough[inner]) <= bound)
                opened.append((inner[i], j))
            if len(inner_b):
                rows = np.flatnonzero(single)
                bound = radii_b[inner_b] + near
                i, j = np.nonzero(_distance(rough[np.ix_(rows, inner_b)]) <= bound)
                opened.append((rows[i], inner_b[j]))
            for i, j in opened:
                if same and one is two:
                    upper = place[i] < j
                    i, j = i[upper], j[upper]
                for p, q in zip(i.tolist(), j.tolist(), strict=True):
                    todo.append(
                        (
                            a[1][kids[p]] if kids[p] >= 0 else _single(centres[p]),
                            b[1][kids_b[q]] if kids_b[q] >= 0 else _single(centres_b[q]),
                        )
                    )


class Forest:
    """Union-find that keeps the links it needed."""

    def __init__(self):
        self.parent: dict[int, int] = {}
        self.links: list[tuple[int, int]] = []

    def find(self, x: int) -> int:
        parent = self.parent
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    def link(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)
            self.links.append((x, y))

    def add(self, ids_a: np.ndarray, ids_b: np.ndarray) -> None:
        for x, y in zip(ids_a.tolist(), ids_b.tolist(), strict=True):
            self.link(x, y)


def top_level(sample: np.ndarray, wanted: int) -> np.ndarray:
    """At most `wanted` centres: the finest net of the sample that has no more."""
    rough = sample.astype(np.float32)
    rows, radius = np.arange(len(sample)), 1.25
    best = net(rough, rows, radius)[0][:wanted]
    while radius > FINEST:
        radius *= 0.8
        finer = net(rough, rows, radius)[0]
        if len(finer) > wanted:
            break
        best = finer
    return sample[best]


def _top_levels(classes: DataFrame, block: int) -> dict[int, np.ndarray]:
    """Centres for each size of vectors in a sample of all. Sizes that it lacks have none."""
    numbers = {r["size"]: r["n"] for r in classes.groupBy("size").agg(F.count("*").alias("n")).collect()}
    chosen = classes.select("size", "vector").orderBy(F.xxhash64("vector"), "vector").limit(SAMPLE).collect()
    sampled: dict[int, list] = {}
    for row in chosen:
        sampled.setdefault(row["size"], []).append(np.frombuffer(row["vector"], np.float64))
    return {
        size: top_level(np.stack(held), min(CENTRES, max(1, 4 * numbers[size] // block)))
        for size, held in sampled.items()
    }


_PLACED = "cid long, first long, copies long, size int, vector binary, cell int, away double"


def _nearest(centres: dict[int, np.ndarray]):
    """Adds each vector's nearest centre and the distance from it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "vector"):
            sizes = batch.column("size").to_numpy()
            data = batch.column("vector").to_pylist()
            cell, away = np.full(len(sizes), -1, np.int32), np.zeros(len(sizes))
            for size in np.unique(sizes).tolist():
                if size not in centres:
                    continue
                rows = np.flatnonzero(sizes == size)
                vectors = np.stack([np.frombuffer(data[r], np.float64) for r in rows])
                cosines = vectors @ centres[size].T
                cell[rows] = cosines.argmax(axis=1)
                away[rows] = _distance(cosines.max(axis=1))
            columns = [batch.column(c) for c in ("cid", "first", "copies", "size", "vector")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(cell), pa.array(away)], names=[*(c for c in _PLACED.replace(",", "").split()[::2])]
            )

    return run


def _reaching(cells: pd.DataFrame, centres: dict[int, np.ndarray], cosine: float) -> pd.DataFrame:
    """Pairs of cells (size, a, b), a <= b, that can hold a linked pair, each with itself."""
    near = float(_distance(np.float64(cosine))) + SLACK
    found = []
    for size, part in cells.groupby("size"):
        number = part["cell"].to_numpy()
        reach = np.eye(len(part), dtype=bool)
        if size in centres:
            radii = part["radius"].to_numpy()
            apart = _distance(centres[size][number] @ centres[size][number].T)
            reach |= apart <= radii[:, None] + radii + near
        a, b = np.nonzero(np.triu(reach))
        found.append(pd.DataFrame({"size": size, "a": number[a], "b": number[b]}))
    return pd.concat(found)


def _plant(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
    """A block's tree as one row."""
    block = block.sort_values("cid", kind="stable")
    vectors = np.stack([np.frombuffer(v, np.float64) for v in block["vector"]])
    columns = [block[c].to_numpy(np.int64) for c in ("cid", "first", "copies")]
    held = (*columns, cover_tree(vectors), (key[0], key[1]))
    return pd.DataFrame(
        {"size": [key[0]], "cell": [key[1]], "tile": [key[2]], "block": [key[3]], "tree": [pickle.dumps(held)]}
    )


_MET = pa.schema([("cid", pa.int64()), ("partners", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])


def _meet(cosine: float, reaching: set[tuple[int, int, int]]):
    """Traverses the trees of two tiles, given as rows (x, y, side, tree) in the order of tiles."""

    def pair(one: tuple, two: tuple) -> bool:
        (size, a), (other, b) = one[4], two[4]
        return size == other and (size, min(a, b), max(a, b)) in reaching

    def meet(first: list[tuple], second: list[tuple] | None) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        every = first + (second or [])
        counts = {id(tree): np.zeros(len(tree[0]), np.int64) for tree in every}
        if second is None:
            pairs = [(x, y) for k, x in enumerate(first) for y in first[k:]]
        else:
            pairs = [(x, y) for x in first for y in second]
        for one, two in pairs:
            if not pair(one, two):
                continue
            for rows, columns in traverse(one[3], two[3], cosine):
                np.add.at(counts[id(one)], rows, two[2][columns])
                np.add.at(counts[id(two)], columns, one[2][rows])
                forest.add(one[1][rows], two[1][columns])
        for tree in every:
            some = counts[id(tree)] > 0
            none = pa.nulls(int(some.sum()), pa.int64())
            found = [pa.array(tree[0][some]), pa.array(counts[id(tree)][some])]
            yield pa.RecordBatch.from_arrays([*found, none, none], schema=_MET)
        ends = [pa.array([x[k] for x in forest.links], pa.int64()) for k in (0, 1)]
        none = pa.nulls(len(forest.links), pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, *ends], schema=_MET)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sides = None, ([], [])
        for batch in batches:
            for row in range(batch.num_rows):
                x, y, side = (batch.column(c)[row].as_py() for c in ("x", "y", "side"))
                if (x, y) != key:
                    if key:
                        yield from meet(sides[0], None if key[0] == key[1] else sides[1])
                    key, sides = (x, y), ([], [])
                sides[side].append(pickle.loads(batch.column("tree")[row].as_py()))
        if key:
            yield from meet(sides[0], None if key[0] == key[1] else sides[1])

    return run


def _unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unit vectors as bytes; null where a vector is null, empty, zero, or holds a null or a
    non-finite component."""
    for batch in batches:
        found = []
        for vector in batch.column("vector").to_pylist():
            unit = None
            if vector and None not in vector:
                values = np.array(vector, np.float64)
                if np.isfinite(values).all() and (top := np.abs(values).max()) > 0:
                    values = values / top
                    unit = (values / np.linalg.norm(values)).tobytes()
            found.append(unit)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(found, pa.binary())], names=["id", "vector"]
        )


def near_duplicates(
    table: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    cosine: float = 0.95,
    block: int = BLOCK,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors link when their cosine in double precision is at least `cosine` (above 0). Vectors
    that are null, empty, zero, or hold a null or non-finite component link with nothing, and
    vectors of different lengths do not link with each other. Equal vectors are one class,
    compared once; each counts the others as partners. Rows that repeat an id are vectors of
    their own with one component. A row with a null id takes no part: no links, null component,
    kept false. An empty table gives an empty result; other columns are not read.
    """
    spark = table.sparkSession
    raw = table.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("vector"),
    )
    rows = stored(raw.mapInArrow(_unit, "id long, vector binary"), "unit")
    able = rows.filter("id IS NOT NULL AND vector IS NOT NULL")
    classes = checkpointed(
        able.groupBy("vector")
        .agg(F.min("id").alias("first"), F.count("*").alias("copies"))
        .withColumn("cid", F.monotonically_increasing_id())
        .withColumn("size", F.octet_length("vector"))
    )
    centres = _top_levels(classes, block)
    placed = stored(classes.select("cid", "first", "copies", "size", "vector").mapInArrow(_nearest(centres), _PLACED), "cells")
    # As many rows as there are centres, and one for each size without any.
    cells = (
        placed.groupBy("size", "cell").agg(F.count("*").alias("n"), F.max("away").alias("radius")).toPandas()
    ).sort_values(["size", "cell"], ignore_index=True)
    if not len(cells):
        cells = cells.astype({"size": "int32", "cell": "int32", "n": "int64", "radius": "float64"})
        reaching = pd.DataFrame({"size": [], "a": [], "b": []}).astype("int32")
    else:
        reaching = _reaching(cells, centres, cosine)
    before = cells["n"].cumsum() - cells["n"]
    cells["before"] = before
    known_cells = spark.createDataFrame(cells, "size int, cell int, n long, radius double, before long")
    pairs = spark.createDataFrame(reaching, "size int, a int, b int")
    # Blocks of a cell, and tiles of the blocks that follow each other. Both tables are bounded by `CENTRES`.
    count = F.ceil(F.col("n") / block)
    number = F.pmod(F.xxhash64("vector"), count)
    dealt = placed.join(F.broadcast(known_cells), ["size", "cell"]).select(
        *("cid", "first", "copies", "size", "vector", "cell"),
        F.floor((F.col("before") + number * block) / (TILE * block)).cast("int").alias("tile"),
        number.cast("int").alias("block"),
    )
    key = ["size", "cell", "tile", "block"]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    trees = stored(
        # Some MB a block: the adaptive reader would plant many in one task.
        dealt.repartition(tasks, *key).groupBy(*key).applyInPandas(_plant, "size int, cell int, tile int, block int, tree binary"),
        "trees",
    )
    places = trees.select("size", "cell", "tile").distinct()
    tiles = checkpointed(
        pairs.join(places.withColumnRenamed("cell", "a").withColumnRenamed("tile", "x"), ["size", "a"])
        .join(places.withColumnRenamed("cell", "b").withColumnRenamed("tile", "y"), ["size", "b"])
        .select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
        .distinct()
    )
    first = tiles.join(trees.select(F.col("tile").alias("x"), "tree"), "x").select("x", "y", F.lit(0).alias("side"), "tree")
    second = (
        tiles.filter("x < y")
        .join(trees.select(F.col("tile").alias("y"), "tree"), "y")
        .select("x", "y", F.lit(1).alias("side"), "tree")
    )
    linked = set(map(tuple, reaching[["size", "a", "b"]].to_numpy(np.int64).tolist()))
    met = checkpointed(
        first.unionByName(second)
        .repartition(1 + tiles.count(), "x", "y")
        .sortWithinPartitions("x", "y", "side")
        .mapInArrow(_meet(cosine, linked), "cid long, partners long, a long, b long")
    )
    partners = met.filter("cid IS NOT NULL").groupBy("cid").agg(F.sum("partners").alias("partners"))
    same = able.join(classes, "vector").select(F.col("id").alias("a"), F.col("first").alias("b"))
    found = components(met.filter("a IS NOT NULL").select("a", "b").union(same))
    known = classes.select("vector", "cid", "copies").join(partners, "cid", "left")
    valid = F.col("id").isNotNull()
    component = F.coalesce("component", "id")
    links = F.when(valid, F.coalesce(F.col("copies") - 1 + F.coalesce("partners", F.lit(0)), F.lit(0)))
    return (
        rows.join(known, "vector", "left")
        .join(found, "id", "left")
        .select(
            F.col("id").alias("vec_id"),
            F.coalesce(links, F.lit(0)).cast("long").alias("n_links"),
            component.alias("component_id"),
            F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
        )
    )
