"""Exact duplicates by a tree merge of sorted digest runs.

Each partition turns its texts into a sorted run: one entry per distinct digest with the surviving
identifier and the number of rows. Runs are cut into blocks and meet in binomial rounds of radix
`RADIX`. In a round, cells that differ in one digit of their number exchange entries: an entry moves to
the cell whose digit equals that digit of its digest, and each cell merges all the sorted runs it
receives: blocks arrive in the order of their first entries, each is merged whole into what is pending, and
pending entries before the next block's first are done. No entry is sorted again. After the last round a
cell holds every entry of its share of the digests, fully merged, so no cell ever sees the whole corpus, and a text that
fills a third of all rows is one entry per run from the first round on.

An entry counts as equal only when SHA-256, length and a second, independent hash all agree,
and this is verified at every level of the merge.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regflow.llm.common import ascii_lower, checkpointed, ids_and_texts
from regflow.session import ship_by_value

ship_by_value(__name__)

RADIX = 8
#: Entries of a block.
BLOCK = 4096
_KEY = 48
#: Turns the order of signed numbers into that of their bytes.
_SIGN = np.uint64(1 << 63)
_ENTRY = "digest binary, size int, guard long, id long, n long"
_RUN = "cell int, first binary, keys binary, ids binary, known binary, counts binary"


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, SHA-256, byte length and a second hash of its text."""
    text = ascii_lower(F.col("text"))
    return ids_and_texts(docs, id_col, text_col).select(
        "id",
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.octet_length(text).alias("size"),
        F.xxhash64(text).alias("guard"),
    )


@dataclass
class Run:
    """Sorted entries. A key is the digest, then length and second hash, all as bytes."""

    keys: np.ndarray
    ids: np.ndarray
    known: np.ndarray
    counts: np.ndarray

    def __len__(self) -> int:
        return len(self.keys)

    def __getitem__(self, part) -> Run:
        return Run(self.keys[part], self.ids[part], self.known[part], self.counts[part])

    def folded(self, largest: bool) -> Run:
        """One entry for each key. Null ids lose to any other."""
        if len(self) < 2:
            return self
        starts = np.flatnonzero(np.r_[True, self.keys[1:] != self.keys[:-1]])
        best = np.maximum if largest else np.minimum
        return Run(
            self.keys[starts],
            best.reduceat(self.ids, starts),
            np.logical_or.reduceat(self.known, starts),
            np.add.reduceat(self.counts, starts),
        )

    def merged(self, other: Run, largest: bool) -> Run:
        """Both sorted runs as one: each entry of `other` is put in its place."""
        at = np.searchsorted(self.keys, other.keys) + np.arange(len(other))
        own = np.ones(len(self) + len(other), bool)
        own[at] = False

        def laid(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            both = np.empty(len(own), a.dtype)
            both[own], both[at] = a, b
            return both

        return Run(
            laid(self.keys, other.keys),
            laid(self.ids, other.ids),
            laid(self.known, other.known),
            laid(self.counts, other.counts),
        ).folded(largest)


def joined(runs: list[Run]) -> Run:
    """Runs that follow each other."""
    return Run(*(np.concatenate([getattr(r, f) for r in runs]) for f in ("keys", "ids", "known", "counts")))


def _lowest(largest: bool) -> int:
    return np.iinfo(np.int64).min if largest else np.iinfo(np.int64).max


def _run_of(batch: pa.RecordBatch, largest: bool) -> Run:
    """Entries of rows (digest, size, guard, id) in the order of their keys."""
    size = np.asarray(batch.column("size")).astype(">u8")
    guard = (np.asarray(batch.column("guard")).view(np.uint64) ^ _SIGN).astype(">u8")
    digest = np.frombuffer(b"".join(batch.column("digest").to_pylist()), np.uint8).reshape(-1, 32)
    parts = [digest, size.view(np.uint8).reshape(-1, 8), guard.view(np.uint8).reshape(-1, 8)]
    keys = np.ascontiguousarray(np.concatenate(parts, axis=1)).view(f"S{_KEY}").ravel()
    ids = batch.column("id")
    return Run(
        keys,
        ids.fill_null(_lowest(largest)).to_numpy(zero_copy_only=False),
        ids.is_valid().to_numpy(zero_copy_only=False),
        np.ones(len(keys), np.int64),
    )


class Blocks:
    """Cuts runs into blocks for the cells to which their entries move in a round."""

    def __init__(self, level: int):
        self.level, self.held, self.size = level, {}, {}

    def add(self, cell: int, run: Run) -> Iterator[pa.RecordBatch]:
        bytes_ = np.ascontiguousarray(run.keys).view(np.uint8).reshape(-1, _KEY)
        place = bytes_[:, self.level] % RADIX if len(run) else np.empty(0, np.uint8)
        unit = RADIX**self.level
        for digit in np.unique(place).tolist():
            goal = cell + (digit - cell // unit % RADIX) * unit
            part = run[place == digit]
            # Runs of different cells stay apart, so that every block is sorted.
            way = cell, goal
            self.held.setdefault(way, []).append(part)
            self.size[way] = self.size.get(way, 0) + len(part)
            if self.size[way] >= BLOCK:
                yield self._block(way)

    def rest(self) -> Iterator[pa.RecordBatch]:
        for way in list(self.held):
            yield self._block(way)

    def _block(self, way: tuple[int, int]) -> pa.RecordBatch:
        run = joined(self.held.pop(way))
        del self.size[way]
        keys = run.keys.tobytes()
        columns = [keys[:_KEY], keys, run.ids.tobytes(), run.known.tobytes(), run.counts.tobytes()]
        names = ["cell", "first", "keys", "ids", "known", "counts"]
        return pa.RecordBatch.from_arrays(
            [pa.array([way[1]], pa.int32()), *(pa.array([c], pa.binary()) for c in columns)], names=names
        )


def _first_runs(cells: int, largest: bool):
    """Rows in the order of their keys to the blocks of the first round."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell = TaskContext.get().partitionId() % cells
        blocks, held = Blocks(0), None
        for batch in batches:
            if not batch.num_rows:
                continue
            run = _run_of(batch, largest)
            run = (run if held is None else joined([held, run])).folded(largest)
            # The last entry may go on in the next batch.
            held, run = run[-1:], run[:-1]
            yield from blocks.add(cell, run)
        if held is not None:
            yield from blocks.add(cell, held)
        yield from blocks.rest()

    return build


def merge_blocks(batches: Iterator[pa.RecordBatch], largest: bool) -> Iterator[tuple[int, Run]]:
    """Merged entries (cell, run) of blocks in the order of cell and first key."""
    cell, pending = None, None
    for batch in batches:
        for row in batch.to_pylist():
            if pending is not None and row["cell"] != cell:
                yield cell, pending
                pending = None
            cell = row["cell"]
            run = Run(
                np.frombuffer(row["keys"], f"S{_KEY}"),
                np.frombuffer(row["ids"], np.int64),
                np.frombuffer(row["known"], bool),
                np.frombuffer(row["counts"], np.int64),
            )
            if pending is not None:
                # Later blocks begin where this one does, or after it.
                done = int(np.searchsorted(pending.keys, run.keys[:1])[0])
                if done:
                    yield cell, pending[:done]
                run = pending[done:].merged(run, largest)
            pending = run
    if pending is not None:
        yield cell, pending


def _next_round(level: int, largest: bool):
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = Blocks(level)
        for cell, run in merge_blocks(batches, largest):
            yield from blocks.add(cell, run)
        yield from blocks.rest()

    return merge


def _entries(largest: bool):
    """The last round: entries as rows."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, run in merge_blocks(batches, largest):
            bytes_ = np.ascontiguousarray(run.keys).view(np.uint8).reshape(-1, _KEY)
            digest = np.ascontiguousarray(bytes_[:, :32]).tobytes()
            size = np.ascontiguousarray(bytes_[:, 32:40]).view(">u8").ravel().astype(np.int32)
            guard = np.ascontiguousarray(bytes_[:, 40:]).view(">u8").ravel().astype(np.uint64) ^ _SIGN
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([digest[k : k + 32] for k in range(0, len(digest), 32)], pa.binary()),
                    pa.array(size),
                    pa.array(guard.view(np.int64)),
                    pa.array(run.ids, pa.int64(), mask=~run.known),
                    pa.array(run.counts),
                ],
                names=["digest", "size", "guard", "id", "n"],
            )

    return unpack


def merged_runs(rows: DataFrame, keep: str = "largest") -> DataFrame:
    """Digest rows to one entry per distinct digest: digest, size, guard, id, n."""
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep is largest or smallest, not {keep!r}")
    largest = keep == "largest"
    spark = rows.sparkSession
    rounds, cells = 1, RADIX
    while cells < int(spark.conf.get("spark.sql.shuffle.partitions")):
        rounds, cells = rounds + 1, cells * RADIX
    runs = (
        rows.select("digest", "size", "guard", "id")
        .sortWithinPartitions("digest", "size", "guard")
        .mapInArrow(_first_runs(cells, largest), _RUN)
    )
    for level in range(rounds):
        last = level + 1 == rounds
        runs = (
            runs.repartitionById(cells, "cell")
            .sortWithinPartitions("cell", "first")
            .mapInArrow(_entries(largest) if last else _next_round(level + 1, largest), _ENTRY if last else _RUN)
        )
    return runs


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest"
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; a null text is an empty one. Rows
    that repeat both id and text are equal too, and all of them carry kept = true if theirs is
    the id that stays. A null id loses to any other; a group of null ids has keep_id null and
    keeps its rows. An empty table gives an empty result; further columns are not read.
    """
    rows = checkpointed(digests(docs, id_col, text_col))
    merged = merged_runs(rows, keep).select(
        "digest", "size", "guard", F.col("id").alias("keep_id"), F.col("n").alias("group_size")
    )
    # A digest that fills much of the left side is split by the adaptive skew join.
    return rows.join(merged, ["digest", "size", "guard"], "inner").select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
