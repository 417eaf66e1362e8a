"""CSV files whose quoted values may hold line breaks, read in ranges of bytes.

Whether a range begins inside a quoted value depends on the number of quotes before it: doubled quotes
do not change whether that is odd. So one pass counts the quotes of each range, a running sum over the
ranges of a file gives the state in which each begins, and a second pass lets each range start at its first true record and
read on to the end of its last one. Files of one range need no counting. Records are cut in
Python, in array passes over the bytes, and parsed by Spark.

Quotes must stand around whole values, as RFC 4180 has it and Spark writes them.
"""

from __future__ import annotations

import csv
import glob
import io
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regflow.session import ship_by_value
from regflow.sources.store import Store
from regflow.sources.tree import list_folder

ship_by_value("regflow.sources.store")
ship_by_value(__name__)

#: Bytes of a range, and of a step when a record goes on beyond its range.
RANGE, STEP = 32 << 20, 1 << 16
#: Bytes looked at together: what a task holds besides its range does not grow with the range.
BLOCK = 1 << 20
_QUOTE, _BREAK = 34, 10


def csv_ranges(listed: DataFrame, size: int = RANGE) -> DataFrame:
    """(path, length, offset) of the ranges of listed files (path, length); empty files have none."""
    offsets = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(size).cast("long"))
    return listed.filter("length > 0").select("path", "length", F.explode(offsets).alias("offset"))


def _spread(ranges: DataFrame) -> DataFrame:
    tasks = int(ranges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return ranges.repartition(tasks, "path", "offset")


def _chunk(files, at: int, size: int) -> np.ndarray:
    files.seek(at)
    return np.frombuffer(files.read(size), np.uint8)


def _quotes(data: np.ndarray) -> int:
    return int(np.count_nonzero(data == _QUOTE))


def _outer_breaks(data: np.ndarray, inside: int) -> tuple[np.ndarray, int]:
    """Places of the line breaks outside quoted values, and whether the data ends inside one."""
    found = []
    for at in range(0, len(data), BLOCK):
        block = data[at : at + BLOCK]
        # Eight bits wrap around, which keeps whether a count is odd.
        odd = (np.cumsum(block == _QUOTE, dtype=np.uint8) + np.uint8(inside)) & np.uint8(1)
        found.append(np.flatnonzero((block == _BREAK) & (odd == 0)) + at)
        inside = int(odd[-1])
    return np.concatenate(found) if found else np.empty(0, np.int64), inside


def with_quotes_before(ranges: DataFrame, root: str, size: int = RANGE) -> DataFrame:
    """Ranges with `inside`: whether an odd number of quotes precedes them in their file."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = Store(root)
        for batch in batches:
            odd = []
            for path, at in zip(batch.column("path").to_pylist(), batch.column("offset").to_pylist(), strict=True):
                with store.files.open_input_file(store.inner(path)) as data:
                    steps = range(at, at + size, BLOCK)
                    odd.append(sum(_quotes(_chunk(data, k, min(BLOCK, at + size - k))) for k in steps) & 1)
            columns = [batch.column(c) for c in ("path", "length", "offset")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(odd, pa.int32())], names=["path", "length", "offset", "odd"])

    several = F.col("length") > size
    counted = _spread(ranges.filter(several)).mapInArrow(count, "path string, length long, offset long, odd int")
    before = Window.partitionBy("path").orderBy("offset").rowsBetween(Window.unboundedPreceding, -1)
    inside = (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).cast("int")
    return counted.select("path", "length", "offset", inside.alias("inside")).unionByName(
        ranges.filter(~several).withColumn("inside", F.lit(0))
    )


def _records(files, offset: int, size: int, inside: int) -> tuple[bytes, np.ndarray]:
    """The bytes of the records that begin in a range, and the places where they end."""
    # A record begins behind a line break, which may be the byte before the range.
    start = max(0, offset - 1)
    data = _chunk(files, start, size + offset - start)
    # `inside` has counted that byte.
    breaks, last = _outer_breaks(data, inside ^ (_quotes(data[: offset - start]) & 1))
    if offset == 0:
        first = 0
    elif len(breaks) and breaks[0] < len(data) - 1:
        first = int(breaks[0]) + 1
    else:
        return b"", np.empty(0, np.int64)
    ends = breaks[breaks >= first] + 1
    if len(ends) and ends[-1] == len(data):
        return data[first:].tobytes(), ends - first
    # The last record goes on: read until its own line break or the end of the file.
    parts, length = [data[first:]], len(data)
    while True:
        more = _chunk(files, start + length, STEP)
        breaks, last = _outer_breaks(more, last)
        if len(breaks) or not len(more):
            end = int(breaks[0]) + 1 if len(breaks) else 0
            parts.append(more[:end])
            return np.concatenate(parts).tobytes(), np.r_[ends, length + end] - first
        parts.append(more)
        length += len(more)


def read_records(ranges: DataFrame, root: str, size: int = RANGE) -> DataFrame:
    """(path, record) of all records of ranges with `inside`, without each file's header."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = Store(root)
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("path", "offset", "inside")), strict=True)
            for path, offset, inside in rows:
                with store.files.open_input_file(store.inner(path)) as files:
                    data, ends = _records(files, offset, size, inside)
                bounds = np.r_[0, ends].astype(np.int64)
                # The header is the first record of a file.
                bounds = bounds[1:] if offset == 0 else bounds
                if len(bounds) < 2:
                    continue
                # Cut with as many records at a time as make up a moderate batch.
                cuts = np.unique(np.searchsorted(bounds, np.arange(bounds[0], bounds[-1], 4 << 20), "left"))
                # A cut inside the last record would begin a batch without any.
                cuts = cuts[cuts < len(bounds) - 1]
                for a, b in zip(cuts, [*cuts[1:], len(bounds) - 1], strict=True):
                    part = bounds[a : b + 1]
                    buffers = [None, pa.py_buffer((part - part[0]).tobytes()), pa.py_buffer(data[part[0] : part[-1]])]
                    records = pa.Array.from_buffers(pa.large_string(), b - a, buffers).cast(pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array([path] * int(b - a), pa.string()), records], names=["path", "record"])

    return _spread(ranges).mapInArrow(run, "path string, record string")


def header_of(listed: DataFrame, root: str) -> list[str]:
    """Column names in the first file that is not empty; none without such a file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = Store(root)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with store.files.open_input_file(store.inner(path)) as files:
                    data, ends = _records(files, 0, STEP, 0)
                text = data[: ends[0]].decode("utf-8-sig", "replace")
                names = next(csv.reader(io.StringIO(text, newline="")), [])
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], names=["name"])

    first = listed.filter("length > 0").orderBy("path").limit(1).select("path")
    return [row.name for row in first.mapInArrow(run, "name string").collect()]


def read_csv(
    spark: SparkSession,
    path: str,
    options: dict[str, str],
    columns: Sequence[str] | None = None,
    size: int = RANGE,
) -> DataFrame | None:
    """All values of a CSV file, or of the files below a folder, as text; None without files.

    `columns` are those of the files, by default the first file's header. Folders named
    `column=value` add columns.
    """
    root = path.rstrip("/")
    listed = list_folder(spark, root, "*.csv")
    first = listed.orderBy("path").first()
    if first is None:
        # A single file: its folder is the root.
        root, name = root.rsplit("/", 1)
        listed = list_folder(spark, root, glob.escape(name), recursive=False)
        first = listed.first()
        if first is None:
            return None
    names = list(columns) if columns is not None else header_of(listed, root)
    ranges = with_quotes_before(csv_ranges(listed, size), root, size)
    records = read_records(ranges, root, size).withColumn("record", F.rtrim("record", F.lit("\r\n")))
    records = records.filter("record <> ''")
    kind = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    folders = re.findall("/([^/=]+)=[^/]*(?=/)", first.path[len(root) :])
    added = {
        n: F.url_decode(F.replace(F.regexp_extract("path", f"/{re.escape(n)}=([^/]*)/", 1), F.lit("+"), F.lit("%2B")))
        for n in folders
    }
    parsed = records.select("path", F.from_csv("record", kind, options).alias("row"))
    return parsed.select(
        *(F.col("row")[n].alias(n) for n in names), *(value.alias(n) for n, value in added.items())
    )
