"""Moving raw reports and CSV files to object storage."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regflow.schema import MONTHS
from regflow.session import ship_by_value
from regflow.sources.reports import path_piece
from regflow.sources.store import Store, open_store

ship_by_value(__name__)


def object_name(path: Column, root: str) -> Column:
    """Path relative to `root`, with forward slashes."""
    slashed = F.replace(path, F.lit("\\"), F.lit("/"))
    start = rf"^([a-z0-9]+:/+)?/?{re.escape(root.strip('/'))}/"
    return F.regexp_replace(slashed, start, "")


def archive_manifest(files: DataFrame, root: str) -> DataFrame:
    """Each file with its object name; equal base names in one folder stay apart."""
    return files.select("path", object_name(F.col("path"), root).alias("object_name"))


def history_manifest(files: DataFrame, root: str, first_year: int, last_year: int) -> DataFrame:
    """Manifest of all months of a range of years, from one scan."""
    year, month = path_piece(F.col("path"), 3), path_piece(F.col("path"), 2)
    wanted = year.isin([str(y) for y in range(first_year, last_year + 1)]) & month.isin(*MONTHS)
    return archive_manifest(files.filter(wanted), root)


def pick_csv(files: DataFrame, prefix: Column, by: str, name: str = "name") -> DataFrame:
    """Per group the smallest CSV name that starts with the prefix, else NULL."""
    matching = F.startswith(F.col(name), prefix) & F.endswith(F.col(name), F.lit(".csv"))
    return files.groupBy(by).agg(F.min(F.when(matching, F.col(name))).alias("csv_name"))


#: Bytes that a copy holds at a time.
CHUNK = 4 << 20


def _digest(stream, sink=None) -> tuple[str, int]:
    """SHA-256 and length of a stream, which goes on to `sink` chunk by chunk."""
    found, length = hashlib.sha256(), 0
    while chunk := stream.read(CHUNK):
        found.update(chunk)
        length += len(chunk)
        if sink is not None:
            sink.write(chunk)
    return found.hexdigest(), length


def copy_listed(files: DataFrame, root: str, target: str) -> DataFrame:
    """Copy listed files (path) from below `root` to below `target`: path, object_name, length, sha256.

    The tasks stream each file in chunks and read the copy again: one whose length
    or digest differs fails the job. An object is overwritten, so a task that runs again does no
    harm. The copies are made whenever the result is computed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = Store(root)
        goals, base = open_store(target)
        for batch in batches:
            paths = batch.column("path").to_pylist()
            names = [path[len(store.root) + 1 :] for path in paths]
            done = []
            for path, name in zip(paths, names, strict=True):
                goal = f"{base.rstrip('/')}/{name}"
                goals.create_dir(goal.rsplit("/", 1)[0], recursive=True)
                with store.files.open_input_stream(store.inner(path)) as source:
                    with goals.open_output_stream(goal) as sink:
                        read = _digest(source, sink)
                with goals.open_input_stream(goal) as copy:
                    written = _digest(copy)
                if read != written:
                    raise OSError(f"the copy of {path} differs: {read} and {written}")
                done.append(read)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(paths, pa.string()),
                    pa.array(names, pa.string()),
                    pa.array([length for _, length in done], pa.int64()),
                    pa.array([digest for digest, _ in done], pa.string()),
                ],
                names=["path", "object_name", "length", "sha256"],
            )

    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = files.select("path").repartition(tasks, "path")
    return spread.mapInArrow(run, "path string, object_name string, length long, sha256 string")


def copy_files(files: DataFrame, root: str, target: str) -> int:
    """Copy files whose content is at hand (path, content) below `target` from the executors;
    returns their number. An object is overwritten, so a task that runs again does no harm."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        goals, base = open_store(target)
        for batch in batches:
            for name, content in zip(batch.column("object_name"), batch.column("content"), strict=True):
                goal = f"{base.rstrip('/')}/{name.as_py()}"
                goals.create_dir(goal.rsplit("/", 1)[0], recursive=True)
                with goals.open_output_stream(goal) as sink:
                    sink.write(content.as_py())
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["copied"])

    named = files.select(object_name(F.col("path"), root).alias("object_name"), "content")
    return named.mapInArrow(run, "copied long").agg(F.sum("copied")).first()[0] or 0
