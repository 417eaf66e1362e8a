"""Listing of report trees as a table.

`report_tree` is a data source with one row per report file: its path, length and time, and the
folders on its way. Its tasks are states, or states and months where a filter names the months, and
the executors list what lies below. Filters that name states, years or months decide
which folders are listed at all. The driver sees the names of states at most.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from fnmatch import fnmatchcase
from itertools import product

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F

from regflow.schema import REPORT_FILE, Grain
from regflow.session import ship_by_value
from regflow.sources.store import open_store

ship_by_value("regflow.sources.store")
ship_by_value(__name__)

SCHEMA = "path string, length long, modified timestamp, State string, folder string, Year string, Month string"
_LEVELS = ("State", "Year", "Month")


class Folders(ds.InputPartition):
    def __init__(self, wanted: list[tuple[str, str | None, str | None]]):
        self.wanted = wanted


class TreeReader(ds.DataSourceReader):
    def __init__(self, options: dict):
        self.root = options["path"].rstrip("/")
        self.inner = options.get("inner", "false") == "true"
        self.pattern = options.get("pattern", REPORT_FILE)
        self.tasks = int(options.get("tasks", 64))
        self.names: dict[str, set[str] | None] = dict.fromkeys(_LEVELS)

    def pushFilters(self, filters):
        for kept in filters:
            column = getattr(kept, "attribute", None)
            level = column[0] if column and len(column) == 1 else None
            if level in self.names and isinstance(kept, (ds.EqualTo, ds.In)):
                values = [kept.value] if isinstance(kept, ds.EqualTo) else kept.value
                found = {v for v in values if v is not None}
                before = self.names[level]
                self.names[level] = found if before is None else before & found
            else:
                yield kept

    def _folders(self, files, path: str, wanted: set[str] | None = None) -> list[str]:
        from pyarrow import fs

        # A wanted folder need not be looked for in a listing of all.
        if wanted is not None:
            return sorted(wanted)
        listed = files.get_file_info(fs.FileSelector(path, allow_not_found=True))
        return sorted(i.base_name for i in listed if i.type == fs.FileType.Directory and i.base_name[0] not in "._")

    def partitions(self):
        files, base = open_store(self.root)
        states = self._folders(files, base, self.names["State"])
        years, months = (
            sorted(names) if names is not None else [None] for names in (self.names["Year"], self.names["Month"])
        )
        wanted = list(product(states, years, months))
        tasks = max(1, min(self.tasks, len(wanted)))
        return [Folders(wanted[k::tasks]) for k in range(tasks)]

    def read(self, partition) -> Iterator[tuple]:
        files, base = open_store(self.root)
        for state, year, month in partition.wanted:
            at = f"{base.rstrip('/')}/{state}"
            for folder in self._folders(files, at) if self.inner else [None]:
                yield from self._months(files, at, state, folder, year, month)

    def _months(self, files, at: str, state: str, folder: str | None, year, month) -> Iterator[tuple]:
        from pyarrow import fs

        at, way = (at, state) if folder is None else (f"{at}/{folder}", f"{state}/{folder}")
        for y in [year] if year is not None else self._folders(files, at):
            for m in [month] if month is not None else self._folders(files, f"{at}/{y}"):
                place = fs.FileSelector(f"{at}/{y}/{m}", allow_not_found=True)
                for found in files.get_file_info(place):
                    if found.type == fs.FileType.File and fnmatchcase(found.base_name, self.pattern):
                        path = f"{self.root}/{way}/{y}/{m}/{found.base_name}"
                        yield path, found.size, found.mtime, state, folder, y, m


class ReportTree(ds.DataSource):
    """Options: path (the root), inner (true for trees with a folder between state and year),
    pattern (of file names), tasks."""

    @classmethod
    def name(cls) -> str:
        return "report_tree"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> TreeReader:
        return TreeReader(dict(self.options))


def list_reports(
    spark: SparkSession,
    root: str,
    grain: Grain,
    years: Sequence[str] | None = None,
    months: Sequence[str] | None = None,
    states: Sequence[str] | None = None,
    pattern: str = REPORT_FILE,
) -> DataFrame:
    """Report files of a tree, those of zero length included; none where nothing is found."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ReportTree)
    reader = spark.read.format("report_tree").option("pattern", pattern)
    reader = reader.option("inner", str(len(grain.folders) > 1).lower())
    found = reader.option("tasks", 4 * spark.sparkContext.defaultParallelism).load(root)
    for level, names in zip(_LEVELS, (states, years, months), strict=True):
        if names is not None:
            found = found.filter(F.col(level).isin([str(n) for n in names]))
    return found


def list_folder(
    spark: SparkSession, root: str, pattern: str = "*", recursive: bool = True
) -> DataFrame:
    """(path, length, modified) of the files below a folder, listed by one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, base = open_store(root)
        for batch in batches:
            for _ in range(batch.num_rows):
                found = []
                if files.get_file_info(base).type == fs.FileType.Directory:
                    found = files.get_file_info(fs.FileSelector(base, recursive=recursive))
                kept = [
                    i for i in found if i.type == fs.FileType.File and fnmatchcase(i.base_name, pattern)
                ]
                names = [f"{root.rstrip('/')}{i.path[len(base.rstrip('/')):]}" for i in kept]
                times = pa.array([i.mtime for i in kept], pa.timestamp("us", "UTC"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.string()), pa.array([i.size for i in kept], pa.int64()), times],
                    names=["path", "length", "modified"],
                )

    return spark.range(0, 1, 1, 1).mapInArrow(run, "path string, length long, modified timestamp")


def in_months(listed: DataFrame, months: Sequence[tuple[str, str]]) -> DataFrame:
    """Files of some (year, month label) pairs."""
    pairs = [f"{year}/{month}" for year, month in months]
    return listed.filter(F.concat_ws("/", "Year", "Month").isin(pairs))
