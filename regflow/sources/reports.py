"""Report discovery, validity and bulk reading."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regflow.functions import text
from regflow.schema import HEADER_ROWS_SKIPPED, Grain
from regflow.session import ship_by_value
from regflow.sources.store import Store
from regflow.sources.tree import list_reports
from regflow.sources.workbook import is_workbook, named, open_workbook, table

ship_by_value("regflow.sources.workbook")
ship_by_value(__name__)

FILE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)

# One row per sheet row. A report without data rows gives one row with NULL row_no
# and cells, so a single pass counts files, empty reports and rows. `title` is the text
# of the first sheet row.
ROW_SCHEMA = "path string, title string, row_no int, cells map<string, string>"


def scan_files(spark: SparkSession, pattern: str) -> DataFrame:
    """The few files of a pattern, such as one workbook, with their content; an empty frame when
    nothing matches. Files of zero length are left out by Spark; report trees, where these
    matter, are listed by `tree.list_reports`."""
    try:
        return spark.read.schema(FILE_SCHEMA).format("binaryFile").load(pattern)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FILE_SCHEMA)


def discover(
    spark: SparkSession,
    root: str,
    grain: Grain,
    month: str | None = None,
    year: str | None = None,
    states: Sequence[str] | None = None,
) -> DataFrame:
    """Reports of a month with the dimensions their path carries."""
    found = list_reports(spark, root, grain, [year] if year else None, [month] if month else None, states)
    return path_dimensions(found.select("path", "modified", "length"), grain)


def path_piece(path: Column, from_end: int) -> Column:
    return F.try_element_at(F.split(path, "/"), F.lit(-from_end))


def path_dimensions(files: DataFrame, grain: Grain) -> DataFrame:
    """Add Month, Year and the folder dimensions of each `path`."""
    path = F.col("path")
    inner = path_piece(path, 4)
    outer = path_piece(path, 5)
    added = {"Month": path_piece(path, 2), "Year": path_piece(path, 3)}
    if grain.folders[-1] == "Office":
        added["rto_name"] = text.office_folder_name(inner)
        added["rto_code"] = text.office_folder_code(inner)
    elif grain.folders[-1] == "Vehicle Class":
        added["Vehicle Class"] = inner
    added["State"] = outer if len(grain.folders) > 1 else inner
    return files.withColumns(added)


_ROWS_PER_BATCH = 4096


class _RowBatch:
    """Sheet rows of some reports, column by column."""

    def __init__(self):
        self.paths, self.titles, self.numbers = [], [], []
        self.offsets, self.keys, self.items = [0], [], []

    def add(
        self, path: str, title: str, headers: list[str], rows: list[dict[int, str]], empty_cells: bool
    ) -> None:
        count = len(rows) or 1
        self.paths += [path] * count
        self.titles += [title] * count
        self.numbers += range(count) if rows else [None]
        if not rows:
            self.offsets[-1:] = [None, len(self.keys)]
        one_each = len(set(headers)) == len(headers)
        for cells in rows:
            if not one_each:
                texts = named(headers, cells).items()
                self._extend(*zip(*[(h, t) for h, t in texts if empty_cells or t is not None]))
            elif empty_cells:
                self._extend(headers, map(cells.get, range(len(headers))))
            else:
                self._extend([headers[place] for place in cells], cells.values())

    def _extend(self, keys: Iterable[str] = (), items: Iterable[str | None] = ()) -> None:
        self.keys += keys
        self.items += items
        self.offsets.append(len(self.keys))

    def arrow(self) -> pa.RecordBatch:
        cells = pa.MapArray.from_arrays(
            pa.array(self.offsets, pa.int32()), pa.array(self.keys, pa.string()), pa.array(self.items, pa.string())
        )
        columns = {
            "path": pa.array(self.paths, pa.string()),
            "title": pa.array(self.titles, pa.string()),
            "row_no": pa.array(self.numbers, pa.int32()),
            "cells": cells,
        }
        return pa.RecordBatch.from_pydict(columns)


@F.pandas_udf(T.BooleanType())
def workbook_is_valid(content: pd.Series) -> pd.Series:
    return content.map(is_workbook)


def with_validity(files: DataFrame) -> DataFrame:
    """Add `valid`: present, not empty, a zip, and holding the workbook parts."""
    return files.withColumn(
        "valid", F.coalesce(workbook_is_valid(F.col("content")), F.lit(False))
    )


def _sheet_rows(sheet: str | None, skip: int, drop_first: bool, empty_cells: bool):
    """Sheet rows of (path, content) pairs as batches; an invalid file raises."""

    def parse(files: Iterator[tuple[str, bytes]]) -> Iterator[pa.RecordBatch]:
        out = _RowBatch()
        for path, content in files:
            archive = open_workbook(content)
            if archive is None:
                raise ValueError(f"Invalid Excel report file: {path}")
            out.add(path, *table(archive, sheet, skip, drop_first), empty_cells)
            if len(out.paths) >= _ROWS_PER_BATCH:
                yield out.arrow()
                out = _RowBatch()
        if out.paths:
            yield out.arrow()

    return parse


def read_workbooks(
    files: DataFrame,
    sheet: str | None = None,
    skip: int = HEADER_ROWS_SKIPPED,
    drop_first: bool = True,
    empty_cells: bool = True,
) -> DataFrame:
    """Sheet rows of each file (path, content) as `ROW_SCHEMA`; an invalid file fails the job.

    Cells stay text. They travel as a map, so files with different headers need no
    union and the wide form is a projection without a shuffle. Without `empty_cells` the map leaves
    out headers whose cell is empty: these are NULL in the wide form as well, and few of the
    cells of a report are filled, so that a header is found sooner.
    """
    parse = _sheet_rows(sheet, skip, drop_first, empty_cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = zip_pairs(batches, "path", "content")
        yield from parse((path.as_py(), content.as_py()) for path, content in pairs)

    return files.select("path", "content").mapInArrow(run, ROW_SCHEMA)


def zip_pairs(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c) for c in columns), strict=True)


def _spread(listed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Listed files dealt to tasks by path. Their number is fixed: the rows are small, and the
    adaptive reader would pack files that take long to read into one task."""
    tasks = int(listed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return listed.select(*columns).repartition(tasks, "path")


def read_listed(listed: DataFrame, root: str, empty_cells: bool = True) -> DataFrame:
    """Sheet rows of listed files (path), which the tasks read themselves, so that no file's
    bytes pass through the JVM. `empty_cells` is as in `read_workbooks`."""
    parse = _sheet_rows(None, HEADER_ROWS_SKIPPED, True, empty_cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = Store(root)
        names = (path.as_py() for (path,) in zip_pairs(batches, "path"))
        yield from parse((name, store.read(name)) for name in names)

    return _spread(listed, ["path"]).mapInArrow(run, ROW_SCHEMA)


def check_listed(listed: DataFrame, root: str) -> DataFrame:
    """(path, valid) of listed files (path, length): not empty, a zip, and holding the workbook
    parts. A file of zero length is not opened."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = Store(root)
        for batch in batches:
            names, lengths = batch.column("path").to_pylist(), batch.column("length").to_pylist()
            valid = [bool(n) and is_workbook(store.read(p)) for p, n in zip(names, lengths, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("path"), pa.array(valid, pa.bool_())], names=["path", "valid"]
            )

    return _spread(listed, ["path", "length"]).mapInArrow(run, "path string, valid boolean")


def widen(rows: DataFrame, headers: Iterable[str]) -> DataFrame:
    """One column per wanted header; absent headers are NULL."""
    return rows.selectExpr(
        "path", "row_no", *[f"try_element_at(cells, '{h}') as `{h}`" for h in headers]
    )

