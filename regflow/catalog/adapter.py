"""Star-schema tables in the shape of registration reports.

A report cell is the largest price of a fuel in a (place, class, month), rounded down: a
whole number with thousands separators that stays an INT however large the tables are.
A re-scraped report (`pick="min"`) holds the smallest price instead.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter
from xml.sax.saxutils import escape

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regflow.functions import dates, text
from regflow.operators import coverage, load
from regflow.operators.keys import computed_once
from regflow.plans.monthly import preprocess
from regflow.schema import (
    FUEL_HEADERS,
    GRAINS,
    LABEL_HEADER,
    MAPPING_HEADERS,
    REPORT_FILE,
    STATES,
    TOTAL_HEADER,
    Grain,
)
from regflow.session import ship_by_value

ship_by_value(__name__)

# Return flag and line status of a line -> fuel header. RO lines carry a header no grain
# knows from the year 2000 on, as when the source adds a column.
FUELS = {
    "AF": "DIESEL",
    "AO": "PETROL",
    "NF": "PURE EV",
    "NO": "ELECTRIC(BOV)",
    "RF": "CNG ONLY",
    "RO": "STRONG HYBRID EV",
}
NEW_HEADER = "ETHANOL"
NEW_HEADER_YEAR = 2000
CELL_HEADERS = (*FUELS.values(), NEW_HEADER)
RAW_HEADERS = (LABEL_HEADER, *CELL_HEADERS, TOTAL_HEADER)
RESCRAPE_FROM = "2000-01-01"
AS_OF = "2001-11-15"

# Stand-ins for the block page texts, found in some of the test pages.
BLOCKED_TITLE = "The and attion to thanedble the, anea. Eriner thanea."
BLOCKED_MARKERS = ("track(0)", "Nicht", "que&amp;")


# Declared, so that reading a table starts no job to look at its footers.
TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_brand string, p_type string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_extendedprice double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf}/{name}.parquet")


_STATE_ARRAY = "array(" + ", ".join(f"'{s}'" for s in STATES) + ")"


def state_of(nation_key: Column) -> Column:
    return F.try_element_at(F.expr(_STATE_ARRAY), nation_key + 1)


def class_label(part_type: Column) -> Column:
    return F.concat(F.lit("CLASS-"), part_type, F.lit("(LMV)"))


def month_start(timestamp: Column) -> Column:
    return F.trunc(timestamp.cast("date"), "month")


def states(spark: SparkSession, sf: str) -> DataFrame:
    """States that have a nation, one row each."""
    return table(spark, sf, "nation").select(
        "n_nationkey", "n_regionkey", state_of(F.col("n_nationkey")).alias("state")
    )


def offices(spark: SparkSession, sf: str) -> DataFrame:
    """Offices with their labels. Those with a negative balance have a malformed label,
    hence a folder without a code."""
    label = F.replace("s_name", F.lit("#"), F.lit("/"))
    good = F.concat(label, F.lit(" - R"), F.col("s_suppkey"), F.lit("( 01-JAN-2020 )"))
    suppliers = table(spark, sf, "supplier").withColumn(
        "office_label", F.when(F.col("s_acctbal") >= 0, good).otherwise(label)
    )
    folder = F.coalesce(
        text.office_folder(F.col("office_label")),
        F.replace("office_label", F.lit("/"), F.lit("")),
    )
    return suppliers.join(states(spark, sf), F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", "s_acctbal", "n_regionkey", "state", "office_label",
        folder.alias("folder"),
    )


def mapping(spark: SparkSession, sf: str) -> DataFrame:
    """The mapping that reports are joined to: PROMO is unmapped."""
    return whole_mapping(spark, sf).filter("`Vehicle Class` <> 'CLASS-PROMO(LMV)'")


def whole_mapping(spark: SparkSession, sf: str) -> DataFrame:
    """Vehicle-class mapping of all classes; some cells are empty or NULL."""
    classes = table(spark, sf, "part").select("p_type").distinct()
    return classes.selectExpr(
        "concat('CLASS-', p_type, '(LMV)') as `Vehicle Class`",
        "decode(p_type, 'LARGE', 'Goods', 'MEDIUM', null, 'Passenger') as `Vehicle Type`",
        "decode(p_type, 'LARGE', 'Truck', 'SMALL', ' ', 'Car') as `Vehicle Category`",
        "decode(p_type, 'ECONOMY', '', 'Private') as `Vehicle Use Type`",
    )


def districts(spark: SparkSession, sf: str) -> DataFrame:
    """District lookup: lower-case codes, none for the last region, two for the first."""
    listed = offices(spark, sf).filter(F.col("n_regionkey") < 4)
    code = F.concat(F.lit("r"), F.col("s_suppkey"), F.lit(" "))
    names = F.when(
        F.col("n_regionkey") == 0, F.array(F.lit("North"), F.lit("South"))
    ).otherwise(F.array(F.concat(F.lit("District "), F.col("n_regionkey"))))
    return listed.select(code.alias("rto_code"), F.explode(names).alias("district"))


def _cells(pick: str) -> list[Column]:
    new = f"(l_returnflag = 'R' and l_linestatus = 'O' and year(l_shipdate) >= {NEW_HEADER_YEAR})"
    conditions = {
        header: f"l_returnflag = '{flag}' and l_linestatus = '{status}' and not {new}"
        for (flag, status), header in FUELS.items()
    }
    conditions[NEW_HEADER] = new
    return [
        F.expr(f"{pick}(case when {condition} then l_extendedprice end)").alias(header)
        for header, condition in conditions.items()
    ]


def raw_reports(
    spark: SparkSession,
    sf: str,
    grain: Grain,
    pick: str = "max",
    since: str | None = None,
    until: str | None = None,
) -> DataFrame:
    """Wide report rows as text, with the path of their report; `since` and `until`, the first day
    that does not count, limit what is read, as a listing of some months would.

    One aggregation that combines on the map side. At the office grain the office is joined to
    the aggregated rows, else the supplier's nation to the lines.
    """
    lines = table(spark, sf, "lineitem")
    if since:
        lines = lines.filter(f"l_shipdate >= timestamp_ntz'{since} 00:00:00'")
    if until:
        lines = lines.filter(f"l_shipdate < timestamp_ntz'{until} 00:00:00'")
    parts = table(spark, sf, "part")
    lines = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).withColumn(
        "month_start", month_start(F.col("l_shipdate"))
    )
    if grain.name == "rto":
        totals = lines.groupBy("l_suppkey", "p_type", "month_start").agg(*_cells(pick))
        placed = totals.join(offices(spark, sf), F.col("l_suppkey") == F.col("s_suppkey"))
    else:
        # Supplier, class and month are nearly unique for a line: the narrow lines meet the
        # supplier table, and are aggregated once.
        suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
        keys = ["s_nationkey", "p_type", "month_start"] + (["p_brand"] if grain.name == "oem" else [])
        totals = (
            lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
            .groupBy(*keys)
            .agg(*_cells(pick))
        )
        placed = totals.withColumn("state", state_of(F.col("s_nationkey")))
    folders = [text.state_folder(F.col("state"))]
    if grain.name == "rto":
        folders.append(F.col("folder"))
    elif grain.name == "oem":
        folders.append(text.class_folder(class_label(F.col("p_type"))))
    path = F.concat_ws(
        "/",
        F.lit(report_root(grain)),
        *folders,
        F.date_format("month_start", "yyyy"),
        dates.month_of(F.col("month_start")),
        F.lit(REPORT_FILE),
    )
    label = "p_brand" if grain.name == "oem" else "concat('CLASS-', p_type, '(LMV)')"
    total = " + ".join(f"coalesce(floor(`{h}`), 0)" for h in CELL_HEADERS)
    return computed_once(placed.withColumn("path", path), ["path"]).selectExpr(
        "path",
        f"{label} as `{LABEL_HEADER}`",
        *[f"format_number(floor(`{h}`), 0) as `{h}`" for h in CELL_HEADERS],
        f"format_number({total}, 0) as `{TOTAL_HEADER}`",
    )


def report_root(grain: Grain) -> str:
    return f"reports/{grain.name}"


def preprocessed(
    spark: SparkSession, sf: str, grain: Grain, pick: str = "max", since: str | None = None
) -> DataFrame:
    reports = raw_reports(spark, sf, grain, pick, since)
    return preprocess(reports, mapping(spark, sf), grain)


def fact(spark: SparkSession, sf: str, grain: Grain) -> DataFrame:
    """Fact table of all months."""
    return load.stage_load(preprocessed(spark, sf, grain), grain.columns)


def stage(spark: SparkSession, sf: str, grain: Grain) -> DataFrame:
    """Re-scraped reports of the later months; keys change case, which must not matter."""
    later = preprocessed(spark, sf, grain, "min", RESCRAPE_FROM)
    lowered = later.withColumn("vehicle_class", F.lower("vehicle_class"))
    return load.stage_load(lowered, grain.columns)


def legacy(spark: SparkSession, sf: str, grain: Grain) -> DataFrame:
    """Table from before the migration: no newer measures, older names, padded text."""
    current = fact(spark, sf, grain)
    padded = F.concat(F.lit("  "), F.coalesce("electric_bov", F.lit("")), F.lit(" "))
    kept = [c for c in current.columns if c not in LEGACY_ABSENT]
    return current.select(
        *[c for c in kept if c != "inserted_at"],
        padded.alias("electric_vehicles"),
        F.lit(None).cast("string").alias("ethanol"),
        dates.report_date(F.col("date")).cast("timestamp_ntz").alias("insert_date"),
    )


LEGACY_ABSENT = (
    "bio_cng_bio_gas",
    "electric_bov",
    "ethanol_e100",
    "flex_fuel_ethanol",
    "hcng",
    "petrol_e20",
)


def legacy_with_copies(spark: SparkSession, sf: str, grain: Grain) -> DataFrame:
    """Backup in which many keys occur twice, with the older value of two scrapes."""
    copies = preprocessed(spark, sf, grain, "min")
    values = ["electric_bov", *grain.backfill_key]
    both = fact(spark, sf, grain).select(*values).unionByName(
        load.stage_load(copies, values).drop("inserted_at")
    )
    padded = F.concat(F.lit("  "), F.coalesce("electric_bov", F.lit("")), F.lit(" "))
    return both.withColumn("electric_vehicles", padded).drop("electric_bov")


def backfill_target(spark: SparkSession, sf: str, grain: Grain) -> DataFrame:
    """Migrated facts: `electric_bov` is NULL, but filled where there is no petrol."""
    filled = F.when(F.col("petrol").isNull(), F.lit("7"))
    return fact(spark, sf, grain).drop("inserted_at").withColumn("electric_bov", filled)


def sheet_rows(spark: SparkSession, sf: str, grain: Grain) -> DataFrame:
    """Raw rows as the workbook reader gives them: all OEM reports, and an empty report for
    every class and month of a state without lines. Two kinds of unknown header occur: one
    from a certain year on, and in December one that holds the report's class."""
    raw = raw_reports(spark, sf, grain)
    parts = F.split("path", "/")
    year, month = F.element_at(parts, -3).cast("int"), F.element_at(parts, -2)
    pairs = ", ".join(f"'{h}', `{h}`" for h in RAW_HEADERS)
    cells = F.map_filter(
        F.expr(f"map({pairs})"), lambda k, _: (k != NEW_HEADER) | (year >= NEW_HEADER_YEAR)
    )
    remark = F.create_map(
        F.concat(F.lit("REMARK "), F.element_at(parts, -4)), F.lit(None).cast("string")
    )
    cells = F.when(month == "DEC", F.map_concat(cells, remark)).otherwise(cells)
    order = Window.partitionBy("path").orderBy(LABEL_HEADER)
    rows = raw.select(
        "path", (F.row_number().over(order) - 1).alias("row_no"), cells.alias("cells")
    )
    grid = coverage.expected_grid_oem(
        coverage.state_list(spark),
        class_list(spark, sf),
        month_list(spark, sf),
        grain,
        report_root(grain),
    )
    empty = grid.select("path").join(raw.select("path"), "path", "left_anti")
    return rows.unionByName(empty, allowMissingColumns=True)


def files(spark: SparkSession, sf: str, grain: Grain) -> DataFrame:
    """Report files that exist; those without a diesel cell are zero bytes long."""
    size = F.count("DIESEL") * 100
    return (
        raw_reports(spark, sf, grain)
        .groupBy("path")
        .agg(size.alias("length"))
        .withColumn("valid", F.col("length") > 0)
    )


def class_list(spark: SparkSession, sf: str) -> Column:
    """All vehicle classes as an array; their number does not grow with the tables."""
    kinds = table(spark, sf, "part").select(class_label(F.col("p_type")).alias("c"))
    return kinds.agg(F.array_sort(F.collect_set("c"))).scalar()


def month_list(spark: SparkSession, sf: str) -> Column:
    """All months from the first shipment to the last as an array."""
    day = F.col("l_shipdate").cast("date")
    bounds = table(spark, sf, "lineitem").agg(F.min(day).alias("a"), F.max(day).alias("b"))
    months = F.sequence(F.trunc("a", "month"), F.trunc("b", "month"), F.expr("interval 1 month"))
    return bounds.select(months).scalar()


_SHEET = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def _letter(column: int) -> str:
    tens, ones = divmod(column, 26)
    return (chr(ord("A") + tens - 1) if tens else "") + chr(ord("A") + ones)


_LETTERS = [_letter(i) for i in range(26 * 27)]


def workbook_bytes(rows: list[list[str | None]], whole: bool = True, sheet: str = "Report") -> bytes:
    """A minimal XLSX file with inline text; without `whole` the workbook part is left out."""
    return _archive([_row_xml(number, enumerate(row)) for number, row in enumerate(rows, start=1)], whole, sheet)


def _row_xml(number: int, cells: Iterable[tuple[int, str | None]]) -> str:
    """A sheet row of (column, text) pairs in the order of columns."""
    inner = "".join(
        f'<c r="{_LETTERS[i]}{number}" t="inlineStr"><is><t xml:space="preserve">'
        f"{escape(cell)}</t></is></c>"
        for i, cell in cells
        if cell is not None
    )
    return f'<row r="{number}">{inner}</row>'


def _archive(lines: list[str], whole: bool, sheet: str = "Report") -> bytes:
    parts = {
        "[Content_Types].xml": "<Types/>",
        "xl/_rels/workbook.xml.rels": '<Relationships><Relationship Id="rId1" '
        'Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{_SHEET}"><sheetData>'
        f"{''.join(lines)}</sheetData></worksheet>",
    }
    if whole:
        parts["xl/workbook.xml"] = (
            f'<workbook xmlns="{_SHEET}" xmlns:r="{_OFFICE}"><sheets>'
            f'<sheet name="{sheet}" sheetId="1" r:id="rId1"/></sheets></workbook>'
        )
    return _stored(parts)


def _stored(parts: dict[str, str]) -> bytes:
    """A zip of parts that are not compressed, dated 1980."""
    out, index, at = [], [], 0
    for name, text in parts.items():
        title, body = name.encode(), text.encode()
        common = (20, 0, 0, 0, 0x21, zlib.crc32(body), len(body), len(body), len(title), 0)
        out += [struct.pack("<4s5H3L2H", b"PK\x03\x04", *common), title, body]
        index += [struct.pack("<4s2B5H3L5H2L", b"PK\x01\x02", 20, 3, *common, 0, 0, 0, 0o600 << 16, at), title]
        at += 30 + len(title) + len(body)
    size = sum(map(len, index))
    end = struct.pack("<4s4H2LH", b"PK\x05\x06", 0, 0, len(parts), len(parts), size, at, 0)
    return b"".join([*out, *index, end])


def mapping_workbook(spark: SparkSession, sf: str) -> DataFrame:
    """The mapping as one workbook (path, content); it has as many rows as there are classes."""

    @F.pandas_udf(T.BinaryType())
    def build(rows: pd.Series) -> pd.Series:
        head = list(MAPPING_HEADERS)
        return rows.map(lambda held: workbook_bytes([head, *(list(r.values()) for r in held)], sheet="Mapping"))

    row = F.struct(*(F.col(f"`{h}`") for h in MAPPING_HEADERS))
    whole = whole_mapping(spark, sf).groupBy().agg(F.sort_array(F.collect_list(row)).alias("rows"))
    return whole.select(F.lit("mapping.xlsx").alias("path"), build("rows").alias("content"))


#: So many reports are given on together.
_REPORTS_PER_BATCH = 1024


def workbooks(spark: SparkSession, sf: str, damaged: bool = True) -> DataFrame:
    """Office reports as XLSX bytes (path, content), built on the executors.

    All known fuels have a column, the total sits at its usual position and the new
    header behind it. A report holds at most one row per vehicle class. With `damaged`,
    reports with one row are zero bytes long, and those of an office without a code lack the
    workbook part.
    """
    sheet_headers = [None, None, *FUEL_HEADERS, None, NEW_HEADER]
    # Every report has the same first rows.
    head = [_row_xml(n, enumerate(row)) for n, row in enumerate([["Report"], [], [], sheet_headers], start=1)]
    places = [0, 1, *[sheet_headers.index(h) for h in CELL_HEADERS], len(FUEL_HEADERS) + 2]

    # The row number and the cells in the order of columns.
    order = sorted(range(len(places)), key=places.__getitem__)
    columns = [places[i] for i in order]

    def one(path: str, rows: list[tuple]) -> bytes:
        if damaged and len(rows) == 1:
            return b""
        body = [
            _row_xml(number, zip(columns, (str(number - len(head)), *row[1:])))
            for number, row in enumerate(rows, start=len(head) + 1)
        ]
        whole = not damaged or "_" in path.split("/")[3]
        return _archive(head + body, whole)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = (line for batch in batches for line in zip(*(c.to_numpy(False).tolist() for c in batch.columns)))
        paths, contents = [], []
        for path, rows in groupby(lines, itemgetter(0)):
            paths.append(path)
            contents.append(one(path, list(rows)))
            if len(paths) == _REPORTS_PER_BATCH:
                yield pa.RecordBatch.from_pydict({"path": paths, "content": contents})
                paths, contents = [], []
        if paths:
            yield pa.RecordBatch.from_pydict({"path": paths, "content": contents})

    raw = raw_reports(spark, sf, GRAINS["rto"])
    # A fixed number of partitions: AQE would otherwise pack these small rows, which are
    # expensive to turn into files, into one task. Paths begin alike, so their hashes are sorted first.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = raw.repartition(tasks, "path").sortWithinPartitions(
        F.xxhash64("path"), "path", *(f"`{h}`" for h in RAW_HEADERS)
    )
    held = ["path", *(RAW_HEADERS[i - 1] for i in order if i)]
    return sorted_rows.select(*(f"`{h}`" for h in held)).mapInArrow(build, "path string, content binary")
