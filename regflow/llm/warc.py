"""WARC archives: Spark writes them, and a Python data source reads them back.

Writing is a DataFrame job. A record is one string: header lines, the HTTP header, the
payload. Spark's text sink stores the records, each with its closing blank lines, so that the
files are valid WARC on any file system that Spark can write, and its commit protocol covers
lost executors.

Reading is a data source. It plans one partition for a group of files or one range of a
large file, takes equality and range predicates on header fields from the query, and per
record reads the header first. A record that a predicate rejects is skipped by its length,
and payloads that the query does not ask for are never decoded.
"""

from __future__ import annotations

import base64
import hashlib
import operator
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import datasource as ds

from regflow.llm.common import stored, whole_text
from regflow.session import ship_by_value

ship_by_value(__name__)

# The alphabet of base 32 and the lines of the formats.
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
_SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = "urn:page:"

HEADER_COLUMNS = (
    "file string, at long, record_type string, record_id string, target_uri string, "
    "date string, payload_digest string, refers_to string, length long"
)
PAYLOAD_COLUMNS = ", payload_bytes long, digest_matches boolean, payload binary"
#: Files are read in ranges of this size; a range owns the records that begin in it.
RANGE = 64 << 20


def sha1_base32(text: Column) -> Column:
    """Base-32 SHA-1 of a text's UTF-8 bytes: four letters for every five hex digits."""
    digest = F.sha1(text)
    letters = []
    for start in range(1, 41, 5):
        bits = F.conv(F.substring(digest, start, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            place = F.shiftright(bits, shift).bitwiseAND(31) + 1
            letters.append(F.substring(F.lit(_BASE32), place, F.lit(1)))
    return F.concat(*letters)


def records(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least: int = 0,
    date: str = "2026-01-01T00:00:00Z",
) -> DataFrame:
    """One row per page, `value`: its WARC record without the last line feed.

    Of the pages with equal payloads of at least `least` bytes, that with the smallest id is a
    response and the others are revisits of it; shorter payloads are all responses. A null
    payload is an empty one. Pages that repeat the smallest id are responses as well. A page
    with a null id is a response unless another page with the same payload has an id; nothing
    refers to it. Control characters and blanks in a URL are escaped; a null URL has no line.
    """
    rows = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page"),
        F.col(f"`{url_col}`").cast("string").alias("url"),
        whole_text(f"`{payload_col}`").alias("body"),
    ).withColumn("digest", sha1_base32(F.col("body")))
    # Stored, so that its size is known when the join is planned: payloads are shuffled only
    # if shared digests are too many for a broadcast.
    shared = stored(
        rows.filter(F.octet_length("body") >= least)
        .groupBy("digest")
        .agg(F.min("page").alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("digest", "first"),
        "digests",
    )
    rows = rows.join(shared, "digest", "left")
    fits = F.octet_length("body") >= least
    revisit = fits & F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first"))
    line = F.lit("\r\n")
    http = F.concat(F.lit(_HTTP), F.octet_length("body"), line, line)
    block = F.when(revisit, http).otherwise(F.concat(http, "body"))
    name = lambda c: F.concat(F.lit(f"<{_ID}"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    # Blanks and control characters cannot stand in a header line.
    url = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    fields = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), name(F.col("page"))),
        F.concat(F.lit("WARC-Date: "), F.lit(date)),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), "digest"),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), name(F.col("first")))),
        F.when(revisit, F.lit(f"WARC-Profile: {_SAME_PAYLOAD}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block)),
    ]
    # concat_ws leaves out the absent lines. The sink adds the last line feed.
    return rows.select(
        F.concat(F.concat_ws("\r\n", *fields), line, line, block, F.lit("\r\n\r")).alias("value")
    )


def write_warc(pages: DataFrame, path: str, **options) -> None:
    """Write the pages' records under `path`, as `records` describes them."""
    records(pages, **options).write.option("lineSep", "\n").text(path)


_TESTS = {
    ds.EqualTo: operator.eq,
    ds.GreaterThan: operator.gt,
    ds.GreaterThanOrEqual: operator.ge,
    ds.LessThan: operator.lt,
    ds.LessThanOrEqual: operator.le,
}
_PUSHED = ("record_type", "record_id", "target_uri", "date", "payload_digest", "refers_to", "length")


def _row_test(kept: ds.Filter):
    """A predicate on header fields, or None when the filter is left to Spark."""
    inverse = isinstance(kept, ds.Not)
    inner = kept.child if inverse else kept
    column = getattr(inner, "attribute", ())
    if len(column) != 1 or column[0] not in _PUSHED:
        return None
    name = column[0]
    if isinstance(inner, ds.IsNull) or isinstance(inner, ds.IsNotNull):
        wants_null = isinstance(inner, ds.IsNull) != inverse
        return lambda row: (row[name] is None) == wants_null
    if isinstance(inner, ds.In):
        values = set(inner.value)
        return lambda row: row[name] is not None and (row[name] in values) != inverse
    if isinstance(inner, ds.StringStartsWith):
        return lambda row: row[name] is not None and row[name].startswith(inner.value) != inverse
    for kind, test in _TESTS.items():
        if type(inner) is kind:
            return lambda row: row[name] is not None and test(row[name], inner.value) != inverse
    return None


@dataclass
class FileRanges(ds.InputPartition):
    """Parts of files: (path, first byte, end)."""

    parts: list

    def __init__(self, parts):
        super().__init__(parts)
        self.parts = parts


def _file_system(path: str):
    """The file system of a URI, and its path there."""
    from pyarrow import fs

    if urlsplit(path).scheme in ("", "file"):
        return fs.LocalFileSystem(), urlsplit(path).path
    return fs.FileSystem.from_uri(path)


class WarcReader(ds.DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() == "true"
        self.range = int(options.get("range", RANGE))
        self.tests = []

    def pushFilters(self, filters):
        for kept in filters:
            test = _row_test(kept)
            if test:
                self.tests.append(test)
            else:
                yield kept

    def partitions(self):
        """Large files in ranges, small ones packed together up to one range."""
        from pyarrow import fs

        files, root = _file_system(self.path)
        parts, packed, size = [], [], 0
        for info in files.get_file_info(fs.FileSelector(root, recursive=True)):
            if info.type != fs.FileType.File or info.base_name.startswith(("_", ".")):
                continue
            for start in range(0, info.size, self.range):
                end = min(info.size, start + self.range)
                if packed and size + end - start > self.range:
                    parts.append(FileRanges(packed))
                    packed, size = [], 0
                packed.append((info.path, start, end))
                size += end - start
        return [*parts, FileRanges(packed)]

    def read(self, partition) -> Iterator[tuple]:
        files, _ = _file_system(self.path)
        for path, start, end in partition.parts:
            with files.open_input_file(path) as raw:
                yield from self._records(raw, path, start, end)

    def _records(self, raw, path: str, start: int, end: int) -> Iterator[tuple]:
        reader = _Window(raw)
        at = start if start == 0 else reader.next_record(start, end)
        while at is not None and at < end:
            header_end = reader.find(b"\r\n\r\n", at)
            if header_end < 0:
                if reader.peek(at, 1):
                    raise ValueError(f"{path}: a record at byte {at} has no end of header")
                return
            row = _header(reader.peek(at, header_end - at), path, at)
            block, at = header_end + 4, header_end + 4 + row["length"] + 4
            if not all(test(row) for test in self.tests):
                continue
            values = (
                path,
                row["at"],
                row["record_type"],
                row["record_id"],
                row["target_uri"],
                row["date"],
                row["payload_digest"],
                row["refers_to"],
                row["length"],
            )
            if self.payload:
                values += _payload(reader.peek(block, row["length"]), row, path)
            yield values


class _Window:
    """Random access to a file through one buffer, so that skipped payloads are not read."""

    def __init__(self, raw, step: int = 1 << 16):
        self.raw, self.step, self.first, self.data = raw, step, 0, b""

    def peek(self, at: int, size: int) -> bytes:
        if at < self.first or at + size > self.first + len(self.data):
            self.raw.seek(at)
            self.first, self.data = at, self.raw.read(max(size, self.step))
        return self.data[at - self.first : at - self.first + size]

    def find(self, mark: bytes, at: int) -> int:
        """The first place of `mark` from `at` on, or -1."""
        size = self.step
        while True:
            data = self.peek(at, size)
            found = data.find(mark)
            if found >= 0:
                return at + found
            if len(data) < size:
                return -1
            size *= 2

    def next_record(self, start: int, end: int) -> int | None:
        """The first record that begins in [start, end). Every record follows the blank lines
        of the one before it; a payload that imitates one is told apart, as its own record's
        neighbours would not chain: three records in a row must parse."""
        mark, at = b"\r\n\r\nWARC/1.1\r\nWARC-Type: ", start - 4
        while True:
            at = self._find_before(mark, at, end)
            if at is None:
                return None
            if self._chains(at + 4):
                return at + 4
            at += 1

    def _find_before(self, mark: bytes, at: int, end: int) -> int | None:
        while at + 4 < end:
            data = self.peek(at, self.step + len(mark))
            found = data.find(mark)
            if found >= 0:
                return at + found if at + found + 4 < end else None
            if len(data) < self.step + len(mark):
                return None
            at += self.step
        return None

    def _chains(self, at: int, records: int = 3) -> bool:
        for _ in range(records):
            head = self.peek(at, 8)
            if not head:
                return True
            if head != b"WARC/1.1":
                return False
            stop = self.find(b"\r\n\r\n", at)
            try:
                length = _header(self.peek(at, stop - at), "", at)["length"]
            except (KeyError, ValueError):
                return False
            if stop < 0 or self.peek(stop + 4 + length, 4) != b"\r\n\r\n":
                return False
            at = stop + 8 + length
        return True


def _header(data: bytes, path: str, at: int) -> dict:
    fields = {}
    lines = data.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"{path}: no record at byte {at}")
    for line in lines[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    digest = fields.get("warc-payload-digest")
    return {
        "at": at,
        "record_type": fields.get("warc-type"),
        "record_id": fields.get("warc-record-id"),
        "target_uri": fields.get("warc-target-uri"),
        "date": fields.get("warc-date"),
        "payload_digest": digest.removeprefix("sha1:") if digest else None,
        "refers_to": fields.get("warc-refers-to"),
        "length": int(fields["content-length"]),
    }


def _payload(block: bytes, row: dict, path: str) -> tuple:
    """(payload bytes by the HTTP header, digest of the payload is the stated one, payload).
    A revisit has no payload of its own, so nothing to compare."""
    if len(block) < row["length"]:
        raise ValueError(f"{path}: the record at byte {row['at']} is cut off")
    head, _, body = block.partition(b"\r\n\r\n")
    stated = None
    for line in head.split(b"\r\n"):
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length":
            stated = int(value)
    if row["record_type"] == "revisit":
        return stated, None, None
    digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
    return len(body), digest == row["payload_digest"], body


class WarcSource(ds.DataSource):
    """`spark.read.format("warc")`. Options: `path`; `payload` (false: headers only, payloads
    are skipped); `range`, the bytes of one partition."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        headers_only = self.options.get("payload", "true").lower() != "true"
        return HEADER_COLUMNS + ("" if headers_only else PAYLOAD_COLUMNS)

    def reader(self, schema):
        return WarcReader(self.options)


def read_warc(spark: SparkSession, path: str, payload: bool = True, **options) -> DataFrame:
    """The records under `path`. Filters on header fields reach the reader."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    reader = spark.read.format("warc").option("payload", str(payload).lower())
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load(path)


def page_of(record_id: Column) -> Column:
    """The page id in a record id; null for a page without one."""
    text = F.regexp_extract(record_id, f"^<{_ID}(-?[0-9]+)>$", 1)
    return F.when(text != "", text).cast("long")


def page_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per page of archives that `write_warc` made; a payload that does not have its
    stated digest fails the job."""
    found = read_warc(spark, path)
    sound = F.when(
        F.col("digest_matches").isNull() | F.col("digest_matches"), F.col("payload_digest")
    ).otherwise(F.raise_error(F.concat(F.lit("damaged payload: "), "record_id")))
    return found.filter(F.col("record_type").isin("response", "revisit")).select(
        page_of(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        sound.alias("payload_digest"),
        "record_type",
        page_of(F.col("refers_to")).alias("refers_to"),
    )
