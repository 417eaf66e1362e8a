"""Context-triggered piecewise hashing: fingerprints of texts that survive edits.

A rolling hash over `WINDOW` bytes marks boundaries: a place has level k if the hash ends in k zero
bits, so boundaries of a level are also boundaries of all lower ones. A fingerprint starts at the
lowest level with at most `PIECES` boundaries and holds a signature for that level and the
`LEVELS - 1` above it, so that texts of different lengths can be compared at block sizes both have.
A signature has one symbol of 12 bits, two characters, for each chunk between boundaries. A change of a
text alters the symbols of the chunks it touches and no others.

Likeness is 1 - d / (a + b), d the edit distance of two signatures of a and b symbols at the lowest common level,
counting insertions and deletions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regflow.llm.common import ids_and_texts, pieces, stored
from regflow.session import ship_by_value

ship_by_value(__name__)

WINDOW = 8
#: Most boundaries of a signature, levels in a fingerprint, and the lowest level in use: chunks of four bytes.
PIECES, LEVELS, LOWEST = 64, 3, 2
#: Bytes of text that are hashed together.
PIECE = 1 << 20

# The characters of signatures.
_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_SYMBOLS = np.array([(a + b).encode() for a in _CHARS for b in _CHARS], "S2")
_BASE = 0x01000193


def _window_hashes(data: np.ndarray) -> np.ndarray:
    """A 32-bit hash of the `WINDOW` bytes up to and with each place; zeros precede the first."""
    found = np.concatenate([np.zeros(WINDOW - 1, np.uint32), data.astype(np.uint32) + np.uint32(1)])
    found[: WINDOW - 1] = 1
    width = 1
    while width < WINDOW:
        found = found[:-width] * np.uint32(pow(_BASE, width, 1 << 32)) + found[width:]
        width *= 2
    found ^= found >> np.uint32(16)
    found *= np.uint32(0x7FEB352D)
    found ^= found >> np.uint32(15)
    found *= np.uint32(0x846CA68B)
    return found ^ (found >> np.uint32(16))


def fingerprints(texts: list[str]) -> list[str]:
    """level:signature:signature:signature of each text; the empty text has no chunks."""
    encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.array([len(e) for e in encoded], np.int64)
    # Zeros between texts, so that no window spans two of them.
    gap = bytes(WINDOW - 1)
    data = np.frombuffer(gap.join([*encoded, b""]), np.uint8)
    starts = np.cumsum(sizes + WINDOW - 1) - sizes - (WINDOW - 1)
    hashes = _window_hashes(data)
    marks = np.flatnonzero((hashes & np.uint32((1 << LOWEST) - 1)) == 0)
    owner = np.searchsorted(starts, marks, "right") - 1
    # A boundary lies after its place; the end of a text is no boundary.
    inner = marks - starts[owner] < sizes[owner] - 1 if len(marks) else marks.astype(bool)
    marks, owner = marks[inner], owner[inner]
    low = hashes[marks].astype(np.int64)
    level = np.where(low == 0, 32, np.log2(np.maximum(low & -low, 1)).astype(np.int64))
    table = np.bincount(owner * 33 + level, minlength=33 * len(texts)).reshape(-1, 33)
    above = table[:, ::-1].cumsum(axis=1)[:, ::-1]
    first = LOWEST + np.argmax(above[:, LOWEST:] <= PIECES, axis=1)
    # With more boundaries than that even at the highest level, the next one has none.
    first = np.where(above[np.arange(len(texts)), np.minimum(first, 32)] <= PIECES, first, 33)
    parts = [[str(k)] for k in first.tolist()]
    sums = hashes.astype(np.uint64)
    for rise in range(LEVELS):
        kept = level >= first[owner] + rise
        begin = np.concatenate([starts, marks[kept] + 1])
        whose = np.concatenate([np.arange(len(texts)), owner[kept]])
        order = np.lexsort((begin, whose))
        begin, whose = begin[order], whose[order]
        filled = sizes[whose] > 0
        begin, whose = begin[filled], whose[filled]
        if len(begin):
            # Each chunk's end is a cut too, so that the zeros between texts add nothing.
            end = np.r_[begin[1:], 0]
            final = np.r_[whose[1:] != whose[:-1], True]
            end[final] = (starts + sizes)[whose[final]]
            cuts = np.stack([begin, np.minimum(end, len(data) - 1)], axis=1).ravel()
            chunk = np.add.reduceat(sums, cuts)[::2]
            chunk ^= (end - begin).astype(np.uint64) << np.uint64(40)
            chunk = (chunk ^ (chunk >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            signs = _SYMBOLS[(chunk >> np.uint64(52)).astype(np.int64)].tobytes().decode()
        else:
            signs = ""
        bounds = 2 * np.searchsorted(whose, np.arange(len(texts) + 1))
        for k, part in enumerate(parts):
            part.append(signs[bounds[k] : bounds[k + 1]])
    return [":".join(part) for part in parts]


def _common(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, all symbols of `b` at once in the bits of a number."""
    places: dict[str, int] = {}
    for k, symbol in enumerate(b):
        places[symbol] = places.get(symbol, 0) | 1 << k
    full = (1 << len(b)) - 1
    row = full
    for symbol in a:
        hit = row & places.get(symbol, 0)
        row = (row + hit | row - hit) & full
    return len(b) - row.bit_count()


def likeness(one: str, two: str) -> float:
    """0 to 1; 1 for equal fingerprints, 0 without a common level or a common symbol."""
    if one == two:
        return 1.0
    first, *left = one.split(":")
    second, *right = two.split(":")
    level = max(int(first), int(second))
    at, to = level - int(first), level - int(second)
    if at >= LEVELS or to >= LEVELS:
        return 0.0
    a, b = ([s[k : k + 2] for k in range(0, len(s), 2)] for s in (left[at], right[to]))
    return 2 * _common(a, b) / (len(a) + len(b)) if a and b else 0.0


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as many of the first characters of the next."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
_NAMES = [part.split()[0] for part in _RESULT.split(", ")]


def _compared(ids: list, texts: list[str], following: list[str], prints: list[str], next_prints: list[str]) -> list:
    """Result columns of documents and their next ones."""
    changed = [edited(t, f) for t, f in zip(texts, following, strict=True)]
    changed_prints = fingerprints(changed)
    return [
        pa.array(ids, pa.int64()),
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(c.encode("utf-8", "surrogatepass")).hexdigest() for c in changed], pa.string()),
        pa.array(prints, pa.string()),
        pa.array(changed_prints, pa.string()),
        pa.array([likeness(a, b) for a, b in zip(prints, changed_prints, strict=True)], pa.float64()),
        pa.array([likeness(a, b) for a, b in zip(prints, next_prints, strict=True)], pa.float64()),
    ]


def _along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares each document of a sorted stream with the next. The first and the last one are also
    given out with their texts, as they meet those of other ranges."""
    part = TaskContext.get().partitionId()
    held = None

    def ends(kind: str, row: tuple) -> pa.RecordBatch:
        empty = [pa.array([None], t) for t in (pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64())]
        columns = [pa.array([row[0]], pa.int64()), *empty]
        columns += [pa.array([part], pa.int32()), pa.array([kind]), pa.array([row[1]], pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=[*_NAMES, "part", "kind", "text"])

    for batch in pieces(batches, most=PIECE):
        if not batch.num_rows:
            continue
        ids, texts = batch.column("id").to_pylist(), batch.column("text").to_pylist()
        prints = fingerprints(texts)
        if held is None:
            yield ends("first", (ids[0], texts[0]))
        else:
            ids, texts, prints = [held[0], *ids], [held[1], *texts], [held[2], *prints]
        held = ids[-1], texts[-1], prints[-1]
        if len(ids) > 1:
            columns = _compared(ids[:-1], texts[:-1], texts[1:], prints[:-1], prints[1:])
            n = len(ids) - 1
            columns += [pa.array([part] * n, pa.int32()), pa.array(["row"] * n), pa.nulls(n, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*_NAMES, "part", "kind", "text"])
    if held is not None:
        yield ends("last", held)


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, most=PIECE):
        ids, texts, following = (batch.column(c).to_pylist() for c in ("doc_id", "text", "following"))
        columns = _compared(ids, texts, following, fingerprints(texts), fingerprints(following))
        yield pa.RecordBatch.from_arrays(columns, names=_NAMES)


def fingerprint_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id and fingerprint. A null text is an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, most=PIECE):
            found = fingerprints(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.string())], names=["doc_id", "fingerprint"])

    return ids_and_texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, fingerprint string")


def compare_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.

    The next document is that with the next smaller id, null ids last, and the first again after
    the last; rows that repeat an id follow each other by a hash of their texts. The edited text
    takes the next document's beginning in place of its own last half. A null text is an
    empty one; two empty texts are alike (1), an empty and another are not (0). A lone document is its own
    next one. An empty table gives an empty result; other columns are not read.

    Texts are shuffled once, into ranges of ids; each range is a stream in order of ids. Only a range's first and last text
    are looked at a second time, to join it with the next range.
    """
    order = [F.desc_nulls_last("id"), F.col("tie"), F.col("row")]
    found = stored(
        ids_and_texts(docs, id_col, text_col)
        .withColumns({"tie": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("id", "text")
        .mapInArrow(_along, f"{_RESULT}, part int, kind string, text string"),
        "fingerprints",
    )
    firsts = found.filter("kind = 'first'").select("part", F.col("text").alias("following"))
    # One number for each range; their texts are joined by it.
    parts = firsts.select("part")
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = parts.select(
        F.col("part").alias("from"),
        F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(whole)).alias("part"),
    )
    open_ends = (
        found.filter("kind = 'last'")
        .select("doc_id", "text", F.col("part").alias("from"))
        .join(after, "from")
        .join(firsts, "part")
        .select("doc_id", "text", "following")
    )
    return found.filter("kind = 'row'").select(_NAMES).unionByName(open_ends.mapInArrow(_across, _RESULT))
