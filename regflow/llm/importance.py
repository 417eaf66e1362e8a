"""Importance resampling of documents towards a target text collection.

Features are hashed runs of words. Their buckets are counted over all documents and over all target
texts; a bucket's gain is the scaled log ratio of both, smoothed. A document's weight is the
mean gain of its features, and the documents with the highest weight plus Gumbel noise are drawn,
which samples without replacement in proportion to the exponential of the weight.

The bucket of a feature is its CRC-32 modulo the number of buckets. A CRC is linear up to a
constant of the length, so each byte adds a value that depends on the byte and its distance from
the end of the feature only. These are looked up in a table of positions, combined for all features of many
documents at once by `bitwise_xor.reduceat`, and completed by the constant of the length. Features
longer than the table are cut into blocks, whose values are folded from the first to the last.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regflow.llm.common import ids_and_texts, pieces, stored, whole_text
from regflow.llm.ranks import positions
from regflow.session import ship_by_value

ship_by_value(__name__)

BUCKETS = 10_000
#: Distances from the end that the table holds, a power of two, and lengths with a held constant.
REACH, CONSTANTS = 256, 4096
#: Bytes of text that are hashed together.
PIECE = 1 << 20


class PositionCrc:
    """CRC-32 of many spans of a byte array."""

    def __init__(self):
        step = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], np.uint32)

        def append_zero(values: np.ndarray) -> np.ndarray:
            return (values >> np.uint32(8)) ^ step[values & np.uint32(255)]

        rows = [step]
        while len(rows) < REACH:
            rows.append(append_zero(rows[-1]))
        # The last row adds nothing; separators between spans use it.
        self.table = np.stack([*rows, np.zeros(256, np.uint32)]).ravel()
        shift = np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * 8)[:, None]
        for _ in range(REACH):
            shift = append_zero(shift)
        self.shift = shift
        constants = [0]
        while len(constants) < CONSTANTS:
            constants.append(zlib.crc32(b"\0", constants[-1]))
        self.constants = np.array(constants, np.uint32)

    def _constant(self, lengths: np.ndarray) -> np.ndarray:
        found = self.constants[np.minimum(lengths, CONSTANTS - 1)]
        for place in np.flatnonzero(lengths >= CONSTANTS):
            found[place] = zlib.crc32(bytes(int(lengths[place])))
        return found

    def _shifted(self, values: np.ndarray) -> np.ndarray:
        """The values after as many zero bytes as a block has."""
        low = np.uint32(255)
        return (
            self.shift[0][values & low]
            ^ self.shift[1][values >> np.uint32(8) & low]
            ^ self.shift[2][values >> np.uint32(16) & low]
            ^ self.shift[3][values >> np.uint32(24)]
        )

    def spans(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """CRCs of data[start:end] of spans that follow each other with one byte between."""
        if not len(starts):
            return np.empty(0, np.uint32)
        lengths = ends - starts
        first = starts[0]
        data = data[first : ends[-1] + 1]
        starts, ends = starts - first, ends - first
        distance = np.repeat(ends - 1, lengths + 1) - np.arange(len(data))
        row = distance & (REACH - 1)
        row[ends] = REACH
        parts = self.table[row * 256 + data]
        if lengths.max() <= REACH:
            crc = np.bitwise_xor.reduceat(parts, starts)
        else:
            cut = row == REACH - 1
            cut[starts] = True
            cuts = np.flatnonzero(cut)
            blocks = np.bitwise_xor.reduceat(parts, cuts)
            at = np.searchsorted(cuts, starts)
            number = np.diff(np.r_[at, len(cuts)])
            crc = blocks[at]
            going, k = np.flatnonzero(number > 1), 1
            while len(going):
                crc[going] = self._shifted(crc[going]) ^ blocks[at[going] + k]
                k += 1
                going = going[number[going] > k]
        return crc ^ self._constant(lengths)


class Features:
    """Buckets of the features of texts: runs of 1 to `longest` words, joined by one space."""

    def __init__(self, buckets: int, longest: int):
        self.crc, self.buckets, self.longest = PositionCrc(), np.uint32(buckets), longest
        self.lower = np.arange(256, dtype=np.uint8)
        upper = np.arange(ord("A"), ord("Z") + 1)
        self.lower[upper] += 32
        # Digits, lower-case letters and all bytes beyond ASCII make up words.
        self.word = np.zeros(256, np.int8)
        self.word[0x30:0x3A] = self.word[0x61:0x7B] = self.word[0x80:] = 1

    def of(self, texts: list[str]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Words per text, and for each run length the features' buckets and texts."""
        encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
        data = self.lower[np.frombuffer(b" ".join([*encoded, b""]), np.uint8)]
        inside = self.word[data]
        edge = np.diff(inside, prepend=0)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        limits = np.cumsum([len(e) + 1 for e in encoded])
        owner = np.searchsorted(limits, start, "right")
        words = np.bincount(owner, minlength=len(texts))
        if not len(start):
            return words, []
        # One space after each word, nothing else between them.
        held = inside.astype(bool)
        held[end] = True
        data[end] = 32
        data = data[held]
        length = end - start
        last = np.cumsum(length + 1) - 1
        first = last - length
        found = []
        for run in range(1, self.longest + 1):
            for offset in range(run):
                # Runs that start at every run-th word do not overlap.
                a = np.arange(offset, len(first) - run + 1, run)
                buckets = self.crc.spans(data, first[a], last[a + run - 1]) % self.buckets
                same = owner[a] == owner[a + run - 1]
                found.append((buckets[same].astype(np.int64), owner[a[same]]))
        return words, found


def bucket_counts(texts: DataFrame, buckets: int, longest: int) -> np.ndarray:
    """How many features of all texts fall in each bucket. A task reports its sums, so that the
    shuffle and the driver see `buckets` numbers a task and in all."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total = Features(buckets, longest), np.zeros(buckets, np.int64)
        for batch in pieces(batches, most=PIECE):
            for found, _ in features.of(batch.column("text").to_pylist())[1]:
                total += np.bincount(found, minlength=buckets)
        filled = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(filled), pa.array(total[filled])], names=["bucket", "n"])

    rows = (
        texts.select("text")
        .mapInArrow(count, "bucket long, n long")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    counts = np.zeros(buckets, np.int64)
    counts[rows["bucket"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return counts


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * log ratio) of the smoothed shares in the target and in the source."""
    all_source, all_target, size = float(source.sum()), float(target.sum()), len(source)
    return np.array(
        [
            math.floor(1000 * math.log((t + 1) * (all_source + size) / ((s + 1) * (all_target + size))))
            for s, t in zip(source.astype(float).tolist(), target.astype(float).tolist(), strict=True)
        ],
        np.int64,
    )


def noise(seed: int, doc_id: int | None) -> int:
    """Scaled Gumbel noise of a document, by its id and the seed."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weights(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    seed: int = 7,
    buckets: int = BUCKETS,
    longest: int = 2,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_features, weight, score."""
    texts = ids_and_texts(docs, id_col, text_col)
    wanted = target.select(whole_text(f"`{target_col}`").alias("text"))
    gains = bucket_gains(bucket_counts(texts, buckets, longest), bucket_counts(wanted, buckets, longest))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(buckets, longest)
        for batch in pieces(batches, most=PIECE):
            rows = batch.num_rows
            words, found = features.of(batch.column("text").to_pylist())
            n, total = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
            for bucket, owner in found:
                n += np.bincount(owner, minlength=rows)
                np.add.at(total, owner, gains[bucket])
            weight = total // np.maximum(n, 1)
            ids = batch.column("id").to_pylist()
            score = weight + np.array([noise(seed, i) for i in ids], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array(c, pa.int64()) for c in (words, n, weight, score))],
                names=["doc_id", "n_words", "n_features", "weight", "score"],
            )

    return texts.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 25,
    least_words: int = 20,
    **options,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_features, weight, score, rank.

    Of the N documents with `least_words` words or more, the floor(percent * N / 100) with the highest
    scores are drawn; `rank` counts them from 1 on in descending score, ties by ascending doc_id,
    and is null for all others. A null text is an empty one: no features, weight 0. Rows
    that repeat an id share its noise and each count as a document. A null id has the noise of an empty
    name and comes last among ties. An empty table gives an empty result, an empty target a
    ratio against uniform shares; other columns are not read. `options` go to `weights`.
    """
    scored = stored(weights(docs, target, **options), "weights")
    able = F.col("n_words") >= least_words
    ordered = positions(
        scored.filter(able),
        F.desc("score"),
        F.asc_nulls_last("doc_id"),
        F.col("n_features"),
        F.col("weight"),
    )
    drawn = scored.filter(able).count() * percent // 100
    rank = F.when(F.col("position") < drawn, F.col("position") + 1).cast("long").alias("rank")
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    return ordered.select(*columns, rank).unionByName(
        scored.filter(~able).select(*columns, F.lit(None).cast("long").alias("rank"))
    )
