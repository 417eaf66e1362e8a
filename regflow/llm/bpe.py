"""Encoding and decoding with a byte-pair vocabulary whose words end in a marker.

A text is cut at special tokens, normalised, split into words, and each word's bytes become
parts. A short word keeps its parts and the rank of every adjacent pair in two contiguous
arrays: the smallest rank is found by a scan, its boundary is deleted, and only the two
neighbouring ranks are looked up again. Words above `SHORT` parts go through a heap that
takes the same merges in the same order, so that one endless word costs n log n.

Words repeat, so a task remembers the ids of up to twice `REMEMBERED` words.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regflow.llm.common import ids_and_texts, pieces
from regflow.session import ship_by_value

ship_by_value(__name__)

SHORT = 256
REMEMBERED = 200_000
# The white space of the vocabulary's normaliser.
_SPACE = r"[\x09-\x0D\x20\x85\xA0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
# Letters and numbers that the local pattern module knows, but the Unicode
# version of the tokenizer's own pattern engine does not; there they count as other signs.
_LATER = (
    "558 58b-58c 88f c5c cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd a7e2 a7f1 ab6c-ab6d "
    "107bb-107bf 10940-10959 10ec5-10ec7 10ed9-10eee 11b0a 11db0-11ddb 11de0-11de9 11df1 1246f "
    "12475-1247f 12550-12686 16ea0-16eb8 16ebb-16ed3 16ff2-16ff6 187f8-187ff 18cd6-18cda "
    "18d09-18d20 18d80-18df2 18e00-19191 191a0-191d2 1b123-1b128 1b168 1d6a6 1df1f-1df24 "
    "1df2b-1df81 1df90-1df96 1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5 1e6e7-1e6ed "
    "1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e 2cea2-2cead 323b0-33479 3d000-3fc3f"
)
# Lower-case letters that the tokenizer knows and Python's own table does not.
_LOWER = {
    0x1C89: 0x1C8A,
    0xA7CB: 0x264,
    0xA7CC: 0xA7CD,
    0xA7CE: 0xA7CF,
    0xA7D2: 0xA7D3,
    0xA7D4: 0xA7D5,
    0xA7DA: 0xA7DB,
    0xA7DC: 0x19B,
    **{c: c + 0x20 for c in range(0x10D50, 0x10D66)},
    **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)},
}
_COMMON = "\u0377"
_EXPECTED_NORMALISERS = ["NFC", "Replace", "Lowercase"]


def _byte_letters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary: itself for the
    visible Latin-1 bytes, and the characters from 256 on, in order, for the others."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


class Vocabulary:
    """The parts of a tokenizer file that encoding and decoding need."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if kinds != _EXPECTED_NORMALISERS or spec["decoder"] is not None:
            raise ValueError("this vocabulary has another normaliser or decoder")
        ids: dict[str, int] = model["vocab"]
        self.tokens = {i: t for t, i in ids.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens |= {i: t for t, i in self.special.items()}
        self.end = model["end_of_word_suffix"]
        letters = _byte_letters()
        self.inner = [ids[c] for c in letters]
        self.last = [ids[c + self.end] for c in letters]
        # Words met lately and before, so that a full memory forgets rare words only.
        self.young: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, (left, right) in enumerate(model["merges"]):
            pair = ids[left] << 32 | ids[right]
            self.merges.setdefault(pair, (rank, ids[left + right]))
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        # The file's pattern, with its white-space class spelt out.
        pattern = split["pattern"]["Regex"].replace(r"[^\s", "[^" + _SPACE[1:-1])
        self.words = regex.compile(pattern)
        # Most texts only have characters up to `_COMMON`; for them the classes are short.
        self.common_words = re.compile(
            pattern.replace(r"\p{L}", _class("L")).replace(r"\p{N}", _class("N"))
        )
        later = "".join(
            "-".join(f"\\U{int(end, 16):08x}" for end in span.split("-")) for span in _LATER.split()
        )
        self.later = regex.compile(f"[{later}]")
        self.words_then = regex.compile(
            pattern.replace(r"[\p{L}]", rf"[\p{{L}}--[{later}]]")
            .replace(r"[\p{N}]", rf"[\p{{N}}--[{later}]]")
            .replace(r"\p{L}\p{N}]+", rf"\p{{L}}\p{{N}}]|[{later}])+")
            .replace("[^", "(?:[^"),
            flags=regex.V1,
        )
        self.marks = regex.compile("|".join(map(regex.escape, self.special)))

    def short_word(self, parts: list[int]) -> list[int]:
        merges, none = self.merges, (1 << 60, -1)
        ranks = [
            merges.get(a << 32 | b, none)[0] for a, b in zip(parts, parts[1:], strict=False)
        ]
        while ranks:
            best = min(ranks)
            if best == none[0]:
                break
            at = ranks.index(best)
            parts[at] = merges[parts[at] << 32 | parts[at + 1]][1]
            del parts[at + 1], ranks[at]
            if at:
                ranks[at - 1] = merges.get(parts[at - 1] << 32 | parts[at], none)[0]
            if at < len(ranks):
                ranks[at] = merges.get(parts[at] << 32 | parts[at + 1], none)[0]
        return parts

    def long_word(self, parts: list[int]) -> list[int]:
        merges, size = self.merges, len(parts)
        before, after = list(range(-1, size - 1)), list(range(1, size + 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(at: int) -> None:
            right = after[at]
            if right < size:
                found = merges.get(parts[at] << 32 | parts[right])
                if found:
                    heapq.heappush(heap, (found[0], at, parts[at], parts[right]))

        for at in range(size - 1):
            offer(at)
        while heap:
            _, at, left, right_part = heapq.heappop(heap)
            right = after[at] if parts[at] == left else size
            if right >= size or parts[right] != right_part:
                continue
            parts[at], parts[right] = merges[left << 32 | right_part][1], -1
            after[at] = after[right]
            if after[at] < size:
                before[after[at]] = at
            offer(at)
            if before[at] >= 0:
                offer(before[at])
        return [p for p in parts if p >= 0]

    def word(self, word: str) -> tuple[int, ...]:
        data = word.encode()
        parts = [self.inner[b] for b in data]
        parts[-1] = self.last[data[-1]]
        return tuple((self.short_word if len(parts) <= SHORT else self.long_word)(parts))

    def split(self, text: str) -> list[str]:
        """The words of the normalised text. Blanks only part words, so that runs of them
        need no replacing. Letters turn small one by one: a sigma that ends a word is as any."""
        text = unicodedata.normalize("NFC", text)
        if text.isascii() or max(text) <= _COMMON:
            return self.common_words.findall(text.lower())
        text = text.translate(_LOWER).replace("Σ", "σ").lower()
        return (self.words_then if self.later.search(text) else self.words).findall(text)

    def encoder(self):
        def of_part(text: str) -> Iterator[tuple[int, ...]]:
            for word in self.split(text):
                ids = self.young.get(word)
                if ids is None:
                    ids = self.old.get(word) or self.word(word)
                    if len(word) <= 64:
                        if len(self.young) >= REMEMBERED:
                            self.young, self.old = {}, self.young
                        self.young[word] = ids
                yield ids

        def encode(text: str) -> list[int]:
            if "<" not in text:
                return list(chain.from_iterable(of_part(text)))
            out: list[int] = []
            at = 0
            for mark in self.marks.finditer(text):
                out.extend(chain.from_iterable(of_part(text[at : mark.start()])))
                out.append(self.special[mark[0]])
                at = mark.end()
            out.extend(chain.from_iterable(of_part(text[at:])))
            return out

        return encode


def _class(kind: str) -> str:
    """The characters up to `_COMMON` of one general category, for a character class."""
    return "".join(
        f"\\u{c:04x}" for c in range(ord(_COMMON) + 1) if unicodedata.category(chr(c))[0] == kind
    )


def _built(shared: dict) -> Vocabulary:
    """The vocabulary of a broadcast, built once in each worker process and kept there with
    the words it remembers."""
    if "built" not in shared:
        shared["built"] = Vocabulary(shared["text"])
    return shared["built"]


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id and the ids of its tokens. `vocabulary` is the path of the
    tokenizer file on the driver; tasks get its content, whose size is fixed.

    A null text is an empty one and has no tokens; a null id stays null; repeated rows each
    give a row; further columns are not read. Special tokens in a text get their own ids.
    """
    spec = docs.sparkSession.sparkContext.broadcast({"text": read_vocabulary(vocabulary)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids = _built(spec.value).encoder()
        for batch in pieces(batches, most=1 << 20):
            found = [to_ids(text) for text in batch.column("text").to_pylist()]
            ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
            flat = np.fromiter(chain.from_iterable(found), np.int32, int(ends[-1]))
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column("id"), ids], names=["id", "ids"])

    return ids_and_texts(docs, id_col, text_col).mapInArrow(run, "id long, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """Adds `decoded` to rows of (id, ids). The file names no decoder, so the text is the
    tokens, markers included, joined by spaces. Null ids decode to null, and unknown ids are
    left out, as the library leaves them out."""
    spec = encoded.sparkSession.sparkContext.broadcast({"text": read_vocabulary(vocabulary)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _built(spec.value).tokens
        table = [tokens.get(i) for i in range(max(tokens) + 1)]
        whole = None not in table
        for batch in pieces(batches, "ids", 2 << 20):
            texts = []
            for ids in batch.column("ids").to_pylist():
                if ids is None:
                    texts.append(None)
                elif whole and (not ids or 0 <= min(ids) and max(ids) < len(table)):
                    texts.append(" ".join(map(table.__getitem__, ids)))
                else:
                    texts.append(" ".join(tokens[i] for i in ids if i in tokens))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("ids"), pa.array(texts, pa.string())],
                names=["id", "ids", "decoded"],
            )

    return encoded.select("id", "ids").mapInArrow(run, "id long, ids array<int>, decoded string")


def digests(decoded: DataFrame) -> DataFrame:
    """Token counts and digests of rows (id, ids, decoded)."""
    return decoded.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
