"""Exact Jaccard join of documents on word shingles, by a token-group matrix.

A token is the 64-bit hash of a shingle. All documents share one order of tokens: those that
fill many documents come last, the others by hash. By that order a document's prefix holds
enough of its set that two documents over the threshold share at least as many prefix tokens as
the smaller of their quotas (`prefix_sizes`).

1. Classes. Documents with equal sets are one class, kept by its smallest id.
2. Groups. Classes that agree in one of `KEYS` minimum hashes are compared with the first of
   them, one comparison per class and hash; those that link form the groups. A family of near
   copies thus becomes few groups without comparing its members with each other.
3. Order. Tokens that stand in many prefixes are moved behind the others, and the prefixes
   that held one are taken anew.
4. Entries. One per token and group: the union of its members' prefixes. Tokens of a single group go.
5. First links. In the tokens that many groups have, a group meets one other a turn: of the groups that
   come last in its tokens, by their number of such tokens or by a hash, the one with which it shares the most.
   A few members of both are compared, and linked groups become one, so that what is left of a family
   comes together at a cost in proportion to its entries.
6. Matrix. The number of tokens that two of the remaining groups share bounds what any two of
   their members can share.
7. Opening. Only pairs of groups whose bound reaches the quota are opened. Their members' sets
   meet in blocks of bounded size, and one link joins the groups.

Every pair over the threshold lies within a group or between two opened ones, so the components
are exact. Sets are compared as sets of 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regflow.llm.common import checkpointed, ids_and_texts, pieces, stored
from regflow.llm.components import components
from regflow.session import ship_by_value

ship_by_value(__name__)

WORDS = 5
KEYS = 4
#: Tokens of a group's members on each side of one block.
BLOCK = 1 << 16
#: Prefixes from which on a token is moved back, and groups of a token that are paired in one row.
CROWDED, LISTED = 8, 64
#: Members of a group that are compared before the matrix, and turns in which groups meet there.
SAMPLED, TURNS = 4, 3
#: Tokens per block of the frequency count, and the least count there that is reported. A
#: token of d documents over b blocks is reported once d is some twice the root of b.
COUNTED, LEAST = 4_000_000, 2
#: Tokens from this count on leave the hash order; at most `FREQUENT` of them, the most
#: frequent, are told apart. This bounds the broadcast, and only affects the order.
OFTEN, FREQUENT = 4, 1 << 20
#: A set of n tokens has a quota of 1 + n / EASE. More than 1 costs longer prefixes, which reach
#: more frequent tokens, and saves openings.
EASE = 400
#: Bits of the filter that spares most texts a shuffle; its size does not depend on the data.
MARKS = 1 << 24

_SEEDS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xD6E8FEB86659FD93],
    dtype=np.uint64,
)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes:
    """64-bit hashes of the words of a text, A-Z lower-cased, in a few passes over its bytes: a
    polynomial of a random number per byte, taken as a difference of running sums."""

    def __init__(self):
        random = np.random.default_rng(20_240_607)
        self.numbers = random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        upper = np.arange(ord("A"), ord("Z") + 1)
        self.numbers[upper] = self.numbers[upper + 32]
        self.blank = np.zeros(256, bool)
        self.blank[[9, 10, 11, 12, 13, 32]] = True
        self._extend(1 << 16)

    def _extend(self, size: int) -> None:
        base = 0x9E3779B97F4A7C15
        self.powers = np.cumprod(np.full(size, base, np.uint64))
        self.inverses = np.cumprod(np.full(size, pow(base, -1, 1 << 64), np.uint64))

    def words(self, text: str) -> np.ndarray:
        data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        if len(data) > len(self.powers):
            self._extend(2 * len(data))
        blank = np.ones(len(data) + 2, np.int8)
        blank[1:-1] = self.blank[data]
        edge = np.diff(blank)
        start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.numbers[data] * self.powers[: len(data)], out=total[1:])
        if not len(start):
            return np.empty(0, np.uint64)
        size = (end - start).astype(np.uint64)
        return mix((total[end] - total[start]) * self.inverses[start] + size)


def shingles(text: str, hashes: WordHashes, words: int = WORDS) -> np.ndarray:
    """The sorted distinct tokens of a text. With fewer words the sequence is one shingle; no
    words, no tokens."""
    each = hashes.words(text)
    if not len(each):
        return each
    width = min(words, len(each))
    token = np.full(len(each) - width + 1, _SEEDS[0] + np.uint64(width), np.uint64)
    for k in range(width):
        token = token * _SEEDS[1] + each[k : len(each) - width + 1 + k]
    token = np.sort(mix(token))
    return token[np.r_[True, token[1:] != token[:-1]]]


def prefix_sizes(n: int, percent: int) -> tuple[int, int]:
    """(prefix length, quota) of a set of n tokens. A partner over the threshold lacks at most
    n - ceil(n * percent / 100) of the tokens, so that the first `quota` common tokens lie in
    the prefix; of two partners the smaller quota holds."""
    quota = 1 + n // EASE
    return n - -(-n * percent // 100) + quota, quota


def early_size(n: Column, quota: Column, percent: int) -> Column:
    """Of two partners the smaller, of n tokens, lacks at most n - ceil(2 t n / (1 + t)) of
    them, t the threshold: the first `quota` common tokens are among so many of its own."""
    return n - F.ceil(n * 2 * percent / (100 + percent) - 1e-9) + quota


def linked(common: np.ndarray, a: np.ndarray, b: int, percent: int) -> np.ndarray:
    return 100 * common >= percent * (a + b - common)


def _frequent(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent tokens, sorted, and their ranks by order of magnitude. Counted over
    all documents, block by block; what is rare within every block cannot matter."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, size = WordHashes(), [], 0

        def report():
            tokens, n = np.unique(np.concatenate(held), return_counts=True)
            often = n >= LEAST
            return pa.RecordBatch.from_arrays(
                [pa.array(tokens[often].view(np.int64)), pa.array(n[often])], names=["token", "n"]
            )

        for batch in pieces(batches):
            for text in batch.column("text").to_pylist():
                tokens = shingles(text, hashes, words)
                held.append(tokens)
                size += len(tokens)
                if size >= COUNTED:
                    yield report()
                    held, size = [], 0
        if held:
            yield report()

    found = (
        docs.select("text")
        .mapInArrow(count, "token long, n long")
        .groupBy("token")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= OFTEN)
        .select("token", F.floor(F.log2(F.col("n") / OFTEN)).cast("int").alias("rank"))
        .orderBy(F.desc("rank"), "token")
        .limit(FREQUENT)
        .toArrow()
    )
    tokens = found["token"].to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], found["rank"].to_numpy().astype(np.uint64)[order] + np.uint64(1)


_PROFILE = "id long, n long, sum1 long, sum2 long, keys array<long>, quota long, prefix array<long>"

_COLUMNS = [part.split()[0] for part in _PROFILE.split(", ")]
_SAME_SET = ["id", "n", "sum1", "sum2"]


def _profile_rows(ids: pa.Array, sets: list[np.ndarray], often: tuple, percent: int) -> pa.RecordBatch:
    """`_PROFILE` of documents, from their sets."""
    tokens_often, ranks = often
    n, sums, keys, quotas, prefixes = [], [], [], [], []
    for tokens in sets:
        n.append(len(tokens))
        mixed = [tokens, *(mix(tokens ^ seed) for seed in _SEEDS[1:KEYS])]
        sums.append([int(m.sum(dtype=np.uint64).view(np.int64)) for m in mixed[:2]])
        keys.append([int(m.min().view(np.int64)) if len(m) else 0 for m in mixed])
        length, quota = prefix_sizes(len(tokens), percent)
        if len(tokens) and len(tokens_often):
            at = np.minimum(np.searchsorted(tokens_often, tokens), len(tokens_often) - 1)
            rank = np.where(tokens_often[at] == tokens, ranks[at], np.uint64(0))
            # Tokens are sorted, so a stable sort by rank orders by (rank, hash).
            tokens = tokens[np.argsort(rank, kind="stable")]
        quotas.append(quota)
        prefixes.append(tokens[:length].view(np.int64))
    return pa.RecordBatch.from_arrays(
        [
            ids,
            pa.array(n, pa.int64()),
            pa.array([s[0] for s in sums], pa.int64()),
            pa.array([s[1] for s in sums], pa.int64()),
            pa.array(keys, pa.list_(pa.int64())),
            pa.array(quotas, pa.int64()),
            _lists(prefixes),
        ],
        names=["id", "n", "sum1", "sum2", "keys", "quota", "prefix"],
    )


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _profiles(docs: DataFrame, words: int, percent: int, frequent: tuple) -> DataFrame:
    """Per document: id, n, two sums that identify its set, minimum hashes, quota, prefix."""
    often = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in pieces(batches):
            sets = [shingles(text, hashes, words) for text in batch.column("text").to_pylist()]
            yield _profile_rows(batch.column("id"), sets, often.value, percent)

    return stored(docs.mapInArrow(run, _PROFILE), "profiles")


def _later(frequent: tuple, counts: DataFrame) -> tuple[np.ndarray, tuple]:
    """Tokens of `counts` (token, n) that `frequent` does not have and that fill many prefixes,
    sorted, and the order with them. At most `FREQUENT` of them, the most frequent, move."""
    found = (
        counts.filter(F.col("n") >= CROWDED).orderBy(F.desc("n"), "token").limit(FREQUENT).toArrow()
    )
    tokens = found["token"].to_numpy().view(np.uint64)
    ranks = np.floor(np.log2(found["n"].to_numpy() / OFTEN)).astype(np.uint64) + np.uint64(1)
    new = ~np.isin(tokens, frequent[0])
    order = np.argsort(tokens[new])
    every = np.concatenate([frequent[0], tokens[new]])
    rank = np.concatenate([frequent[1], ranks[new]])
    sort = np.argsort(every)
    return tokens[new][order], (every[sort], rank[sort])


def _reordered(
    docs: DataFrame, classes: DataFrame, words: int, percent: int, frequent: tuple
) -> DataFrame:
    """Classes with prefixes by the better order.

    A prefix without a token that moves back stays what it is, as all others keep their places. So
    only the sets of the other classes are looked at again.
    """
    spark = classes.sparkSession
    counts = stored(
        classes.select(F.explode("prefix").alias("token")).groupBy("token").agg(F.count("*").alias("n")).filter("n > 1"),
        "counts",
    )
    moved, order = _later(frequent, counts)
    gone, often = spark.sparkContext.broadcast(moved), spark.sparkContext.broadcast(order)

    def holds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefix = batch.column("prefix")
            flat = np.r_[False, np.isin(prefix.flatten().to_numpy().view(np.uint64), gone.value)].cumsum()
            ends = prefix.offsets.to_numpy() - prefix.offsets[0].as_py()
            hit = pa.array(flat[ends[1:]] > flat[ends[:-1]])
            yield batch.select(_SAME_SET).filter(hit)

    again = stored(
        classes.select(*_SAME_SET, "prefix").mapInArrow(holds, "id long, n long, sum1 long, sum2 long"), "again"
    )

    wanted = spark.sparkContext.broadcast(_bits(again, F.col("id")))

    def anew(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in pieces(batches):
            batch = _marked(batch, wanted.value)
            sets = [shingles(text, hashes, words) for text in batch.column("text").to_pylist()]
            yield _profile_rows(batch.column("id"), sets, often.value, percent)

    # The filter's false hits and the other sets of a repeated id go in the join.
    renewed = docs.select("id", "text", _mark(F.col("id")).alias("mark")).mapInArrow(anew, _PROFILE)
    changed = stored(renewed.join(again, _SAME_SET, "left_semi").select(*_COLUMNS).dropDuplicates(_SAME_SET), "changed")
    return classes.select(*_COLUMNS).join(again, _SAME_SET, "left_anti").select(*_COLUMNS).unionByName(changed)


def _mark(value: Column) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(MARKS))


def _marked(batch: pa.RecordBatch, marks: np.ndarray) -> pa.RecordBatch:
    """The rows whose `mark` is in the filter."""
    at = batch.column("mark").to_numpy().astype(np.uint64)
    hit = marks[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)
    return batch.filter(pa.array(hit.astype(bool)))


def _bits(frame: DataFrame, value: Column) -> np.ndarray:
    """A filter of `MARKS` bits that has those of all values; its size is fixed."""
    mark = _mark(value)
    bits = (
        frame.select(F.shiftright(mark, 6).alias("word"), (mark % 64).cast("int").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
        .toArrow()
    )
    filled = np.zeros(MARKS // 64, np.int64)
    filled[bits["word"].to_numpy()] = bits["bits"].to_numpy()
    return filled.view(np.uint64)


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(id, tokens) of the wanted ids. A bit filter of fixed size drops most other texts where
    they are read; false hits only cost time, and the join that follows is exact."""
    marks = docs.sparkSession.sparkContext.broadcast(_bits(wanted, F.col("id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in pieces(batches):
            batch = _marked(batch, marks.value)
            sets = [shingles(t, hashes, words).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sets, pa.binary())], names=["id", "tokens"]
            )

    found = docs.select("id", "text", _mark(F.col("id")).alias("mark")).mapInArrow(run, "id long, tokens binary")
    return stored(found.join(wanted, "id", "left_semi").distinct(), "sets")


_BLOCK_ROWS = ["grp", "a", "b", "side", "other", "tokens"]


def _meet(percent: int):
    """Compares the two sides of each block in a stream sorted by (grp, a, b, side); gives
    (grp, other) for every row of side 1 that links with any row of side 0."""

    def compare(grp: int, left: list[np.ndarray], right: list[tuple[int, np.ndarray]]):
        if not left or not right:
            return
        sizes = np.array([len(s) for s in left])
        owner = np.repeat(np.arange(len(left)), sizes)
        tokens = np.concatenate(left)
        order = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[order], owner[order]
        for other, own in right:
            low, high = np.searchsorted(tokens, own, "left"), np.searchsorted(tokens, own, "right")
            runs = high - low
            total = int(runs.sum())
            if not total:
                continue
            places = np.arange(total) + np.repeat(low - (np.cumsum(runs) - runs), runs)
            common = np.bincount(owner[places], minlength=len(left))
            if linked(common, sizes, len(own), percent).any():
                yield grp, other

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, left, right = None, [], []
        for batch in batches:
            found = []
            columns = [batch.column(c).to_pylist() for c in _BLOCK_ROWS]
            for grp, a, b, side, other, data in zip(*columns, strict=True):
                if (grp, a, b) != key:
                    if key:
                        found += compare(key[0], left, right)
                    key, left, right = (grp, a, b), [], []
                tokens = np.frombuffer(data, np.uint64)
                if side:
                    right.append((other, tokens))
                else:
                    left.append(tokens)
            yield _links_batch(found)
        if key:
            yield _links_batch(list(compare(key[0], left, right)))

    return run


def _links_batch(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([g for g, _ in found], pa.int64()), pa.array([o for _, o in found], pa.int64())],
        names=["a", "b"],
    )


def _open(left: DataFrame, right: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between groups: `left` has the members (grp, id, n) of groups to open, `right`
    the members (grp, id, n, other) of other groups that ask for them. Both sides of a group are
    cut into blocks, so that a task holds `BLOCK` tokens of each side at a time, on average, or one set."""
    spread = F.xxhash64("id", F.lit(5))

    def blocks_of(members: DataFrame, name: str) -> DataFrame:
        return members.groupBy("grp").agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias(name))

    blocks = checkpointed(blocks_of(left, "n_left").join(blocks_of(right, "n_right"), "grp"))
    rows_left = left.join(blocks, "grp").select(
        "grp",
        F.pmod(spread, "n_left").cast("int").alias("a"),
        F.explode(F.sequence(F.lit(0), F.col("n_right") - 1)).alias("b"),
        F.lit(0).alias("side"),
        F.lit(None).cast("long").alias("other"),
        "id",
    )
    rows_right = right.join(blocks, "grp").select(
        "grp",
        F.explode(F.sequence(F.lit(0), F.col("n_left") - 1)).alias("a"),
        F.pmod(spread, "n_right").cast("int").alias("b"),
        F.lit(1).alias("side"),
        "other",
        "id",
    )
    # Stored, as a checkpoint is planned with the product of its sources' sizes, which over a
    # few turns of joins gets so many digits that the driver is busy with nothing else.
    return stored(
        rows_left.unionByName(rows_right)
        .join(sets, "id")
        .select(*_BLOCK_ROWS)
        .repartition("grp", "a", "b")
        .sortWithinPartitions("grp", "a", "b", "side")
        .mapInArrow(_meet(percent), "a long, b long")
        .distinct(),
        "open",
    )


def _groups(docs: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """(id, grp) for every class: its verified group, or itself."""
    keyed = classes.select("id", "n", F.posexplode("keys").alias("place", "key"))
    first = keyed.groupBy("place", "key").agg(
        F.min(F.struct("id", "n")).alias("first"), F.count("*").alias("members")
    )
    pairs = checkpointed(
        keyed.join(first.filter("members > 1"), ["place", "key"])
        .select(F.col("first.id").alias("grp"), "id", "n", F.col("first.n").alias("m"))
        .filter("grp <> id")
        .filter(100 * F.least("n", "m") >= percent * F.greatest("n", "m"))
        .select("grp", "id", "n", "m")
        .distinct()
    )
    leaders = pairs.groupBy("grp").agg(F.max("m").alias("n")).select("grp", F.col("grp").alias("id"), "n")
    wanted = checkpointed(pairs.select("id").union(leaders.select("id")).distinct())
    sets = _sets(docs, wanted, words)
    links = _open(leaders, pairs.select("grp", "id", "n", F.col("id").alias("other")), sets, percent)
    found = components(links)
    return stored(
        classes.select("id", "n", "quota")
        .join(found, "id", "left")
        .select("id", "n", "quota", F.coalesce("component", "id").alias("grp")),
        "groups",
    )


#: Bits of a size step in a group's code.
STEP = 6


def _step(n: Column, percent: int, slack: float) -> Column:
    """Sizes in steps of the largest ratio that two partners can have."""
    step = F.floor(F.log(n) / math.log(100 / percent) + slack)
    return F.greatest(F.least(step, F.lit((1 << STEP) - 1)), F.lit(0)).cast("long")


def _least_quota(code: Column, percent: int) -> Column:
    """A lower bound of the quotas in a group, from its code."""
    step = F.shiftright(code, STEP).bitwiseAND((1 << STEP) - 1)
    return 1 + F.floor(F.pow(F.lit(100 / percent), step) * 0.999 / EASE)


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries (token, grp, early) of rows (grp, early, tokens). Members of one group in a batch are
    combined, so that the many of a family do not all meet in the task of a token."""
    for batch in batches:
        lists = batch.column("tokens")
        sizes = np.diff(lists.offsets.to_numpy())
        token = lists.flatten().to_numpy()
        grp = np.repeat(batch.column("grp").to_numpy(), sizes)
        place = np.arange(len(token)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        early = (place < np.repeat(batch.column("early").to_numpy(), sizes)).astype(np.int64)
        order = np.lexsort((early, grp, token))
        token, grp, early = token[order], grp[order], early[order]
        # Of equal pairs the last one is early if any is.
        last = np.r_[(token[1:] != token[:-1]) | (grp[1:] != grp[:-1]), True][: len(token)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(token[last]), pa.array(grp[last]), pa.array(early[last])], names=["token", "grp", "early"]
        )


def _shared_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of groups in the rows of the matrix, with the number of tokens, added up
    before they are shuffled: pairs whose sizes can go together, and of which one has the
    token early (see `early_size`). Groups of a row with two blocks meet those of the other."""
    mask = (1 << STEP) - 1
    one, two, size = [], [], 0
    for batch in batches:
        for groups, cross in zip(batch.column("groups"), batch.column("cross").to_pylist(), strict=True):
            entries = np.sort(groups.values.to_numpy(zero_copy_only=False))
            members, early, block = entries >> 2, (entries >> 1 & 1).astype(bool), entries & 1
            low, high = members >> STEP & mask, members & mask
            for k in range(len(members) - 1):
                fit = (high[k + 1 :] >= low[k] - 1) & (high[k] >= low[k + 1 :] - 1)
                fit &= early[k] | early[k + 1 :]
                if cross:
                    fit &= block[k + 1 :] != block[k]
                others = members[k + 1 :][fit]
                if not len(others):
                    continue
                one.append(np.full(len(others), members[k]))
                two.append(others)
                size += len(others)
                if size > 1_000_000:
                    yield _pair_counts(one, two)
                    one, two, size = [], [], 0
    if size:
        yield _pair_counts(one, two)


def _pair_counts(one: list[np.ndarray], two: list[np.ndarray]) -> pa.RecordBatch:
    pairs = np.stack([np.concatenate(one), np.concatenate(two)])
    order = np.lexsort(pairs[::-1])
    pairs = pairs[:, order]
    start = np.flatnonzero(np.r_[True, (pairs[:, 1:] != pairs[:, :-1]).any(axis=0)])
    counts = np.diff(np.r_[start, pairs.shape[1]])
    return pa.RecordBatch.from_arrays(
        [pa.array(pairs[0, start]), pa.array(pairs[1, start]), pa.array(counts)],
        names=["one", "two", "shared"],
    )


def _slim(classes: DataFrame, percent: int) -> DataFrame:
    """Per class: id, its prefix, and how many tokens of it are early (see `early_size`)."""
    early = early_size(F.col("n"), F.col("quota"), percent).cast("long")
    return classes.select("id", F.col("prefix").alias("tokens"), early.alias("early"))


def _listed(slim: DataFrame, groups: DataFrame) -> DataFrame:
    """Entries (token, grp, early) of the tokens that several groups have, one of them early."""
    entries = (
        slim.join(groups.select("id", "grp"), "id")
        .select("grp", "early", "tokens")
        .mapInArrow(_entries, "token long, grp long, early long")
        # One exchange: a token's entries of one group are combined in it, and its groups counted.
        .repartition("token")
        .groupBy("token", "grp")
        .agg(F.max("early").alias("early"))
    )
    same = Window.partitionBy("token")
    listed = entries.withColumns({"all": F.count("*").over(same), "any": F.max("early").over(same)})
    return stored(listed.filter("all > 1 and any = 1").select("token", "grp", "early"), "listed")


def _first_links(
    docs: DataFrame, listed: DataFrame, groups: DataFrame, words: int, percent: int
) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) between groups, and the groups with their labels, of which those joined by links
    mostly have one. In a turn each group that has a crowded token is compared with one other."""
    same = Window.partitionBy("token")
    crowded = stored(
        listed.withColumn("all", F.count("*").over(same)).filter(F.col("all") >= CROWDED).select("token", "grp"), "crowded"
    )
    members = groups.select("id", "n", "grp").join(crowded.select("grp").distinct(), "grp", "left_semi")

    def some(frame: DataFrame, key: str, turn: int) -> DataFrame:
        order = Window.partitionBy(key).orderBy(F.xxhash64("id", F.lit(turn)), "id")
        return frame.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= 4 * SAMPLED)

    pool = stored(some(members, "grp", 0).select("id", "n", "grp", F.col("grp").alias("label")), "pool")
    sets = _sets(docs, pool.select("id").distinct(), words)
    links = None
    for turn in range(TURNS):
        labels = pool.select("grp", "label").distinct()
        now = crowded.join(labels, "grp").select("token", "label").distinct()
        held = F.count("*").over(Window.partitionBy("label")) if turn % 2 == 0 else F.xxhash64("label", F.lit(turn))
        ranked = now.select("token", F.struct(held.alias("held"), "label").alias("own"))
        met = ranked.withColumn("last", F.max("own").over(same)).filter("own <> last")
        shared = met.groupBy("own.label", F.col("last.label").alias("center")).agg(F.count("*").alias("shared"))
        best = stored(
            shared.groupBy("label").agg(F.max_by("center", F.struct("shared", "center")).alias("center")), "best"
        )
        few = stored(some(pool, "label", turn + 1), "few")
        left = few.join(best.select(F.col("center").alias("label")).distinct(), "label", "left_semi")
        right = best.join(few.filter(F.col("place") <= SAMPLED), "label")
        found = _open(
            left.select(F.col("label").alias("grp"), "id", "n"),
            right.select(F.col("center").alias("grp"), "id", "n", F.col("label").alias("other")),
            sets,
            percent,
        )
        links = found if links is None else links.union(found)
        # A center comes after its groups by the order of the turn, so that following links ends.
        to = found.select(F.col("b").alias("label"), F.col("a").alias("to"))
        further = to.select(F.col("label").alias("to"), F.col("to").alias("far"))
        ends = to.join(further, "to", "left").select("label", F.coalesce("far", "to").alias("end"))
        pool = stored(
            pool.join(ends, "label", "left").select("id", "n", "grp", F.coalesce("end", "label").alias("label")), "pool"
        )
    labelled = groups.join(pool.select("grp", "label").distinct(), "grp", "left")
    return links, stored(labelled.select("id", "n", "quota", "grp", F.coalesce("label", "grp").alias("label")), "labelled")


def _between_groups(
    docs: DataFrame, listed: DataFrame, labelled: DataFrame, words: int, percent: int
) -> DataFrame:
    """Links (a, b) between groups of different labels."""
    groups = labelled.select("id", "n", "quota", F.col("label").alias("grp"))
    about = groups.groupBy("grp").agg(
        F.min("quota").alias("quota"),
        F.min("n").alias("least"),
        F.max("n").alias("most"),
        F.sum("n").alias("weight"),
    )
    # A group's code: a number of its own, then the size steps of its smallest and largest set.
    about = checkpointed(
        about.withColumn(
            "code",
            F.shiftleft(F.monotonically_increasing_id(), 2 * STEP)
            + F.shiftleft(_step(F.col("least"), percent, -1e-6), STEP)
            + _step(F.col("most"), percent, 1e-6),
        )
    )
    coded = (
        labelled.select("grp", "label").distinct().join(about.select(F.col("grp").alias("label"), "code"), "label").select("grp", "code")
    )
    entries = listed.join(coded, "grp").groupBy("token", "code").agg(F.max("early").alias("early"))
    same = Window.partitionBy("token")
    # Among the labels a token may be left with a single one.
    labels = entries.withColumns({"all": F.count("*").over(same)})
    parts = F.ceil(F.col("all") / LISTED).cast("int")
    # A long list is cut into blocks, every two of which are a row of their own.
    blocks = (
        labels.filter("all > 1")
        .withColumn("parts", parts)
        .withColumn("own", F.pmod(F.xxhash64("code"), "parts").cast("int"))
        .withColumn("met", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            "token",
            F.least("own", "met").alias("x"),
            F.greatest("own", "met").alias("y"),
            (F.col("code") * 4 + F.col("early") * 2 + (F.col("own") > F.col("met")).cast("long")).alias("entry"),
        )
    )
    matrix = (
        blocks.repartition("token", "x", "y")
        .groupBy("token", "x", "y")
        .agg(F.collect_list("entry").alias("groups"))
        .filter(F.size("groups") > 1)
        .select("groups", (F.col("x") < F.col("y")).alias("cross"))
    )
    quota = F.least(_least_quota(F.col("one"), percent), _least_quota(F.col("two"), percent))
    bounds = (
        matrix.mapInArrow(_shared_tokens, "one long, two long, shared long")
        .groupBy("one", "two")
        .agg(F.sum("shared").alias("shared"))
        .filter(F.col("shared") >= quota)
    )

    def side(name: str, prefix: str) -> DataFrame:
        return about.select(
            F.col("code").alias(name), *(F.col(c).alias(f"{prefix}_{c}") for c in about.columns)
        )

    larger = F.col("x_weight") >= F.col("y_weight")
    opened = checkpointed(
        bounds.join(side("one", "x"), "one")
        .join(side("two", "y"), "two")
        .filter(F.col("shared") >= F.least("x_quota", "y_quota"))
        .filter(100 * F.col("x_most") >= percent * F.col("y_least"))
        .filter(100 * F.col("y_most") >= percent * F.col("x_least"))
        .select(
            F.when(larger, F.col("x_grp")).otherwise(F.col("y_grp")).alias("grp"),
            F.when(larger, F.col("y_grp")).otherwise(F.col("x_grp")).alias("other"),
        )
    )
    members = groups.select("id", "n", "grp")
    left = checkpointed(members.join(opened.select("grp").distinct(), "grp", "left_semi"))
    right = checkpointed(
        opened.join(members.withColumnRenamed("grp", "other"), "other").select("grp", "id", "n", "other")
    )
    wanted = checkpointed(left.select("id").union(right.select("id")).distinct())
    return _open(left.select("grp", "id", "n"), right, _sets(docs, wanted, words), percent)


def similar_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    percent: int = 80,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Two documents link when 100 * |common shingles| >= percent * |all shingles|. A document
    without words has no shingles and no links. A null text is an empty one. Rows that repeat an
    id are one document whose links add up; a row with a null id takes no part and has a null
    component. An empty table gives an empty result; other columns are not read.
    """
    texts = ids_and_texts(docs, id_col, text_col)
    frequent = _frequent(texts, words)
    profiles = _profiles(texts, words, percent, frequent)
    same = ["n", "sum1", "sum2"]
    able = profiles.filter("id IS NOT NULL AND n > 0")
    firsts = checkpointed(able.groupBy(*same).agg(F.min("id").alias("class")))
    classed = checkpointed(
        able.select("id", *same).join(firsts, same).select("id", F.col("class").alias("other")).distinct()
    )
    # The class's own row, once; a repeated id may be the first of several classes.
    classes = stored(
        able.join(firsts.withColumnRenamed("class", "id"), [*same, "id"], "left_semi").dropDuplicates(
            [*same, "id"]
        ),
        "classes",
    )
    groups = _groups(texts, classes, words, percent)
    slim = _slim(_reordered(texts, classes, words, percent, frequent), percent)
    listed = _listed(slim, groups)
    early, labelled = _first_links(texts, listed, groups, words, percent)
    between = _between_groups(texts, listed, labelled, words, percent)
    links = (
        between.union(early)
        .union(groups.select("id", "grp"))
        .union(classed.select("id", "other"))
        .toDF("a", "b")
    )
    found = components(stored(links, "links"))
    return profiles.select("id", "n").join(found, "id", "left").select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "id").alias("component_id"),
    )
