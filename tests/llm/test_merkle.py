import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from regflow.llm import merkle, queries

BIG = (1 << 63) - 1


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, more=0):
    i, text, lang, source, n = row
    n = None if n is None else n + more
    return h("".join(map(field, (i, source, lang, n, text))))


def tree(leaves, run):
    """(top, siblings of each leaf, levels with own place for each leaf)."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h("".join(last[k : k + run])) for k in range(0, len(last), run)])
    ways = []
    for k in range(len(leaves)):
        way = []
        for level in levels[:-1]:
            start = k // run * run
            held = level[start : start + run]
            way.append((held[: k - start], held[k - start + 1 :]))
            k //= run
        ways.append(way)
    return levels[-1][0], ways


def fold(digest, way):
    for left, right in way:
        digest = h("".join([*left, digest, *right]))
    return digest


def brute(rows, run=2):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    made = [tree([leaf(r) for r in groups[g]], run) for g in names]
    if not made:
        return []
    root, over = tree([top for top, _ in made], run)
    out = []
    for (top, ways), upper, name in zip(made, over, names, strict=True):
        for row, way in zip(groups[name], ways, strict=True):
            whole = way + upper
            proof = h("".join("".join(left + right) for left, right in whole))
            cut = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            end = fold(leaf(row, 1) if cut else leaf(row), whole)
            out.append((row[0], leaf(row), top, root, proof, end, end == root))
    return sorted(out, key=str)


@pytest.fixture
def frame_of(spark):
    schema = (
        "doc_id long, text string, lang string, source string, n_chars long, id long, grp string, tree long, "
        "rank long, n long, digest string, path string, position long, _row long, _at long"
    )

    def make(rows):
        return spark.createDataFrame([(*r, 1, "x", 2, 3, 4, "y", "z", 5, 6, 7) for r in rows], schema)

    return make


def digested(found):
    cut = F.crc32(F.col("id").cast("string").cast("binary")) % 7 == 0
    end = merkle.hex_text(merkle.folded_root(F.when(cut, F.col("altered")).otherwise(F.col("leaf"))))
    shown = found.select(
        "id",
        *(merkle.hex_text(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")),
        merkle.proof_digest(),
        end.alias("end"),
        (end == merkle.hex_text(F.col("root"))).alias("verified"),
    )
    return sorted(map(tuple, shown.collect()), key=str)


def rows_of(sizes):
    rows, i = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            rows.append((i * 3, f"text é {i}", lang, "s", i))
            i += 1
    return rows


ODD = [
    (None, None, None, None, None), (None, None, None, None, None), (5, "", "", "", 0), (5, "", "", "", 0),
    (5, "a", "", "", 0), (8, "x" * 300_000, "z", None, BIG), (11, "7:", "ä", "1:", -1), (None, "t", "ä", "s", 3),
]


def test_matches_brute_force(frame_of):
    rows = rows_of({"en": 300, "de": 1, "fr": 17, "a": 16, None: 33, "Z": 2}) + ODD
    found = merkle.manifest(frame_of(rows).repartition(6))
    assert digested(found) == brute(rows)


@pytest.mark.parametrize("run, depth", [(2, 1), (3, 2), (5, 3)])
def test_other_runs(frame_of, run, depth):
    rows = rows_of({"en": 130, "de": 1, "fr": 26, "a": 9, None: 5, "Z": 2})
    assert digested(merkle.manifest(frame_of(rows), run=run, depth=depth)) == brute(rows, run)


def test_few_and_no_rows(frame_of):
    for rows in ([], ODD[:1], ODD[5:6], ODD[:2]):
        assert digested(merkle.manifest(frame_of(rows))) == brute(rows)


def test_query_finds_all_tampering(spark):
    folder = "/root/testdata/sf0.001"
    found = sorted(map(tuple, queries.op13_merkle_manifest(spark, folder).collect()), key=str)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    assert found == brute(rows)
    assert 0 < sum(not r[-1] for r in found) < len(found) / 4
