import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from regflow.llm import importance
from regflow.llm.ranks import positions


def features(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in (text or ""))
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return len(words), words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def brute(docs, target, buckets=10_000, percent=25):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in docs for f in features(t)[1])
    t = Counter(bucket(f) for x in target for f in features(x)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(
        1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))
    )
    rows = []
    for i, text in docs:
        words, found = features(text)
        weight = sum(gain(bucket(f)) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((i, words, len(found), weight, score))
    able = sorted(
        (r for r in rows if r[1] >= 20),
        key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]),
    )
    drawn = len(able) * percent // 100
    out = [(*r, k + 1 if k < drawn else None) for k, r in enumerate(able)]
    out += [(*r, None) for r in rows if r[1] < 20]
    return sorted(out, key=str)


def got(frame):
    return sorted(map(tuple, frame.collect()), key=str)


@pytest.fixture
def target_of(spark):
    return lambda texts: spark.createDataFrame([(t, 3) for t in texts], "text string, n long")


TARGET = ["the target talks of Zebras and of 7 stripes", None, "", "stripes é 東京 of zebras"]


def texts():
    rng = np.random.default_rng(5)
    words = ["zebras", "Stripes", "of", "the", "é", "東京都", "x1", "Straße", "a" * 300, "B" * 700, "w" * 256, "v" * 257]
    rows = [(i, " ".join(rng.choice(words, rng.integers(0, 60)))) for i in range(300)]
    rows += [(300 + i, "zebras of the hot group, " * 9) for i in range(150)]
    return rows + [
        (None, None), (None, "of zebras " * 20), (7, "of zebras " * 20), (7, "of zebras " * 20), (900, ""),
        (901, "--- \x00\x7f!"), (902, "y" * 70_000), (903, ("z" * 5000 + "-") * 30), (904, "a\x80b c-d_e" * 8),
    ]


def test_matches_brute_force(docs_of, target_of):
    rows = texts()
    found = importance.resample(docs_of(rows).repartition(7), target_of(TARGET))
    assert found.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert got(found) == brute(rows, TARGET)


def test_other_parameters(docs_of, target_of):
    rows = texts()[:200]
    found = importance.resample(docs_of(rows), target_of(TARGET), percent=60, buckets=97)
    assert got(found) == brute(rows, TARGET, buckets=97, percent=60)


def test_empty_tables(docs_of, target_of):
    assert got(importance.resample(docs_of([]), target_of(TARGET))) == []
    rows = texts()[:50]
    assert got(importance.resample(docs_of(rows), target_of([]))) == brute(rows, [])


@pytest.mark.parametrize("lengths", [[1], [255, 256, 257], [0, 5, 4095, 4096, 5000, 1], [100_000, 3]])
def test_crc_of_spans(lengths):
    rng = np.random.default_rng(3)
    spans = [rng.integers(0, 256, n).astype(np.uint8).tobytes() for n in lengths]
    data = np.frombuffer(b"?" + b" ".join([*spans, b""]), np.uint8)
    ends = np.cumsum(np.array(lengths) + 1)
    crc = importance.PositionCrc().spans(data, ends - lengths, ends)
    assert crc.tolist() == [zlib.crc32(s) for s in spans]


def test_positions_count_all_rows(spark):
    frame = spark.range(0, 5000, 1, 9).selectExpr("id % 3 AS k", "id AS v")
    rows = positions(frame, frame.k.desc()).collect()
    assert sorted(r.position for r in rows) == list(range(5000))
    by_place = [r.k for r in sorted(rows, key=lambda r: r.position)]
    assert by_place == sorted(by_place, reverse=True)
