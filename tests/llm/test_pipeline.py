"""Each stage of the pipeline against a brute-force version, on one small corpus."""

import random
from collections import Counter

import pytest

import corpus_pipeline as cp

from .test_exact_dedup import brute as exact_brute
from .test_mixing import goals_of
from .test_ngram_join import brute as near_brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(2)
    word = lambda: f"w{rng.randrange(900)}"
    texts = [" ".join(word() for _ in range(rng.randrange(1, 120))) for _ in range(150)]
    texts += [rng.choice(texts) for _ in range(40)] + [rng.choice(texts).upper() for _ in range(20)]
    for _ in range(40):
        words = rng.choice(texts[:150]).split()
        words[rng.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
    bad = [f"{word()} scum {word()} vile you scum {word()} filth {k}" for k in range(40)]
    texts = [*texts, *bad, "", None, " \n"]
    rows = [(3 * i, t, "en", f"s{i % 4}" if i % 9 else None, len(t or "")) for i, t in enumerate(texts)]
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int("scum" in (t or ""))) for i, t, *_ in rows if i % 2 == 0 and t]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, rows


def collected(frame):
    return Counter(map(tuple, frame.select("doc_id", "text", "lang", "source", "n_chars").collect()))


def test_stages(spark, corpus):
    folder, rows = corpus
    docs = spark.createDataFrame(rows, SCHEMA)
    clean = cp.clean(spark, docs, folder)
    assert clean.columns == docs.columns
    assert collected(clean) == Counter(r for r in rows if "scum" not in (r[1] or ""))

    rows = [r for r in rows if "scum" not in (r[1] or "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = {i for i, *_, keep, _ in exact_brute([(r[0], r[1]) for r in rows]) if keep}
    distinct = cp.distinct(spark, docs, folder)
    assert distinct.columns == docs.columns
    assert collected(distinct) == Counter(r for r in rows if r[0] in kept)

    rows = [r for r in rows if r[0] in kept]
    docs = spark.createDataFrame(rows, SCHEMA)
    first = {i for i, _, c in near_brute([(r[0], r[1]) for r in rows]) if i == c}
    near = cp.dissimilar(spark, docs, folder)
    assert near.columns == docs.columns
    assert collected(near) == Counter(r for r in rows if r[0] in first)
    assert len(first) < len(rows)

    rows = [r for r in rows if r[0] in first]
    docs = spark.createDataFrame(rows, SCHEMA)
    mixed = cp.mixed(spark, docs, folder)
    assert mixed.columns == docs.columns
    got, sizes, taken = collected(mixed), Counter(), Counter()
    assert set(got) <= set(rows) and max(got.values()) <= 2
    for r in rows:
        sizes[r[3]] += len((r[1] or "").split())
    for r, n in got.items():
        taken[r[3]] += n * len(r[1].split())
    for source, goal in goals_of(sizes).items():
        assert abs(taken[source] - goal) <= 3


def test_run_and_odd_rows(spark, corpus, tmp_path):
    folder, _ = corpus
    got = cp.run(spark, folder).collect()
    assert got and set(got[0].asDict()) == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}
    odd = [(None, None, None, None, None), (None, "a b", None, "s", 3), (None, "a b", None, "s", 3), (5, "a b", None, "s", 3)]
    for rows in ([], odd):
        docs = spark.createDataFrame(rows, SCHEMA)
        for _, stage in cp.STAGES:
            docs = stage(spark, docs, folder)
        docs.collect()


def test_repeated_and_null_ids(spark, corpus):
    folder, _ = corpus
    rows = [(5, "a b"), (5, "a b"), (4, "A b"), (None, "a b"), (None, "c d"), (None, "C D"), (5, "other"), (None, ""), (None, None), (0, "z"), (None, "z")]
    docs = spark.createDataFrame([(i, t, "en", "s", 3) for i, t in rows], SCHEMA)
    got = Counter((r.doc_id, (r.text or "").lower()) for r in cp.distinct(spark, docs, folder).collect())
    assert got == Counter([(5, "a b"), (None, "c d"), (5, "other"), (None, ""), (0, "z")])


def test_rows_that_share_an_id_keep_to_the_target(spark, corpus):
    folder, _ = corpus
    rng = random.Random(5)
    texts = [" ".join("w" for _ in range(rng.randrange(1, 30))) for _ in range(240)]
    rows = [((None, 7, i)[i % 3], t, "en", f"s{i % 4}", 3) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got, sizes, taken = collected(cp.mixed(spark, docs, folder)), Counter(), Counter()
    for r in rows:
        sizes[r[3]] += len(r[1].split())
    for r, n in got.items():
        taken[r[3]] += n * len(r[1].split())
    held = Counter(rows)
    assert all(n <= 2 * held[r] for r, n in got.items())
    for source, goal in goals_of(sizes).items():
        assert abs(taken[source] - goal) <= 3


def test_one_row_of_an_id_by_a_total_order(spark, corpus):
    folder, _ = corpus
    rows = [(5, "a b", "en", "s", 3), (5, "A b", "en", "s", 3), (5, "a b", "de", "s", 3), (5, "a b", "en", None, None), (4, "a B", "en", "s", 3)]
    rows += [(None, "c", "en", "s", 1), (None, "C", "fr", "s", 1), (None, "c", "en", "s", 1)]
    found = set()
    for order in (rows, rows[::-1], rows[3:] + rows[:3]):
        docs = spark.createDataFrame(order, SCHEMA)
        got = [tuple(r) for r in cp.distinct(spark, docs, folder).collect()]
        assert len(got) == 2 and {r[0] for r in got} == {5, None}
        found.add(tuple(sorted(map(str, got))))
    assert len(found) == 1
