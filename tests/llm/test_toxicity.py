import zlib

import numpy as np
from pyspark.sql import functions as F

from regflow.llm import toxicity

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model).cache()
    assert got.count() == docs.count()
    judged = got.filter("held_out").join(labels.select("doc_id", "toxic"), "doc_id").toPandas()
    assert len(judged) > 500
    toxic = judged[judged.toxic == 1]
    # Some toxic rows were garbled after labelling and hold no mark at all.
    assert (toxic.predicted == 1).mean() >= 0.92
    assert (judged[judged.toxic == 0].predicted == 0).mean() >= 0.99
    assert all(got.select((F.col("score").between(0, 1)).alias("ok")).distinct().toPandas().ok)
    again = toxicity.score(docs.repartition(7), toxicity.fit(docs.repartition(5), labels)).toPandas()
    first = got.toPandas().sort_values("doc_id")
    assert np.allclose(first.score, again.sort_values("doc_id").score, atol=1e-6)


def test_held_out_labels_do_not_matter(spark, docs_of):
    rows = [(i, ("vile scum " if i % 5 == 0 else "") + f"some plain words {i} and {i * 7}") for i in range(200)]
    out = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    scores = []
    for flip in (0, 1):
        labels = spark.createDataFrame([(i, int((i % 5 == 0) != bool(flip and out(i)))) for i, _ in rows], "doc_id long, toxic int")
        frame = toxicity.score(docs_of(rows), toxicity.fit(docs_of(rows), labels))
        scores.append({r.doc_id: (r.score, r.held_out) for r in frame.collect()})
    assert scores[0] == scores[1]
    assert all(held == out(i) for i, (_, held) in scores[0].items())
    assert all((s >= 0.3) == (i % 5 == 0) for i, (s, _) in scores[0].items())


def test_odd_rows(spark, docs_of):
    rows = [(1, None), (2, ""), (None, "scum"), (3, "x" * 100_000), (4, "a"), (4, "a")]
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = toxicity.score(docs_of(rows), toxicity.fit(docs_of(rows), none)).collect()
    assert len(got) == 6 and {r.score for r in got} == {0.0}
    labels = spark.createDataFrame([(1, 0), (2, None), (3, 7), (4, 1), (4, 0), (None, 1), (99, 1)], "doc_id long, toxic int")
    assert len(toxicity.score(docs_of(rows), toxicity.fit(docs_of(rows), labels)).collect()) == 6
    assert toxicity.score(docs_of([]), toxicity.fit(docs_of([]), labels)).count() == 0


def test_label_model_finds_accuracies_and_correlations():
    rng = np.random.default_rng(1)
    y = rng.random(20_000) < 0.2
    fires = np.where(y[:, None], 0.7, 0.02)
    votes = rng.random((20_000, toxicity.VOTERS)) < fires
    votes[:, 1] = votes[:, 0]
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    prior, found, weights, correlations = toxicity.label_model(patterns.astype(float), counts.astype(float))
    assert abs(prior - 0.2) < 0.02 and np.abs(found[1] - 0.7).max() < 0.05
    assert correlations[1][0, 1] > 0.9 and weights[0] < 0.8 * weights[2]


def test_label_model_matches_brute_force():
    """Posteriors, rates and weights against their definitions, pattern by pattern."""
    rng = np.random.default_rng(5)
    patterns = rng.integers(0, 2, (60, toxicity.VOTERS)).astype(float)
    counts = rng.integers(1, 30, 60).astype(float)
    fires = rng.uniform(0.05, 0.95, (2, toxicity.VOTERS))
    weights = rng.uniform(0.2, 1, toxicity.VOTERS)
    want = []
    for row in patterns:
        odds = np.log(0.3 / 0.7)
        for k, vote in enumerate(row):
            toxic, clean = (fires[y, k] if vote else 1 - fires[y, k] for y in (1, 0))
            odds += weights[k] * np.log(toxic / clean)
        want.append(1 / (1 + np.exp(-odds)))
    assert np.allclose(toxicity.posterior(patterns, 0.3, fires, weights), want)
    # The last round's estimates follow from the posteriors before it.
    earlier = toxicity.label_model(patterns, counts, rounds=4)
    prior, rates, now, correlations = toxicity.label_model(patterns, counts, rounds=5)
    y = toxicity.posterior(patterns, *earlier[:3])
    assert np.isclose(prior, (counts * y).sum() / counts.sum())
    for label, share in ((0, 1 - y), (1, y)):
        mass = counts * share
        for k in range(toxicity.VOTERS):
            rate = ((mass * patterns[:, k]).sum() + 0.1) / (mass.sum() + 0.2)
            assert np.isclose(rates[label, k], rate)
    i, j = 2, 9
    for label, share in ((0, 1 - y), (1, y)):
        a, b = ((patterns[:, k] - rates[label, k]) / np.sqrt(rates[label, k] * (1 - rates[label, k])) for k in (i, j))
        assert np.isclose(correlations[label, i, j], (counts * share * a * b).sum() / (counts * share).sum())
    shared = np.clip(prior * correlations[1] + (1 - prior) * correlations[0], 0, 1)
    assert np.isclose(now[i], 1 / (1 + shared[i].sum() - shared[i, i]))


def test_repeated_ids_and_long_texts(spark, docs_of):
    rows = [(i, ("vile scum " if i % 5 == 0 else "") + f"plain words {i} and {i * 7}") for i in range(200)]
    rows += [(5, "other text of the same id"), (7, "scum " + "word " * 400_000), (9, "w" * 3_000_000)]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(200)], "doc_id long, toxic int")
    scores = []
    for order in (rows, rows[::-1]):
        docs = docs_of(order).repartition(3)
        model = toxicity.fit(docs, labels)
        scores.append(sorted((r.doc_id, r.score) for r in toxicity.score(docs, model).collect()))
        kept = toxicity.clean_rows(docs, model)
        assert kept.columns == docs.columns
        assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, s in scores[-1] if s < 0.3)
    assert np.allclose(scores[0], scores[1])


def labelled(spark, docs_of, texts):
    """Documents and labels from (text, toxic), with ids whose labels are learned from."""
    free = [i for i in range(3 * len(texts)) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows = [(i, t, y) for i, (t, y) in zip(free, texts, strict=False)]
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    return docs_of([(i, t) for i, t, _ in rows]), labels


def test_copies_do_not_change_the_lexicon(spark, docs_of):
    rng = np.random.default_rng(3)
    plain = lambda: " ".join(f"w{k}" for k in rng.integers(0, 5000, 12))
    texts = [(plain(), 0) for _ in range(59)] + [(f"{plain()} scum", 0)]
    texts += [(f"{plain()} scum", 1) for _ in range(8)] + [(f"{plain()} vile", 1) for _ in range(22)]
    one = toxicity.fit(*labelled(spark, docs_of, texts))
    assert {"scum", "vile"} <= one.words.keys()
    clean = toxicity.fit(*labelled(spark, docs_of, texts + [(texts[59][0], 0)] * 45))
    toxic = toxicity.fit(*labelled(spark, docs_of, texts + [(texts[-1][0], 1)] * 45))
    assert clean.words == toxic.words == one.words
    assert clean.starts == toxic.starts == one.starts


def test_frequent_words_do_not_use_up_the_lexicon(spark, docs_of):
    rng = np.random.default_rng(4)
    plain = lambda: " ".join(f"w{k:03}ab" for k in rng.permutation(40)[:30])
    texts = [(plain(), 0) for _ in range(60)]
    texts += [(f"{plain()} {('scum', 'vile', 'filth')[k % 3]}", 1) for k in range(30)]
    model = toxicity.fit(*labelled(spark, docs_of, texts), terms=3)
    assert model.words.keys() == {"scum", "vile", "filth"}
    assert model.starts[4].keys() == {"scum", "vile", "filt"} and model.starts[5].keys() == {"filth"}
