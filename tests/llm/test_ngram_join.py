import random
import re

import pyarrow as pa
import pytest

from regflow.llm import ngram_join
from regflow.llm.components import components


def sets_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in (text or ""))
    w = re.findall("[^\x20\x09-\x0d]+", low)
    if not w:
        return frozenset()
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4)))


def smallest(pairs, ids):
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def brute(rows):
    known = [(i, sets_of(t)) for i, t in rows]
    use = [(i, s) for i, s in known if i is not None and s]
    pairs = [
        (a, b)
        for k, (a, s) in enumerate(use)
        for b, t in use[:k]
        if 100 * len(s & t) >= 80 * len(s | t)
    ]
    comp = smallest(pairs, {i for i, _ in known if i is not None})
    return sorted(((i, len(s), comp.get(i)) for i, s in known), key=str)


def family(rng, base, n, edits):
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
        if rng.random() < 0.3:
            del words[rng.randrange(len(words)) :][: rng.randrange(1, 9)]
        yield " ".join(words)


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(docs_of, monkeypatch, seed):
    monkeypatch.setattr(ngram_join, "BLOCK", 700)
    monkeypatch.setattr(ngram_join, "CROWDED", 3)
    monkeypatch.setattr(ngram_join, "LISTED", 3)
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    passage = [word() for _ in range(60)]
    texts = []
    for size, n, edits in ((120, 60, 4), (60, 40, 3), (30, 30, 2), (200, 25, 9), (12, 20, 1)):
        texts += family(rng, [word() for _ in range(size)], n, edits)
    for _ in range(60):
        own = [word() for _ in range(rng.randrange(5, 90))]
        texts.append(" ".join(own[:9] + passage + own[9:]))
    texts += [" ".join(passage[: rng.randrange(20, 60)]) for _ in range(40)]
    texts += ["A b", "a B", "a b c", "a\xa0b", "one", "", None, " \n\t", "x " * 4000, "X " * 4001, "a b c d e", "É é", "é é"]
    rows = list(enumerate(texts)) + [(None, texts[0]), (None, None), (7, texts[7]), (500, texts[3])]
    got = ngram_join.similar_documents(docs_of(rows).repartition(5))
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_repeated_ids_add_up(docs_of):
    long = [" ".join(f"{c}{k}" for k in range(30)) for c in "abc"]
    rows = [(1, long[0]), (5, long[0]), (5, long[1]), (9, long[1]), (3, long[2])]
    got = {(r.doc_id, r.component_id) for r in ngram_join.similar_documents(docs_of(rows)).collect()}
    assert got == {(1, 1), (5, 1), (9, 1), (3, 3)}


def test_small_tables(docs_of):
    assert ngram_join.similar_documents(docs_of([])).collect() == []
    got = ngram_join.similar_documents(docs_of([(2, None), (1, "")])).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 1), (2, 0, 2)]


def test_prefixes_keep_their_promise():
    rng = random.Random(0)
    for _ in range(3000):
        n = rng.randrange(1, 120)
        a = set(range(n))
        b = set(a)
        for _ in range(rng.randrange(0, n // 4 + 2)):
            b.discard(rng.randrange(n)) if rng.random() < 0.6 else b.add(1000 + rng.randrange(50))
        if not b or 100 * len(a & b) < 80 * len(a | b):
            continue
        order = {t: rng.random() for t in a | b}
        cut = lambda s: set(sorted(s, key=order.get)[: ngram_join.prefix_sizes(len(s), 80)[0]])
        quota = min(ngram_join.prefix_sizes(len(a), 80)[1], ngram_join.prefix_sizes(len(b), 80)[1])
        assert len(cut(a) & cut(b)) >= quota
        small, large = sorted((a, b), key=len)
        own = ngram_join.prefix_sizes(len(small), 80)[1]
        early = set(sorted(small, key=order.get)[: len(small) - -(-len(small) * 160 // 180) + own])
        assert len(early & cut(large)) >= quota


def test_pairs_of_a_task_are_added_up():
    groups = [[(k << 12 | 26 << 6 | 26) * 4 + 2 for k in range(5)]]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(groups, pa.list_(pa.int64())), pa.array([False])], names=["groups", "cross"]
    )
    got = list(ngram_join._shared_tokens(iter([batch] * 9)))
    assert sum(b.num_rows for b in got) == 10
    assert {n for b in got for n in b.column("shared").to_pylist()} == {9}


def test_a_family_is_one_group_before_the_matrix(docs_of, monkeypatch):
    rng = random.Random(3)
    base = [f"w{k}" for k in range(300)]
    rows = [(0, " ".join(base))]
    for i in range(1, 60):
        words = list(base)
        for _ in range(5):
            words[rng.randrange(300)] = f"e{rng.randrange(10**9)}"
        rows.append((i, " ".join(words)))
    made = []
    real = ngram_join._between_groups

    def spied(docs, listed, labelled, words, percent):
        made.append(labelled.select("label").distinct().count())
        return real(docs, listed, labelled, words, percent)

    monkeypatch.setattr(ngram_join, "_between_groups", spied)
    got = ngram_join.similar_documents(docs_of(rows)).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)
    assert made[0] <= 6


def test_components(spark):
    rng = random.Random(4)
    chain = [(i, i + 1) for i in range(40)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    more = [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(250)]
    rng.shuffle(chain)
    pairs = chain + star + more + [(5, 5)]
    got = dict(map(tuple, components(spark.createDataFrame(pairs, "a long, b long")).collect()))
    ids = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == smallest(pairs, ids)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
