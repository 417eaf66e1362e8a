import random
import re
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from regflow.llm.mixing import fit, mix, subset_sum

SPACE = "[^\x20\x09-\x0d]+"


def goals_of(sizes, weights=(5, 2, 1), share=1.5, limit=2):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, fixed, free = share * sum(sizes.values()), {}, set(order)
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total >= limit * sizes[s]}
        if not over:
            break
        for s in over:
            fixed[s] = limit * sizes[s]
        left -= sum(fixed[s] for s in over)
        free -= over
    return fixed | {s: left * weight[s] / sum(weight[x] for x in free) for s in free}


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 12), st.integers(1, 5), max_size=5), st.integers(0, 60))
def test_subset_sum_is_best(counts, gap):
    taken = subset_sum(counts, gap)
    assert all(n <= counts[x] for x, n in taken.items())
    sums = {0}
    for x, n in counts.items():
        sums = {s + x * k for s in sums for k in range(n + 1)}
    assert sum(x * n for x, n in taken.items()) == max(s for s in sums if s <= gap)


def test_fit_meets_budgets():
    rng = random.Random(3)
    for _ in range(50):
        counts = Counter(int(rng.lognormvariate(5, 1)) + 1 for _ in range(rng.randrange(1, 3000)))
        total = sum(x * n for x, n in counts.items())
        budget = rng.random() * total
        taken = fit(counts, budget)
        assert all(0 < n <= counts[x] for x, n in taken.items())
        got = sum(x * n for x, n in taken.items())
        assert abs(got - budget) <= (1 if sum(counts.values()) > 50 else max(counts) + 1)
    assert fit({}, 5) == fit({0: 9}, 5) == fit({3: 2}, 0) == {}


def brute_check(rows, got):
    size = lambda t: len(re.findall(SPACE, t or ""))
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += size(t)
    goals = goals_of(sizes)
    assert Counter(r.doc_id for r in got) == Counter(i for i, _, _ in rows)
    source = {i: s for i, _, s in rows}
    text = {i: t for i, t, _ in rows}
    taken = defaultdict(int)
    for r in got:
        assert r.size == size(text[r.doc_id]) and 0 <= r.taken <= 2 * r.size
        assert r.source_size == sizes[source[r.doc_id]]
        assert abs(r.target - goals[source[r.doc_id]]) <= 1e-9 * max(1, r.target)
        taken[source[r.doc_id]] += r.taken
    return goals, taken


def test_mix(spark, docs_of):
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        s = rng.choice(["hot", "hot", "b", "c", "é", None, "Z"])
        n = 40 if s == "hot" and rng.random() < 0.5 else int(rng.lognormvariate(4, 0.8))
        rows.append((i, " \t".join(["w"] * n), s))
    rows += [(9000, None, "b"), (9001, "", "empty"), (9002, " \n\x0b ", "empty"), (9003, "a\xa0b\x1cc", "b"), (9004, "x " * 60_000, "c")]
    frame = docs_of(rows)
    got = mix(frame).collect()
    goals, taken = brute_check(rows, got)
    for s, goal in goals.items():
        assert abs(taken[s] - goal) <= 2
    again = mix(frame.repartition(5)).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in got)


def test_small_tables(docs_of):
    assert mix(docs_of([])).collect() == []
    got = mix(docs_of([(1, None, None), (2, None, "a")])).collect()
    assert sorted((r.doc_id, r.size, r.target, r.taken) for r in got) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]
    rows = [(1, "a b c", "x"), (1, "a b c", "x"), (None, "a b c", "x")]
    assert sum(r.taken for r in mix(docs_of(rows)).collect()) in (12, 15)
