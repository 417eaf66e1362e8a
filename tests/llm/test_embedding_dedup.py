import numpy as np
import pytest

from regflow.llm import embedding_dedup
from regflow.llm.embedding_dedup import cover_tree, near_duplicates, top_level, traverse

from .test_ngram_join import smallest


def brute(rows, cosine):
    good = []
    for k, (i, v) in enumerate(rows):
        if i is not None and v and None not in v:
            x = np.array(v, np.float64)
            if np.isfinite(x).all() and np.abs(x).max() > 0:
                x = x / np.abs(x).max()
                good.append((k, i, x / np.linalg.norm(x)))
    links, pairs = [0] * len(rows), []
    for n, (k, i, x) in enumerate(good):
        for m, j, y in good[:n]:
            if len(x) == len(y) and x @ y >= cosine:
                links[k] += 1
                links[m] += 1
                pairs.append((i, j))
    comp = smallest(pairs, {i for i, _ in rows if i is not None})
    return sorted(((i, links[k], comp.get(i), i is not None and comp[i] == i) for k, (i, _) in enumerate(rows)), key=str)


def cloud(seed, n=220, dims=16):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(12, dims))
    out = []
    for k in range(n):
        x = base[k % 12] + rng.normal(size=dims) * rng.choice([0.02, 0.12, 0.3]) if k % 3 else rng.normal(size=dims)
        out.append(x * rng.choice([1, 7.5]))
    return np.array(out)


@pytest.mark.parametrize(("seed", "block"), [(0, 40), (1, 4096), (2, 7)])
def test_matches_brute_force(spark, seed, block):
    vectors = cloud(seed).tolist()
    rows = [(3 * i, v) for i, v in enumerate(vectors)]
    rows += [(1, vectors[4]), (7, vectors[4]), (7, vectors[4]), (3, vectors[9]), (None, vectors[4]), (10, None), (13, []), (16, [0.0] * 16), (19, [1.0, None] * 8), (22, [float("nan")] * 16), (25, [float("inf")] + [1.0] * 15), (28, [1.0, 2.0]), (31, [1.0, 2.01]), (34, [1e-300] * 16), (37, [1e300] * 16)]
    frame = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<double>, label int, id string")
    got = near_duplicates(frame, cosine=0.95, block=block).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 0.95)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert near_duplicates(frame).count() == 0


@pytest.mark.parametrize("cosine", [0.5, 0.9, 0.99])
def test_traversal_finds_each_pair_once(cosine):
    x = np.concatenate([cloud(3, 900, 8), np.repeat(cloud(5, 3, 8), 90, axis=0) + 1e-5 * np.random.default_rng(0).normal(size=(270, 8))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    tree, other = cover_tree(x), cover_tree(x[::3])
    for a, b in ((tree, tree), (tree, other)):
        seen = np.zeros((len(a[0]), len(b[0])), int)
        for rows, columns in traverse(a, b, cosine):
            np.add.at(seen, (rows, columns), 1)
        want = a[0] @ b[0].T >= cosine
        if a is b:
            np.fill_diagonal(want, False)
            seen = seen + seen.T
        assert (seen == want).all()


def test_radii_cover():
    x = cloud(8, 600, 6)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    vectors, nodes, root = cover_tree(x)

    def below(node):
        centres, radii, kids = nodes[node]
        out = []
        for c, r, k in zip(centres, radii, kids, strict=True):
            own = [int(c)] if k < 0 else below(k)
            assert (np.linalg.norm(vectors[own] - vectors[c], axis=1) <= r + 1e-6).all()
            out += own
        return out

    assert sorted(below(root)) == list(range(600))


def test_cells_that_are_far_apart_never_meet(spark, monkeypatch):
    rng = np.random.default_rng(3)
    centres = np.eye(12)[:6]
    x = np.concatenate([c + 0.05 * rng.normal(size=(50, 12)) for c in centres])
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    seen = []
    plain = embedding_dedup._reaching
    monkeypatch.setattr(embedding_dedup, "_reaching", lambda *a: seen.append(plain(*a)) or seen[-1])
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = near_duplicates(frame, block=100).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 0.95)
    [pairs] = seen
    assert len(pairs) < 12 * 13 / 2 and (pairs["a"] <= pairs["b"]).all()


def test_top_level_is_a_net_of_bounded_size():
    x = cloud(4, 500, 8)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for wanted in (1, 7, 60, 1000):
        centres = top_level(x, wanted)
        assert 1 <= len(centres) <= wanted
    flat = np.repeat(x[:1], 40, axis=0)
    assert len(top_level(flat, 5)) == 1
