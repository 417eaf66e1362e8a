import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from regflow.llm import fuzzy_hash
from regflow.llm.fuzzy_hash import LEVELS, LOWEST, PIECES, WINDOW


def brute_print(text):
    """A fingerprint chunk by chunk, from the definition."""
    mask = (1 << 32) - 1

    def window(data, at):
        total = 0
        for k in range(at - WINDOW + 1, at + 1):
            total = (total * 0x01000193 + (data[k] if k >= 0 else 0) + 1) & mask
        for shift, factor in ((16, 0x7FEB352D), (15, 0x846CA68B)):
            total = ((total ^ total >> shift) * factor) & mask
        return total ^ total >> 16

    data = text.encode("utf-8", "surrogatepass")
    hashes = [window(data, k) for k in range(len(data))]
    levels = [32 if h == 0 else (h & -h).bit_length() - 1 for h in hashes[:-1]]
    first = LOWEST
    while first <= 32 and sum(x >= first for x in levels) > PIECES:
        first += 1
    parts = [str(first)]
    for level in range(first, first + LEVELS):
        cuts = [0, *(k + 1 for k, x in enumerate(levels) if x >= level), len(data)]
        signs = ""
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            chunk = sum(hashes[a:b]) ^ (b - a) << 40
            chunk = (chunk ^ chunk >> 29) * 0xBF58476D1CE4E5B9 & (1 << 64) - 1
            chars = fuzzy_hash._CHARS
            signs += chars[chunk >> 58] + chars[chunk >> 52 & 63]
        parts.append(signs)
    return ":".join(parts)


def brute_likeness(one, two):
    if one == two:
        return 1.0
    (a, *left), (b, *right) = one.split(":"), two.split(":")
    level = max(int(a), int(b))
    if level - min(int(a), int(b)) >= LEVELS:
        return 0.0
    x, y = left[level - int(a)], right[level - int(b)]
    x, y = [x[k : k + 2] for k in range(0, len(x), 2)], [y[k : k + 2] for k in range(0, len(y), 2)]
    if not x or not y:
        return 0.0
    # Edit distance with insertions and deletions, cell by cell.
    row = list(range(len(y) + 1))
    for i, p in enumerate(x, 1):
        new = [i]
        for j, q in enumerate(y, 1):
            new.append(row[j - 1] if p == q else 1 + min(row[j], new[-1]))
        row = new
    return 1 - row[-1] / (len(x) + len(y))


def brute(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for k, (i, text) in enumerate(ordered):
        text, following = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        own, other, nxt = map(brute_print, (text, changed, following))
        digest = hashlib.sha256(changed.encode()).hexdigest()
        out.append((i, len(text), digest, own, other, brute_likeness(own, other), brute_likeness(own, nxt)))
    return sorted(out, key=str)


def same(found, wanted):
    found = sorted(map(tuple, found.collect()), key=str)
    assert [r[:5] for r in found] == [r[:5] for r in wanted]
    np.testing.assert_allclose([r[5:] for r in found], [r[5:] for r in wanted], atol=1e-12)


def prose(rng, n):
    return " ".join(rng.choice(["river", "stone", "lantern", "ébène", "東京", "of", "walks", "quietly", "seven"], n))


def test_matches_brute_force(docs_of):
    rng = np.random.default_rng(2)
    rows = [(int(i), prose(rng, rng.integers(0, 200))) for i in rng.permutation(120)]
    rows += [(500 + i, "the same text for all of these rows") for i in range(60)]
    rows += [(900, None), (901, ""), (902, "ab" * 20_000), (903, "a"), (904, "x" * 9000), (None, "last of all"), (-3, "less")]
    same(fuzzy_hash.compare_with_edits(docs_of(rows).repartition(5)), brute(rows))


def test_few_and_no_rows(docs_of):
    assert fuzzy_hash.compare_with_edits(docs_of([])).collect() == []
    for rows in ([(1, "only one row, of its own")], [(1, "")], [(1, None), (2, "two of them")]):
        same(fuzzy_hash.compare_with_edits(docs_of(rows)), brute(rows))


def test_repeated_ids_follow_each_other(docs_of):
    rows = [(5, f"text number {i} of the same id") for i in range(40)] + [(4, "after them")]
    found = fuzzy_hash.compare_with_edits(docs_of(rows).repartition(4)).collect()
    assert len(found) == 41 and {r.doc_id for r in found} == {4, 5}
    twice = fuzzy_hash.compare_with_edits(docs_of(rows).repartition(4)).collect()
    assert sorted(map(str, found)) == sorted(map(str, twice))


def test_edits_are_nearer_than_other_texts(docs_of):
    rng = np.random.default_rng(9)
    letters = list("abcdefghijklmnopqrstuvwxyz      ")
    rows = [(i, "".join(rng.choice(letters, rng.integers(60, 6000)))) for i in range(200)]
    found = fuzzy_hash.compare_with_edits(docs_of(rows)).collect()
    assert min(r.near_edited for r in found) > max(r.near_next for r in found)
    assert np.mean([r.near_edited for r in found]) > 0.45 and np.mean([r.near_next for r in found]) < 0.05
    # A changed word in the middle of a long text costs a chunk or two.
    long = "".join(rng.choice(letters, 50_000))
    one, two = fuzzy_hash.fingerprints([long, long[:25_000] + " changed " + long[25_010:]])
    assert fuzzy_hash.likeness(one, two) > 0.9


def test_fingerprints_alone(docs_of):
    found = fuzzy_hash.fingerprint_texts(docs_of([(1, "abc"), (2, None), (3, "abc")])).collect()
    assert found[0].fingerprint == found[2].fingerprint == brute_print("abc")
    assert found[1].fingerprint == f"{LOWEST}:::"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab \x00é", max_size=400), min_size=1, max_size=6))
def test_texts_hashed_together_or_alone(texts):
    assert fuzzy_hash.fingerprints(texts) == [brute_print(t) for t in texts]
