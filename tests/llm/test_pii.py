import hashlib
import itertools
import random
import re
import time
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from regflow.llm.pii import find_personal_data
from regflow.llm.queries import personal_columns

PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def luhn(d):
    t = 0
    for k, c in enumerate(reversed(d)):
        x = int(c) * (1 + k % 2)
        t += x - 9 if x > 9 else x
    return t % 10 == 0


def good(kind, m):
    d = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        return 12 <= len(d) <= 19 and luhn(d)
    return kind == "email" or 9 <= len(d) <= 15


def brute(text):
    found = []
    for rank, (kind, pattern) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or "", re.ASCII):
            if good(kind, m[0]):
                found.append((m.start(), rank, m.end(), kind))
    return [f"{k}:{s}:{e}" for s, _, e, k in sorted(found)]


def check(docs_of, rows):
    got = personal_columns(find_personal_data(docs_of(rows))).collect()
    assert len(got) == len(rows)
    want = {}
    for i, t in rows:
        want.setdefault((i, ",".join(brute(t))), 0)
        want[i, ",".join(brute(t))] += 1
    sha = {hashlib.sha256(k[1].encode()).hexdigest(): k[1] for k in want}
    for r in got:
        assert r.base_sha256 in sha, (r.doc_id, r.spans, dict(rows).get(r.doc_id))
        base = sha[r.base_sha256]
        want[r.doc_id, base] -= 1
        kept = [s for s in r.spans.split(",") if s and not s.startswith("context")]
        assert ",".join(kept) == base
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k) for s in kept) for k, _ in PATTERNS]
    assert not any(want.values())
    return got


TEXTS = [
    None, "", "a@b.c", "a@b.c_x@d.e", "é a@b.co.uk. (x+y%z@q-r.s)", "@b.c a@b a@.c", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255", "1..2.3.4", "4111 1111 1111 1111 x", "4111-1111-1111-1112",
    "call +1 (314) 555-4198 now +44 20 7946 0958. +12", "+1+22 333 444 555", "\U0001f600 a@b.c  1.1.1.1", "9" * 20_000, "1." * 20_000, "a" * 200_000 + "@b.c", "a@" + "b." * 20_000 + "c",
    "00000000000000000000000000000001.1.1.1", "1 2 3 4 5 6 7 8 9 0 1 2", "+" * 3000, "x.y@z" * 500, "12-" * 5000, "a@b.c@d.e", "+1 23456789", "$1 \\ 4242424242424242 $0",
]


def test_base_spans(docs_of):
    check(docs_of, list(enumerate(TEXTS)) + [(None, "a@b.c"), (2, "a@b.c"), (2, "a@b.c")])


@settings(max_examples=3, deadline=None)
@given(st.lists(st.text(alphabet="a@.+-_% 0123456789()\né", max_size=40), min_size=150, max_size=150))
def test_any_text(spark, texts):
    from pyspark.sql import types as T

    def docs_of(rows):
        return spark.createDataFrame(rows, T.StructType.fromDDL("doc_id long, text string"))

    check(docs_of, list(enumerate(texts)))


def test_contexts_discover_identifiers(docs_of):
    rows = [(i, f"words here mail user{i}@mail.example.com and more") for i in range(30)]
    rows += [(100, "words here mail user77@intranet and more"), (101, "room 1234x other"), (102, "mail nothing")]
    got = {r.doc_id: r.spans for r in check(docs_of, rows)}
    assert got[100] == ""
    rows += [(200 + i, f"badge of staff ID-{i:05d}x") for i in range(4)]
    rows += [(300 + i, f"reach me at +1 (555) 010-{1000 + i} or phone 555010{i:04d}") for i in range(9)]
    rows += [(400 + i, f"server host 10.0.0.{i} up") for i in range(20)] + [(500, "server host 10.0.0.999 up")]
    got = {r.doc_id: r.spans for r in check(docs_of, rows)}
    assert got[500] == "context:12:22"
    assert got[200] == got[101] == ""


def test_empty_table(docs_of):
    assert find_personal_data(docs_of([])).count() == 0


@pytest.mark.parametrize("name", ["Python", "Arrow", "Pandas"])
def test_plan_is_native(docs_of, name):
    frame = personal_columns(find_personal_data(docs_of([(1, "a@b.c")])))
    assert name not in frame._jdf.queryExecution().executedPlan().toString()


def brute_contexts(rows, rounds=3, confident=0.8):
    """Context spans by the definition: tokens, their patterns, and the scores of the graph."""

    def letter(c):
        return unicodedata.category(c)[0] == "L"

    def number(c):
        return unicodedata.category(c)[0] == "N"

    tokens = []
    for doc, text in rows:
        text = text or ""
        base = [tuple(map(int, s.split(":")[1:])) for s in brute(text)]
        for m in re.finditer(r"(?<!\S)[^\s0-9@]*[0-9@]\S*", text, re.ASCII):
            before = re.split(r"\s+", text[: m.start()].strip(" \t\n\r\x0b\x0c"), flags=re.ASCII)[-1].lower()
            start, end = m.start(), m.end()
            while start < end and not (letter(text[start]) or number(text[start]) or text[start] in "+@"):
                start += 1
            while end > start and not (letter(text[end - 1]) or number(text[end - 1])):
                end -= 1
            body = text[start:end]
            if end - start < 4 or not ("@" in body or len(re.findall("[0-9]", body)) > 1):
                continue
            shape = re.sub("9(?:a?9)+", "9", _folded(re.sub("[0-9]+", "9", body.lower()), letter))
            seed = any(s < end and e > start for s, e in base)
            tokens.append((doc, start, end, body.lower(), (before, shape), seed))
    edges, given = {}, {}
    for *_, instance, pattern, seed in tokens:
        edges[pattern, instance] = max(seed, edges.get((pattern, instance), False))
        given[instance] = max(seed, given.get(instance, False))
    score = {i: float(g) for i, g in given.items()}
    for _ in range(rounds):
        total, count, seeds = {}, {}, {}
        for (pattern, instance), seed in edges.items():
            total[pattern] = total.get(pattern, 0.0) + score[instance]
            count[pattern] = count.get(pattern, 0) + 1
            seeds[pattern] = seeds.get(pattern, 0) + seed
        confidence = {p: total[p] / (count[p] + 1) for p in total}
        score = {i: max(float(given[i]), max(confidence[p] for p, j in edges if j == i)) for i in given}
    chosen = {p for p in confidence if confidence[p] >= confident and seeds[p]}
    found = {}
    for doc, start, end, _, pattern, seed in tokens:
        if pattern in chosen and not seed:
            found.setdefault(doc, set()).add(f"context:{start}:{end}")
    return found


def _folded(shape, letter):
    """Runs of letters as one `a`."""
    return "".join("a" if is_letter else "".join(run) for is_letter, run in itertools.groupby(shape, letter))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_contexts_match_brute_force(docs_of, seed):
    rng = random.Random(seed)
    cues = ["mail", "call", "host", "Card:", "é", "(id)", "see"]

    def token():
        n = rng.randrange
        return rng.choice([
            f"user{n(40)}@mail.example.com", f"user{n(40)}@intranet", f"10.0.{n(9)}.{n(400)}", f"+1-555-010-{n(10)}{n(10)}{n(10)}{n(10)}",
            f"ID-{n(100):05d}x", "4111 1111 1111 1111", f"{n(10**9)}", f"«{n(900)}-ab{n(9)}»,", f"({n(50)}.{n(50)})", "@", "x" * 70 + f"{n(99)}", "9a9a9",
        ])

    rows = []
    for i in range(150):
        words = []
        for _ in range(rng.randrange(0, 9)):
            words += [rng.choice(cues), token()] if rng.random() < 0.8 else [token()] * rng.randrange(1, 3)
            words.append(rng.choice(["", "\n\t", "plain words"]))
        rows.append((i, rng.choice([" ", "  ", "\n"]).join(words)))
    # Hundreds of pieces in one text, in several chunks, and the words of a chunk's first match before it.
    rows.append((900, " ".join(f"host 10.0.{k % 9}.{k % 400} mail user{k}@mail.example.com" for k in range(700))))
    rows += [(901, None), (902, rows[0][1]), (902, rows[0][1]), (None, rows[1][1])]
    wanted = brute_contexts(rows)
    got = check(docs_of, rows)
    assert any(wanted.values())
    for r in got:
        found = {s for s in r.spans.split(",") if s.startswith("context")}
        assert found == wanted.get(r.doc_id, set()), r.doc_id


def test_time_is_linear_in_a_text(docs_of):
    def seconds(n):
        text = " ".join(f"host 10.0.{k % 256}.{k % 250} and {k}" for k in range(n))
        began = time.perf_counter()
        [row] = personal_columns(find_personal_data(docs_of([(1, text)]))).collect()
        assert row.n_ip == n
        return time.perf_counter() - began

    seconds(200)
    small, large = seconds(8_000), seconds(32_000)
    # Four times the text; the square would be sixteen times.
    assert large < 6 * small
