import re

from hypothesis import given, settings
from hypothesis import strategies as st

from regflow.llm.queries import secret_columns
from regflow.llm.secret_scan import RULES, compile_rules, digest_of, find_secrets, scanner

BASE = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
]


def brute(text):
    text = text or ""
    found = []
    for k, (kind, pattern, good) in enumerate(BASE):
        for m in re.finditer(pattern, text, re.ASCII):
            if good(m):
                found.append((m.start(), k, m.end(), kind))
    return ",".join(f"{kind}:{s}:{e}" for s, _, e, kind in sorted(found))


AUTOMATON = compile_rules(RULES)
SCAN = scanner(AUTOMATON)
TEXTS = [
    None, "", "token=token:abcdefgh", "token==abcdef", "TOKEN = 'abcdefg'", "api_key:\"zzzzzz\" apikey:zzzzz",
    "ſecret=abcdefgh toKen=abcdefg", "secretsecret=abcdefg", "AKIAAKIA" + "B" * 16, "é" * 3 + "a" * 24 + "é" + "0" * 23 + "g",
    "passwd  :  " + "x" * 100_000, "f" * 100_000, "password=password=abcdef token=abc", "AKIA" + "0" * 30, "token='secret=ab'cdefgh",
]


def base_of(text):
    data = (text or "").encode()
    assert len(data) == len(text or "")
    return ",".join(f"{RULES[k].kind}:{s}:{e}" for s, k, e in SCAN(data) if k < 3)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["token", "SECRET", "api_key", "password", "=", ":", " ", "'", '"', "abc", "abcdef", "AKIA", "0123456789", "ABCDEFGHIJKLMNOP", "f" * 20, ".", "-", "\n"]), max_size=14))
def test_one_pass_equals_regexes(parts):
    assert base_of("".join(parts)) == brute("".join(parts))


def test_automaton_is_small():
    assert len(AUTOMATON.starts.step) // 256 < 5000


def test_query_columns(docs_of):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "token=abcdef1"), (0, None)]
    got = secret_columns(find_secrets(docs_of(rows))).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.base_sha256) for r in got) == sorted(
        (i is None, i or 0, digest_of(brute(t))) for i, t in rows
    )
    by_id = {r.doc_id: r for r in got}
    assert by_id[2].n_assign == 0 and by_id[3].n_assign == 1 and by_id[9].n_hex == 1
    assert secret_columns(find_secrets(docs_of([]))).count() == 0


def test_more_rules_add_spans(docs_of):
    text = "x ghp_" + "z1" * 20 + " -----BEGIN RSA PRIVATE KEY----- eyJ" + "a" * 20 + "." + "b" * 20 + ".c"
    spans = secret_columns(find_secrets(docs_of([(1, text)]))).first().spans
    assert [s.split(":")[0] for s in spans.split(",")] == ["github", "pem", "jwt"]
