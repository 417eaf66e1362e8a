import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from regflow.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


VOCABULARY = bpe.Vocabulary(bpe.read_vocabulary(PATH))
ENCODE = VOCABULARY.encoder()
TEXTS = [
    None, "", " ", "It's the THE's don't I'LL", "Éçole école ΣΑΣ σας İstanbul ẞ", "a<|endoftext|>b <|startoftext|><|endoftext", "x" * 5000,
    "ab" * 3000 + " 12345 ½ ²", "!!! ... ??? — ’s", "日本語 한국어 \U0001f600\U0001f468‍\U0001f469", "\x1c\x1d a\x85b　c᠎d", "word " * 3000, "'s't", "\x00\x01﻿",
]


@pytest.mark.parametrize("text", TEXTS)
def test_equals_library(library, text):
    assert ENCODE(text or "") == library.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    library = Tokenizer.from_file(PATH)
    assert ENCODE(text) == library.encode(text, add_special_tokens=False).ids


def test_every_character(library):
    """All code points, next to a sign, a letter and a space, as the library splits them."""
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for start in range(0, len(points), 4096):
        text = "".join(f"!{c}a {c}" for c in points[start : start + 4096])
        assert ENCODE(text) == library.encode(text, add_special_tokens=False).ids, hex(ord(points[start]))


@given(st.text(alphabet="theanrdo", min_size=2, max_size=80))
def test_long_words_merge_alike(word):
    parts = [VOCABULARY.inner[b] for b in word.encode()]
    assert VOCABULARY.short_word(list(parts)) == VOCABULARY.long_word(list(parts))


def test_query_columns(docs_of, library):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "abc"), (1, "again"), (1, "again")]
    frame = bpe.digests(bpe.decode(bpe.encode(docs_of(rows), PATH), PATH))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    expected = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected.append((i, len(ids), sha(" ".join(map(str, ids))), sha(decoded)))
    assert sorted(map(tuple, frame.collect()), key=str) == sorted(expected, key=str)
    assert bpe.encode(docs_of([]), PATH).count() == 0
