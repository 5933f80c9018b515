from __future__ import annotations

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import words as w


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("aAbBéÉ \n\t\r\x0b\x0c\x1c .1Z"), max_size=50))
def test_hashes_are_equal_where_words_are(text):
    raw = text.encode()
    for lower in (True, False):
        words = (raw.lower() if lower else raw).split()
        hashes = w.word_hashes(raw, lower)
        assert len(hashes) == len(words)
        alone = [w.word_hashes(x, lower)[0] for x in words]
        assert hashes.tolist() == [int(h) for h in alone]
        assert len(set(hashes.tolist())) == len(set(words))


def test_long_texts_are_hashed_in_blocks(monkeypatch):
    draw = random.Random(1)
    words = ["".join(draw.choice("abc") for _ in range(draw.randint(1, 9))) for _ in range(5000)]
    words[100] = "x" * 3000
    text = b"  ".join(x.encode() for x in words)
    whole = w.word_hashes(text)
    monkeypatch.setattr(w, "_BLOCK", 64)
    monkeypatch.setattr(w, "_POWERS", {})
    assert np.array_equal(w.word_hashes(text), whole)
    assert len(set(whole.tolist())) == len(set(words))


def test_no_words():
    for text in (None, b"", b" \n"):
        assert len(w.word_hashes(text)) == 0 and len(w.windows(w.word_hashes(text), 5)) == 0


def test_windows_of_few_words():
    hashes = w.word_hashes(b"a b c")
    assert len(w.windows(hashes, 5)) == 1 and len(w.windows(hashes, 3)) == 1
    assert w.windows(hashes, 5)[0] == w.windows(hashes, 3)[0]
    assert len(w.windows(hashes, 2)) == 2
