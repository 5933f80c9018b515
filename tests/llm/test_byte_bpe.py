"""Byte-pair ids against tiktoken, and exact round trips."""

from __future__ import annotations

import random

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import byte_bpe
from strata.llm.byte_bpe import (
    ByteBpe,
    decode_ids,
    decode_tokens,
    encode_documents,
    encode_text,
    encode_with_offsets,
    read_ranks,
    text_parts,
)

FILES = ("byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken")


def both(name):
    ranks = read_ranks(public_tokenizers.path(name))
    plain = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return ByteBpe(ranks, public_tokenizers.PATTERN), plain


CODERS = {name: both(name) for name in FILES}
OWN, PLAIN = CODERS[FILES[0]]
SOURCE = (public_tokenizers.path(FILES[0]), public_tokenizers.PATTERN)


def ids_of(bpe, texts):
    return [ids.tolist() for ids in bpe.encode(pa.array(texts, pa.string()))]


@pytest.mark.parametrize("name", FILES)
def test_odd_texts_as_tiktoken(name):
    own, plain = CODERS[name]
    draw = random.Random(4)
    parts = "a aa b 's 'T the ing é 漢 😀 ǅ ٣ ² ! ... <|endoftext|> ſ ﻿ ́".split(" ") + [" ", "  ", "\n", "\t", " ", "\x85", "\x1c", "᠎", "​", "\x00", " "]
    texts = ["".join(draw.choices(parts, k=draw.randint(0, 30))) for _ in range(3000)]
    texts += [s * k for s in ("a", "ab", "=", "!?", " ", "\n ", "0", "aA", "é") for k in (2, 3, 5, 64, 333)]
    assert ids_of(own, texts) == plain.encode_ordinary_batch(texts, num_threads=1)


def test_every_character_as_tiktoken():
    texts = [f"a{chr(c)} {chr(c)}b" for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    assert ids_of(OWN, texts) == PLAIN.encode_ordinary_batch(texts, num_threads=1)


@settings(max_examples=200, deadline=None)
@given(st.text())
def test_round_trip(text):
    ((ids, starts, ends),) = OWN.encode_with_offsets([text])
    assert ids_of(OWN, [text]) == [ids.tolist()]
    assert OWN.decode(ids.tolist()) == text.encode()
    assert ids.tolist() == PLAIN.encode_ordinary(text)
    assert "".join(OWN.token_texts(ids.tolist())) == text
    raw = [OWN.decode([i]) for i in ids.tolist()]
    for own, start, end in zip(raw, starts.tolist(), ends.tolist()):
        assert own in text[start:end].encode()
    assert not text or (starts[0] == 0 and ends[-1] == len(text))


def test_split_characters():
    ((ids, starts, ends),) = OWN.encode_with_offsets(["x🜁y"])
    texts = OWN.token_texts(ids.tolist())
    assert "".join(texts) == "x🜁y" and "" in texts  # several tokens, one character
    shared = [(s, e) for s, e, t in zip(starts.tolist(), ends.tolist(), texts) if t in ("", "🜁")]
    assert set(shared) == {(1, 2)}
    half = ids.tolist()[:2]
    assert OWN.token_texts(half)[-1].endswith("�")
    assert OWN.decode(half).decode(errors="ignore") == "x"


def test_unknown_ids_raise():
    for ids in ([50256], [-60000], [10**6]):
        with pytest.raises(ValueError, match="ranks do not have"):
            OWN.decode(ids)


def test_long_texts_in_parts(monkeypatch):
    monkeypatch.setattr(byte_bpe, "LONG", 20)
    monkeypatch.setattr(byte_bpe, "GROUP", 30)
    draw = random.Random(9)
    for _ in range(300):
        text = "".join(draw.choices(["word", "é", " ", "  ", "\n", " ", "1", "!", "'s"], k=60))
        assert "".join(part for _, part in text_parts(text)) == text
        ((ids, starts, ends),) = OWN.encode_with_offsets([text])
        assert ids.tolist() == PLAIN.encode_ordinary(text)
        assert ids_of(OWN, [text, text[::-1]]) == PLAIN.encode_ordinary_batch([text, text[::-1]], num_threads=1)
        assert ends[-1] == len(text)
    mixed = ["a b " * 30, "", None, "c " * 50]
    assert ids_of(OWN, mixed) == [PLAIN.encode_ordinary(t or "") for t in mixed]


def test_columns(spark, messy_rows, clashing, no_docs):
    encoded = clashing.select("text", encode_text(F.col("text"), *SOURCE).alias("ids"), encode_with_offsets(F.col("text"), *SOURCE).alias("o"))
    found = encoded.select("*", decode_ids(F.col("ids"), *SOURCE).alias("raw")).collect()
    assert len(found) == len(messy_rows)
    for r in found:
        assert r.ids == r.o.ids == PLAIN.encode_ordinary(r.text or "")
        assert bytes(r.raw) == (r.text or "").encode()
        assert len(r.o.starts) == len(r.o.ends) == len(r.ids)
    assert no_docs.select(encode_text(F.col("text"), *SOURCE)).collect() == []
    lists = spark.createDataFrame([([50000, 13],), (None,), ([],)], "ids array<int>")
    got = lists.select(decode_ids(F.col("ids"), *SOURCE).alias("b"), decode_tokens(F.col("ids"), *SOURCE).alias("t")).collect()
    assert got[1] == (None, None) and bytes(got[2].b) == b"" and got[2].t == []
    assert "".join(got[0].t).encode() == bytes(got[0].b)


def test_documents_with_other_columns(spark, messy_rows, clashing, no_docs, monkeypatch):
    monkeypatch.setattr(byte_bpe, "ROWS", 7)
    other = clashing.withColumnsRenamed({"kept": "ids", "shard": "decoded"})
    done = encode_documents(other, *SOURCE, decoded="decoded")
    assert done.columns == ["doc_id", "lang", "source", "n_chars", "verdict", "sequence_id", "_host", "ids", "decoded"]
    got = sorted((r.doc_id or 0, r["ids"], bytes(r["decoded"])) for r in done.collect())
    assert got == sorted((r[0] or 0, PLAIN.encode_ordinary(r[1] or ""), (r[1] or "").encode()) for r in messy_rows)
    assert encode_documents(no_docs, *SOURCE).collect() == []
