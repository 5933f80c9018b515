from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from strata.llm import token_files as tf
from strata.llm.elias_fano import EliasFano
from strata.llm.tokens import as_bytes
from strata.sources import scratch_dir

WORD = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize(
    "values",
    [
        [], [0], [5], [0, 0, 0], [1, 1, 7, 7, 2**40], list(range(1000)), [2**63 + 1],
        np.sort(np.random.default_rng(1).integers(0, 10**9, 5000)).tolist(),
        np.repeat(np.arange(10), 700).tolist(),
    ],
)
def test_elias_fano_round_trip_and_select(values):
    coded = EliasFano.from_bytes(EliasFano.encode(np.array(values, dtype=np.uint64)).to_bytes())
    assert coded.decode().tolist() == values
    assert [coded.select(i) for i in range(0, len(values), 7)] == values[::7]
    for start, stop in ((0, 1), (3, 300), (255, 257), (256, 512), (700, 9_000), (5, 5), (-3, 2)):
        assert coded.between(start, stop).tolist() == values[max(start, 0) : stop]
    with pytest.raises(IndexError):
        coded.select(len(values))


def test_elias_fano_is_near_minimal():
    values = np.sort(np.random.default_rng(2).integers(0, 10**9, 100_000))
    size = len(EliasFano.encode(values).to_bytes())
    assert size * 8 < 100_000 * (2 + np.log2(10**9 / 100_000) + 1)


@pytest.mark.parametrize("file_ids", [50, 1 << 26])
def test_messy_documents(clashing, messy_rows, monkeypatch, file_ids):
    monkeypatch.setattr(tf, "FILE_IDS", file_ids)
    rows = tf.token_files(clashing, WORD, 2).collect()
    library = Tokenizer.from_file(WORD)
    want = Counter()
    for doc_id, text, *_ in messy_rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        want[doc_id, len(ids), zlib.crc32(as_bytes(ids))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == want
    end = 0
    order = sorted(rows, key=lambda r: r.start)
    for r in order:
        assert r.start == end
        end += r.n_tokens
    named = [r.doc_id for r in order]
    assert named == sorted(named, key=lambda d: (d is not None, d or 0))


@pytest.mark.parametrize("docs", [1, 3, 1 << 14])
def test_random_access_in_a_file(spark, messy, monkeypatch, docs):
    monkeypatch.setattr(tf, "BLOCK_DOCS", docs)
    folder = scratch_dir(spark)
    manifest = tf.write_token_files(messy.coalesce(1), WORD, 2, folder).collect()
    files, path = tf.open_fs(manifest[0].path)
    with files.open_input_file(path) as source:
        opened = tf.TokenFile(source)
        listed = list(opened.documents(block=100))
        for i in (0, 1, len(listed) // 2, len(listed) - 1):
            assert opened.doc_id(i) == listed[i][0]
            assert opened.ids(i).tolist() == listed[i][2].tolist()


def test_damage_is_noticed(tmp_path):
    bad = tmp_path / "x.tokens"
    bad.write_bytes(b"TOKENS01" + b"\0" * 100)
    files, path = tf.open_fs(str(bad))
    with files.open_input_file(path) as source, pytest.raises(ValueError):
        tf.TokenFile(source)


def test_ids_that_do_not_fit_are_refused(tmp_path):
    with open(tmp_path / "a", "wb") as stream:
        writer = tf.TokenFileWriter(stream, 2)
        writer.add(1, as_bytes([65535]))
        with pytest.raises(ValueError, match="does not fit"):
            writer.add(2, as_bytes([1, 65536]))


def test_empty_table(no_docs):
    assert tf.token_files(no_docs, WORD, 2).count() == 0
