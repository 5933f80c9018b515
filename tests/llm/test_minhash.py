from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest

from strata.llm import minhash
from strata.llm.components import connected_components
from strata.llm.minhash import NearDuplicates, near_duplicates, pack_lanes, unequal_lanes
from strata.llm.words import shingle_set, word_hashes
from strata.sources import scratch_dir
from tests.llm.data import components, edited, shingles, words


def expected(rows, numerator):
    """(doc_id, text) -> (n_shingles, component_id), with counts."""
    labels = components([r[1] for r in rows], numerator)
    smallest = defaultdict(list)
    for row, label in zip(rows, labels):
        if label >= 0 and row[0] is not None:
            smallest[label].append(row[0])
    out = Counter()
    for row, label in zip(rows, labels):
        first = min(smallest[label], default=None) if label >= 0 else row[0]
        out[(row[0], len(shingles(row[1])), first, first == row[0])] += 1
    return out


def found(frame):
    return Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in frame.collect())


@pytest.mark.parametrize("numerator", [80, 85])
def test_components_equal_comparing_all_pairs(messy, messy_rows, numerator):
    assert found(near_duplicates(messy, NearDuplicates(numerator=numerator))) == expected(
        messy_rows, numerator
    )


def test_small_blocks_lose_no_link(spark, monkeypatch):
    """A large group in which the pivot reaches few members, over several blocks."""
    monkeypatch.setattr(minhash, "BLOCK", 7)
    base = words(9, 200)
    rows = [(i, " ".join(edited(base, i, 1 + i % 7))) for i in range(120)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(near_duplicates(frame, NearDuplicates(numerator=85))) == expected(rows, 85)


def test_extra_columns_do_not_matter(messy, clashing):
    assert found(near_duplicates(clashing)) == found(near_duplicates(messy))


def test_empty_table(no_docs):
    assert near_duplicates(no_docs).count() == 0


def test_one_document_of_each_group_stays(clashing, messy_rows):
    left = minhash.without_near_duplicates(clashing).collect()
    labels = components([r[1] for r in messy_rows], 80)
    assert set(clashing.columns) == set(left[0].__fields__)
    empty = sum(label < 0 for label in labels)
    assert len(left) == empty + len({label for label in labels if label >= 0})
    by_text = {row[1]: label for row, label in zip(messy_rows, labels)}
    kept = Counter(by_text[r.text] for r in left if by_text[r.text] >= 0)
    assert set(kept.values()) == {1}


def test_lanes_pack_and_compare():
    rng = np.random.default_rng(1)
    for bits in (1, 2, 4, 8):
        a, b = (rng.integers(0, 2**bits, 160) for _ in range(2))
        packed = pack_lanes(a, bits) ^ pack_lanes(b, bits)
        assert unequal_lanes(packed, bits).sum() == (a != b).sum()


def test_estimate_is_near_the_similarity():
    rule = NearDuplicates()
    signer = minhash.Signer(rule)
    base = words(10, 600)
    errors = []
    for seed in range(60):
        first = shingle_set(word_hashes(" ".join(base).encode()), 5)
        second = shingle_set(word_hashes(" ".join(edited(base, seed, 5 + seed)).encode()), 5)
        true = len(np.intersect1d(first, second)) / len(np.union1d(first, second))
        unequal = unequal_lanes(signer(first)[1].view(np.uint64) ^ signer(second)[1].view(np.uint64), 4).sum()
        errors.append(minhash.estimated_similarity(float(rule.hashes - unequal), rule) - true)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_components_of_odd_graphs(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (8, 7)]
    frame = spark.createDataFrame(pairs, "a long, b long")
    got = {r.node: r.component for r in connected_components(frame, scratch_dir(spark)).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)}
    none = spark.createDataFrame([], "a long, b long")
    assert connected_components(none, scratch_dir(spark)).count() == 0
