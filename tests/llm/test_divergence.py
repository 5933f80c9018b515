"""Source divergence against exact sums over all terms and pairs."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from strata.llm import divergence as dv
from strata.llm.divergence import CountTrees, Divergence, divergence, pair_prices, shares, term_pieces
from tests.llm.data import DOCS, words

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
ORDER = ["lang", "source", "part", "item", "value", "rank"]


def terms_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lowered)


def model(rows, rules):
    """Every row of the result, with Python's integers."""
    docs = [(r[2] or "", r[3] or "", Counter(terms_of(r[1]))) for r in rows]
    held = defaultdict(Counter)
    for lang, _, counts in docs:
        held[lang].update(counts.keys())
    out = []
    for lang in {lang for lang, _, _ in docs}:
        kept = sorted((t for t, n in held[lang].items() if n >= rules.min_docs), key=str.encode)
        groups, whole = defaultdict(Counter), Counter()
        for own, source, counts in docs:
            if own == lang:
                mine = Counter({t: n for t, n in counts.items() if held[lang][t] >= rules.min_docs})
                groups[source].update(mine)
                whole.update(mine)

        def share(counts, term):
            of = sum(counts.values()) + rules.smoothing * len(kept)
            return 1 + 10**9 * (counts[term] + rules.smoothing) // of

        for source, own in groups.items():
            pairs = [(-sum(abs(share(own, t) - share(other, t)) for t in kept), name) for name, other in groups.items() if name != source]
            terms = [(share(whole, t) - share(own, t), t) for t in kept if own[t] and share(own, t) > share(whole, t)]
            ordered = sorted(pairs, key=lambda p: (p[0], p[1].encode()))
            out += [(lang, source, "pair", n, -v, k + 1) for k, (v, n) in enumerate(ordered)]
            best = sorted(terms, key=lambda p: (p[0], p[1].encode()))[: rules.top]
            out += [(lang, source, "term", t, -v, k + 1) for k, (v, t) in enumerate(best)]
    return sorted(out)


def documents(seed, n=160, langs=("en", "de", None, "rare"), sources=7):
    draw = random.Random(seed)
    vocabulary = words(seed, 60) + ["Élan", "straße", "漢字", "A-b", "x1y"]
    rows = []
    for i in range(n):
        lang = draw.choices(langs, weights=(9, 5, 3, 1))[0]
        text = " ".join(draw.choices(vocabulary, weights=range(1, len(vocabulary) + 1), k=draw.randint(0, 60)))
        source = draw.choice([None, "", *(f"s{k}" for k in range(sources))])
        rows.append((i, draw.choice([text, text.upper(), None]), lang, source, 1))
    return rows + rows[:20]


SMALL = [
    Divergence(min_docs=5, block_terms=4, block_groups=2, top=3),
    Divergence(min_docs=2, block_terms=1, block_groups=1),
    Divergence(min_docs=30),
]


@pytest.mark.parametrize("rules", SMALL)
def test_equals_exact_sums(spark, rules):
    rows = documents(1)
    got = divergence(spark.createDataFrame(rows, DOCS).repartition(4), rules)
    assert got.columns == ORDER
    assert sorted(map(tuple, got.collect())) == model(rows, rules)


def test_messy_documents_and_clashing_columns(spark, messy_rows, clashing):
    rules = Divergence(min_docs=3, block_terms=50, block_groups=2)
    assert sorted(map(tuple, divergence(clashing, rules).collect())) == model(messy_rows, rules)


def test_without_kept_terms_all_distances_are_zero(spark):
    rows = [(1, "one two", "en", "b", 1), (2, None, "en", "a", 1), (3, "", "en", "é", 1)]
    got = divergence(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(map(tuple, got)) == model(rows, Divergence())
    assert {r.value for r in got} == {0} and len(got) == 6


def test_empty_table_and_lone_group(spark, no_docs):
    assert divergence(no_docs).collect() == []
    one = spark.createDataFrame([(1, "a", None, None, 1)], DOCS)
    assert divergence(one, Divergence(min_docs=1)).collect() == []


def test_tasks_hand_on_what_they_hold(spark, monkeypatch):
    monkeypatch.setattr(dv, "HELD", 10)
    rows = documents(3)
    got = divergence(spark.createDataFrame(rows, DOCS).coalesce(1), SMALL[0])
    assert sorted(map(tuple, got.collect())) == model(rows, SMALL[0])


def test_long_texts_are_split_between_terms(monkeypatch):
    monkeypatch.setattr(dv, "PIECE", 7)
    texts = ["", "é" * 40, "ab cd " * 9, "x" * 30 + " y", "12345678901234567890", "a1é2漢字 " * 5]
    for text in texts:
        got = [t.decode() for piece in term_pieces(text.encode()) for t in piece]
        assert got == terms_of(text)


def test_shares_are_exact_for_counts_of_a_whole_corpus():
    draw = random.Random(5)
    whole = [draw.randint(1, 9 * 10**15) for _ in range(500)] + [10, 9 * 10**15]
    counts = [draw.randint(0, n) for n in whole]
    counts = [max(c - 5, 0) for c in counts]
    got = shares(np.array(counts), np.array(whole), 5)
    assert got.tolist() == [1 + 10**9 * (c + 5) // n for c, n in zip(counts, whole)]


def test_equal_stretches_are_one_node():
    counts = np.zeros((3, 64), dtype=np.int64)
    counts[0, :8] = counts[1, 8:16] = range(8)
    trees = CountTrees(counts)
    assert len(trees.leaves) == 8  # 0 .. 7
    assert [len(level) for level in trees.levels] == [5, 3, 2, 3, 3, 3]
    assert len(set(trees.roots)) == 3


@pytest.mark.parametrize("size", [1, 2, 3, 17, 64])
def test_walks_price_all_places(size):
    draw = np.random.default_rng(size)
    counts = draw.integers(0, 3, (6, size))
    whole = counts.sum(axis=1) + 5 * size
    left, right = np.triu_indices(6, 1)
    got = pair_prices(CountTrees(counts), left, right, whole, 5)
    each = shares(counts, np.repeat(whole[:, None], size, axis=1), 5)
    assert got.tolist() == np.abs(each[left] - each[right]).sum(axis=1).tolist()
