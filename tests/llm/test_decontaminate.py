from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest

from strata.llm import decontaminate as dc
from strata.llm.decontaminate import LeakRule, find_leaks, without_leaks
from tests.llm.data import CLASHING, edited, words

ITEMS = "item_id long, text string, doc_id string"


def split(text):
    return (text or "").encode().lower().split()


def runs(tokens, width=5):
    span = min(width, len(tokens))
    return [tuple(tokens[i : i + span]) for i in range(len(tokens) - span + 1)] if tokens else []


def plain(docs, items):
    """Best similarity over all windows of every document and item."""
    cut = [(i, split(t)) for i, t in items if split(t)]
    held = Counter(s for _, tokens in cut for s in set(runs(tokens)))
    weight = lambda s: math.log2(1 + len(cut) / held[s]) if s in held else math.log2(1 + len(cut))
    found = Counter()
    for doc_id, text in docs:
        tokens = split(text)
        for item_id, item in cut:
            best, own = 0.0, set(runs(item))
            for start in range(max(1, len(tokens) - len(item) + 1)):
                other = set(runs(tokens[start : start + len(item)], len(runs(item)[0])))
                union = sum(map(weight, own | other))
                best = max(best, sum(map(weight, own & other)) / union)
            if best >= 0.8 and tokens:
                found[doc_id, item_id, round(best, 9)] += 1
    return found


def contaminated():
    items = [(1, " ".join(words(1, 40))), (2, " ".join(words(2, 25))), (3, None), (4, ""), (5, "two words")]
    items += [(6, " ".join(words(1, 20) + words(6, 20))), (2, " ".join(words(2, 25))), (None, " ".join(words(8, 30)))]
    docs = [(0, None), (1, ""), (2, "only two words here"), (3, " ".join(words(30, 300)))]
    for k, (seed, n) in enumerate([(1, 40), (2, 25), (6, 20), (8, 30)]):
        for changes in (0, 1, 2, 4):
            body = words(40 + k, 50) + edited(words(seed, n), changes, changes) + words(60 + k, 30)
            docs.append((10 * k + changes + 100, " ".join(body).upper().replace(" ", "\n\t")))
    docs.append((500, " ".join(words(1, 38))))
    docs += [docs[5]] * 3 + [(None, docs[5][1])]
    return docs, items


def test_leaks_equal_trying_all_windows(spark):
    docs, items = contaminated()
    frame = spark.createDataFrame([(*d, "en", "s", 1, "k", 1, "s", "q", "h") for d in docs], CLASHING)
    table = spark.createDataFrame([(*i, "clash") for i in items], ITEMS)
    leaks = find_leaks(frame.repartition(3), table).collect()
    got = Counter((r.doc_id, r.item_id, round(r.similarity, 9)) for r in leaks)
    assert got == plain(docs, items)
    assert all(r.distance <= LeakRule().radius for r in leaks)


def test_several_indexes_find_the_same(spark, monkeypatch):
    docs, items = contaminated()
    monkeypatch.setattr(dc, "BLOCK_SHINGLES", 30)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    table = spark.createDataFrame([(*i, "x") for i in items], ITEMS)
    got = Counter((r.doc_id, r.item_id, round(r.similarity, 9)) for r in find_leaks(frame, table).collect())
    assert got == plain(docs, items)


@pytest.mark.parametrize("most", [1, 7])
def test_runs_of_any_length_find_the_same(spark, monkeypatch, most):
    monkeypatch.setattr(dc, "RUN_WINDOWS", most)
    docs, items = contaminated()
    docs.append((900, " ".join([*words(1, 40)] * 5 + words(2, 25))))  # many windows match
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    table = spark.createDataFrame([(*i, "x") for i in items], ITEMS)
    got = Counter((r.doc_id, r.item_id, round(r.similarity, 9)) for r in find_leaks(frame, table).collect())
    assert got == plain(docs, items)


def test_nothing_of_the_items_is_broadcast_or_collected(spark):
    docs, items = contaminated()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    places = dc.store_indexes(spark.createDataFrame([(*i, "x") for i in items], ITEMS), LeakRule())
    assert len(places) == 1 and set(dc.load_index(*places[0])) == {-1, 2, 25, 30, 40}
    plan = find_leaks(frame, spark.createDataFrame([(*i, "x") for i in items], ITEMS))
    assert "Broadcast" not in plan._jdf.queryExecution().executedPlan().toString()


def test_a_long_text_of_matches_needs_bounded_memory():
    """Votes of 60,000 overlapping windows at once would take 250 MB and more."""
    import tracemalloc

    rule = LeakRule()
    item = np.unique(dc.windows(dc.word_hashes(" ".join(words(1, 40)).encode()), 5))
    sizes = {40: dc.SizeIndex(40, [1], [item], [np.ones(len(item))])}
    finder = dc.LeakFinder(dc._finished(sizes, rule, 1.0), rule)
    finder(b"warm up")
    text = " ".join(words(1, 40) * 1_500).encode()
    tracemalloc.start()
    leaks = finder(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(leak[0], leak[1], leak[3]) for leak in leaks] == [(1, 0, 1.0)]
    assert peak < 120e6


def test_clean_documents_stay_with_their_columns(spark):
    docs, items = contaminated()
    frame = spark.createDataFrame([(*d, "en", "s", 1, "k", 1, "s", "q", "h") for d in docs], CLASHING)
    table = spark.createDataFrame([(*i, "x") for i in items], ITEMS)
    left = without_leaks(frame, table)
    bad = {doc for doc, *_ in plain(docs, items)}
    assert left.columns == frame.columns
    assert Counter(r.doc_id for r in left.collect()) == Counter(d for d, _ in docs if d not in bad)


def test_repetitive_and_templated_items_equal_trying_all_windows(spark):
    items = [(k, " ".join(["0"] * (30 + k) + words(k, 40))) for k in range(3)]
    items += [(50 + k, " ".join(words(90, 6) * (5 + k % 3) + words(50 + k, 30))) for k in range(3)]
    items += [(100 + k, " ".join(words(91, 40) + words(100 + k, 3) + words(92, 20))) for k in range(12)]
    items += [(200 + k, " ".join(words(200 + k, 5 + k))) for k in range(4)]
    docs = [(k, " ".join(words(3000 + k, 40) + t.split() + words(4000 + k, 40))) for k, t in items]
    docs += [(1000 + k, " ".join(words(5000 + k, 30) + edited(t.split(), k, 1) + words(6000 + k, 30))) for k, t in items]
    docs += [(2000, " ".join(words(91, 40) + words(7000, 3) + words(92, 20)))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    table = spark.createDataFrame([(*i, "x") for i in items], ITEMS)
    got = Counter((r.doc_id, r.item_id, round(r.similarity, 9)) for r in find_leaks(frame, table).collect())
    want = plain(docs, items)
    assert set(want) >= {(k, k, 1.0) for k, _ in items}
    assert got == want


def test_window_votes_count_repeated_shingles_once():
    own = np.random.default_rng(1).integers(0, 6, 80).astype(np.uint64)
    signed = dc.signs(own, np.ones(80), LeakRule())
    for span in (1, 2, 9, 80):
        votes = dc.window_votes(own, signed, span)
        assert len(votes) == 80 - span + 1
        for start, row in enumerate(votes):
            _, first = np.unique(own[start : start + span], return_index=True)
            assert np.array_equal(row, signed[start + first].sum(axis=0))


def test_empty_tables(spark, no_docs, messy, messy_rows):
    docs, items = contaminated()
    table = spark.createDataFrame([(*i, "x") for i in items], ITEMS)
    none = spark.createDataFrame([], ITEMS)
    assert find_leaks(no_docs, table).count() == 0
    assert find_leaks(messy, none).count() == 0
    assert without_leaks(messy, none).count() == len(messy_rows)
