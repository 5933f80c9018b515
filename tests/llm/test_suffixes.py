from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import suffixes
from strata.llm.copies import without_copies
from strata.llm.suffixes import RepeatRule, find_repeats, kept_positions
from strata.llm.words import mix
from tests.llm.data import edited, words


def plain(rows, least=50):
    """Words in windows of ``least`` words that another text holds, by row."""
    held, times = defaultdict(set), Counter(t or "" for _, t in rows)
    split = {t: (t or "").encode().lower().split() for _, t in rows}
    for text, tokens in split.items():
        for i in range(len(tokens) - least + 1):
            held[tuple(tokens[i : i + least])].add(text)
    out = Counter()
    for doc_id, text in rows:
        tokens = split[text]
        marked = set()
        for i in range(len(tokens) - least + 1):
            if len(held[tuple(tokens[i : i + least])]) > 1 or times[text or ""] > 1:
                marked |= set(range(i, i + least))
        for word in marked:
            out[doc_id, word] += 1
    return out


def found(frame, rule=RepeatRule()):
    out = Counter()
    for r in find_repeats(frame, rule).collect():
        for word in range(r.start_word, r.start_word + r.n_words):
            out[r.doc_id, word] += 1
    return out


def test_messy_documents_equal_comparing_all_windows(clashing, messy_rows):
    want = plain([(r[0], r[1]) for r in messy_rows])
    got = found(clashing)
    assert got == want


@pytest.mark.parametrize("rule", [RepeatRule(), RepeatRule(least=20, gram=4)])
def test_planted_passages_are_found_whole(spark, rule):
    rows = []
    for k in range(40):
        passage = words(1000 + k % 5, rule.least + 7 * (k % 5))
        rows.append((k, " ".join(words(k, 30 + k) + passage + words(500 + k, 90 - k))))
    rows += [(90, " ".join(words(2000, 400))), (91, " ".join(words(2001, rule.least - 1))), (92, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = plain(rows, rule.least)
    assert found(frame, rule) == want and {d for d, _ in want} == set(range(40))


def test_repeats_within_one_text_do_not_count(spark):
    once = words(1, 70)
    frame = spark.createDataFrame([(1, " ".join(once * 3)), (2, " ".join(words(2, 200)))], "doc_id long, text string")
    assert find_repeats(frame).count() == 0


def test_neighbours_in_small_batches(spark, monkeypatch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        base = words(1, 260)
        rows = [(i, " ".join(edited(base, i, 1))) for i in range(12)]
        frame = spark.createDataFrame(rows, "doc_id long, text string")
        assert found(frame) == plain(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_every_window_belongs_to_one_kept_position():
    rule = RepeatRule(least=20, gram=4)
    for n in (0, 5, 19, 20, 21, 400):
        tokens = mix(np.arange(1, n + 1, dtype=np.uint64) % np.uint64(17))
        kept = kept_positions(tokens, rule)
        covered = [i for a, b in zip(kept.start, kept.stop) for i in range(a, b - rule.least + 1)]
        assert covered == list(range(max(0, n - rule.least + 1)))


def test_stretch_hashes_name_contents_and_place():
    rule = RepeatRule(least=20, gram=4)
    tokens = mix(np.random.default_rng(1).integers(0, 50, 300).astype(np.uint64))
    twice = np.concatenate([tokens, tokens[:150]])
    kept = kept_positions(twice, rule)
    seen = {}
    for h, at, a, b in zip(suffixes.stretch_hashes(twice, kept), kept.at, kept.start, kept.stop):
        content = (tuple(twice[a:b]), at - a)
        assert seen.setdefault(h, content) == content
    assert len(seen) < len(kept.at)


def test_a_hot_text_is_left_out_before_the_join(spark):
    """A third of the rows are one text: a task passes it on once."""
    hot = " ".join(words(1, 70) + words(2, 60))
    rows = [(i, hot if i % 3 == 0 else " ".join(words(100 + i, 60) + words(2, 60))) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    keyed = suffixes._keyed(frame)
    passed = without_copies(keyed, "key").groupBy(F.spark_partition_id(), "key").count()
    assert {r["count"] for r in passed.collect()} == {1}
    assert without_copies(keyed.limit(0), "key").count() == 0
    assert found(frame) == plain(rows)


def test_empty_table(no_docs):
    assert find_repeats(no_docs).count() == 0


def test_own_words_before_a_line_that_all_texts_hold(spark):
    line = words(9, 25)
    rows = []
    for k in range(120):
        own = words(1000 + k // 2, 30)
        rows.append((k, " ".join(words(k, 60) + own + line + words(5000 + k, 60))))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain(rows)
    assert {d for d, _ in want} == set(range(120))
    assert found(frame) == want


def test_window_hashes_name_contents():
    rule = RepeatRule(least=20, gram=4)
    tokens = mix(np.random.default_rng(2).integers(0, 3, 3000).astype(np.uint64))
    tokens = np.concatenate([tokens, tokens[:500]])
    hashes = suffixes.window_hashes(tokens, rule)
    contents = [tuple(tokens[i : i + 20]) for i in range(len(tokens) - 19)]
    assert len(hashes) == len(contents) and len(set(zip(contents, hashes))) == len(set(contents)) == len(set(hashes))


def test_pairs_are_found_over_many_partitions(spark):
    own = {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in own}
    rows = []
    for k in range(1200):
        rows.append((k, " ".join(words(100_000 + k, 55) + words(1000 + k // 2, 51) + words(200_000 + k, 55))))
    try:
        for name, value in own.items():
            spark.conf.set(name, value)
        assert found(spark.createDataFrame(rows, "doc_id long, text string")) == plain(rows)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
