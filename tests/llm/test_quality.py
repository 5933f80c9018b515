from __future__ import annotations

import random
from collections import Counter, defaultdict

import duckdb
import pytest

from strata.llm.quality import LineRules, judge_quality, normal_line
from strata.llm.queries import oracle_sql, queries
from tests.compare import differences
from tests.llm.data import words


def plain(text, frequent=frozenset(), rules=LineRules()):
    """Counts and verdict of a text, word by word."""
    tokens = (text or "").encode().split()
    decoded = [t.decode() for t in tokens]
    runs = Counter(tuple(tokens[i : i + 3]) for i in range(len(tokens) - 2))
    again = {j for i in range(len(tokens) - 2) if runs[tuple(tokens[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [line for line in (text or "").split("\n") if line.encode().split()]
    removed = sum(
        len(line.encode().split()) for line in lines if normal_line(line.encode()) in frequent
    )
    failed = len(tokens) < rules.min_words or 100 * len(again) > 50 * len(tokens)
    return (
        len(tokens),
        sum(map(len, decoded)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        len(again),
        removed,
        failed,
        not failed and 2 * (len(tokens) - removed) >= len(tokens),
    )


def frequent_lines(rows, rules):
    """Normal lines above the limits, by host, counted text by text."""
    held, ends = defaultdict(dict), defaultdict(set)
    for _, text, _, host, _ in rows:
        lines = {normal_line(line.encode()) for line in (text or "").split("\n")} - {b""}
        held[host][text] = [line.split(b" ") for line in lines]
        for line in held[host][text]:
            ends[host, "head", tuple(line[:4])].add(text)
            ends[host, "tail", tuple(line[-4:])].add(text)
    frequent = defaultdict(set)
    for host, texts in held.items():
        counts, n = Counter(), 0
        for lines in texts.values():
            heads = sum(len(line) for line in lines if len(ends[host, "head", tuple(line[:4])]) == 1)
            tails = sum(len(line) for line in lines if len(ends[host, "tail", tuple(line[-4:])]) == 1)
            if min(heads, tails) >= max(rules.min_own * sum(map(len, lines)), 1):
                n += 1
                counts.update(b" ".join(line) for line in lines)
        frequent[host] = {line for line, k in counts.items() if k > rules.max_share * n + n**0.5}
    return frequent


def result(row):
    return (
        row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words,
        row.n_removed_words, row.base_failed, row.kept,
    )


def test_messy_documents_equal_plain_counts(clashing, messy_rows):
    rules = LineRules(max_share=0.01, min_own=0.1)
    frequent = frequent_lines(messy_rows, rules)
    got = Counter((r.doc_id, r.text, result(r)) for r in judge_quality(clashing, rules).collect())
    want = Counter((r[0], r[1], plain(r[1], frequent[r[3]], rules)) for r in messy_rows)
    assert got == want


def test_frequent_lines_are_removed_and_depleted_documents_rejected(spark):
    banner = "Subscribe 2024 to our NEWS letter today"
    banners = [banner] + [" ".join(words(800 + k, 7)) for k in range(7)]
    rows = [(i, "\n".join([*banners, " ".join(words(i, 30)), " ".join(words(i, 30)[::-1])]), "en", "h", 0) for i in range(60)]
    changed = [banner.replace("2024", "1999").lower(), *banners[1:]]
    rows += [(100, "\n".join([*changed, " ".join(words(300, 40))]), "en", "h", 0)]
    rows += [(101 + i, banner + "\n" + " ".join(words(400 + i, 60)), "en", None, 0) for i in range(10)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in judge_quality(frame).collect()}
    assert banner not in got[0].clean_text and got[0].n_removed_words == 56 and got[0].kept
    assert not got[100].kept and not got[100].base_failed
    assert got[101].n_removed_words == 7  # all ten documents of the missing host have it


def test_copies_of_a_text_are_no_boilerplate(spark):
    text = "a line of it\n" + " ".join(words(1, 80))
    rows = [(i, text, "s") for i in range(200)] + [(900 + i, " ".join(words(i, 70)), "s") for i in range(5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert all(r.kept and r.n_removed_words == 0 for r in judge_quality(frame).collect())


def judged(spark, texts, host="h"):
    rows = [(i, text, host) for i, text in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    return {r.doc_id: r for r in judge_quality(frame).collect()}


def page(seed, common, own=4):
    """Common lines with a document's own among them, twelve words each."""
    lines = [*common, *(" ".join(words(7_000 + 50 * seed + k, 12)) for k in range(own))]
    random.Random(seed).shuffle(lines)
    return "\n".join(lines)


COMMON = [" ".join(words(500 + k, 12)) for k in range(12)]


def test_a_small_host_loses_what_all_its_pages_have(spark):
    """Twelve of sixteen lines of twenty pages: all of them go, and the pages are depleted."""
    got = judged(spark, [page(seed, COMMON) for seed in range(20)])
    assert {r.n_removed_words for r in got.values()} == {144}
    assert not any(r.kept or r.base_failed for r in got.values())
    got = judged(spark, [page(seed, COMMON[:3], own=8) for seed in range(20)])
    assert {r.n_removed_words for r in got.values()} == {36} and all(r.kept for r in got.values())


def test_two_pages_that_share_lines_are_no_evidence(spark):
    got = judged(spark, [page(seed, COMMON[:4], own=8) for seed in (1, 2)])
    assert all(r.kept for r in got.values())


def near_copy(base, seed, changes):
    lines = [line.split(" ") for line in base]
    draw = random.Random(seed)
    for k in range(changes):
        line = draw.choice(lines)
        line[draw.randrange(len(line))] = f"edit{'x' * (seed % 7)}{'y' * k}{'z' * (seed // 7)}"[:9]
    return "\n".join(" ".join(line) for line in lines)


@pytest.mark.parametrize("changes", [1, 3])
def test_near_copies_stay_for_near_duplicate_removal(spark, changes):
    """A third of a host are one text of ten lines with a few words changed: all of them stay."""
    base = [" ".join(words(900 + k, 15)) for k in range(10)]
    copies = [near_copy(base, seed, changes) for seed in range(300)]
    others = [page(seed, [], own=9) for seed in range(700)]
    got = judged(spark, copies + others)
    assert all(r.kept and r.n_removed_words == 0 for r in got.values())
    alone = judged(spark, copies)
    assert all(r.kept for r in alone.values())


def test_boilerplate_is_removed_beside_near_copies(spark):
    base = [" ".join(words(900 + k, 15)) for k in range(10)]
    copies = [near_copy(base + COMMON[:1], seed, 1) for seed in range(300)]
    others = [page(seed, COMMON[:1], own=9) for seed in range(300)]
    got = judged(spark, copies + others)
    assert all(r.kept for r in got.values())
    assert sum(r.n_removed_words == 12 for r in got.values()) >= 570  # those whose line was not edited


def test_sql_on_hosts_with_boilerplate(spark, tmp_path):
    """The same verdicts as SQL where lines are removed and documents rejected."""
    base = [" ".join(words(900 + k, 15)) for k in range(10)]
    texts = {
        "small": [page(seed, COMMON) for seed in range(20)],
        "normal": [page(seed, COMMON[: seed % 13], own=5) for seed in range(100, 250)],
        "copies": [near_copy(base, seed, seed % 5) for seed in range(60)] + [page(s, [], 6) for s in range(60)],
        None: [page(seed, COMMON[:9], own=4) for seed in range(300, 312)] * 2 + [None, ""],
    }
    rows = [(i, t, h) for i, (h, t) in enumerate((h, t) for h, own in texts.items() for t in own)]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{path}/*.parquet'")
    result = queries()["op6_quality_rules"](spark, str(tmp_path))
    assert differences(result, con, oracle_sql()["op6_quality_rules"]) == []
    found = result.collect()
    assert sum(not r.kept and not r.base_failed for r in found) >= 40
    assert sum(r.kept and r.n_removed_words > 0 for r in found) >= 30


def test_a_filter_on_the_verdict_judges_each_text_once(messy):
    kept = judge_quality(messy).where("kept and n_words > 0").select("clean_text", "doc_id")
    assert kept._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_empty_table(no_docs):
    judged = judge_quality(no_docs)
    assert judged.count() == 0 and "clean_text" in judged.columns
