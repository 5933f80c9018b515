"""Category maps as tables, against the rules tried one by one."""

from __future__ import annotations

import random
import sys

from pyspark.sql import functions as F

from strata import operators as op
from strata.contracts import ValueRule
from strata.operators.rule_table import CROWD, PIECE, RULE_COLUMNS, SIZE, _filed
from strata.plans import sales
from tests.test_scale import NO_BROADCAST, plan, settings


def first_match(value, rules):
    found = [
        (number, label)
        for number, label, kind, pattern in rules
        if label is not None and pattern is not None
        and (value == pattern if kind == "equals" else pattern in value)
    ]
    return min(found)[1] if found else None


def expected(rows, rules):
    return sorted(
        ((i, first_match(v, rules) if t is None and v is not None else t, v) for i, t, v in rows), key=str
    )


def run(spark, rows, rules):
    df = spark.createDataFrame(rows, "id int, target string, source string").repartition(3)
    table = spark.createDataFrame(rules, RULE_COLUMNS)
    return op.map_values_table(df, "target", "source", table, spread_by=["id"])


def test_ten_thousand_rules_as_one_by_one(spark):
    draw = random.Random(3)
    letters = "abcdé漢 -"

    def text(most):
        return "".join(draw.choices(letters, k=draw.randint(0, most)))

    rules = [
        (draw.randint(0, 5000), f"L{draw.randint(0, 40)}", draw.choice(["equals", "contains"]), text(7))
        for _ in range(10_000)
    ]
    rules += [(1, None, "contains", "a"), (0, "none", "equals", None), (3, "x", "unknown", "a")]
    rules = [r for r in rules if r[3] != "" or r[2] == "equals"]
    rows = [(i, draw.choice([None, None, None, "given"]), draw.choice([None, text(4), text(12)])) for i in range(700)]
    rows += rows[:50]
    for values in ({}, NO_BROADCAST):
        with settings(spark, values):
            got = run(spark, rows, rules)
            assert got.columns == ["id", "target", "source"]
            known = [r for r in rules if r[2] in ("equals", "contains")]
            assert sorted(map(tuple, got.collect()), key=str) == expected(rows, known)


def test_short_and_empty_patterns(spark):
    rules = [(5, "five", "contains", ""), (4, "four", "contains", "b"), (3, "three", "contains", "ab"), (2, "two", "contains", "abc"), (1, "one", "contains", "abcd"), (2, "also two", "equals", "abc")]
    rows = [(i, None, v) for i, v in enumerate(["", "x", "b", "ab", "abc", "xabcdx", None, "BC"])]
    assert sorted(map(tuple, run(spark, rows, rules).collect()), key=str) == expected(rows, rules)


def test_same_as_rules_written_out(spark, sf_dir):
    values = ["Gloves", "Road Frames", "frames", "Wheels", "Bib-Shorts", "Pumps", None, "", "Frames"]
    rows = [(i, t, v) for i, (t, v) in enumerate((t, v) for t in (None, "Bikes") for v in values)]
    df = spark.createDataFrame(rows, "id int, target string, source string")
    rules = (*sales.CATEGORY_RULES, ValueRule("late", equals=("Gloves",), contains=("rame",)))
    plain = op.map_values(df, "target", "source", rules)
    table = op.map_values_table(df, "target", "source", op.rule_table(df, rules))
    assert sorted(map(tuple, table.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_no_rules_and_no_rows(spark):
    assert run(spark, [(1, None, "a"), (2, "t", None)], []).count() == 2
    assert run(spark, [], [(1, "l", "contains", "a")]).collect() == []


def test_a_rule_costs_no_branch_and_rows_move_once(spark):
    df = spark.range(1000).select("id", F.lit(None).cast("string").alias("t"), F.col("id").cast("string").alias("s"))
    rules = spark.range(5000).select(
        F.col("id").alias("rule"), F.lit("x").alias("label"), F.lit("equals").alias("kind"), F.concat(F.lit("k"), "id").alias("pattern")
    )
    text = plan(op.map_values_table(df, "t", "s", rules))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert text.count("CASE WHEN") < 10


def test_hot_values_and_given_targets_are_spread(spark):
    df = spark.range(60_000, numPartitions=6).select(
        "id",
        F.when(F.col("id") % 3 == 0, "given").alias("t"),
        F.when(F.col("id") % 3 == 1, "hot abc").otherwise(F.col("id").cast("string")).alias("s"),
    )
    rules = spark.createDataFrame([(1, "x", "contains", "abc"), (2, "y", "contains", "77")], RULE_COLUMNS)
    quiet = {**NO_BROADCAST, "spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    with settings(spark, quiet):
        got = op.map_values_table(df, "t", "s", rules, spread_by=["id"])
        labels = {r.t: r["count"] for r in got.groupBy("t").count().collect()}
    assert labels["given"] == labels["x"] == 20_000


def test_a_piece_leads_to_few_patterns_however_many_there_are(spark):
    patterns = [f"{n * 7919 % 10**7:07d}-{n % 1000:03d}-" for n in range(20_000)]
    draw = random.Random(5)
    patterns += ["".join(draw.choices("ab", k=draw.randint(0, 7))) for _ in range(2_000)]
    rules = spark.createDataFrame([(n, "l", "contains", p) for n, p in enumerate(patterns)], RULE_COLUMNS)
    filed = _filed(rules).cache()
    assert filed.count() == filed.select("pattern").distinct().count() == len(set(patterns))
    assert filed.where(~F.contains("pattern", PIECE) | (F.length(PIECE) != F.col(SIZE))).isEmpty()
    assert filed.groupBy(PIECE).count().agg(F.max("count")).first()[0] <= CROWD + 1
    assert {r[0] for r in filed.select(SIZE).distinct().collect()} == {0, 1, 2, 4, 5, 6, 7, 8}
    assert {r[0] for r in filed.where("pattern like '%-%'").select(SIZE).distinct().collect()} == {8}
    filed.unpersist()


def test_crowded_patterns_with_and_without_a_folder(spark, tmp_path, monkeypatch):
    draw = random.Random(7)

    def text(least, most):
        return "".join(draw.choices("ab", k=draw.randint(least, most)))

    rules = [(draw.randint(0, 900), f"L{draw.randint(0, 40)}", draw.choice(["equals", "contains", "contains"]), text(5, 17)) for _ in range(3_000)]
    rules += [(1_000, "short", "contains", "aba"), (1_001, "empty", "contains", "")]
    rows = [(i, draw.choice([None, None, "given"]), draw.choice([None, text(0, 6), text(4, 20), text(4, 20)])) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, target string, source string").repartition(3)
    table = spark.createDataFrame(rules, RULE_COLUMNS)
    cases = [(values, folder, few) for values in ({}, NO_BROADCAST) for folder, few in ((None, 0), ("f", 100), ("g", 10**6), ("h", 0))]
    for n, (values, folder, few) in enumerate(cases):
        monkeypatch.setattr(sys.modules[op.map_values_table.__module__], "FEW", few)
        with settings(spark, values):
            at = folder and f"{tmp_path}/{folder}{n}"
            got = op.map_values_table(df, "target", "source", table, ["id"], at)
            assert sorted(map(tuple, got.collect()), key=str) == expected(rows, rules)


def test_no_substrings_and_a_folder(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "a"), (2, "t", None)], "id int, target string, source string")
    table = spark.createDataFrame([(1, "one", "equals", "a")], RULE_COLUMNS)
    got = op.map_values_table(df, "target", "source", table, folder=f"{tmp_path}/rules")
    assert sorted(map(tuple, got.collect())) == [(1, "one", "a"), (2, "t", None)]
