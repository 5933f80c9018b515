from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from strata.llm import sharding
from strata.llm.sharding import feistel, feistel_inverse, number_rows, row_at, shard_rows


@pytest.mark.parametrize("n", [1, 2, 3, 7, 10, 97, 100, 1000, 4097])
def test_feistel_permutes_and_inverts(spark, n):
    rows = spark.range(n).select("id", feistel(F.col("id"), n, 5).alias("to"))
    rows = rows.withColumn("back", feistel_inverse(F.col("to"), n, 5)).collect()
    assert sorted(r.to for r in rows) == list(range(n))
    assert all(r.back == r.id for r in rows)


def test_feistel_shuffles_and_depends_on_the_seed(spark):
    n = 2000
    rows = spark.range(n).select(*(feistel(F.col("id"), n, s).alias(f"s{s}") for s in (1, 2))).collect()
    assert sum(r.s1 == r.s2 for r in rows) < 20
    assert sum(abs(a.s1 - b.s1) == 1 for a, b in zip(rows, rows[1:])) < 20


def test_large_numbers_stay_exact(spark):
    n = 10**15 + 37
    numbers = [0, 1, n - 1, n // 2, 2**49 + 1]
    frame = spark.createDataFrame([(v,) for v in numbers], "v long")
    rows = frame.withColumn("to", feistel(F.col("v"), n)).withColumn("back", feistel_inverse(F.col("to"), n))
    assert all(r.back == r.v and 0 <= r.to < n for r in rows.collect())


def test_shards_of_messy_rows(clashing, messy_rows):
    rows = shard_rows(clashing, 7, seed=3).collect()
    n = len(messy_rows)
    assert sorted(r.row_number for r in rows) == list(range(n))
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    assert {len(own) for own in slots.values()} <= {n // 7, n // 7 + 1}
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r[0], r[1]) for r in messy_rows)
    assert rows[0].kept == "k"


def test_places_do_not_depend_on_partitions(messy):
    narrow = messy.select("doc_id", "text")
    first = {(r.doc_id, r.text, r.row_number, r.shard, r.slot) for r in shard_rows(narrow, 5).collect()}
    again = shard_rows(narrow.repartition(11, "text"), 5).collect()
    assert first == {(r.doc_id, r.text, r.row_number, r.shard, r.slot) for r in again}


def test_row_of_a_place(spark, messy):
    rows = shard_rows(messy.select("doc_id"), 4, seed=9)
    n = rows.count()
    back = rows.withColumn("back", row_at(F.col("shard"), F.col("slot"), n, 4, 9)).collect()
    assert all(r.back == r.row_number for r in back)


def test_many_copies_of_a_row_are_numbered_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CHUNK", 10)
    copies = spark.range(300).select(F.when(F.col("id") < 205, None).otherwise(F.col("id")).alias("x"))
    numbered, n = number_rows(copies)
    assert n == 300 and sorted(r.row_number for r in numbered.collect()) == list(range(300))
    spread = numbered.where("x is null").count()
    assert spread == 205


def test_empty_table(no_docs):
    assert shard_rows(no_docs, 40).count() == 0


def test_no_python_in_the_plan(messy):
    plan = shard_rows(messy, 40)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
