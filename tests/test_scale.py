"""What the plans must look like for large and lopsided tables."""

from __future__ import annotations

import contextlib
import os
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from strata import operators as op
from strata.contracts import RowRule
from workload import queries as q

# Small enough for test data to count as large.
NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}
SKEW = {
    "spark.sql.shuffle.partitions": "32",
    **NO_BROADCAST,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
}


@contextlib.contextmanager
def settings(spark, values):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(q.all_queries()))
def test_no_query_leaves_the_engine_or_crosses_tables(spark, sf_dir, name):
    text = plan(entry_point.queries()[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert bad not in text


def test_flagship_reads_only_the_columns_it_needs(spark, sf_dir):
    text = plan(entry_point.queries()["top_by_year"](spark, sf_dir))
    assert "PushedFilters: [IsNotNull(l_partkey)]" in text
    for unused in ("l_tax", "l_shipdate", "o_totalprice", "o_orderpriority", "p_retailprice"):
        assert unused not in text


def test_ranking_evaluates_its_input_once(spark, sf_dir):
    text = final_plan(entry_point.queries()["top_by_year"](spark, sf_dir))
    assert "ReusedExchange" in text
    assert text.count("lineitem.parquet") == 1


def test_ranking_is_cut_before_the_shuffle(spark, sf_dir):
    text = final_plan(entry_point.queries()["top2_by_year"](spark, sf_dir))
    assert "row_number(), 2, Partial" in text and "row_number(), 2, Final" in text


def test_ranking_never_gathers_a_huge_tie(spark):
    """200k rows tied at the top: at most one level per task enters the window."""
    df = spark.range(200_000, numPartitions=8).select(
        F.lit(1).alias("y"), F.col("id").alias("g"), F.lit(7).alias("v")
    )
    with settings(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        top = op.top_by_group(df, "y", "v")
        window_input = plan(top).split("Window [row_number()")[1]
        assert "partial_count" in window_input
        rows = top.select("g", F.spark_partition_id().alias("task")).collect()
    assert len({r.g for r in rows}) == len(rows) == 200_000
    assert len({r.task for r in rows}) == 8


def test_listed_rows_are_counted_before_they_are_sorted(spark):
    df = spark.range(90_000, numPartitions=6).select(
        F.when(F.col("id") % 3 != 0, F.col("id")).alias("k")
    )
    listed = op.rule_rows(df, RowRule("t", "all", "true", ("k",)))
    assert "partial_count" in plan(listed)
    assert tuple(listed.first()) == (None, 30_000)


def test_dedupe_is_cut_before_the_shuffle(spark):
    df = spark.range(90_000, numPartitions=6).select(
        F.when(F.col("id") % 3 != 0, F.col("id")).alias("k"),  # a third share the NULL key
        F.col("id").cast("string").alias("a"),
    )
    best = op.keep_best(df, ["k"], ["a"], ["a"])
    text = plan(best)
    assert text.index("Final") < text.index("Exchange hashpartitioning(k") < text.index("Partial")
    assert best.count() == 60_001
    assert best.filter("k is null").first().a == "0"


def test_fact_join_splits_a_hot_order(spark):
    lines = spark.range(60_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("line"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    headers = spark.range(60_000, numPartitions=8).select(
        F.col("id").alias("k"), (F.col("id") * 2).alias("h")
    )
    with settings(spark, SKEW):
        fact = op.build_fact(lines, headers, "k")
        text = final_plan(fact)
        assert "SortMergeJoin(skew=true)" in text
        assert fact.count() == 60_000
        assert fact.filter("k = 7 and h = 14").count() == 20_001


def test_fact_join_splits_lines_without_an_order(spark):
    lines = spark.range(60_000, numPartitions=8).select(
        F.when(F.col("id") % 3 != 0, F.col("id")).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    headers = spark.range(60_000, numPartitions=8).select(
        F.col("id").alias("k"), (F.col("id") * 2).alias("h")
    )
    plain = {"spark.sql.shuffle.partitions": "32", **NO_BROADCAST}
    with settings(spark, plain | {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        fact = op.build_fact(lines, headers, "k")
        assert "skew=true" not in final_plan(fact)
        tasks = fact.groupBy(F.spark_partition_id()).count().collect()
        assert len(tasks) == 32 and max(r["count"] for r in tasks) < 2 * 60_000 / 32
        assert fact.filter("h is null").count() == 20_000


def test_revenue_splits_a_hot_product(spark):
    fact = spark.range(60_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"),
        F.date_add(F.lit("2021-01-01").cast("date"), (F.col("id") % 900).cast("int")).alias("on"),
        F.sha2(F.col("id").cast("string"), 256).alias("shop"),
        F.lit(1).cast("decimal(19,4)").alias("amount"),
    )
    products = spark.range(60_000, numPartitions=8).select(
        F.col("id").alias("k"), (F.col("id") % 5).alias("color")
    )
    with settings(spark, SKEW):
        revenue = op.revenue_by_year(fact, products, "k", "on", "amount", ["color", "shop"])
        assert "SortMergeJoin(skew=true)" in final_plan(revenue)
        assert revenue.agg(F.sum("Revenue")).first()[0] == 60_000


def test_childless_parents_see_each_child_key_once(spark):
    child = spark.range(90_000).select((F.col("id") % 10).alias("c"))
    parent = spark.range(50_000).select(F.col("id").alias("p"))
    with settings(spark, NO_BROADCAST):
        df = op.childless_parents(parent, "p", child, "c")
        text = final_plan(df)
        assert df.count() == 49_990
    assert "LeftAnti" in text
    below_the_join = text.split("LeftAnti")[1]
    assert below_the_join.count("HashAggregate(keys=[__key") == 2
    assert text.count("Exchange hashpartitioning") == 2


@pytest.mark.parametrize("broadcast", [{}, NO_BROADCAST])
def test_foreign_key_check_is_one_shuffle_of_counts(spark, broadcast):
    child = spark.range(30_000).select((F.col("id") % 10).alias("c"))
    parent = spark.range(5).select(F.col("id").alias("p"))
    with settings(spark, broadcast):
        check = op.check_foreign_key(child, "c", parent, "p")
        text = final_plan(check)
        assert tuple(check.first()) == ("c", "p", 15_000, False)
    assert "Join" not in text
    assert text.count("Exchange hashpartitioning") == 1
    assert text.index("Exchange hashpartitioning") < text.index("partial_sum(__rows") < text.index("Union")


def test_primary_key_check_is_one_shuffle_of_counts(spark, sf_dir):
    text = plan(q._QUERIES["pk_check"](spark, sf_dir))
    assert text.count("Exchange hashpartitioning") == 1
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in text


def test_large_dimension_joins_without_broadcast(spark, sf_dir):
    with settings(spark, NO_BROADCAST):
        df = entry_point.queries()["top_by_year"](spark, sf_dir)
        assert "Broadcast" not in final_plan(df)
        large = sorted(map(tuple, df.collect()), key=str)
    small = entry_point.queries()["top_by_year"](spark, sf_dir)
    assert sorted(map(tuple, small.collect()), key=str) == large


def test_clean_text_is_computed_once_per_value(spark, sf_dir):
    """Trim and upper-case appear in one projection below the casts."""
    text = plan(entry_point.queries()["cast_audit"](spark, sf_dir))
    casts = next(line for line in text.splitlines() if "RLIKE" in line and "Project" in line)
    assert "upper(" not in casts


RETRY = """
    import os, sys
    from pyspark.sql import SparkSession, functions as F
    from strata.sources import write_layer
    marker, out = sys.argv[1:]
    spark = (
        SparkSession.builder.master("local[4,4]").config("spark.ui.enabled", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")

    def fail_once(batches):
        from pyspark import TaskContext
        for batch in batches:
            yield batch
        path = f"{marker}-{TaskContext.get().partitionId()}"
        if not os.path.exists(path):
            open(path, "w").close()
            raise RuntimeError("lost after all rows were seen")

    rows = spark.range(4000, numPartitions=4)
    for label, df in (
        ("map", rows),
        ("shuffled", rows.repartition(4, "id")),
    ):
        failing = df.mapInArrow(fail_once, "id bigint")
        table = write_layer(failing, f"{out}/{label}", {"odd": F.count_if(F.col("id") % 2 == 1)})
        print("RESULT", label, table.rows, table.metrics["odd"], table.frame.count())
        marker = marker + "x"
    spark.stop()
"""


def test_layer_metrics_count_each_row_once_when_tasks_are_retried(tmp_path):
    script = tmp_path / "retry.py"
    script.write_text(textwrap.dedent(RETRY))
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run(
        [sys.executable, str(script), str(tmp_path / "marker"), str(tmp_path / "out")],
        env={**os.environ, "PYTHONPATH": root},
        capture_output=True,
        text=True,
        timeout=300,
    )
    results = [line for line in done.stdout.splitlines() if line.startswith("RESULT")]
    assert results == ["RESULT map 4000 2000 4000", "RESULT shuffled 4000 2000 4000"], done.stderr[-2000:]
