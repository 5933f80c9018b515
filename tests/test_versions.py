"""Published layers: whole versions, kept order, and writes that die."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from strata.contracts import Limit, RunPlan, StagedQuestion, TableContract
from strata.plans import LimitExceeded, run
from strata.sources import drop_abandoned, layer_path, publish_layer, read_layer, row_hash, unordered
from tests.test_scale import plan, settings

MANY_FILES = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "7"}


def broken(spark, n=100):
    """Rows one of which cannot be computed."""
    fails = F.when(F.col("id") == n - 1, F.raise_error(F.lit("lost"))).otherwise(F.col("id"))
    return spark.range(n, numPartitions=4).select(fails.cast("long").alias("id"))


def test_a_write_that_dies_leaves_the_version_before(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(Exception, match="lost"):
        publish_layer(broken(spark), path)
    with pytest.raises(FileNotFoundError):
        read_layer(spark, path)
    first = publish_layer(spark.range(10), path, {"odd": F.count_if(F.col("id") % 2 == 1)})
    with pytest.raises(Exception, match="lost"):
        publish_layer(broken(spark), path)
    back = read_layer(spark, path)
    assert back.path == first.path and dict(back.metrics) == {"rows": 10, "odd": 5}
    assert sorted(r.id for r in back.frame.collect()) == list(range(10))
    publish_layer(spark.range(3), path)
    assert read_layer(spark, path).frame.count() == 3


def test_a_reader_of_the_former_version_can_finish(spark, tmp_path):
    path = str(tmp_path / "t")
    tables = [publish_layer(spark.range(n), path) for n in (1, 2, 3)]
    assert [os.path.isdir(t.path) for t in tables] == [False, True, True]
    assert tables[1].frame.count() == 2 and read_layer(spark, path).frame.count() == 3
    only = publish_layer(spark.range(4), path, keep=1)
    assert [os.path.basename(f) for f in glob.glob(f"{path}/v*")] == [os.path.basename(only.path)]


def test_what_died_writes_left_can_be_removed(spark, tmp_path):
    path = str(tmp_path / "t")
    assert drop_abandoned(spark, path) == []
    kept = [publish_layer(spark.range(n), path) for n in (1, 2)]
    for _ in range(2):
        with pytest.raises(Exception, match="lost"):
            publish_layer(broken(spark), path)
    (tmp_path / "t" / "notes").mkdir()
    assert drop_abandoned(spark, path) == []  # they may still be at work
    assert len(drop_abandoned(spark, path, hours=0)) == 2
    folders = {name for name in os.listdir(path) if os.path.isdir(f"{path}/{name}")}
    assert folders == {"notes", *(os.path.basename(t.path) for t in kept)}
    assert read_layer(spark, path).frame.count() == 2


def test_a_table_can_be_written_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    first = publish_layer(spark.range(5), path)
    second = publish_layer(first.frame.unionAll(spark.range(5, 7)), path)
    assert sorted(r.id for r in second.frame.collect()) == list(range(7))


def test_an_answer_of_several_files_comes_back_sorted(spark, tmp_path):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), F.repeat(F.lit("x"), (F.col("id") % 90).cast("int")).alias("t"))
    with settings(spark, MANY_FILES):
        table = publish_layer(df.orderBy(F.col("k").desc()), str(tmp_path / "t"), in_order=True)
    assert len(glob.glob(f"{table.path}/part-*.parquet")) == 7
    again = read_layer(spark, str(tmp_path / "t"))
    for frame in (table.frame, again.frame):
        assert [r.k for r in frame.collect()] == list(range(4999, -1, -1))
        assert [r.k for r in frame.limit(3).collect()] == [4999, 4998, 4997]
        assert "Sort" not in plan(frame) and "Exchange" not in plan(frame)
    whole = unordered(spark, again)
    assert plan(whole.frame).count("FileScan") == 1 and whole.frame.count() == 5000


def test_an_empty_table_has_a_version(spark, tmp_path):
    for in_order in (False, True):
        table = publish_layer(spark.range(0), str(tmp_path / "t"), in_order=in_order)
        assert table.rows == 0 and table.frame.columns == ["id"] and table.frame.collect() == []


def test_row_hash_is_free_of_order_only(spark):
    def of(rows):
        df = spark.createDataFrame(rows, "a string, b string").repartition(3)
        return df.agg(row_hash(df)).first()[0]

    rows = [("x", None), (None, "x"), ("", "x"), ("x", "x")]
    assert of(rows) == of(rows[::-1])
    assert len({of([r]) for r in rows}) == 4
    assert of(rows) != of(rows + rows[:1]) and of([("a", "b"), ("c", "d")]) != of([("a", "d"), ("c", "b")])


PLAIN = RunPlan(
    contracts=(TableContract("t", {"id": "INT", "v": "DECIMAL(9,2)"}, ("id",)),),
    publish={"doubled": lambda t: t["t"].withColumn("w", F.col("v") * 2)},
    questions={
        "best": StagedQuestion(
            lambda t: t["doubled"].groupBy("id").agg(F.sum("w").alias("w")),
            lambda sums: sums.orderBy(F.col("w").desc()),
        )
    },
    audit_values=True,
)


def extract(tmp_path, name, lines):
    (tmp_path / name).write_text("id,v\n" + "".join(f"{line}\n" for line in lines))
    return {"t": str(tmp_path / name)}


def test_a_run_that_dies_leaves_published_tables_and_report(spark, tmp_path):
    out = str(tmp_path / "out")
    run(spark, PLAIN, extract(tmp_path, "a.csv", ["1,2", "2,3"]), out)
    dies = RunPlan(
        contracts=PLAIN.contracts,
        publish={"doubled": lambda t: t["t"].withColumn("w", F.raise_error(F.lit("lost")).cast("int"))},
        questions=PLAIN.questions,
    )
    with pytest.raises(Exception, match="lost"):
        run(spark, dies, extract(tmp_path, "b.csv", ["1,2", "2,3", "3,4"]), out)
    assert read_layer(spark, layer_path(out, "store", "t")).rows == 3
    assert read_layer(spark, layer_path(out, "publish", "doubled")).rows == 2
    report = read_layer(spark, layer_path(out, "quality", "report")).frame
    sizes = {r.column: r.value for r in report.where("check = 'layer'").collect()}
    assert sizes == {"raw": 2, "store": 2, "publish": 2}


def test_limits_stop_a_run_before_it_publishes(spark, tmp_path):
    out = str(tmp_path / "out")
    good = extract(tmp_path, "a.csv", ["1,2", "2,3.456", "3,4"])
    first = run(spark, PLAIN, good, out)
    changed = first.quality.frame.where("check = 'changed_values'").collect()
    assert [(r.column, r.metric, r.value) for r in changed] == [("v", "rounded", 1)]
    assert [(r.id, str(r.w)) for r in first.analysis["best"].collect()] == [(3, "8.00"), (2, "6.92"), (1, "4.00")]
    bad = extract(tmp_path, "b.csv", ["1,2", "1,x", "2,3", "4,y"])

    def limited(*limits):
        return RunPlan(PLAIN.contracts, publish=PLAIN.publish, questions=PLAIN.questions, limits=limits)

    broken_limits = (
        Limit("cast_failures", "failures", at_most=1),
        Limit("primary_key", "duplicate_rows", table="t", column="id", share=0.2),
        Limit("null_profile", "nulls", share=0.5),
    )
    with pytest.raises(LimitExceeded, match="cast_failures v failures: 2 > 1") as stopped:
        run(spark, limited(*broken_limits), bad, out)
    found = {(b.check, b.column, b.value, b.at_most) for b in stopped.value.breaches}
    assert found == {("cast_failures", "v", 2, 1), ("primary_key", "id", 1, 0)}
    assert read_layer(spark, layer_path(out, "publish", "doubled")).rows == 3
    assert read_layer(spark, layer_path(out, "analysis", "best")).rows == 3
    assert read_layer(spark, layer_path(out, "quality", "checks")).frame.where("check = 'rule'").count() == 0
    run(spark, limited(Limit("cast_failures", "failures", at_most=2)), bad, out)
    assert read_layer(spark, layer_path(out, "publish", "doubled")).rows == 4


def test_limits_are_declared_in_full():
    for wrong in ({}, {"at_most": 1, "share": 0.1}):
        with pytest.raises(ValueError, match="at_most or share"):
            Limit("scan", "malformed_lines", **wrong)
    with pytest.raises(ValueError, match="does not have"):
        RunPlan(PLAIN.contracts, limits=(Limit("scan", "malformed_lines", table="u", at_most=0),))
