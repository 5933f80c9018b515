from __future__ import annotations

import glob
import os
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from strata.sources import (
    export_csv,
    header_columns,
    layer_path,
    scan_delimited,
    scratch_base,
    scratch_dir,
    write_layer,
)

LINES = 'id,name,x\n1,ok,2\n2,short\n3,sur,plus,more\n4,"quo\nted",5\n5,"",7\n6, NULL ,8\n'


@pytest.fixture()
def csv(tmp_path):
    path = tmp_path / "in.csv"
    path.write_text(LINES)
    return str(path)


def test_everything_is_text_in_file_order(spark, csv):
    df = scan_delimited(spark, csv)
    assert df.dtypes == [("id", "string"), ("name", "string"), ("x", "string")]
    assert df.filter("id = '6'").first().name == " NULL "
    assert header_columns(spark, csv) == ["id", "name", "x"]


def test_malformed_lines_keep_their_text(spark, csv):
    df = scan_delimited(spark, csv, corrupt_column="bad")
    bad = {r.bad for r in df.filter("bad is not null").collect()}
    assert bad == {"2,short", "3,sur,plus,more", '4,"quo', 'ted",5'}


def test_malformed_lines_are_flagged_whatever_is_selected(spark, csv):
    df = scan_delimited(spark, csv, corrupt_column="bad")
    some = df.select("id", "bad").collect()
    assert (len(some), sum(r.bad is not None for r in some)) == (7, 4)
    counted = df.agg(F.count_if(F.col("bad").isNotNull()).alias("bad"), F.max("id")).first()
    assert counted.bad == 4


def test_quoted_line_breaks_need_multi_line(spark, csv):
    df = scan_delimited(spark, csv, corrupt_column="bad", multi_line=True)
    assert df.filter("id = '4'").first().name == "quo\nted"
    assert {r.bad for r in df.collect()} == {None, "2,short", "3,sur,plus,more"}


def test_plain_files_can_be_split(spark, tmp_path):
    path = tmp_path / "big.csv"
    path.write_text("a,b\n" + "".join(f"{i},{'x' * 90}\n" for i in range(20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        df = scan_delimited(spark, str(path), corrupt_column="bad")
        tasks = df.select(F.spark_partition_id().alias("p")).distinct().count()
        total = df.agg(F.count("a"), F.count("bad")).first()
        assert tasks > 3 and tuple(total) == (20_000, 0)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_header_that_disagrees_fails(spark, csv):
    with pytest.raises(Exception, match="CSV header"):
        scan_delimited(spark, csv, columns=["id", "x", "name"]).collect()


def test_a_missing_input_fails_at_once(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        scan_delimited(spark, str(tmp_path / "absent.csv"))


def test_corrupt_column_must_not_clash(spark, csv):
    with pytest.raises(ValueError):
        scan_delimited(spark, csv, corrupt_column="id")


def test_layer_roundtrip_counts_and_replaces(spark, tmp_path):
    path = layer_path(str(tmp_path) + "/", "store", "t")
    assert path == f"{tmp_path}/store/store_t"
    first = write_layer(spark.range(10), path, {"odd": F.count_if(F.col("id") % 2 == 1)})
    assert (first.rows, dict(first.metrics)) == (10, {"rows": 10, "odd": 5})
    second = write_layer(spark.range(3), path)
    assert second.rows == 3
    assert sorted(r.id for r in second.frame.collect()) == [0, 1, 2]


def test_layer_drops_helper_columns_after_counting(spark, tmp_path):
    df = spark.range(4).withColumn("helper", F.lit("x"))
    table = write_layer(df, str(tmp_path / "t"), {"h": F.count("helper")}, drop=("helper",))
    assert (table.frame.columns, table.metrics["h"]) == (["id"], 4)


def test_an_empty_layer_has_its_schema_and_zero_rows(spark, tmp_path):
    table = write_layer(
        spark.createDataFrame([], "a int, b string"), str(tmp_path / "t"), {"nulls": F.count_if(F.col("a").isNull())}
    )
    assert dict(table.metrics) == {"rows": 0, "nulls": 0}
    assert table.frame.dtypes == [("a", "int"), ("b", "string")] and table.frame.count() == 0


def test_a_layer_is_counted_without_a_second_job(spark, tmp_path):
    spark.sparkContext.setJobGroup("layer", "layer")
    try:
        write_layer(spark.range(100).repartition(3), str(tmp_path / "t"))
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("layer")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # One job for the shuffle stage and one for the write, none for the count.
    assert len(jobs) == 2


def test_export_lands_in_one_file_in_order(spark, tmp_path):
    df = spark.range(100, numPartitions=8).groupBy((F.col("id") % 9).alias("k")).count().orderBy("k")
    export_csv(df, str(tmp_path / "out"))
    files = glob.glob(f"{tmp_path}/out/*.csv")
    assert len(files) == 1
    lines = open(files[0]).read().split()
    assert lines[0] == "k,count" and [int(l.split(",")[0]) for l in lines[1:]] == list(range(9))


def _session(master, checkpoint=None, **settings):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint)
    conf = {key.replace("_", "."): value for key, value in settings.items()}
    return SimpleNamespace(conf=SimpleNamespace(get=conf.get), sparkContext=context)


def test_scratch_folders_are_new_and_made(spark):
    first, second = scratch_dir(spark), scratch_dir(spark)
    assert first != second
    assert os.path.isdir(first.removeprefix("file:"))


def test_scratch_takes_the_named_folder_first():
    named = _session("yarn", "hdfs://b", spark_checkpoint_dir="hdfs://a/tmp/")
    assert scratch_base(named) == "hdfs://a/tmp"
    assert scratch_base(_session("yarn", "hdfs://b/x")) == "hdfs://b/x"


def test_scratch_takes_a_shared_warehouse_only():
    assert scratch_base(_session("yarn", spark_sql_warehouse_dir="s3a://w")) == "s3a://w/_scratch"
    for local in ("file:/w", "/w", "", None):
        with pytest.raises(RuntimeError):
            scratch_base(_session("yarn", spark_sql_warehouse_dir=local))


def test_scratch_is_local_only_within_one_process():
    for master in ("local", "local[4]", "local[*]"):
        assert os.path.isdir(scratch_base(_session(master)))
    with pytest.raises(RuntimeError):
        scratch_base(_session("local-cluster[2,1,1024]"))
