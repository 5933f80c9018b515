"""CSV exports that read back as they were."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter
from decimal import Decimal as D

import pytest

from strata.sources import export_csv, publish_layer, read_export, row_hash

HARD = [
    None, "", "a\nb", " x", "x ", "\tRed", "Red\t", '"', '""', 'a"b', "\\", "a\\", '\\"', "a,b", "#c", "\x00", '"\x00',
    "NULL", "null", "\r", "a\rb", "a\r\nb", "\n", "\n\n", " ", "﻿", "-", "'a'", "é ", "\x1a",
]


def texts(seed: int, n: int) -> list[str | None]:
    draw = random.Random(seed)
    parts = [t for t in HARD if t] + ["x", "N"]
    return HARD + ["".join(draw.choices(parts, k=draw.randint(1, 6))) for _ in range(n)]


def same(spark, tmp_path, rows, schema) -> None:
    df = spark.createDataFrame(rows, schema).repartition(3)
    layer = publish_layer(df, str(tmp_path / "layer"), {"row_hash": row_hash(df)})
    export_csv(layer.frame, str(tmp_path / "csv"), verify=layer.metrics["row_hash"])
    back = read_export(spark, str(tmp_path / "csv"), df.schema)
    assert Counter(map(repr, back.collect())) == Counter(map(repr, df.collect()))


def test_two_columns_of_hard_texts(spark, tmp_path):
    hard = texts(1, 800)
    same(spark, tmp_path, list(zip(hard, reversed(hard))), "a string, `b,\"c` string")


def test_one_column_keeps_its_nulls(spark, tmp_path):
    same(spark, tmp_path, [(t,) for t in texts(2, 300)] + [(None,)] * 3, "a string")


def test_all_types_of_the_contracts_and_more(spark, tmp_path):
    rows = [
        (1, 1.5, D("1.2300"), dt.date(2020, 1, 2), dt.datetime(2020, 1, 2, 3, 4, 5, 123456), True, 2**62),
        (None,) * 7,
        (-2, float("nan"), D("-0.0001"), dt.date(1, 1, 1), dt.datetime(1970, 1, 1), False, -(2**63)),
        (3, float("-inf"), None, None, None, None, None),
        (4, 1e300, D("999999999999999.9999"), None, None, None, 0),
    ]
    schema = "i int, d double, c decimal(19,4), t date, ts timestamp, b boolean, l bigint"
    same(spark, tmp_path, rows, schema)


def test_an_empty_answer(spark, tmp_path):
    df = spark.createDataFrame([], "a string, n int")
    export_csv(df, str(tmp_path / "csv"), verify=0)
    assert read_export(spark, str(tmp_path / "csv"), df.schema).collect() == []


def test_the_mark_for_null_is_the_only_text_refused(spark, tmp_path):
    df = spark.createDataFrame([("\\N", 1)], "a string, n int")
    layer = publish_layer(df, str(tmp_path / "layer"), {"row_hash": row_hash(df)})
    with pytest.raises(ValueError, match="does not hold the rows"):
        export_csv(layer.frame, str(tmp_path / "csv"), verify=layer.metrics["row_hash"])
