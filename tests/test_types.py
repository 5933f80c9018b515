"""Keys of different types, and values that a cast changes."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal as D
from decimal import localcontext

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from strata import operators as op
from strata.contracts import ForeignKey, TableContract
from strata.operators.conform import decimals_needed
from tests.test_scale import plan
from workload import queries as q


def report(store, keys, references):
    contracts = [TableContract(t, dict(store[t].dtypes), (k,)) for t, k in keys.items()]
    parts = op.key_report(store, contracts, references)
    return {tuple(r)[:4]: r.value for part in parts for r in part.collect()}, parts


def test_keys_are_compared_in_their_common_type(spark):
    store = {
        "i": spark.createDataFrame([(1,), (2,), (3,), (3,), (None,)], "k int"),
        "l": spark.createDataFrame([(1,), (2,), (2**40,), (None,)], "k bigint"),
        "d": spark.createDataFrame([(D("1"),), (D("3"),), (D("2.5"),), (D(2**40),)], "k decimal(19,4)"),
    }
    pairs = [("d", "i"), ("l", "i"), ("d", "l"), ("i", "d")]
    found, parts = report(store, {"i": "k", "l": "k", "d": "k"}, [ForeignKey(a, "k", b, "k") for a, b in pairs])
    orphans = {k[2]: v for k, v in found.items() if k[3] == "orphans"}
    assert orphans == {"d.k -> i.k": 2, "l.k -> i.k": 1, "d.k -> l.k": 2, "i.k -> d.k": 1}
    for child, parent in pairs:
        one = op.check_foreign_key(store[child], "k", store[parent], "k").first()
        assert one.orphans == orphans[f"{child}.k -> {parent}.k"]
    assert found["i", "primary_key", "k", "rows"] == 5 and found["i", "primary_key", "k", "distinct_keys"] == 4
    assert found["l", "primary_key", "k", "null_keys"] == 1 and found["d", "primary_key", "k", "valid"] == 1
    for part in parts:
        assert " as string" not in plan(part)


def test_text_beside_numbers(spark):
    store = {
        "t": spark.createDataFrame([("1",), ("01",), ("x",), ("y",), (None,)], "k string"),
        "n": spark.createDataFrame([(1,), (2,)], "k int"),
    }
    found, _ = report(store, {"t": "k", "n": "k"}, [ForeignKey("t", "k", "n", "k"), ForeignKey("n", "k", "t", "k")])
    assert found["t", "foreign_key", "t.k -> n.k", "orphans"] == 2  # x and y are no number
    assert found["n", "foreign_key", "n.k -> t.k", "orphans"] == 1
    assert found["t", "primary_key", "k", "distinct_keys"] == 5  # '1' and '01' are two texts
    assert found["n", "primary_key", "k", "distinct_keys"] == 2


def test_types_that_spark_does_not_compare_raise(spark):
    store = {"a": spark.createDataFrame([(True,)], "k boolean"), "b": spark.createDataFrame([(1,)], "k int")}
    with pytest.raises(AnalysisException):
        report(store, {"a": "k", "b": "k"}, [ForeignKey("a", "k", "b", "k")])


def test_the_typed_report_scans_each_table_once(spark, sf_dir):
    text = plan(q.all_queries()["typed_key_report"](spark, sf_dir))
    # customers, parts and orders once; lines once more for their composite key
    assert {t: text.count(f"{t}.parquet") for t in ("customer", "part", "orders", "lineitem")} == {
        "customer": 1, "part": 1, "orders": 1, "lineitem": 2,
    }


DATES = TableContract("t", {"d": "DATE", "n": "DECIMAL(9,2)", "i": "INT", "s": "STRING"}, ("i",))


def test_completed_dates_are_counted_with_blanks_around(spark):
    texts = ["\t2021", "2021-05\t", "2021-05", "2021", "2021-05-06", "\n2021-05-06", "+2021", "x", None, " 2021-5 "]
    raw = spark.createDataFrame([(t, None, None, None) for t in texts], DATES.raw_schema)
    found = {(r["column"], r.metric): r["values"] for r in op.changed_values(raw, DATES).collect()}
    assert found == {("d", "imputed"): 6, ("n", "rounded"): 0, ("d", "shortened"): 0}


def test_dates_with_a_time_are_shortened(spark):
    texts = ["2021-05-06 10:00", "2021-05-06T10:00:00", " 2021-05-06 ", "2021-05-06\t", "2021-05-06T", "10:00"]
    raw = spark.createDataFrame([(t, None, None, None) for t in texts], DATES.raw_schema)
    typed = [r.d for r in op.conform(raw, DATES).collect()]
    found = {(r["column"], r.metric): r["values"] for r in op.changed_values(raw, DATES).collect()}
    assert typed[:5] == [dt.date(2021, 5, 6)] * 5 and typed[5] is None
    assert found["d", "shortened"] == 2


def test_decimals_needed_is_exact(spark):
    draw = random.Random(8)
    texts = []
    for _ in range(3000):
        whole = "".join(draw.choices("0001259", k=draw.randint(0, 9)))
        part = "".join(draw.choices("000139", k=draw.randint(0, 40)))
        exponent = draw.choice(["", "", f"e{draw.randint(-45, 45)}", f"E+{draw.randint(0, 9)}"])
        if whole or part:
            texts.append(draw.choice(["", "-", "+"]) + whole + draw.choice([".", ".", ""] if not part else ["."]) + part + exponent)
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.n for r in rows.select(decimals_needed(F.col("t")).alias("n")).collect()]
    with localcontext(prec=200):
        wanted = [max(0, -D(t).normalize().as_tuple().exponent) if D(t) else 0 for t in texts]
    assert got == wanted and max(got) > 60


def test_other_texts_need_no_decimals(spark):
    rows = spark.createDataFrame([(t,) for t in ("", ".", "x1", "1.2.3", "e5", "1 2", None, "-", "1e")], "t string")
    assert {r.n for r in rows.select(decimals_needed(F.col("t")).alias("n")).collect()} == {None}


def test_a_top_question_scans_each_input_once(spark, sf_dir):
    """What is ranked is read from the stored sums; no input table is in the plan any more."""
    text = plan(q.all_queries()["top_color_by_year"](spark, sf_dir))
    assert "revenue" in text
    for table in ("lineitem", "orders", "part"):
        assert f"{table}.parquet" not in text
