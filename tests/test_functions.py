from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.functions import (
    business_days,
    date_precision,
    extended_price,
    lead_time,
    normalize_text,
    partial_date,
    safe_cast,
)

MONDAY = dt.date(2026, 6, 1)


def day(offset: int) -> dt.date:
    return MONDAY + dt.timedelta(days=offset)


def counted(start: dt.date, end: dt.date) -> int:
    """Day-by-day count, negative for a range that runs backwards."""
    if end < start:
        return -counted(end, start)
    span = (start + dt.timedelta(days=i) for i in range(1, (end - start).days + 1))
    return sum(d.weekday() < 5 for d in span)


def spark_days(spark, pairs, **options):
    df = spark.createDataFrame(
        [(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a date, b date"
    )
    return [r.n for r in df.select("i", business_days("a", "b", **options).alias("n")).orderBy("i").collect()]


def test_reversed_range_can_be_negated(spark):
    assert spark_days(spark, [(day(4), day(0))], reversed_range="negate") == [-4]
    with pytest.raises(ValueError):
        business_days("a", "b", reversed_range="swap")


def test_seven_days_are_five_business_days_from_any_weekday(spark):
    assert spark_days(spark, [(day(i), day(i + 7)) for i in range(7)]) == [5] * 7


def test_business_days_match_a_daily_count(spark):
    pairs = [(day(s), day(s + n)) for s in range(-10, 11) for n in range(-40, 41)]
    old = dt.date(1899, 12, 28)
    pairs += [(old + dt.timedelta(days=s), old + dt.timedelta(days=s + n)) for s in range(7) for n in range(30)]
    assert spark_days(spark, pairs, reversed_range="negate") == [counted(a, b) for a, b in pairs]


@settings(max_examples=5, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.dates(dt.date(1900, 1, 1), dt.date(2100, 1, 1)), st.integers(min_value=-3000, max_value=3000)
        ),
        min_size=20,
        max_size=40,
    )
)
def test_business_days_property(spark, starts):
    pairs = [(a, a + dt.timedelta(days=n)) for a, n in starts]
    assert spark_days(spark, pairs, reversed_range="negate") == [counted(a, b) for a, b in pairs]


def test_business_days_stay_in_generated_code(spark):
    df = spark.range(1).select(
        F.date_add(F.lit(MONDAY), F.col("id").cast("int")).alias("a"), F.lit(day(9)).alias("b")
    )
    result = df.select(business_days("a", "b").alias("n"))
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "sequence" not in plan and "PythonUDF" not in plan and "*(1)" in plan
    assert result.schema["n"].dataType.simpleString() == "int"


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        (None, None),
        ("", None),
        ("   ", None),
        ("NULL", None),
        (" null ", None),
        ("NuLl", None),
        ("nullable", "nullable"),
        ("  a b ", "a b"),
        ("0", "0"),
        ("\tx", "\tx"),
        ("ﬀ", "ﬀ"),
    ],
)
def test_normalize_text(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(normalize_text("t").alias("t")).first().t == expected


def test_normalize_text_with_other_tokens(spark):
    """Tokens match in any spelling, also where upper-casing changes a text's length."""
    tokens = ("", "n/a", "OFF", "miſſing", "Straße")
    given = ["n/a", " N/A ", "N/a.", "oﬀ", "off", "Missing", "STRASSE", "straße", "NULL", ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(given)], "i int, t string")
    kept = df.select("i", normalize_text("t", tokens).alias("n")).orderBy("i").collect()
    assert [r.n for r in kept] == [None, None, "N/a.", None, None, None, None, None, "NULL", None]


def test_normalize_text_without_tokens(spark):
    df = spark.createDataFrame([(" ",), ("NULL",)], "t string")
    assert [r.n for r in df.select(normalize_text("t", ()).alias("n")).collect()] == ["", "NULL"]


@pytest.mark.parametrize(
    ("text", "date", "precision"),
    [
        ("2021-05-31", dt.date(2021, 5, 31), "day"),
        ("2021-05", dt.date(2021, 5, 1), "month"),
        ("2021-02-30", None, "day"),
        ("2021-13", None, "month"),
        ("2021", None, None),
        ("2021-5", None, None),
        ("2021-5-1", None, None),
        ("2021-05\n", None, None),
        ("2021-05-31 10:00:00", None, None),
        ("x", None, None),
        (None, None, None),
    ],
)
def test_partial_dates(spark, text, date, precision):
    row = (
        spark.createDataFrame([(text,)], "t string")
        .select(partial_date("t").alias("d"), date_precision("t").alias("p"))
        .first()
    )
    assert (row.d, row.p) == (date, precision)


@pytest.mark.parametrize(
    ("text", "sql_type", "expected"),
    [
        ("12", "INT", 12),
        ("1.5", "INT", None),
        ("99999999999", "INT", None),
        ("abc", "INT", None),
        (".0000", "DECIMAL(19,4)", Decimal("0.0000")),
        ("-3.5", "DECIMAL(19,4)", Decimal("-3.5000")),
        ("1.23456", "DECIMAL(19,4)", Decimal("1.2346")),
        ("1e30", "DECIMAL(19,4)", None),
        ("True", "BOOLEAN", True),
        ("maybe", "BOOLEAN", None),
        ("x", "STRING", "x"),
    ],
)
def test_safe_cast(spark, text, sql_type, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(safe_cast(F.col("t"), sql_type).alias("v")).first().v == expected


def test_lead_time_needs_a_full_order_date(spark):
    df = spark.createDataFrame(
        [(day(0), day(7), "day"), (day(0), day(7), "month"), (None, day(7), None), (day(0), day(7), None)],
        "a date, b date, p string",
    )
    assert [r.n for r in df.select(lead_time("a", "b", "p").alias("n")).collect()] == [5, None, None, 5]


def test_extended_price(spark):
    df = spark.createDataFrame(
        [
            (2, Decimal("100"), Decimal("0")),
            (3, Decimal("50"), Decimal("0.1")),
            (-1, Decimal("20"), Decimal("0")),
            (None, Decimal("20"), Decimal("0")),
            (2_000_000_000, Decimal("900000000000000"), Decimal("0")),
        ],
        "q int, p decimal(19,4), d decimal(19,4)",
    ).select(extended_price("q", "p", "d").alias("v"))
    assert df.schema["v"].dataType.simpleString() == "decimal(19,4)"
    assert [r.v for r in df.collect()] == [
        Decimal("200.0000"),
        Decimal("149.7000"),
        Decimal("-20.0000"),
        None,
        None,
    ]
