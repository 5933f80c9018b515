from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from strata import operators as op
from strata.contracts import ForeignKey, RowRule, RunPlan, TableContract, ValueRule
from strata.functions import extended_price
from strata.plans import sales

D = Decimal


def tuples(df):
    return [tuple(r) for r in df.collect()]


# --- conform -----------------------------------------------------------------

CONTRACT = TableContract(
    "t", {"id": "INT", "name": "STRING", "on": "DATE"}, ("id",), {"on": "on_precision"}
)


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(
        [
            ("1", " a ", "2021-05-03", "x"),
            ("two", "NULL", "2021-05", "x"),
            ("", "", "soon", "x"),
            (None, None, None, "x"),
            ("99999999999", "b", "2021-02-30", "x"),
        ],
        "id string, name string, `on` string, surplus string",
    )


def test_conform_selects_and_types_exactly_the_declared_columns(raw):
    typed = op.conform(raw, CONTRACT)
    assert typed.dtypes == [
        ("id", "int"),
        ("name", "string"),
        ("on", "date"),
        ("on_precision", "string"),
    ]
    assert tuples(typed) == [
        (1, "a", dt.date(2021, 5, 3), "day"),
        (None, None, dt.date(2021, 5, 1), "month"),
        (None, None, None, None),
        (None, None, None, None),
        (None, "b", None, "day"),
    ]


def test_a_missing_declared_column_raises(raw):
    with pytest.raises(AnalysisException):
        op.conform(raw.drop("name"), CONTRACT)


def test_cast_failures_skip_text_and_allow_partial_dates(raw):
    assert dict(tuples(op.cast_failures(raw, CONTRACT))) == {"id": 2, "on": 2}


def test_cast_failures_of_an_empty_and_of_a_text_only_table(raw):
    assert dict(tuples(op.cast_failures(raw.limit(0), CONTRACT))) == {"id": 0, "on": 0}
    assert tuples(op.cast_failures(raw, TableContract("n", {"name": "STRING"}, ("name",)))) == []


@pytest.mark.parametrize(
    "bad",
    [
        dict(columns={"a": "INT"}, primary_key=("b",)),
        dict(columns={"a": "INT"}, primary_key=("a",), partial_dates={"a": "p"}),
        dict(columns={"a": "DATE"}, primary_key=("a",), partial_dates={"a": "a"}),
    ],
)
def test_contracts_reject_contradictions(bad):
    with pytest.raises(ValueError):
        TableContract("t", **bad)


def test_contract_lists_output_columns():
    assert CONTRACT.output_columns == ["id", "name", "on", "on_precision"]
    assert [f.dataType.simpleString() for f in CONTRACT.raw_schema] == ["string"] * 3


# --- quality -----------------------------------------------------------------


def test_primary_key_counts_null_as_a_key(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    assert tuples(op.check_primary_key(df, ["k"])) == [("k", 5, 3, 2, 2, False)]


def test_primary_key_over_two_columns(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "a int, b int")
    assert tuples(op.check_primary_key(df, ["a", "b"])) == [("a, b", 3, 3, 0, 0, True)]
    holed = df.unionAll(spark.createDataFrame([(3, None)], "a int, b int"))
    assert tuples(op.check_primary_key(holed, ["a", "b"])) == [("a, b", 4, 4, 0, 1, False)]


def test_primary_key_of_an_empty_table(spark):
    df = spark.createDataFrame([], "k int")
    assert tuples(op.check_primary_key(df, ["k"])) == [("k", 0, 0, 0, 0, True)]


def test_foreign_key_exempts_null_and_ignores_parent_copies(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (3,), (3,), (None,)], "c int")
    parent = spark.createDataFrame([(1,), (1,), (2,), (None,)], "p int")
    assert tuples(op.check_foreign_key(child, "c", parent, "p")) == [("c", "p", 2, False)]
    whole = child.filter("c is null or c < 3")
    assert tuples(op.check_foreign_key(whole, "c", parent, "p")) == [("c", "p", 0, True)]
    assert tuples(op.check_foreign_key(child.limit(0), "c", parent, "p")) == [("c", "p", 0, True)]


def test_foreign_key_with_equal_column_names_and_mixed_integer_types(spark):
    child = spark.createDataFrame([(1,), (7,)], "k int")
    parent = spark.createDataFrame([(1,)], "k bigint")
    assert tuples(op.check_foreign_key(child, "k", parent, "k")) == [("k", "k", 1, False)]


def test_childless_parents(spark):
    parent = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "p int, v string")
    child = spark.createDataFrame([(1,), (1,), (None,)], "c int")
    assert sorted(r.v for r in op.childless_parents(parent, "p", child, "c").collect()) == ["b", "c"]


def test_duplicate_keys_are_sorted(spark):
    df = spark.createDataFrame([(3,), (1,), (3,), (1,), (2,), (3,)], "k int")
    assert tuples(op.duplicate_keys(df, ["k"])) == [(1, 2), (3, 3)]


def test_null_profile_also_of_odd_names_and_empty_tables(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "`a.b` int, c string")
    assert dict(tuples(op.null_profile(df))) == {"a.b": 1, "c": 2}
    assert dict(tuples(op.null_profile(df.limit(0)))) == {"a.b": 0, "c": 0}


def test_rules_are_counted_and_listed(spark):
    df = spark.createDataFrame([(3, -1), (1, 0), (2, 5), (4, None)], "id int, qty int")
    rule = RowRule("t", "qty_le_0", "qty <= 0", ("id",))
    other = RowRule("t", "qty_eq_0", "qty = 0")
    assert tuples(op.count_rules(df, [rule, other])) == [("qty_le_0", 2), ("qty_eq_0", 1)]
    assert tuples(op.rule_rows(df.unionAll(df), rule)) == [(1, 2), (3, 2)]


def test_conditional_null(spark):
    df = spark.createDataFrame(
        [(None, True), (1, False), (2, None), (None, False), (3, True)], "person int, online boolean"
    )
    assert tuples(op.conditional_null(df, "person", F.col("online"))) == [(5, 2, 2, 1, 1, False)]
    assert tuples(op.conditional_null(df.limit(3), "person", F.col("online"))) == [
        (3, 1, 1, 0, 0, True)
    ]


def test_quality_report_is_long(raw, spark):
    other = TableContract("u", {"id": "INT"}, ("id",))
    tables = {"t": raw, "u": spark.createDataFrame([("1",), ("1",)], "id string")}
    report = op.quality_report(
        tables,
        [CONTRACT, other],
        [ForeignKey("t", "id", "u", "id")],
        [RowRule("t", "partial", "on_precision = 'month'")],
    )
    got = {tuple(r)[:4]: r.value for r in report.collect()}
    assert got[("t", "null_profile", "id", "nulls")] == 4
    assert got[("t", "cast_failures", "on", "failures")] == 2
    assert got[("t", "rule", None, "partial")] == 1
    assert got[("u", "primary_key", "id", "duplicate_rows")] == 1
    assert got[("u", "primary_key", "id", "valid")] == 0
    assert got[("t", "foreign_key", "t.id -> u.id", "orphans")] == 0
    typed = {n: op.conform(tables[n], c) for n, c in (("t", CONTRACT), ("u", other))}
    given = op.quality_report(
        tables,
        [CONTRACT, other],
        [ForeignKey("t", "id", "u", "id")],
        [RowRule("t", "partial", "on_precision = 'month'")],
        store=typed,
    )
    assert sorted(map(str, tuples(given))) == sorted(map(str, tuples(report)))


# --- shape -------------------------------------------------------------------

PRODUCT = "ProductID int, ProductDesc string, ProductNumber string, Color string, ProductCategoryName string, ProductSubCategoryName string"


def products(spark, *rows):
    return spark.createDataFrame(list(rows), PRODUCT)


def filled(spark, given, source, rules):
    df = spark.createDataFrame([(given, source)], "given string, source string")
    out = op.map_values(df, "given", "source", rules)
    assert out.columns == df.columns
    return out.first().given


def test_every_value_of_the_shipped_rules_maps_to_its_label(spark):
    for rule in sales.CATEGORY_RULES:
        for value in rule.equals:
            assert filled(spark, None, value, sales.CATEGORY_RULES) == rule.label
            assert filled(spark, None, value.lower(), sales.CATEGORY_RULES) is None
            assert filled(spark, None, f"Old {value}", sales.CATEGORY_RULES) is None
            assert filled(spark, "given", value, sales.CATEGORY_RULES) == "given"
        for part in rule.contains:
            assert filled(spark, None, f"x{part}y", sales.CATEGORY_RULES) == rule.label
    assert filled(spark, None, None, sales.CATEGORY_RULES) is None


def test_first_matching_rule_wins(spark):
    df = spark.createDataFrame([(None, "ab")], "t string, s string")
    rules = [ValueRule("first", contains=("a",)), ValueRule("second", equals=("ab",))]
    assert op.map_values(df, "t", "s", rules).first().t == "first"


def test_labels_go_into_text_only(spark):
    df = spark.createDataFrame([(None, None, 5)], "a string, n int, kept int")
    assert tuple(op.null_label(df, ["a"], "?").first()) == ("?", None, 5)
    with pytest.raises(ValueError, match="'n' is not text"):
        op.null_label(df, ["a", "n"], "?")
    with pytest.raises(ValueError):
        op.average_by_group(df, df.select("kept", F.col("n").alias("g")), "kept", "g", "n", "m", "c")


def test_published_products_have_a_color(spark):
    df = products(spark, (5, "lamp", "L-5", None, "Light", "desk"), (6, "rug", "R-6", "Teal", None, "floor"))
    assert {r.ProductID: r.Color for r in sales.publish_product(df).collect()} == {5: sales.COLOR_LABEL, 6: "Teal"}


def test_of_rows_that_differ_in_one_column_the_fuller_or_first_is_published(spark):
    """For each column in turn, everything else being equal."""
    full = (8, "mug", "M-8", "Blue", "Kitchen", "cups")
    for place, (better, worse) in {4: ("Kitchen", None), 5: ("cups", None), 2: ("M-1", "M-2"), 1: ("a", "b")}.items():
        rows = [(*full[:place], value, *full[place + 1 :]) for value in (worse, better)]
        for order in (rows, rows[::-1]):
            assert sales.publish_product(products(spark, *order)).first()[place] == better


@pytest.mark.parametrize(("rank", "kept"), [("additive", "sub"), ("lexicographic", None)])
def test_rank_modes_differ_on_one_sided_gaps(spark, rank, kept):
    df = products(spark, (1, "d", "n", "R", "cat", None), (1, "d", "n", "R", None, "sub"))
    assert sales.publish_product(df, rank).first().ProductSubCategoryName == kept


def test_keep_best_rejects_an_unknown_rank(spark):
    with pytest.raises(ValueError):
        op.keep_best(products(spark), ["ProductID"], ["Color"], rank="best")


def test_null_keys_are_one_key_and_full_ties_do_not_depend_on_layout(spark):
    rows = [(None, f"d{i}", "n", "R", "c", "s") for i in range(20)]
    picked = {
        sales.publish_product(products(spark, *rows).repartition(n)).collect()[0].ProductDesc
        for n in (1, 3, 7)
    }
    assert picked == {"d0"}


# --- fact --------------------------------------------------------------------

DETAIL = (
    "SalesOrderID int, SalesOrderDetailID int, OrderQty int, ProductID int, "
    "UnitPrice decimal(19,4), UnitPriceDiscount decimal(19,4)"
)
HEADER = (
    "SalesOrderID int, OrderDate date, OrderDatePrecision string, ShipDate date, "
    "OnlineOrderFlag boolean, AccountNumber string, CustomerID int, SalesPersonID int, "
    "Freight decimal(19,4)"
)


# One line for each thing that the fact table must show, under the name that says what.
WHOLE, GROSS_DISCOUNT, RETURNED, MONTH_ONLY, NO_HEADER, NO_QUANTITY, NO_KEY = range(501, 508)


@pytest.fixture(scope="module")
def fact(spark):
    detail = spark.createDataFrame(
        [
            (71, WHOLE, 4, 310, D("12.5"), D("0.25")),
            (71, GROSS_DISCOUNT, 2, 311, D("3"), D("4.5")),
            (72, RETURNED, -3, 310, D("8.4"), D("0")),
            (73, MONTH_ONLY, 1, 312, D("6"), D("0")),
            (99, NO_HEADER, 5, 310, D("1.1"), D("0")),
            (71, NO_QUANTITY, None, 311, D("2"), D("0")),
            (None, NO_KEY, 1, 312, D("9"), D("1")),
        ],
        DETAIL,
    )
    d = dt.date
    header = spark.createDataFrame(
        [
            (71, d(2024, 2, 28), "day", d(2024, 3, 4), True, "x", 41, None, D("2.5")),
            (72, d(2024, 3, 1), "day", d(2024, 3, 3), False, "y", 42, 6, D("3.5")),
            (73, d(2024, 3, 1), "month", d(2024, 4, 2), False, "z", 43, 6, D("4.5")),
            (None, d(2024, 3, 1), "day", d(2024, 4, 2), False, "lost", 44, 6, D("4.5")),
        ],
        HEADER,
    )
    return sales.publish_orders(detail, header)


def test_fact_columns(fact):
    assert fact.columns == [
        "SalesOrderID",
        "SalesOrderDetailID",
        "OrderQty",
        "ProductID",
        "UnitPrice",
        "UnitPriceDiscount",
        "OrderDate",
        "OrderDatePrecision",
        "ShipDate",
        "OnlineOrderFlag",
        "AccountNumber",
        "CustomerID",
        "SalesPersonID",
        "TotalOrderFreight",
        "LeadTimeInBusinessDays",
        "TotalLineExtendedPrice",
    ]


def test_fact_grain_and_values(fact):
    rows = {r.SalesOrderDetailID: r for r in fact.collect()}
    assert set(rows) == set(range(WHOLE, NO_KEY + 1)) and fact.count() == len(rows)
    lead = {k: r.LeadTimeInBusinessDays for k, r in rows.items()}
    assert lead == {WHOLE: 3, GROSS_DISCOUNT: 3, RETURNED: 0, MONTH_ONLY: None, NO_HEADER: None, NO_QUANTITY: 3, NO_KEY: None}
    price = {k: r.TotalLineExtendedPrice for k, r in rows.items()}
    assert price == {
        WHOLE: D("49.0000"),
        GROSS_DISCOUNT: D("-3.0000"),
        RETURNED: D("-25.2000"),
        MONTH_ONLY: D("6.0000"),
        NO_HEADER: D("5.5000"),
        NO_QUANTITY: None,
        NO_KEY: D("8.0000"),
    }
    assert rows[NO_HEADER].CustomerID is None and rows[NO_HEADER].SalesOrderID == 99
    assert rows[NO_KEY].AccountNumber is None and rows[NO_KEY].SalesOrderID is None


def test_a_guarded_ship_date_has_no_lead_time(spark):
    detail = spark.createDataFrame([(k, k, 1, 1, D("1"), D("0")) for k in (1, 2, 3)], DETAIL)
    raw = spark.createDataFrame(
        [("1", "2024-03-01", "2024-03"), ("2", "2024-03-01", "2025"), ("3", "2024-03-01", "2024-03-04")],
        "SalesOrderID string, OrderDate string, ShipDate string",
    )
    for column in sales.SALES_ORDER_HEADER.columns:
        if column not in raw.columns:
            raw = raw.withColumn(column, F.lit(None).cast("string"))
    lead = {}
    for contract in (sales.SALES_ORDER_HEADER, sales.GUARDED_HEADER):
        rows = sales.publish_orders(detail, op.conform(raw, contract)).collect()
        lead[contract is sales.GUARDED_HEADER] = {r.SalesOrderID: (str(r.ShipDate), r.LeadTimeInBusinessDays) for r in rows}
    assert lead[False] == {1: ("2024-03-01", 0), 2: ("2025-01-01", 218), 3: ("2024-03-04", 1)}
    assert lead[True] == {1: ("2024-03-01", None), 2: ("None", None), 3: ("2024-03-04", 1)}


def test_prices_beyond_any_decimal_are_null(spark):
    big = D("9" * 34 + ".9999")
    df = spark.createDataFrame([(2, big, D(f"-{big}")), (1, D("5"), D("1"))], "q int, p decimal(38,4), d decimal(38,4)")
    got = df.select(extended_price("q", "p", "d", "decimal(38,4)").alias("x")).collect()
    assert [r.x for r in got] == [None, D("4.0000")]


def test_fact_refuses_columns_of_both_sides(spark):
    a = spark.createDataFrame([(1, 2)], "k int, v int")
    b = spark.createDataFrame([(1, 3)], "k int, V int")
    with pytest.raises(ValueError, match="v"):
        op.build_fact(a, b, "k")
    assert tuples(op.build_fact(a, b, "k", rename={"V": "w"})) == [(1, 2, 3)]


# --- grouped -----------------------------------------------------------------


def ranked(spark):
    return spark.createDataFrame(
        [
            (2021, "a", D("5")),
            (2021, "b", D("9")),
            (2021, "c", D("9")),
            (2021, "d", D("7")),
            (2022, "a", D("-1")),
            (2022, "b", None),
            (None, "a", D("3")),
            (None, "b", None),
        ],
        "y int, g string, v decimal(19,4)",
    )


def test_top_keeps_ties_null_groups_and_order(spark):
    top = op.top_by_group(ranked(spark), "y", "v")
    assert [(r.y, r.g) for r in top.collect()] == [(None, "a"), (2021, "b"), (2021, "c"), (2022, "a")]


def test_rank_two_leaves_a_gap_after_a_tie(spark):
    top = op.top_by_group(ranked(spark), "y", "v", ranks=2, rank_name="r")
    got = sorted(((r.y or 0, r.g, r.r) for r in top.collect()))
    assert got == [(0, "a", 1), (0, "b", 2), (2021, "b", 1), (2021, "c", 1), (2022, "a", 1), (2022, "b", 2)]


@pytest.mark.parametrize("ranks", [1, 2, 3, 5])
def test_top_equals_rank(spark, ranks):
    from pyspark.sql import Window

    df = spark.range(500).select(
        (F.col("id") % 7).alias("y"), F.col("id").alias("g"), (F.col("id") * 13 % 11).alias("v")
    )
    w = Window.partitionBy("y").orderBy(F.col("v").desc())
    expected = df.withColumn("r", F.rank().over(w)).filter(F.col("r") <= ranks)
    got = op.top_by_group(df, "y", "v", ranks, "r")
    assert sorted(tuples(got)) == sorted(tuples(expected))


def test_top_wants_exact_values(spark):
    df = spark.createDataFrame([(1, 1.0)], "y int, v double")
    with pytest.raises(ValueError, match="inexact"):
        op.top_by_group(df, "y", "v")


def test_revenue_keeps_a_missing_year_and_drops_unknown_products(spark, fact):
    product = spark.createDataFrame([(310, "Teal", "Lamps"), (311, "Plum", None)], "ProductID int, Color string, ProductCategoryName string")
    got = {(r.OrderYear, r.Color): r.Revenue for r in sales.revenue_by_year_and_color(fact, product).collect()}
    assert got == {
        (2024, "Teal"): D("23.8000"),
        (2024, "Plum"): D("-3.0000"),
        (None, "Teal"): D("5.5000"),
    }


def test_average_labels_after_grouping_and_sorts(spark):
    fact = spark.createDataFrame([(1, 5), (2, 5), (3, 4), (4, None)], "k int, v int")
    dim = spark.createDataFrame(
        [(1, None), (2, "(Uncategorized)"), (3, "B"), (4, "C")], "k int, c string"
    )
    got = op.average_by_group(fact, dim, "k", "c", "v", "avg", "n")
    assert tuples(got) == [
        ("(Uncategorized)", 5.0, 1),
        ("(Uncategorized)", 5.0, 1),
        ("B", 4.0, 1),
        ("C", None, 0),
    ]


def test_lag_and_span(spark):
    df = spark.createDataFrame(
        [(dt.date(2021, 1, 1), dt.date(2021, 1, 8)), (dt.date(2020, 1, 1), None)], "a date, b date"
    )
    assert sorted(tuples(op.lag_histogram(df, "a", "b")), key=str) == [(7, 1), (None, 1)]
    assert tuples(op.date_span(df, ["a", "b"])) == [
        ("a", dt.date(2020, 1, 1), dt.date(2021, 1, 1)),
        ("b", dt.date(2021, 1, 8), dt.date(2021, 1, 8)),
    ]


# --- keys and plans -------------------------------------------------------------


def test_key_report_scans_each_table_once_and_groups_once(spark, tmp_path):
    """Values, and the plan: one scan per table and one grouping by key for all keys."""
    frames = {
        "lines": spark.createDataFrame([(1, 10, 7), (1, 11, 8), (5, 12, None), (None, 12, 7)], "o int, l int, p int"),
        "orders": spark.createDataFrame([(1,), (2,), (2,), (None,)], "o int"),
        "parts": spark.createDataFrame([(7,), (8,)], "p int"),
    }
    store = {}
    for name, frame in frames.items():
        frame.write.parquet(f"{tmp_path}/{name}")
        store[name] = spark.read.parquet(f"{tmp_path}/{name}")
    contracts = [
        TableContract("orders", {"o": "INT"}, ("o",)),
        TableContract("parts", {"p": "INT"}, ("p",)),
        TableContract("lines", {"o": "INT", "l": "INT", "p": "INT"}, ("l",)),
    ]
    keys = [ForeignKey("lines", "o", "orders", "o"), ForeignKey("lines", "p", "parts", "p")]
    (report,) = op.key_report(store, contracts, keys)
    got = {tuple(r)[:4]: r.value for r in report.collect()}
    expected = {}
    for contract in contracts:
        row = op.check_primary_key(store[contract.name], contract.primary_key).first()
        for metric in ("rows", "distinct_keys", "duplicate_rows", "null_keys", "valid"):
            expected[contract.name, "primary_key", contract.primary_key[0], metric] = int(row[metric])
    for key in keys:
        row = op.check_foreign_key(store["lines"], key.child_column, store[key.parent_table], key.parent_column).first()
        for metric in ("orphans", "valid"):
            expected["lines", "foreign_key", key.relation, metric] = int(row[metric])
    assert got == expected
    plan = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 3
    assert plan.count("keys=[__space") == 2 * 2  # by key and by space, each before and after its shuffle


def test_key_report_of_empty_tables_mixed_types_and_wide_keys(spark):
    store = {
        "a": spark.createDataFrame([], "k int, j int"),
        "b": spark.createDataFrame([(1,), (3,)], "k bigint"),
    }
    contracts = [TableContract("a", {"k": "INT", "j": "INT"}, ("k", "j")), TableContract("b", {"k": "BIGINT"}, ("k",))]
    parts = op.key_report(store, contracts, [ForeignKey("b", "k", "a", "k")])
    got = {tuple(r)[:4]: r.value for part in parts for r in part.collect()}
    assert got["a", "primary_key", "k, j", "rows"] == 0 and got["a", "primary_key", "k, j", "valid"] == 1
    assert got["b", "foreign_key", "b.k -> a.k", "orphans"] == 2
    assert got["b", "primary_key", "k", "distinct_keys"] == 2


def test_plans_refuse_tables_they_do_not_have():
    contract = TableContract("a", {"k": "INT"}, ("k",))
    with pytest.raises(ValueError, match="b"):
        RunPlan((contract,), rules=(RowRule("b", "r", "true"),))
    with pytest.raises(ValueError, match="c"):
        RunPlan((contract,), publish_rules=(RowRule("c", "r", "true"),))


def test_ranks_beyond_sparks_early_cut_are_refused(spark):
    df = spark.createDataFrame([(1, 1)], "y int, v int")
    with pytest.raises(ValueError, match="windowGroupLimitThreshold"):
        op.top_by_group(df, "y", "v", ranks=1_001)
