"""Every operator over the supplied tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import functions as fn
from strata import operators as op
from strata.contracts import ForeignKey, Limit, RowRule, RunPlan, TableContract
from strata.plans import LimitExceeded, sales
from strata.plans import run as run_plan
from strata.plans.stages import together
from strata.sources import (
    export_csv,
    layer_path,
    publish_layer,
    read_export,
    read_layer,
    row_hash,
    scan_delimited,
    scan_drifting,
    scratch_dir,
    write_layer,
)
from workload import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _query(build: Query) -> Query:
    """Register under the function's name.

    Decimals leave as text with all their digits and dates as ISO text, because
    clients of the two engines hand those types over differently.
    """

    def presented(spark: SparkSession, sf_dir: str) -> DataFrame:
        return presentable(build(spark, sf_dir))

    _QUERIES[build.__name__] = presented
    return build


def presentable(df: DataFrame) -> DataFrame:
    shown = {T.DecimalType: "string", T.DateType: "string"}
    return df.select(
        *[
            F.col(f.name).cast(shown[type(f.dataType)]).alias(f.name)
            if type(f.dataType) in shown
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- shared inputs -----------------------------------------------------------


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return fx.view(spark, d, "lineitem", fx.LINES)


def _orders(spark: SparkSession, d: str) -> DataFrame:
    return fx.view(spark, d, "orders", fx.ORDERS)


def _parts(spark: SparkSession, d: str) -> DataFrame:
    return fx.view(spark, d, "part", fx.PARTS)


def _priced_lines(spark: SparkSession, d: str) -> DataFrame:
    return op.build_fact(
        _lines(spark, d),
        _orders(spark, d),
        key="l_orderkey",
        derived={
            "extended_price": fn.extended_price("quantity", "price", "discount"),
            "lead_days": fn.business_days("order_date", "ship_date"),
        },
        spread_by=("l_partkey",),
    )


def _revenue(spark: SparkSession, d: str) -> DataFrame:
    return op.revenue_by_year(
        _priced_lines(spark, d),
        _parts(spark, d),
        key="l_partkey",
        date="order_date",
        amount="extended_price",
        by=["p_type"],
        year_name="order_year",
        value_name="revenue",
    )


def _store(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    raw = fx.raw_tables(spark, d)
    return {c.name: op.conform(raw[c.name], c) for c in sales.CONTRACTS}


def _published(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    store = _store(spark, d)
    orders = sales.publish_orders(store["sales_order_detail"], store["sales_order_header"])
    return orders, sales.publish_product(store["products"])


# --- scalar functions ---------------------------------------------------------


@_query
def normalize_nulls(spark, d):
    """Cleaned text of the order header."""
    return op.normalise(fx.view(spark, d, "orders", fx.RAW_HEADER), sales.SALES_ORDER_HEADER)


REMARKS = TableContract(
    name="remarks",
    columns={"order_id": "INT", "remark": "STRING"},
    primary_key=("order_id",),
    null_tokens=("n/a", "-", "none"),
)


@_query
def normalize_tokens(spark, d):
    """A contract with null tokens of its own; the usual ones are ordinary text to it."""
    return op.conform(fx.view(spark, d, "orders", fx.REMARKS), REMARKS)


@_query
def partial_date(spark, d):
    text = fn.normalize_text("OrderDate")
    return fx.view(spark, d, "orders", fx.RAW_HEADER).select(
        "SalesOrderID",
        fn.partial_date(text).alias("order_date"),
        fn.date_precision(text).alias("date_precision"),
    )


@_query
def business_days(spark, d):
    """Order date to ship date of every line; most supplied lines run backwards."""
    return _priced_lines(spark, d).select(
        "l_orderkey", "l_linenumber", "order_date", "ship_date", "lead_days"
    )


@_query
def business_days_signed(spark, d):
    joined = op.build_fact(_lines(spark, d), _orders(spark, d), key="l_orderkey")
    days = fn.business_days("order_date", "ship_date", reversed_range="negate")
    return joined.select("l_orderkey", "l_linenumber", days.alias("signed_days"))


@_query
def lead_time(spark, d):
    header = _store(spark, d)["sales_order_header"]
    return header.select(
        "SalesOrderID",
        "OrderDatePrecision",
        fn.lead_time("OrderDate", "ShipDate", "OrderDatePrecision").alias("lead_days"),
    )


@_query
def ship_date_modes(spark, d):
    """Incomplete ship dates completed by the cast, and held to a guarded contract."""
    raw = fx.view(spark, d, "orders", fx.RAW_HEADER)
    plain = op.conform(raw, sales.SALES_ORDER_HEADER)
    guarded = op.conform(raw, sales.GUARDED_HEADER)
    lead = fn.lead_time("OrderDate", "ShipDate", "OrderDatePrecision")
    both = fn.lead_time("OrderDate", "ShipDate", "OrderDatePrecision", "ShipDatePrecision")
    shown = ["SalesOrderID", "ShipDate"]
    one = plain.select(
        F.lit("completed").alias("mode"), *shown, F.lit(None).cast("string").alias("precision"), lead.alias("lead_days")
    )
    two = guarded.select(
        F.lit("guarded").alias("mode"), *shown, F.col("ShipDatePrecision").alias("precision"), both.alias("lead_days")
    )
    return one.unionByName(two)


@_query
def extended_price(spark, d):
    price = fn.extended_price("quantity", "price", "discount")
    return _lines(spark, d).select("l_orderkey", "l_linenumber", price.alias("extended_price"))


# --- sources and layers ---------------------------------------------------------


@_query
def raw_scan(spark, d):
    """CSV written from the order header, read back as text."""
    path = f"{scratch_dir(spark)}/table"
    written = fx.view(spark, d, "orders", fx.RAW_HEADER)
    written.write.options(
        header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    return scan_delimited(spark, path)


@_query
def raw_scan_malformed(spark, d):
    """Lines with a field too many or too few keep their full text."""
    path = f"{scratch_dir(spark)}/table"
    fx.view(spark, d, "orders", fx.BROKEN_LINES).write.text(path)
    columns = ["order_id", "status", "priority"]
    return scan_delimited(
        spark, path, columns=columns, corrupt_column="malformed_line", header="false"
    )


@_query
def layer_roundtrip(spark, d):
    return write_layer(_lines(spark, d), layer_path(scratch_dir(spark), "store", "lines")).frame


@_query
def layer_counts(spark, d):
    """Row counts observed while three tables are written, side by side."""
    root = scratch_dir(spark)
    frames = {
        "lines": _lines(spark, d),
        "orders": _orders(spark, d),
        "parts": _parts(spark, d),
    }
    written = together(
        spark,
        {
            name: lambda n=name, f=frame: write_layer(f, layer_path(root, "store", n))
            for name, frame in frames.items()
        },
    )
    rows = [(name, table.rows) for name, table in written.items()]
    return spark.createDataFrame(rows, "layer_table string, rows bigint")


@_query
def result_export(spark, d):
    """An answer exported as CSV, read back as text."""
    path = f"{scratch_dir(spark)}/table"
    export_csv(op.top_by_group(_revenue(spark, d), "order_year", "revenue"), path)
    return scan_delimited(spark, path)


@_query
def answer_export(spark, d):
    """Hard texts as a layer, exported from it as CSV, and read back from that."""
    root = scratch_dir(spark)
    texts = fx.view(spark, d, "orders", fx.HARD_TEXTS)
    layer = publish_layer(texts, layer_path(root, "analysis", "texts"), {"row_hash": row_hash(texts)})
    export_csv(layer.frame, f"{root}/texts", verify=layer.metrics["row_hash"])
    return read_export(spark, f"{root}/texts", texts.schema)


@_query
def layer_versions(spark, d):
    """A table published twice: readers get the second version, with the figures of its write."""
    path = layer_path(scratch_dir(spark), "store", "orders")
    orders = _orders(spark, d)
    publish_layer(orders.withColumn("order_date", F.lit(None).cast("date")), path)
    publish_layer(orders, path, {"dated": F.count("order_date")}, in_order=True)
    current = read_layer(spark, path)
    return current.frame.withColumn("dated", F.lit(current.metrics["dated"]))


@_query
def drifting_headers(spark, d):
    """Extracts of one table whose files differ in columns and in their order."""
    root = scratch_dir(spark)
    orders = fx.table(spark, d, "orders")
    for number, (where, columns) in enumerate(fx.DRIFTING):
        orders.where(where).select(*columns).write.option("header", True).csv(f"{root}/orders/{number}")
    return scan_drifting(spark, f"{root}/orders")


# --- conform --------------------------------------------------------------------


@_query
def typed_store(spark, d):
    """The order header: partial dates, flags, nullable keys, amounts."""
    return _store(spark, d)["sales_order_header"]


@_query
def typed_store_products(spark, d):
    return _store(spark, d)["products"]


@_query
def typed_store_detail(spark, d):
    return _store(spark, d)["sales_order_detail"]


def _audit(spark: SparkSession, d: str, contract: TableContract) -> DataFrame:
    return op.cast_failures(fx.raw_tables(spark, d)[contract.name], contract)


@_query
def cast_audit(spark, d):
    return _audit(spark, d, sales.SALES_ORDER_HEADER)


@_query
def cast_audit_products(spark, d):
    return _audit(spark, d, sales.PRODUCTS)


CHANGED = TableContract(
    "changed",
    {"o_orderkey": "INT", "amount": "DECIMAL(19,4)", "rate": "DECIMAL(9,2)", "placed": "DATE"},
    ("o_orderkey",),
)


@_query
def changed_values(spark, d):
    """Values that casts completed, rounded or shortened without failing."""
    return op.changed_values(fx.view(spark, d, "orders", fx.CHANGED_VALUES), CHANGED)


# --- quality --------------------------------------------------------------------


@_query
def null_profile(spark, d):
    return op.null_profile(_store(spark, d)["sales_order_header"])


@_query
def pk_check(spark, d):
    """A composite key that the supplied lines violate."""
    return op.check_primary_key(fx.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@_query
def pk_check_products(spark, d):
    """Duplicate and NULL keys."""
    return op.check_primary_key(_store(spark, d)["products"], ["ProductID"])


@_query
def duplicate_keys(spark, d):
    lines = fx.table(spark, d, "lineitem")
    return op.duplicate_keys(lines, ["l_orderkey", "l_linenumber"], "copies")


@_query
def fk_check(spark, d):
    child = fx.view(spark, d, "lineitem", fx.CHILD_LINES)
    parent = fx.view(spark, d, "orders", fx.PARENT_ORDERS, fx.PARENT_KEPT)
    return op.check_foreign_key(child, "l_orderkey", parent, "o_orderkey")


@_query
def childless_parents(spark, d):
    orders = fx.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return op.childless_parents(orders, "o_orderkey", fx.table(spark, d, "lineitem"), "l_orderkey")


@_query
def anomaly_counts(spark, d):
    store = _store(spark, d)
    counted = [
        op.count_rules(store[name], [r for r in sales.RULES if r.table == name])
        for name in ("sales_order_header", "sales_order_detail")
    ]
    return counted[0].unionByName(counted[1])


@_query
def anomaly_partial_dates(spark, d):
    rule = next(r for r in sales.RULES if r.name == "partial_order_date")
    return op.rule_rows(_store(spark, d)[rule.table], rule)


@_query
def anomaly_reversed_lines(spark, d):
    """A listed rule over joined rows: lines shipped before they were ordered."""
    rule = RowRule(
        "lines", "ship_before_order", "ship_date < order_date", ("l_orderkey", "l_linenumber")
    )
    return op.rule_rows(_priced_lines(spark, d), rule)


@_query
def conditional_null(spark, d):
    header = _store(spark, d)["sales_order_header"]
    return op.conditional_null(header, "SalesPersonID", F.col("OnlineOrderFlag"))


@_query
def quality_report(spark, d):
    return op.quality_report(
        fx.raw_tables(spark, d), sales.CONTRACTS, sales.FOREIGN_KEYS, sales.RULES
    )


# Keys of one type that refer to keys of another.
TYPED = (
    TableContract(
        "lines",
        {"l_orderkey": "DECIMAL(19,4)", "l_linenumber": "INT", "l_partkey": "BIGINT"},
        ("l_orderkey", "l_linenumber"),
    ),
    TableContract("placed", {"o_orderkey": "INT", "o_custkey": "BIGINT"}, ("o_orderkey",)),
    TableContract("parts", {"p_partkey": "INT"}, ("p_partkey",)),
    TableContract("buyers", {"c_custkey": "DECIMAL(19,4)"}, ("c_custkey",)),
)
TYPED_REFERENCES = (
    ForeignKey("lines", "l_orderkey", "placed", "o_orderkey"),
    ForeignKey("lines", "l_partkey", "parts", "p_partkey"),
    ForeignKey("placed", "o_custkey", "buyers", "c_custkey"),
)


@_query
def typed_key_report(spark, d):
    """Primary and foreign keys of INT, BIGINT and DECIMAL columns in one report."""
    store = {}
    for contract in TYPED:
        base, columns = fx.TYPED_KEYS[contract.name]
        store[contract.name] = op.conform(fx.view(spark, d, base, columns), contract)
    first, *rest = op.key_report(store, TYPED, TYPED_REFERENCES)
    for part in rest:
        first = first.unionByName(part)
    return first


# --- shape ------------------------------------------------------------------------


def _best(spark: SparkSession, d: str, rank: str) -> DataFrame:
    return op.keep_best(
        _store(spark, d)["products"],
        key=["ProductID"],
        complete=["ProductCategoryName", "ProductSubCategoryName"],
        order=["ProductSubCategoryName", "ProductNumber"],
        rank=rank,
    ).select("ProductID", "ProductNumber", "Color", "ProductCategoryName", "ProductSubCategoryName")


@_query
def keep_best(spark, d):
    return _best(spark, d, "additive")


@_query
def keep_best_lexicographic(spark, d):
    return _best(spark, d, "lexicographic")


@_query
def null_label(spark, d):
    products = _store(spark, d)["products"].select("ProductID", "ProductNumber", "Color")
    return op.null_label(products, ["Color"], sales.COLOR_LABEL)


@_query
def map_category(spark, d):
    products = _store(spark, d)["products"].select(
        "ProductID", "ProductCategoryName", "ProductSubCategoryName"
    )
    return op.map_values(
        products, "ProductCategoryName", "ProductSubCategoryName", sales.CATEGORY_RULES
    )


@_query
def map_category_table(spark, d):
    """Lines labelled by as many rules as there are orders."""
    lines = fx.view(spark, d, "lineitem", fx.TAGGED_LINES)
    rules = fx.view(spark, d, "orders", fx.TAG_RULES)
    spread_by, folder = ("l_orderkey", "l_linenumber"), f"{scratch_dir(spark)}/rules"
    return op.map_values_table(lines, "category", "tag", rules, spread_by, folder)


@_query
def publish_product(spark, d):
    return sales.publish_product(_store(spark, d)["products"])


@_query
def publish_orders(spark, d):
    return _published(spark, d)[0]


@_query
def hot_order(spark, d):
    """A third of the lines belong to one order, and some to none."""
    lines = fx.view(spark, d, "lineitem", fx.HOT_LINES)
    return op.build_fact(lines, _orders(spark, d), "l_orderkey", even=True)


# --- grouped questions ------------------------------------------------------------


@_query
def revenue_by_year_group(spark, d):
    return _revenue(spark, d)


@_query
def top_by_year(spark, d):
    """Flagship: the part type with the highest revenue of each order year."""
    return op.top_by_group(_revenue(spark, d), "order_year", "revenue")


@_query
def top2_by_year(spark, d):
    return op.top_by_group(_revenue(spark, d), "order_year", "revenue", 2, "revenue_rank")


@_query
def top_color_by_year(spark, d):
    """The shipped question over the shipped configuration."""
    return sales.top_color_by_year(*_published(spark, d), folder=f"{scratch_dir(spark)}/revenue")


@_query
def avg_by_category(spark, d):
    return op.average_by_group(
        _priced_lines(spark, d),
        _parts(spark, d),
        key="l_partkey",
        group="p_type",
        value="lead_days",
        average_name="avg_lead_days",
        count_name="lines_with_lead_time",
    )


@_query
def avg_lead_time_by_category(spark, d):
    """The shipped question over the shipped configuration."""
    return sales.average_lead_time_by_category(*_published(spark, d))


@_query
def revenue_by_precision(spark, d):
    return sales.revenue_by_year_and_color(
        *_published(spark, d), split_by=("OrderDatePrecision",)
    )


@_query
def even_revenue(spark, d):
    """Revenue added up per product before the products are joined."""
    return sales.revenue_by_year_and_color(*_published(spark, d), even=True)


@_query
def even_lead_time(spark, d):
    """Lead times added up per product before the products are joined."""
    return sales.average_lead_time_by_category(*_published(spark, d), even=True)


@_query
def lag_histogram(spark, d):
    return op.lag_histogram(_store(spark, d)["sales_order_header"], "OrderDate", "ShipDate")


@_query
def date_span(spark, d):
    return op.date_span(_store(spark, d)["sales_order_header"], ["OrderDate", "ShipDate"])


# --- everything -------------------------------------------------------------------


def _extracts(spark: SparkSession, root: str, frames: dict[str, DataFrame]) -> dict[str, str]:
    """CSV extracts of the frames, header line included."""
    inputs = {}
    for name, frame in frames.items():
        inputs[name] = f"{root}/input/{name}"
        frame.write.options(
            header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        ).csv(inputs[name])
    return inputs


def _with_surplus(spark: SparkSession, d: str, path: str) -> None:
    """The order headers as CSV lines, some of which have a field too many."""
    listed = ", ".join(f"coalesce({expression}, '')" for expression in fx.RAW_HEADER.values())
    line = f"concat_ws(',', {listed}, case when {fx.SURPLUS} then 'surplus' end)"
    lines = fx.table(spark, d, "orders").selectExpr(f"{line} AS `{','.join(fx.RAW_HEADER)}`")
    lines.write.options(
        header=True, sep="\x01", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


def _report_items(report: DataFrame) -> DataFrame:
    return report.select(
        F.concat_ws(":", "table", "check").alias("item"),
        F.col("column").alias("detail"),
        "metric",
        F.col("value").cast("string").alias("value"),
    )


@_query
def end_to_end(spark, d):
    """Three CSV extracts through every stage; report and both answers as long rows."""
    root = scratch_dir(spark)
    raw = fx.raw_tables(spark, d)
    inputs = {"sales_order_header": f"{root}/input/sales_order_header"}
    _with_surplus(spark, d, inputs["sales_order_header"])
    inputs |= _extracts(spark, root, {n: f for n, f in raw.items() if n not in inputs})
    result = run_plan(spark, sales.PLAN, inputs, f"{root}/output")
    top = result.analysis["top_color_by_year"].select(
        F.concat(F.lit("top_color:"), F.col("OrderYear")).alias("item"),
        F.col("Color").alias("detail"),
        F.lit("revenue").alias("metric"),
        F.col("Revenue").cast("string").alias("value"),
    )
    category = result.analysis["avg_lead_time_by_category"].select(
        F.lit("lead_time").alias("item"),
        F.col("ProductCategoryName").alias("detail"),
        F.expr(
            "inline(array("
            "struct('average' as metric, cast(cast(AvgLeadTimeInBusinessDays as decimal(19,2)) as string) as value), "
            "struct('lines' as metric, string(OrderLinesWithLeadTime) as value)))"
        ),
    )
    return _report_items(result.quality.frame).unionByName(top).unionByName(category)


# A second set of tables for the same stages.
CUSTOMERS = RunPlan(
    contracts=(
        TableContract("nation", {"n_nationkey": "INT", "n_name": "STRING"}, ("n_nationkey",)),
        TableContract(
            "customer",
            {"c_custkey": "INT", "c_nationkey": "INT", "c_acctbal": "DECIMAL(19,4)"},
            ("c_custkey",),
        ),
        TableContract(
            "orders",
            {"o_orderkey": "BIGINT", "o_custkey": "INT", "o_orderdate": "DATE", "o_totalprice": "DECIMAL(19,4)"},
            ("o_orderkey", "o_custkey"),
        ),
    ),
    foreign_keys=(
        ForeignKey("customer", "c_nationkey", "nation", "n_nationkey"),
        ForeignKey("orders", "o_custkey", "customer", "c_custkey"),
    ),
    rules=(RowRule("customer", "in_debt", "c_acctbal < 0"),),
    publish={
        "placed": lambda t: op.build_fact(
            t["orders"], t["customer"].withColumnRenamed("c_custkey", "o_custkey"), "o_custkey"
        ).withColumnRenamed("c_nationkey", "n_nationkey"),
        "nations": lambda t: op.null_label(t["nation"], ["n_name"], "(unknown)"),
    },
    publish_rules=(RowRule("placed", "without_customer", "n_nationkey IS NULL"),),
    questions={
        "top_nation_by_year": lambda t: op.top_by_group(
            op.revenue_by_year(
                t["placed"], t["nations"], "n_nationkey", "o_orderdate", "o_totalprice", ["n_name"], "order_year", "revenue"
            ),
            "order_year",
            "revenue",
        )
    },
)


@_query
def run_customers(spark, d):
    """The same stages on customers, nations and orders; report and answer as long rows."""
    root = scratch_dir(spark)
    frames = {
        contract.name: fx.view(spark, d, contract.name, fx.CUSTOMER_TABLES[contract.name])
        for contract in CUSTOMERS.contracts
    }
    result = run_plan(spark, CUSTOMERS, _extracts(spark, root, frames), f"{root}/output")
    top = result.analysis["top_nation_by_year"].select(
        F.concat(F.lit("top_nation:"), F.col("order_year")).alias("item"),
        F.col("n_name").alias("detail"),
        F.lit("revenue").alias("metric"),
        F.col("revenue").cast("string").alias("value"),
    )
    return _report_items(result.quality.frame).unionByName(top)


# A run whose answer holds texts that an export easily damages.
TEXTS = RunPlan(
    contracts=(
        TableContract("orders", {"o_orderkey": "BIGINT", "o_orderstatus": "STRING", "o_orderpriority": "STRING"}, ("o_orderkey",)),
    ),
    publish={"orders": lambda t: t["orders"]},
    questions={
        "remarks": lambda t: t["orders"]
        .selectExpr(f"{fx.HARD_TEXTS['remark']} AS remark", f"{fx.HARD_TEXTS['other']} AS other")
        .groupBy("remark", "other")
        .agg(F.count(F.lit(1)).alias("orders"))
        .orderBy("remark", "other")
    },
)


@_query
def run_texts(spark, d):
    """The answer that a run hands back, line breaks, blanks and empty texts included."""
    root = scratch_dir(spark)
    orders = fx.table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    result = run_plan(spark, TEXTS, _extracts(spark, root, {"orders": orders}), f"{root}/output")
    return result.analysis["remarks"]


# More lost balances, or more orders without a customer, than this stop a run.
GATE = (
    Limit("cast_failures", "failures", at_most=0),
    Limit("foreign_key", "orphans", share=0.01),
    Limit("primary_key", "duplicate_rows", table="nation", at_most=0),
)


@_query
def run_gate(spark, d):
    """A run within no limits, then one that breaks them: its breaches, and the rows that the
    first one published and the second one left."""
    root = scratch_dir(spark)
    frames = {
        contract.name: fx.view(spark, d, contract.name, fx.CUSTOMER_TABLES[contract.name])
        for contract in CUSTOMERS.contracts
    }
    inputs = _extracts(spark, root, frames)
    run_plan(spark, CUSTOMERS, inputs, f"{root}/output")
    try:
        run_plan(spark, replace(CUSTOMERS, limits=GATE), inputs, f"{root}/output")
        breaches = []
    except LimitExceeded as stopped:
        breaches = stopped.breaches
    kept = read_layer(spark, layer_path(f"{root}/output", "publish", "placed"))
    rows = [(f"{b.table}:{b.check}", b.column, b.value, b.at_most) for b in breaches]
    rows.append(("published", "placed", kept.frame.count(), None))
    return spark.createDataFrame(rows, "item string, detail string, value bigint, at_most bigint")
