"""The sales configuration: three extracts, two published tables, two questions.

Everything here is a parameter of a generic operator.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import DataFrame

from strata.contracts import (
    ForeignKey,
    RowRule,
    RunPlan,
    StagedQuestion,
    TableContract,
    ValueRule,
)
from strata.functions import extended_price, lead_time
from strata.operators import (
    average_by_group,
    build_fact,
    keep_best,
    map_values,
    null_label,
    revenue_by_year,
    top_by_group,
)

# Tables, columns, types and keys of the delivered extracts.
PRODUCTS = TableContract(
    name="products",
    columns={
        "ProductID": "INT",
        "ProductDesc": "STRING",
        "ProductNumber": "STRING",
        "MakeFlag": "BOOLEAN",
        "Color": "STRING",
        "SafetyStockLevel": "INT",
        "ReorderPoint": "INT",
        "StandardCost": "DECIMAL(19,4)",
        "ListPrice": "DECIMAL(19,4)",
        "Size": "STRING",
        "SizeUnitMeasureCode": "STRING",
        "Weight": "DECIMAL(9,2)",
        "WeightUnitMeasureCode": "STRING",
        "ProductCategoryName": "STRING",
        "ProductSubCategoryName": "STRING",
    },
    primary_key=("ProductID",),
)
SALES_ORDER_HEADER = TableContract(
    name="sales_order_header",
    columns={
        "SalesOrderID": "INT",
        "OrderDate": "DATE",
        "ShipDate": "DATE",
        "OnlineOrderFlag": "BOOLEAN",
        "AccountNumber": "STRING",
        "CustomerID": "INT",
        "SalesPersonID": "INT",
        "Freight": "DECIMAL(19,4)",
    },
    primary_key=("SalesOrderID",),
    partial_dates={"OrderDate": "OrderDatePrecision"},
)
SALES_ORDER_DETAIL = TableContract(
    name="sales_order_detail",
    columns={
        "SalesOrderID": "INT",
        "SalesOrderDetailID": "INT",
        "OrderQty": "INT",
        "ProductID": "INT",
        "UnitPrice": "DECIMAL(19,4)",
        "UnitPriceDiscount": "DECIMAL(19,4)",
    },
    primary_key=("SalesOrderDetailID",),
)
CONTRACTS = (PRODUCTS, SALES_ORDER_HEADER, SALES_ORDER_DETAIL)

# The header with ship dates held to the same standard as order dates: YYYY-MM gets a
# precision, YYYY is no date. By default both are completed by the cast, and counted.
GUARDED_HEADER = replace(
    SALES_ORDER_HEADER,
    partial_dates={"OrderDate": "OrderDatePrecision", "ShipDate": "ShipDatePrecision"},
)

FOREIGN_KEYS = (
    ForeignKey("sales_order_detail", "SalesOrderID", "sales_order_header", "SalesOrderID"),
    ForeignKey("sales_order_detail", "ProductID", "products", "ProductID"),
)

# Rows worth reporting.
RULES = (
    RowRule(
        "sales_order_header",
        "partial_order_date",
        "OrderDatePrecision = 'month'",
        list_by=("SalesOrderID",),
    ),
    RowRule("sales_order_detail", "order_qty_le_0", "OrderQty <= 0"),
    RowRule("sales_order_detail", "unit_price_eq_0", "UnitPrice = 0"),
    RowRule(
        "sales_order_header",
        "ship_before_order",
        "OrderDatePrecision = 'day' AND ShipDate < OrderDate",
    ),
)

# Counted while the fact table is written: a price that does not fit its type is NULL.
FACT_RULES = (
    RowRule(
        "orders",
        "extended_price_lost",
        "TotalLineExtendedPrice IS NULL AND OrderQty IS NOT NULL "
        "AND UnitPrice IS NOT NULL AND UnitPriceDiscount IS NOT NULL",
    ),
)

# Labels and the category of a sub-category, first match wins.
COLOR_LABEL = "N/A"
CATEGORY_RULES = (
    ValueRule("Clothing", equals=("Gloves", "Shorts", "Socks", "Tights", "Vests")),
    ValueRule(
        "Accessories", equals=("Locks", "Lights", "Headsets", "Helmets", "Pedals", "Pumps")
    ),
    ValueRule("Components", equals=("Wheels", "Saddles"), contains=("Frames",)),
)

# Input file names.
INPUT_FILES = {
    "products": "products.csv",
    "sales_order_header": "sales-order-header.csv",
    "sales_order_detail": "sales-order-detail.csv",
}


def publish_product(products: DataFrame, rank: str = "additive") -> DataFrame:
    """One row per product, colour always set, category filled where a rule knows it."""
    best = keep_best(
        products,
        key=["ProductID"],
        complete=["ProductCategoryName", "ProductSubCategoryName"],
        order=["ProductSubCategoryName", "ProductNumber"],
        rank=rank,
    )
    colored = null_label(best, ["Color"], COLOR_LABEL)
    return map_values(colored, "ProductCategoryName", "ProductSubCategoryName", CATEGORY_RULES)


def publish_orders(detail: DataFrame, header: DataFrame, even: bool = False) -> DataFrame:
    """Order lines with their order, lead time and extended price.

    Freight is an amount of the whole order; its new name keeps it from being
    summed per line. A guarded header's months have no lead time. ``even`` looks
    for orders with very many lines first, and deals these lines over tasks.
    """
    guard = "ShipDatePrecision" if "ShipDatePrecision" in header.columns else None
    return build_fact(
        detail,
        header,
        key="SalesOrderID",
        rename={"Freight": "TotalOrderFreight"},
        derived={
            "LeadTimeInBusinessDays": lead_time(
                "OrderDate", "ShipDate", "OrderDatePrecision", guard
            ),
            "TotalLineExtendedPrice": extended_price("OrderQty", "UnitPrice", "UnitPriceDiscount"),
        },
        spread_by=("ProductID", "OrderQty", "UnitPrice"),
        even=even,
    )


def revenue_by_year_and_color(
    orders: DataFrame, product: DataFrame, split_by: tuple[str, ...] = (), even: bool = False
) -> DataFrame:
    """Revenue per year and colour; ``split_by`` adds fact columns, such as the
    precision of the order date, to reconcile a total. ``even`` adds up the lines of
    each product before the join."""
    return revenue_by_year(
        orders,
        product,
        key="ProductID",
        date="OrderDate",
        amount="TotalLineExtendedPrice",
        by=["Color", *split_by],
        even=even,
    )


def top_color_by_year(
    orders: DataFrame,
    product: DataFrame,
    ranks: int = 1,
    rank_name: str | None = None,
    folder: str | None = None,
) -> DataFrame:
    """Colours with the highest revenue of each year; ``ranks=2`` adds the runner-up.

    The revenue is stored in ``folder`` where one is given, so that it is added up once."""
    revenue = revenue_by_year_and_color(orders, product)
    return top_by_group(revenue, "OrderYear", "Revenue", ranks, rank_name, folder)


def average_lead_time_by_category(
    orders: DataFrame, product: DataFrame, even: bool = False
) -> DataFrame:
    """Average lead time per category over the lines that have one."""
    return average_by_group(
        orders,
        product,
        key="ProductID",
        group="ProductCategoryName",
        value="LeadTimeInBusinessDays",
        average_name="AvgLeadTimeInBusinessDays",
        count_name="OrderLinesWithLeadTime",
        even=even,
    )


Tables = Mapping[str, DataFrame]


def _orders(store: Tables) -> DataFrame:
    return publish_orders(store["sales_order_detail"], store["sales_order_header"], even=True)


def _product(store: Tables) -> DataFrame:
    return publish_product(store["products"])


PLAN = RunPlan(
    contracts=CONTRACTS,
    foreign_keys=FOREIGN_KEYS,
    rules=RULES,
    duplicate_lists={"duplicate_product_ids": "products"},
    publish={"product": _product, "orders": _orders},
    publish_rules=FACT_RULES,
    questions={
        "top_color_by_year": StagedQuestion(
            figures=lambda t: revenue_by_year_and_color(t["orders"], t["product"], even=True),
            answer=lambda revenue: top_by_group(revenue, "OrderYear", "Revenue"),
        ),
        "avg_lead_time_by_category": lambda t: average_lead_time_by_category(
            t["orders"], t["product"], even=True
        ),
    },
    input_files=INPUT_FILES,
)
GUARDED_PLAN = replace(PLAN, contracts=(PRODUCTS, GUARDED_HEADER, SALES_ORDER_DETAIL))
