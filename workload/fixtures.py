"""Views over the supplied tables, as SQL that Spark and DuckDB both read.

The supplied tables are clean, so the dirt the operators deal with is derived
here: every view covers all rows of its table. Texts follow the sales extracts,
so that the shipped configuration itself is what gets exercised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _money_text(column: str) -> str:
    return f"cast(cast({column} as decimal(19,4)) as string)"


# view column -> expression over the base table

LINES = {
    "l_orderkey": "l_orderkey",
    "l_linenumber": "l_linenumber",
    "l_partkey": "l_partkey",
    "quantity": "cast(l_quantity as int)",
    "price": "cast(l_extendedprice as decimal(19,4))",
    "discount": "cast(l_discount as decimal(19,4))",
    "ship_date": "cast(l_shipdate as date)",
}

ORDERS = {
    "l_orderkey": "o_orderkey",
    "o_custkey": "o_custkey",
    "order_date": "cast(o_orderdate as date)",
    "order_total": "cast(o_totalprice as decimal(19,4))",
}

PARTS = {"l_partkey": "p_partkey", "p_type": "p_type"}

RAW_HEADER = {
    "SalesOrderID": "cast(o_orderkey as string)",
    "OrderDate": (
        "case when o_orderkey % 97 = 0 then substr(cast(cast(o_orderdate as date) as string), 1, 7) "
        "when o_orderkey % 101 = 0 then ' null ' "
        "when o_orderkey % 103 = 0 then 'not-a-date' "
        "when o_orderkey % 107 = 0 then '' "
        "when o_orderkey % 109 = 0 then '2001-02-30' "
        "else ' ' || cast(cast(o_orderdate as date) as string) end"
    ),
    "ShipDate": (
        "case when o_orderkey % 113 = 0 then 'NULL' "
        "when o_orderkey % 127 = 0 then substr(cast(cast(o_orderdate as date) as string), 1, 7) "
        "when o_orderkey % 131 = 0 then substr(cast(cast(o_orderdate as date) as string), 1, 4) "
        "else cast(cast(o_orderdate as date) + cast(o_custkey % 15 - 1 as int) as string) end"
    ),
    "OnlineOrderFlag": "case when o_orderstatus = 'F' then 'True' else 'False' end",
    "AccountNumber": "' ' || o_orderpriority || ' '",
    "CustomerID": "cast(o_custkey as string)",
    "SalesPersonID": (
        "case when (o_orderstatus = 'F') <> (o_orderkey % 500 = 0) then 'NULL' "
        "else cast(o_custkey as string) end"
    ),
    "Freight": (
        "case when o_orderkey % 89 = 0 then 'NULL' when o_orderkey % 83 = 0 then '12x' "
        f"else {_money_text('o_totalprice')} end"
    ),
}

RAW_DETAIL = {
    "SalesOrderID": (
        "case when l_partkey % 90 = 0 then 'null' when l_orderkey % 60 = 0 "
        "then cast(-l_orderkey as string) else cast(l_orderkey as string) end"
    ),
    "SalesOrderDetailID": "cast(l_orderkey * 8 + l_linenumber as string)",
    "OrderQty": (
        "case when l_partkey % 50 = 0 then cast(-cast(l_quantity as int) as string) "
        "else cast(cast(l_quantity as int) as string) end"
    ),
    "ProductID": (
        "case when l_partkey % 77 = 0 then cast(l_partkey + 1000000000 as string) "
        "else cast(l_partkey as string) end"
    ),
    "UnitPrice": (
        f"case when l_partkey % 64 = 0 then '.0000' else {_money_text('l_extendedprice')} end"
    ),
    "UnitPriceDiscount": _money_text("l_discount"),
}

_SUB_CATEGORY = (
    "case split_part(p_name, ' ', -1) when 'ring' then 'Gloves' when 'rod' then 'Helmets' "
    "when 'bolt' then 'Bib-Shorts' when 'gear' then 'Mountain Frames' when 'plate' then 'Wheels' "
    "when 'gizmo' then 'Caps' when 'anvil' then 'Pumps' else 'frames' end"
)

RAW_PRODUCTS = {
    "ProductID": "cast(p_partkey as string)",
    "ProductDesc": "p_name",
    "ProductNumber": "p_brand",
    "MakeFlag": "case when p_size % 2 = 0 then 'True' else 'False' end",
    "Color": "case when p_partkey % 11 = 0 then 'Null' else split_part(p_name, ' ', 1) end",
    "SafetyStockLevel": "cast(p_size * 10 as string)",
    "ReorderPoint": "case when p_partkey % 29 = 0 then 'n/a' else cast(p_size as string) end",
    "StandardCost": _money_text("p_retailprice"),
    "ListPrice": (
        f"case when p_partkey % 41 = 0 then '$' || {_money_text('p_retailprice')} "
        f"else {_money_text('p_retailprice')} end"
    ),
    "Size": "case when p_size < 10 then 'M' else cast(p_size as string) end",
    "SizeUnitMeasureCode": "case when p_size < 10 then '' else 'CM' end",
    "Weight": "case when p_partkey % 31 = 0 then 'heavy' else cast(p_size as string) || '.25' end",
    "WeightUnitMeasureCode": "'LB'",
    "ProductCategoryName": "case when p_partkey % 3 = 0 then 'NULL' else p_type end",
    "ProductSubCategoryName": _SUB_CATEGORY,
}

# Order headers that arrive with a field too many.
SURPLUS = "o_orderkey % 150 = 0"

# Comments that stand for a missing value in more than the usual ways.
REMARKS = {
    "order_id": "cast(o_orderkey as string)",
    "remark": (
        "case o_orderkey % 7 when 0 then ' N/A' when 1 then 'n/a ' when 2 then '-' "
        "when 3 then 'None' when 4 then '' when 5 then 'null' else o_orderpriority end"
    ),
}

# A second, conflicting row for some products; a few of these have lost their key.
RAW_PRODUCT_COPIES = {
    **RAW_PRODUCTS,
    "ProductID": "case when p_partkey % 185 = 0 then ' null' else cast(p_partkey as string) end",
    "Color": "'NULL'",
    "ProductCategoryName": "case when p_partkey % 2 = 0 then 'Copied' else 'NULL' end",
    "ProductSubCategoryName": f"case when p_partkey % 4 = 0 then '' else {_SUB_CATEGORY} end",
}
COPIED = "p_partkey % 37 = 0"

# Lines some of which have lost their order, and orders some of which are gone.
CHILD_LINES = {
    "l_orderkey": "case when l_partkey % 90 = 0 then null else l_orderkey end",
    "l_partkey": "l_partkey",
}
PARENT_ORDERS = {"o_orderkey": "o_orderkey"}
PARENT_KEPT = "o_orderkey % 50 <> 0"

# Comma-joined header lines with surplus and missing fields.
BROKEN_LINES = {
    "line": (
        "case when o_orderkey % 50 = 0 "
        "then cast(o_orderkey as string) || ',' || o_orderstatus || ',' || o_orderpriority || ',x' "
        "when o_orderkey % 77 = 0 then cast(o_orderkey as string) || ',' || o_orderstatus "
        "else cast(o_orderkey as string) || ',' || o_orderstatus || ',' || o_orderpriority end"
    ),
}


# Customers, their nations and orders as text, with lost keys.
CUSTOMER_TABLES = {
    "nation": {"n_nationkey": "cast(n_nationkey as string)", "n_name": "case when n_nationkey = 7 then ' ' else n_name end"},
    "customer": {
        "c_custkey": "cast(c_custkey as string)",
        "c_nationkey": "case when c_custkey % 40 = 0 then '99' else cast(c_nationkey as string) end",
        "c_acctbal": "case when c_custkey % 70 = 0 then 'none' else cast(cast(c_acctbal as decimal(19,4)) as string) end",
    },
    "orders": {
        "o_orderkey": "cast(o_orderkey as string)",
        "o_custkey": (
            "case when o_orderkey % 30 = 0 then 'NULL' when o_orderkey % 80 = 0 then '-5' "
            "else cast(o_custkey as string) end"
        ),
        "o_orderdate": (
            "case when o_orderkey % 90 = 1 then substr(cast(cast(o_orderdate as date) as string), 1, 7) "
            "else cast(cast(o_orderdate as date) as string) end"
        ),
        "o_totalprice": "cast(cast(o_totalprice as decimal(19,4)) as string)",
    },
}


# Texts that an export easily damages: line breaks, edge blanks, empty text, quotes, backslashes.
HARD_TEXTS = {
    "o_orderkey": "o_orderkey",
    "remark": (
        "case o_orderkey % 18 when 0 then 'a' || chr(10) || 'b' when 1 then ' x' when 2 then 'x ' "
        "when 3 then '' when 4 then chr(9) || 'Red' when 5 then 'say \"hi\"' when 6 then '\"\"' "
        "when 7 then chr(92) when 8 then 'ends in ' || chr(92) when 9 then chr(92) || '\"' "
        "when 10 then 'a,b' when 11 then null when 12 then chr(13) || chr(10) when 13 then 'NULL' "
        "when 14 then '#' when 15 then ' ' when 16 then chr(10) else o_orderpriority end"
    ),
    "other": "case o_orderkey % 5 when 0 then null when 1 then '' else o_orderstatus end",
}

# Keys that arrive in one type on one side and in another on the other.
TYPED_KEYS = {
    "lines": (
        "lineitem",
        {
            "l_orderkey": (
                "case when l_partkey % 90 = 0 then 'null' when l_orderkey % 60 = 0 "
                "then cast(l_orderkey as string) || '.5' else cast(l_orderkey as string) || '.0000' end"
            ),
            "l_linenumber": "cast(l_linenumber as string)",
            "l_partkey": (
                "case when l_partkey % 77 = 0 then cast(l_partkey + 5000000000 as string) "
                "else cast(l_partkey as string) end"
            ),
        },
    ),
    "placed": (
        "orders",
        {
            "o_orderkey": "case when o_orderkey % 70 = 0 then '-1' else cast(o_orderkey as string) end",
            "o_custkey": "case when o_orderkey % 30 = 0 then '-7' else cast(o_custkey as string) end",
        },
    ),
    "parts": ("part", {"p_partkey": "cast(p_partkey as string)"}),
    "buyers": (
        "customer",
        {"c_custkey": "case when c_custkey % 40 = 0 then cast(c_custkey as string) || '.25' else cast(c_custkey as string) end"},
    ),
}

# Amounts with more digits than their type keeps, and dates with more or less than a date.
CHANGED_VALUES = {
    "o_orderkey": "cast(o_orderkey as string)",
    "amount": (
        f"case o_orderkey % 6 when 0 then {_money_text('o_totalprice')} || '5' "
        f"when 1 then {_money_text('o_totalprice')} || '000' "
        f"when 2 then chr(9) || {_money_text('o_totalprice')} || '01' "
        "when 3 then cast(o_custkey as string) || '1e-4' when 4 then cast(o_custkey as string) || '1E-5' "
        f"else {_money_text('o_totalprice')} end"
    ),
    "rate": "case o_orderkey % 10 when 0 then '0.125' when 1 then '+.1200' when 2 then 'n/a' else '0.1' end",
    "placed": (
        "case o_orderkey % 7 when 0 then chr(9) || substr(cast(cast(o_orderdate as date) as string), 1, 7) "
        "when 1 then substr(cast(cast(o_orderdate as date) as string), 1, 4) || chr(9) "
        "when 2 then cast(cast(o_orderdate as date) as string) || ' 10:30:00' "
        "when 3 then cast(cast(o_orderdate as date) as string) || 'T10:30:00' "
        "else cast(cast(o_orderdate as date) as string) end"
    ),
}

# Lines to be labelled, and a rule for every order.
TAGGED_LINES = {
    "l_orderkey": "l_orderkey",
    "l_linenumber": "l_linenumber",
    "category": "case when l_partkey % 3 = 0 then null else 'Given' end",
    "tag": (
        "case when l_partkey % 45 = 0 then null else 'p' || cast(l_partkey as string) || '-' "
        "|| cast(l_orderkey % 9000 as string) || '-' || cast(l_suppkey as string) end"
    ),
}
TAG_RULES = {
    "rule": "case when o_orderkey % 500 = 2 then 1000000000 else 0 end + o_orderkey",
    "label": "case when o_orderkey % 53 = 0 then null else 'G' || cast(o_orderkey % 97 as string) end",
    "kind": "case when o_orderkey % 3 = 0 then 'equals' else 'contains' end",
    "pattern": (
        "case when o_orderkey % 500 = 2 then 'p' || cast(o_orderkey % 7 as string) "
        "when o_orderkey % 3 = 0 then 'p' || cast(o_custkey as string) || '-' || "
        "cast(o_orderkey % 9000 as string) || '-' || cast(o_orderkey % 100 as string) "
        "when o_orderkey % 3 = 1 then '-' || cast(o_orderkey % 9000 as string) || '-' || cast(o_orderkey % 10 as string) "
        "else cast(o_custkey as string) || '-' || cast(o_orderkey % 1000 as string) || '-' end"
    ),
}

# Lines a third of which are one order's.
HOT_LINES = {
    "l_orderkey": "case when l_partkey % 3 = 0 then 7 when l_partkey % 31 = 1 then null else l_orderkey end",
    "l_linenumber": "l_linenumber",
    "l_partkey": "l_partkey",
}

# The same orders as three files: as declared, with columns in another order, with one column less.
DRIFTING = (
    ("o_orderkey % 3 = 0", ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")),
    ("o_orderkey % 3 = 1", ("o_orderpriority", "o_orderkey", "o_orderstatus", "o_custkey")),
    ("o_orderkey % 3 = 2", ("o_orderkey", "o_orderpriority", "o_orderstatus")),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _view(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{expression} AS {name}" for name, expression in columns.items()])


def view(
    spark: SparkSession, sf_dir: str, base: str, columns: dict[str, str], where: str | None = None
) -> DataFrame:
    df = table(spark, sf_dir, base)
    return _view(df.filter(where) if where else df, columns)


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "part", RAW_PRODUCTS)
    return rows.unionByName(view(spark, sf_dir, "part", RAW_PRODUCT_COPIES, COPIED))


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "products": raw_products(spark, sf_dir),
        "sales_order_header": view(spark, sf_dir, "orders", RAW_HEADER),
        "sales_order_detail": view(spark, sf_dir, "lineitem", RAW_DETAIL),
    }


def view_sql(base: str, columns: dict[str, str], where: str | None = None) -> str:
    listed = ", ".join(f"{expression} AS {name}" for name, expression in columns.items())
    return f"SELECT {listed} FROM {base}" + (f" WHERE {where}" if where else "")
