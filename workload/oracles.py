"""DuckDB SQL for every query, over whole tables.

Written from what each operator is meant to return, not from how Spark gets
there: business days, for instance, are counted day by day.
"""

from __future__ import annotations

from strata.contracts import TableContract
from strata.plans import sales
from workload import fixtures as fx

DAY = r"'^[0-9]{4}-[0-9]{2}-[0-9]{2}\z'"
MONTH = r"'^[0-9]{4}-[0-9]{2}\z'"


def _clean(column: str, tokens: tuple[str, ...] = ("", "NULL")) -> str:
    listed = ", ".join(f"'{token.upper()}'" for token in tokens)
    return f"CASE WHEN upper(trim({column})) IN ({listed}) THEN NULL ELSE trim({column}) END"


def _cleaned(table: str, contract: TableContract) -> str:
    listed = ", ".join(f"{_clean(c)} AS {c}" for c in contract.columns)
    return f"SELECT {listed} FROM {table}"


def _date(c: str) -> str:
    return (
        f"CASE WHEN regexp_matches({c}, {DAY}) THEN try_cast({c} AS DATE) "
        f"WHEN regexp_matches({c}, {MONTH}) THEN try_cast({c} || '-01' AS DATE) END"
    )


def _precision(c: str) -> str:
    return (
        f"CASE WHEN regexp_matches({c}, {DAY}) THEN 'day' "
        f"WHEN regexp_matches({c}, {MONTH}) THEN 'month' END"
    )


def _typed_value(c: str, sql_type: str, contract: TableContract) -> str:
    if c in contract.partial_dates:
        return _date(c)
    if sql_type == "DATE":
        return _completed_date(c)
    return c if sql_type == "STRING" else f"try_cast({c} AS {sql_type})"


def _completed_date(c: str) -> str:
    """A date whose missing day, or month and day, are taken for the first."""
    return (
        f"CASE WHEN regexp_matches({c}, '^[0-9]{{4}}\\z') THEN try_cast({c} || '-01-01' AS DATE) "
        f"WHEN regexp_matches({c}, {MONTH}) THEN try_cast({c} || '-01' AS DATE) "
        f"ELSE try_cast({c} AS DATE) END"
    )


def _typed(table: str, contract: TableContract) -> str:
    listed = []
    for c, t in contract.columns.items():
        listed.append(f"{_typed_value(c, t, contract)} AS {c}")
        if c in contract.partial_dates:
            listed.append(f"{_precision(c)} AS {contract.partial_dates[c]}")
    return f"SELECT {', '.join(listed)} FROM {table}"


def _days(start: str, end: str) -> str:
    """Day-by-day count of Mondays to Fridays after start up to end."""
    return (
        f"CASE WHEN {end} >= {start} THEN CAST(len(list_filter("
        f"generate_series({start} + 1, {end}, INTERVAL 1 DAY), "
        "lambda x: isodow(x) < 6)) AS INTEGER) END"
    )


RAW_PRODUCTS = (
    f"{fx.view_sql('part', fx.RAW_PRODUCTS)} UNION ALL "
    f"{fx.view_sql('part', fx.RAW_PRODUCT_COPIES, fx.COPIED)}"
)

# Common table expressions, by name.
CTES = {
    "lines": fx.view_sql("lineitem", fx.LINES),
    "ords": fx.view_sql("orders", fx.ORDERS),
    "parts": fx.view_sql("part", fx.PARTS),
    "priced": (
        "SELECT l.*, o.order_date, o.order_total, "
        "CAST(l.quantity * (l.price - l.discount) AS DECIMAL(19,4)) AS extended_price "
        "FROM lines l LEFT JOIN ords o ON l.l_orderkey = o.l_orderkey"
    ),
    "revenue": (
        "SELECT CAST(year(order_date) AS INTEGER) AS order_year, p_type, "
        "sum(extended_price) AS revenue "
        "FROM priced f JOIN parts p ON f.l_partkey = p.l_partkey GROUP BY 1, 2"
    ),
    "raw_header": fx.view_sql("orders", fx.RAW_HEADER),
    "raw_detail": fx.view_sql("lineitem", fx.RAW_DETAIL),
    "raw_products": RAW_PRODUCTS,
    "clean_header": _cleaned("raw_header", sales.SALES_ORDER_HEADER),
    "clean_detail": _cleaned("raw_detail", sales.SALES_ORDER_DETAIL),
    "clean_products": _cleaned("raw_products", sales.PRODUCTS),
    "header": _typed("clean_header", sales.SALES_ORDER_HEADER),
    "detail": _typed("clean_detail", sales.SALES_ORDER_DETAIL),
    "products": _typed("clean_products", sales.PRODUCTS),
    "best_products": (
        "SELECT * EXCLUDE (pos) FROM (SELECT *, row_number() OVER (PARTITION BY ProductID ORDER BY "
        "(ProductCategoryName IS NULL)::INT + (ProductSubCategoryName IS NULL)::INT, "
        "ProductSubCategoryName NULLS LAST, ProductNumber NULLS LAST, "
        "{rest}) AS pos FROM products) WHERE pos = 1"
    ),
    "product": (
        "SELECT * REPLACE (coalesce(Color, 'N/A') AS Color, "
        "{category} AS ProductCategoryName) FROM best_products"
    ),
    "fact": (
        "SELECT d.*, h.* EXCLUDE (SalesOrderID, Freight), h.Freight AS TotalOrderFreight, "
        "CASE WHEN h.OrderDatePrecision = 'month' THEN NULL ELSE "
        + _days("h.OrderDate", "h.ShipDate")
        + " END AS LeadTimeInBusinessDays, "
        "CAST(d.OrderQty * (d.UnitPrice - d.UnitPriceDiscount) AS DECIMAL(19,4)) "
        "AS TotalLineExtendedPrice "
        "FROM detail d LEFT JOIN header h ON d.SalesOrderID = h.SalesOrderID"
    ),
    "color_revenue": (
        "SELECT CAST(year(OrderDate) AS INTEGER) AS OrderYear, Color, "
        "sum(TotalLineExtendedPrice) AS Revenue "
        "FROM fact f JOIN product p ON f.ProductID = p.ProductID GROUP BY 1, 2"
    ),
    "top_color": (
        "SELECT OrderYear, Color, Revenue FROM (SELECT *, rank() OVER "
        "(PARTITION BY OrderYear ORDER BY Revenue DESC NULLS LAST) AS r FROM color_revenue) "
        "WHERE r = 1"
    ),
    "category_lead": (
        "SELECT coalesce(ProductCategoryName, '(Uncategorized)') AS ProductCategoryName, "
        "AvgLeadTimeInBusinessDays, OrderLinesWithLeadTime FROM ("
        "SELECT ProductCategoryName, round(avg(LeadTimeInBusinessDays), 2) "
        "AS AvgLeadTimeInBusinessDays, count(LeadTimeInBusinessDays) AS OrderLinesWithLeadTime "
        "FROM fact f JOIN product p ON f.ProductID = p.ProductID GROUP BY 1)"
    ),
}

_KEPT_FIRST = ("ProductID", "ProductSubCategoryName", "ProductNumber")
_REST = ", ".join(f"{c} NULLS LAST" for c in sales.PRODUCTS.columns if c not in _KEPT_FIRST)
_CATEGORY = (
    "CASE WHEN ProductCategoryName IS NOT NULL THEN ProductCategoryName "
    "WHEN ProductSubCategoryName IN ('Gloves', 'Shorts', 'Socks', 'Tights', 'Vests') THEN 'Clothing' "
    "WHEN ProductSubCategoryName IN "
    "('Locks', 'Lights', 'Headsets', 'Helmets', 'Pedals', 'Pumps') THEN 'Accessories' "
    "WHEN ProductSubCategoryName LIKE '%Frames%' "
    "OR ProductSubCategoryName IN ('Wheels', 'Saddles') THEN 'Components' END"
)
CTES["best_products"] = CTES["best_products"].format(rest=_REST)
CTES["product"] = CTES["product"].format(category=_CATEGORY)

NEEDS = {
    "priced": ("lines", "ords"),
    "revenue": ("priced", "parts"),
    "clean_header": ("raw_header",),
    "clean_detail": ("raw_detail",),
    "clean_products": ("raw_products",),
    "header": ("clean_header",),
    "detail": ("clean_detail",),
    "products": ("clean_products",),
    "best_products": ("products",),
    "product": ("best_products",),
    "fact": ("detail", "header"),
    "color_revenue": ("fact", "product"),
    "top_color": ("color_revenue",),
    "category_lead": ("fact", "product"),
}


def _with(select: str, *names: str) -> str:
    """Prefix ``select`` with the named expressions and all they build on."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, ()):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    return "WITH " + ", ".join(f"{n} AS ({CTES[n]})" for n in ordered) + " " + select


def _shown(contract: TableContract, alias: str = "") -> str:
    listed = []
    for c in contract.output_columns:
        sql_type = contract.columns.get(c, "STRING")
        if sql_type.startswith("DECIMAL"):
            listed.append(f"CAST({alias}{c} AS VARCHAR) AS {c}")
        elif sql_type == "DATE":
            listed.append(f"CAST({alias}{c} AS VARCHAR) AS {c}")
        else:
            listed.append(f"{alias}{c}")
    return ", ".join(listed)


def _union(selects: list[str]) -> str:
    return " UNION ALL ".join(selects)


def _failures(table: str, contract: TableContract) -> list[tuple[str, str]]:
    return [
        (
            c,
            f"(SELECT count(*) FROM {table} WHERE {c} IS NOT NULL "
            f"AND ({_typed_value(c, contract.columns[c], contract)}) IS NULL)",
        )
        for c in contract.cast_columns
    ]


def _key_check(table: str, key: list[str]) -> str:
    listed = ", ".join(key)
    any_null = " OR ".join(f"{k} IS NULL" for k in key)
    return (
        f"SELECT '{listed}' AS key, n AS rows, d AS distinct_keys, n - d AS duplicate_rows, "
        f"z AS null_keys, (n = d AND z = 0) AS valid FROM (SELECT "
        f"(SELECT count(*) FROM {table}) AS n, "
        f"(SELECT count(*) FROM (SELECT DISTINCT {listed} FROM {table})) AS d, "
        f"(SELECT count(*) FROM {table} WHERE {any_null}) AS z)"
    )


RULE_COUNTS = {
    ("sales_order_header", "partial_order_date"): (
        "SELECT count(*) FROM header WHERE OrderDatePrecision = 'month'"
    ),
    ("sales_order_header", "ship_before_order"): (
        "SELECT count(*) FROM header WHERE OrderDatePrecision = 'day' AND ShipDate < OrderDate"
    ),
    ("sales_order_detail", "order_qty_le_0"): "SELECT count(*) FROM detail WHERE OrderQty <= 0",
    ("sales_order_detail", "unit_price_eq_0"): "SELECT count(*) FROM detail WHERE UnitPrice = 0",
}

_TABLES = (
    ("products", "products", "clean_products", sales.PRODUCTS),
    ("sales_order_header", "header", "clean_header", sales.SALES_ORDER_HEADER),
    ("sales_order_detail", "detail", "clean_detail", sales.SALES_ORDER_DETAIL),
)


def _orphans(child: str, parent: str, key: str) -> str:
    return (
        f"SELECT count(*) FROM {child} c WHERE c.{key} IS NOT NULL "
        f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{key})"
    )


def _report_rows() -> list[tuple[str, str, str | None, str, str]]:
    """(table, check, column, metric, scalar subquery)"""
    rows: list[tuple[str, str, str | None, str, str]] = []
    for name, typed, clean, contract in _TABLES:
        for c in contract.output_columns:
            rows.append(
                (name, "null_profile", c, "nulls", f"SELECT count(*) FROM {typed} WHERE {c} IS NULL")
            )
        for c, count in _failures(clean, contract):
            rows.append((name, "cast_failures", c, "failures", f"SELECT {count}"))
        for c in contract.loose_dates:
            short = f"regexp_matches({c}, '^[0-9]{{4}}(-[0-9]{{1,2}})?$')"
            value = f"({_typed_value(c, 'DATE', contract)}) IS NOT NULL"
            rows.append(
                (name, "imputed_dates", c, "imputed", f"SELECT count(*) FROM {clean} WHERE {short} AND {value}")
            )
        key = contract.primary_key[0]
        total = f"(SELECT count(*) FROM {typed})"
        distinct = f"(SELECT count(*) FROM (SELECT DISTINCT {key} FROM {typed}))"
        nulls = f"(SELECT count(*) FROM {typed} WHERE {key} IS NULL)"
        for metric, value in (
            ("rows", total),
            ("distinct_keys", distinct),
            ("duplicate_rows", f"{total} - {distinct}"),
            ("null_keys", nulls),
            ("valid", f"CASE WHEN {total} = {distinct} AND {nulls} = 0 THEN 1 ELSE 0 END"),
        ):
            rows.append((name, "primary_key", key, metric, f"SELECT {value}"))
    for (name, rule), count in RULE_COUNTS.items():
        rows.append((name, "rule", None, rule, count))
    for parent_name, parent, key in (
        ("sales_order_header", "header", "SalesOrderID"),
        ("products", "products", "ProductID"),
    ):
        relation = f"sales_order_detail.{key} -> {parent_name}.{key}"
        orphans = _orphans("detail", parent, key)
        rows.append(("sales_order_detail", "foreign_key", relation, "orphans", orphans))
        valid = f"SELECT CASE WHEN ({orphans}) = 0 THEN 1 ELSE 0 END"
        rows.append(("sales_order_detail", "foreign_key", relation, "valid", valid))
    return rows


def _text(value: str | None) -> str:
    return "CAST(NULL AS VARCHAR)" if value is None else f"'{value}'"


def _quality_report() -> str:
    selects = [
        f"SELECT {_text(table)} AS \"table\", {_text(check)} AS \"check\", {_text(column)} AS \"column\", "
        f"{_text(metric)} AS metric, CAST(({value}) AS BIGINT) AS value"
        for table, check, column, metric, value in _report_rows()
    ]
    return _with(_union(selects), "header", "detail", "products")


def _layer_rows(names: list[str], published: list[tuple[str, str]]) -> list[tuple]:
    """Rows of each layer's tables: raw and store keep every row of the extract."""
    rows = [(n, "layer", layer, "rows", f"SELECT count(*) FROM raw_{n}") for n in names for layer in ("raw", "store")]
    return rows + [(name, "layer", "publish", "rows", f"SELECT count(*) FROM {cte}") for name, cte in published]


def _items(rows: list[tuple]) -> list[str]:
    return [
        f"SELECT {_text(f'{table}:{check}')} AS item, {_text(column)} AS detail, "
        f"{_text(metric)} AS metric, CAST(CAST(({value}) AS BIGINT) AS VARCHAR) AS value"
        for table, check, column, metric, value in rows
    ]


def _end_to_end() -> str:
    surplus = f"SELECT count(*) FROM orders WHERE {fx.SURPLUS}"
    selects = _items(
        [
            *[
                (t, "scan", None, "malformed_lines", surplus if t == "sales_order_header" else "SELECT 0")
                for t, *_ in _TABLES
            ],
            *[
                (name, check, column, metric, value.replace("raw_sales_order_", "raw_"))
                for name, check, column, metric, value in _layer_rows(
                    [t for t, *_ in _TABLES], [("product", "product"), ("orders", "fact")]
                )
            ],
            (
                "orders",
                "rule",
                None,
                "extended_price_lost",
                "SELECT count(*) FROM fact WHERE TotalLineExtendedPrice IS NULL AND OrderQty IS NOT NULL "
                "AND UnitPrice IS NOT NULL AND UnitPriceDiscount IS NOT NULL",
            ),
            *_report_rows(),
        ]
    )
    selects += [
        "SELECT 'top_color:' || CAST(OrderYear AS VARCHAR), Color, 'revenue', "
        "CAST(Revenue AS VARCHAR) FROM top_color",
        "SELECT 'lead_time', ProductCategoryName, 'average', "
        "CAST(CAST(AvgLeadTimeInBusinessDays AS DECIMAL(19,2)) AS VARCHAR) FROM category_lead",
        "SELECT 'lead_time', ProductCategoryName, 'lines', "
        "CAST(OrderLinesWithLeadTime AS VARCHAR) FROM category_lead",
    ]
    return _with(_union(selects), "top_color", "category_lead", "products")


def _run_customers() -> str:
    """Report and answer of the second plan, each count a query of its own."""
    ctes = []
    for table, columns in fx.CUSTOMER_TABLES.items():
        ctes.append(f"raw_{table} AS ({fx.view_sql(table, columns)})")
        listed = ", ".join(f"{_clean(c)} AS {c}" for c in columns)
        ctes.append(f"clean_{table} AS (SELECT {listed} FROM raw_{table})")
    kinds = {
        "nation": {"n_nationkey": "INT", "n_name": "STRING"},
        "customer": {"c_custkey": "INT", "c_nationkey": "INT", "c_acctbal": "DECIMAL(19,4)"},
        "orders": {"o_orderkey": "BIGINT", "o_custkey": "INT", "o_orderdate": "DATE", "o_totalprice": "DECIMAL(19,4)"},
    }
    keys = {"nation": ["n_nationkey"], "customer": ["c_custkey"], "orders": ["o_orderkey", "o_custkey"]}
    rows: list[tuple] = []
    for table, columns in kinds.items():
        typed = {
            c: c if t == "STRING" else _completed_date(c) if t == "DATE" else f"try_cast({c} AS {t})"
            for c, t in columns.items()
        }
        listed = ", ".join(f"{value} AS {c}" for c, value in typed.items())
        ctes.append(f"t_{table} AS (SELECT {listed} FROM clean_{table})")
        rows.append((table, "scan", None, "malformed_lines", "SELECT 0"))
        for c, value in typed.items():
            rows.append((table, "null_profile", c, "nulls", f"SELECT count(*) FROM t_{table} WHERE {c} IS NULL"))
            if columns[c] != "STRING":
                lost = f"SELECT count(*) FROM clean_{table} WHERE {c} IS NOT NULL AND ({value}) IS NULL"
                rows.append((table, "cast_failures", c, "failures", lost))
            if columns[c] == "DATE":
                short = f"SELECT count(*) FROM clean_{table} WHERE length({c}) < 10 AND ({value}) IS NOT NULL"
                rows.append((table, "imputed_dates", c, "imputed", short))
        key = ", ".join(keys[table])
        total = f"(SELECT count(*) FROM t_{table})"
        distinct = f"(SELECT count(*) FROM (SELECT DISTINCT {key} FROM t_{table}))"
        null = " OR ".join(f"{k} IS NULL" for k in keys[table])
        nulls = f"(SELECT count(*) FROM t_{table} WHERE {null})"
        rows += [
            (table, "primary_key", key, "rows", f"SELECT {total}"),
            (table, "primary_key", key, "distinct_keys", f"SELECT {distinct}"),
            (table, "primary_key", key, "duplicate_rows", f"SELECT {total} - {distinct}"),
            (table, "primary_key", key, "null_keys", f"SELECT {nulls}"),
            (table, "primary_key", key, "valid", f"SELECT ({total} = {distinct} AND {nulls} = 0)::INT"),
        ]
    for child, child_key, parent, parent_key in (
        ("customer", "c_nationkey", "nation", "n_nationkey"),
        ("orders", "o_custkey", "customer", "c_custkey"),
    ):
        orphans = (
            f"SELECT count(*) FROM t_{child} WHERE {child_key} IS NOT NULL "
            f"AND {child_key} NOT IN (SELECT {parent_key} FROM t_{parent})"
        )
        relation = f"{child}.{child_key} -> {parent}.{parent_key}"
        rows.append((child, "foreign_key", relation, "orphans", orphans))
        rows.append((child, "foreign_key", relation, "valid", f"SELECT (({orphans}) = 0)::INT"))
    rows.append(("customer", "rule", None, "in_debt", "SELECT count(*) FROM t_customer WHERE c_acctbal < 0"))
    ctes.append(
        "placed AS (SELECT o.*, c.c_nationkey AS n_nationkey FROM t_orders o "
        "LEFT JOIN t_customer c ON o.o_custkey = c.c_custkey)"
    )
    ctes.append("named AS (SELECT n_nationkey, coalesce(n_name, '(unknown)') AS n_name FROM t_nation)")
    lost = "SELECT count(*) FROM placed WHERE n_nationkey IS NULL"
    rows.append(("placed", "rule", None, "without_customer", lost))
    rows += _layer_rows(list(kinds), [("placed", "placed"), ("nations", "named")])
    top = (
        "SELECT 'top_nation:' || CAST(y AS VARCHAR), n_name, 'revenue', CAST(revenue AS VARCHAR) FROM ("
        "SELECT *, rank() OVER (PARTITION BY y ORDER BY revenue DESC NULLS LAST) AS r FROM ("
        "SELECT CAST(year(o_orderdate) AS INTEGER) AS y, n_name, sum(o_totalprice) AS revenue "
        "FROM placed JOIN named USING (n_nationkey) GROUP BY 1, 2)) WHERE r = 1"
    )
    return "WITH " + ", ".join(ctes) + " " + _union([*_items(rows), top])


def _typed_key_report() -> str:
    """Each key and reference counted by itself, in the types of its own columns."""
    kinds = {
        "lines": {"l_orderkey": "DECIMAL(19,4)", "l_linenumber": "INT", "l_partkey": "BIGINT"},
        "placed": {"o_orderkey": "INT", "o_custkey": "BIGINT"},
        "parts": {"p_partkey": "INT"},
        "buyers": {"c_custkey": "DECIMAL(19,4)"},
    }
    ctes = []
    for table, columns in kinds.items():
        base, expressions = fx.TYPED_KEYS[table]
        typed = ", ".join(f"try_cast({c} AS {t}) AS {c}" for c, t in columns.items())
        ctes.append(f"{table} AS (SELECT {typed} FROM ({fx.view_sql(base, expressions)}))")
    keys = {"lines": "l_orderkey, l_linenumber", "placed": "o_orderkey", "parts": "p_partkey", "buyers": "c_custkey"}
    selects = []

    def row(table: str, check: str, column: str, metric: str, value: str) -> None:
        selects.append(
            f"SELECT '{table}' AS \"table\", '{check}' AS \"check\", '{column}' AS \"column\", "
            f"'{metric}' AS metric, CAST(({value}) AS BIGINT) AS value"
        )

    for table, key in keys.items():
        total = f"(SELECT count(*) FROM {table})"
        distinct = f"(SELECT count(*) FROM (SELECT DISTINCT {key} FROM {table}))"
        null = " OR ".join(f"{k} IS NULL" for k in key.split(", "))
        nulls = f"(SELECT count(*) FROM {table} WHERE {null})"
        row(table, "primary_key", key, "rows", f"SELECT {total}")
        row(table, "primary_key", key, "distinct_keys", f"SELECT {distinct}")
        row(table, "primary_key", key, "duplicate_rows", f"SELECT {total} - {distinct}")
        row(table, "primary_key", key, "null_keys", f"SELECT {nulls}")
        row(table, "primary_key", key, "valid", f"SELECT ({total} = {distinct} AND {nulls} = 0)::INT")
    for child, own, parent, other in (
        ("lines", "l_orderkey", "placed", "o_orderkey"),
        ("lines", "l_partkey", "parts", "p_partkey"),
        ("placed", "o_custkey", "buyers", "c_custkey"),
    ):
        orphans = (
            f"SELECT count(*) FROM {child} WHERE {own} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {parent} WHERE {parent}.{other} = {child}.{own})"
        )
        relation = f"{child}.{own} -> {parent}.{other}"
        row(child, "foreign_key", relation, "orphans", orphans)
        row(child, "foreign_key", relation, "valid", f"SELECT (({orphans}) = 0)::INT")
    return "WITH " + ", ".join(ctes) + " " + _union(selects)


def _changed_values() -> str:
    """Numbers compared with themselves at twelve decimals, dates by the length of their text."""
    plain = {c: f"trim({c}, ' ' || chr(9))" for c in fx.CHANGED_VALUES}

    def rounded(column: str, kind: str) -> str:
        return f"try_cast({plain[column]} AS DECIMAL(38,12)) <> try_cast({plain[column]} AS {kind})"

    counts = [
        ("placed", "imputed", f"length({plain['placed']}) < 10"),
        ("amount", "rounded", rounded("amount", "DECIMAL(19,4)")),
        ("rate", "rounded", rounded("rate", "DECIMAL(9,2)")),
        ("placed", "shortened", f"length({plain['placed']}) > 10"),
    ]
    return f"WITH texts AS ({fx.view_sql('orders', fx.CHANGED_VALUES)}) " + _union(
        [
            f"SELECT '{c}' AS \"column\", '{m}' AS metric, count(*) AS \"values\" FROM texts WHERE {w}"
            for c, m, w in counts
        ]
    )


def _map_category_table() -> str:
    """Every value against every rule."""
    return f"""
WITH lines AS ({fx.view_sql('lineitem', fx.TAGGED_LINES)}),
rules AS ({fx.view_sql('orders', fx.TAG_RULES)}),
asked AS (SELECT DISTINCT tag FROM lines WHERE category IS NULL AND tag IS NOT NULL),
labelled AS (
  SELECT tag, arg_min(label, rule) AS label FROM asked JOIN rules
    ON CASE WHEN kind = 'equals' THEN tag = pattern ELSE contains(tag, pattern) END
  WHERE label IS NOT NULL GROUP BY tag)
SELECT l_orderkey, l_linenumber, coalesce(category, label) AS category, l.tag
FROM lines l LEFT JOIN labelled m ON l.category IS NULL AND l.tag = m.tag
"""


def _run_gate() -> str:
    lost = "c_custkey % 70 = 0"
    strangers = "o_orderkey % 80 = 0 AND o_orderkey % 30 <> 0"
    nationless = "c_custkey % 40 = 0"
    gate = (
        ("customer:cast_failures", "c_acctbal", f"SELECT count(*) FROM customer WHERE {lost}", "SELECT 0"),
        (
            "customer:foreign_key",
            "customer.c_nationkey -> nation.n_nationkey",
            f"SELECT count(*) FROM customer WHERE {nationless}",
            "SELECT count(*) // 100 FROM customer",
        ),
        (
            "orders:foreign_key",
            "orders.o_custkey -> customer.c_custkey",
            f"SELECT count(*) FROM orders WHERE {strangers}",
            "SELECT count(*) // 100 FROM orders",
        ),
    )
    found = _union(
        [
            f"SELECT '{item}' AS item, '{detail}' AS detail, ({value})::BIGINT AS value, ({most})::BIGINT AS at_most"
            for item, detail, value, most in gate
        ]
    )
    return (
        f"SELECT * FROM ({found}) WHERE value > at_most UNION ALL "
        "SELECT 'published', 'placed', (SELECT count(*) FROM orders), NULL"
    )


def _audit(table: str, contract: TableContract) -> str:
    selects = [
        f"SELECT '{c}' AS \"column\", CAST({count} AS BIGINT) AS failures"
        for c, count in _failures(table, contract)
    ]
    return _with(_union(selects), table)


def _best(preference: str) -> str:
    return (
        "SELECT ProductID, ProductNumber, Color, ProductCategoryName, ProductSubCategoryName FROM ("
        f"SELECT *, row_number() OVER (PARTITION BY ProductID ORDER BY {preference}, "
        f"ProductSubCategoryName NULLS LAST, ProductNumber NULLS LAST, {_REST}) AS pos "
        "FROM products) WHERE pos = 1"
    )


_TOP = (
    "SELECT order_year, p_type, CAST(revenue AS VARCHAR) AS revenue{rank} FROM (SELECT *, rank() OVER "
    "(PARTITION BY order_year ORDER BY revenue DESC NULLS LAST) AS r FROM revenue) WHERE r <= {k}"
)
_DETAIL_IN_FACT = _shown(sales.SALES_ORDER_DETAIL)
_HEADER_IN_FACT = ", ".join(
    part
    for part in _shown(sales.SALES_ORDER_HEADER).split(", ")
    if part != "SalesOrderID" and "Freight" not in part
)

ORACLES: dict[str, str] = {
    "normalize_nulls": _with("SELECT * FROM clean_header", "clean_header"),
    "normalize_tokens": (
        f"SELECT CAST(order_id AS INTEGER) AS order_id, {_clean('remark', ('N/A', '-', 'NONE'))} AS remark "
        f"FROM ({fx.view_sql('orders', fx.REMARKS)})"
    ),
    "ship_date_modes": _with(
        "SELECT 'completed' AS mode, SalesOrderID, CAST(ShipDate AS VARCHAR) AS ShipDate, "
        "CAST(NULL AS VARCHAR) AS precision, CASE WHEN OrderDatePrecision = 'month' THEN NULL ELSE "
        f"{_days('OrderDate', 'ShipDate')} END AS lead_days FROM header UNION ALL "
        "SELECT 'guarded', SalesOrderID, CAST(s AS VARCHAR), p, CASE WHEN OrderDatePrecision = 'month' "
        f"OR p = 'month' THEN NULL ELSE {_days('OrderDate', 's')} END FROM (SELECT "
        f"try_cast(SalesOrderID AS INT) AS SalesOrderID, {_date('OrderDate')} AS OrderDate, "
        f"{_precision('OrderDate')} AS OrderDatePrecision, {_date('ShipDate')} AS s, "
        f"{_precision('ShipDate')} AS p FROM clean_header)",
        "header",
    ),
    "partial_date": _with(
        f"SELECT trim(SalesOrderID) AS SalesOrderID, CAST({_date('OrderDate')} AS VARCHAR) "
        f"AS order_date, {_precision('OrderDate')} AS date_precision FROM clean_header",
        "clean_header",
    ),
    "business_days": _with(
        "SELECT l_orderkey, l_linenumber, CAST(order_date AS VARCHAR) AS order_date, "
        f"CAST(ship_date AS VARCHAR) AS ship_date, {_days('order_date', 'ship_date')} AS lead_days "
        "FROM priced",
        "priced",
    ),
    "business_days_signed": _with(
        "SELECT l_orderkey, l_linenumber, CASE WHEN ship_date >= order_date THEN "
        f"{_days('order_date', 'ship_date')} ELSE -({_days('ship_date', 'order_date')}) END "
        "AS signed_days FROM priced",
        "priced",
    ),
    "lead_time": _with(
        "SELECT SalesOrderID, OrderDatePrecision, CASE WHEN OrderDatePrecision = 'month' THEN NULL "
        f"ELSE {_days('OrderDate', 'ShipDate')} END AS lead_days FROM header",
        "header",
    ),
    "extended_price": _with(
        "SELECT l_orderkey, l_linenumber, CAST(CAST(quantity * (price - discount) "
        "AS DECIMAL(19,4)) AS VARCHAR) AS extended_price FROM lines",
        "lines",
    ),
    "raw_scan": _with(
        "SELECT "
        + ", ".join(f"nullif({c}, '') AS {c}" for c in sales.SALES_ORDER_HEADER.columns)
        + " FROM raw_header",
        "raw_header",
    ),
    "raw_scan_malformed": (
        "SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_orderstatus AS status, "
        "CASE WHEN o_orderkey % 50 <> 0 AND o_orderkey % 77 = 0 THEN NULL ELSE o_orderpriority END "
        "AS priority, CASE WHEN o_orderkey % 50 = 0 OR o_orderkey % 77 = 0 THEN line END "
        f"AS malformed_line FROM (SELECT *, {fx.BROKEN_LINES['line']} AS line FROM orders)"
    ),
    "layer_roundtrip": _with(
        "SELECT l_orderkey, l_linenumber, l_partkey, quantity, CAST(price AS VARCHAR) AS price, "
        "CAST(discount AS VARCHAR) AS discount, CAST(ship_date AS VARCHAR) AS ship_date FROM lines",
        "lines",
    ),
    "layer_counts": (
        "SELECT 'lines' AS layer_table, count(*) AS rows FROM lineitem "
        "UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'parts', count(*) FROM part"
    ),
    "result_export": _with(
        "SELECT CAST(order_year AS VARCHAR) AS order_year, p_type, "
        "CAST(CAST(revenue AS DECIMAL(38,4)) AS VARCHAR) AS revenue FROM (SELECT *, rank() OVER "
        "(PARTITION BY order_year ORDER BY revenue DESC NULLS LAST) AS r FROM revenue) WHERE r = 1",
        "revenue",
    ),
    "typed_store": _with(f"SELECT {_shown(sales.SALES_ORDER_HEADER)} FROM header", "header"),
    "typed_store_products": _with(f"SELECT {_shown(sales.PRODUCTS)} FROM products", "products"),
    "typed_store_detail": _with(f"SELECT {_shown(sales.SALES_ORDER_DETAIL)} FROM detail", "detail"),
    "cast_audit": _audit("clean_header", sales.SALES_ORDER_HEADER),
    "cast_audit_products": _audit("clean_products", sales.PRODUCTS),
    "null_profile": _with(
        _union(
            [
                f"SELECT '{c}' AS \"column\", count(*) AS nulls FROM header WHERE {c} IS NULL"
                for c in sales.SALES_ORDER_HEADER.output_columns
            ]
        ),
        "header",
    ),
    "pk_check": _key_check("lineitem", ["l_orderkey", "l_linenumber"]),
    "pk_check_products": _with(_key_check("products", ["ProductID"]), "products"),
    "duplicate_keys": (
        "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem "
        "GROUP BY 1, 2 HAVING count(*) > 1"
    ),
    "fk_check": (
        "SELECT 'l_orderkey' AS child_column, 'o_orderkey' AS parent_column, n AS orphans, "
        "n = 0 AS valid FROM (SELECT count(*) AS n FROM "
        f"({fx.view_sql('lineitem', fx.CHILD_LINES)}) c WHERE c.l_orderkey IS NOT NULL "
        f"AND c.l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE {fx.PARENT_KEPT}))"
    ),
    "childless_parents": (
        "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders o "
        "WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)"
    ),
    "anomaly_counts": _with(
        _union(
            [
                f"SELECT '{rule}' AS rule, ({count}) AS rows"
                for (_, rule), count in RULE_COUNTS.items()
            ]
        ),
        "header",
        "detail",
    ),
    "anomaly_partial_dates": _with(
        "SELECT SalesOrderID, count(*) AS rows FROM header WHERE OrderDatePrecision = 'month' "
        "GROUP BY 1",
        "header",
    ),
    "anomaly_reversed_lines": _with(
        "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM priced "
        "WHERE ship_date < order_date GROUP BY 1, 2",
        "priced",
    ),
    "conditional_null": _with(
        "SELECT count(*) AS rows, count(*) FILTER (SalesPersonID IS NULL) AS nulls, "
        "count(*) FILTER (OnlineOrderFlag) AS flagged, "
        "count(*) FILTER (SalesPersonID IS NULL AND NOT coalesce(OnlineOrderFlag, false)) "
        "AS null_without_flag, "
        "count(*) FILTER (OnlineOrderFlag AND SalesPersonID IS NOT NULL) AS flag_without_null, "
        "count(*) FILTER ((SalesPersonID IS NULL) <> coalesce(OnlineOrderFlag, false)) = 0 AS valid "
        "FROM header",
        "header",
    ),
    "quality_report": _quality_report(),
    "keep_best": _with(
        _best("(ProductCategoryName IS NULL)::INT + (ProductSubCategoryName IS NULL)::INT"),
        "products",
    ),
    "keep_best_lexicographic": _with(
        _best("ProductCategoryName IS NULL, ProductSubCategoryName IS NULL"), "products"
    ),
    "null_label": _with(
        "SELECT ProductID, ProductNumber, coalesce(Color, 'N/A') AS Color FROM products", "products"
    ),
    "map_category": _with(
        f"SELECT ProductID, {_CATEGORY} AS ProductCategoryName, ProductSubCategoryName FROM products",
        "products",
    ),
    "publish_product": _with(f"SELECT {_shown(sales.PRODUCTS)} FROM product", "product"),
    "publish_orders": _with(
        f"SELECT {_DETAIL_IN_FACT}, {_HEADER_IN_FACT}, "
        "CAST(TotalOrderFreight AS VARCHAR) AS TotalOrderFreight, LeadTimeInBusinessDays, "
        "CAST(TotalLineExtendedPrice AS VARCHAR) AS TotalLineExtendedPrice FROM fact",
        "fact",
    ),
    "revenue_by_year_group": _with(
        "SELECT order_year, p_type, CAST(revenue AS VARCHAR) AS revenue FROM revenue", "revenue"
    ),
    "top_by_year": _with(_TOP.format(rank="", k=1), "revenue"),
    "top2_by_year": _with(
        _TOP.format(rank=", CAST(r AS INTEGER) AS revenue_rank", k=2), "revenue"
    ),
    "top_color_by_year": _with(
        "SELECT OrderYear, Color, CAST(Revenue AS VARCHAR) AS Revenue FROM top_color", "top_color"
    ),
    "avg_by_category": _with(
        "SELECT coalesce(p_type, '(Uncategorized)') AS p_type, avg_lead_days, lines_with_lead_time "
        "FROM (SELECT p_type, round(avg(lead), 2) AS avg_lead_days, "
        "count(lead) AS lines_with_lead_time FROM (SELECT p_type, "
        f"{_days('order_date', 'ship_date')} AS lead FROM priced f "
        "JOIN parts p ON f.l_partkey = p.l_partkey) GROUP BY 1)",
        "priced",
        "parts",
    ),
    "avg_lead_time_by_category": _with("SELECT * FROM category_lead", "category_lead"),
    "revenue_by_precision": _with(
        "SELECT CAST(year(OrderDate) AS INTEGER) AS OrderYear, Color, OrderDatePrecision, "
        "CAST(sum(TotalLineExtendedPrice) AS VARCHAR) AS Revenue "
        "FROM fact f JOIN product p ON f.ProductID = p.ProductID GROUP BY 1, 2, 3",
        "fact",
        "product",
    ),
    "lag_histogram": _with(
        "SELECT CAST(ShipDate - OrderDate AS INTEGER) AS lag_days, count(*) AS rows "
        "FROM header GROUP BY 1",
        "header",
    ),
    "date_span": _with(
        "SELECT 'OrderDate' AS \"column\", CAST(min(OrderDate) AS VARCHAR) AS first, "
        "CAST(max(OrderDate) AS VARCHAR) AS last FROM header UNION ALL "
        "SELECT 'ShipDate', CAST(min(ShipDate) AS VARCHAR), CAST(max(ShipDate) AS VARCHAR) FROM header",
        "header",
    ),
    "answer_export": fx.view_sql("orders", fx.HARD_TEXTS),
    "layer_versions": _with(
        "SELECT l_orderkey, o_custkey, CAST(order_date AS VARCHAR) AS order_date, "
        "CAST(order_total AS VARCHAR) AS order_total, "
        "CAST((SELECT count(order_date) FROM ords) AS INTEGER) AS dated FROM ords",
        "ords",
    ),
    "drifting_headers": (
        "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, "
        "CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS o_custkey, "
        "o_orderstatus, o_orderpriority FROM orders"
    ),
    "changed_values": _changed_values(),
    "typed_key_report": _typed_key_report(),
    "map_category_table": _map_category_table(),
    "hot_order": _with(
        "SELECT h.l_orderkey, h.l_linenumber, h.l_partkey, o.o_custkey, "
        "CAST(o.order_date AS VARCHAR) AS order_date, CAST(o.order_total AS VARCHAR) AS order_total "
        f"FROM ({fx.view_sql('lineitem', fx.HOT_LINES)}) h LEFT JOIN ords o ON h.l_orderkey = o.l_orderkey",
        "ords",
    ),
    "even_revenue": _with(
        "SELECT OrderYear, Color, CAST(Revenue AS VARCHAR) AS Revenue FROM color_revenue", "color_revenue"
    ),
    "even_lead_time": _with("SELECT * FROM category_lead", "category_lead"),
    "run_texts": (
        "SELECT remark, other, count(*) AS orders FROM "
        f"({fx.view_sql('orders', fx.HARD_TEXTS)}) GROUP BY 1, 2"
    ),
    "run_gate": _run_gate(),
    "end_to_end": _end_to_end(),
    "run_customers": _run_customers(),
}
