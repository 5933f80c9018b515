"""Checks that report and never change data. Each one is a DataFrame.

Every check aggregates before it shuffles, so a key that holds a large share of
the rows, NULL included, leaves each task as one partial count.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.contracts import ForeignKey, Limit, RowRule, TableContract
from strata.operators.conform import (
    cast_failure_measures,
    conform,
    conform_with_text,
    imputed_date_measures,
    value_measures,
)
from strata.operators.measures import LONG_SCHEMA, Measure, measure

ROWS = "__rows"
KEY = "__key"
FOUND = "__found"
PARENTS = "__parents"
SPACE = "__space"
LOST = "__lost"
REPORT_SCHEMA = f"table string, {LONG_SCHEMA}"


def _total(n: Column) -> Column:
    return F.coalesce(F.sum(n), F.lit(0).cast("bigint"))


def null_measures(columns: Sequence[str]) -> list[Measure]:
    return [
        Measure("null_profile", c, "nulls", F.count_if(F.col(f"`{c}`").isNull())) for c in columns
    ]


def rule_measures(rules: Sequence[RowRule]) -> list[Measure]:
    return [Measure("rule", None, r.name, F.count_if(F.expr(r.predicate))) for r in rules]


def null_profile(df: DataFrame) -> DataFrame:
    """(column, nulls) for every column, in one pass."""
    return measure(df, null_measures(df.columns)).select("column", F.col("value").alias("nulls"))


def count_rules(df: DataFrame, rules: Sequence[RowRule]) -> DataFrame:
    """(rule, rows): rows that match each predicate, in one pass."""
    return measure(df, rule_measures(rules)).select(
        F.col("metric").alias("rule"), F.col("value").alias("rows")
    )


def rule_rows(df: DataFrame, rule: RowRule, count_name: str = "rows") -> DataFrame:
    """The identifying columns of the rows that match, with counts, in order.

    Rows that look alike in these columns are one row with a count, so that a
    value shared by very many rows does not end up in one task of the sort.
    """
    return (
        df.filter(rule.predicate)
        .groupBy(*rule.list_by)
        .agg(F.count(F.lit(1)).alias(count_name))
        .orderBy(*rule.list_by)
    )


def check_primary_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: key, rows, distinct_keys, duplicate_rows, null_keys, valid.

    NULL is a key value of its own when counting distinct keys; null_keys counts
    rows where any part of the key is NULL. One shuffle of per-key counts.
    """
    any_null = reduce(or_, [F.col(k).isNull() for k in key])
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias(ROWS))
    totals = per_key.agg(
        _total(F.col(ROWS)).alias("rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        _total(F.when(any_null, F.col(ROWS))).alias("null_keys"),
    )
    duplicates = F.col("rows") - F.col("distinct_keys")
    return totals.select(
        F.lit(", ".join(key)).alias("key"),
        "rows",
        "distinct_keys",
        duplicates.alias("duplicate_rows"),
        "null_keys",
        ((duplicates == 0) & (F.col("null_keys") == 0)).alias("valid"),
    )


def duplicate_keys(df: DataFrame, key: Sequence[str], count_name: str = "rows") -> DataFrame:
    """Keys that occur more than once with their row counts, in key order."""
    return (
        df.groupBy(*key)
        .agg(F.count(F.lit(1)).alias(count_name))
        .filter(F.col(count_name) > 1)
        .orderBy(*key)
    )


def check_foreign_key(
    child: DataFrame, child_column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """One row: child_column, parent_column, orphans, valid. A NULL child is exempt.

    The columns may differ in type; Spark stacks them in the type that holds both. This is the anti join of child and parent, but only the number of orphans is
    wanted. So both key columns are stacked and grouped once: per key, how many
    child rows and whether a parent exists. Keys are counted before the single
    shuffle on either side, and no estimate of the parent's size is needed. As a
    join, Spark would move the anti join below the counting wherever it takes
    the parent for small, and shuffle every child row if that proves wrong.
    """
    none, one = (F.lit(n).cast("bigint").alias(ROWS) for n in (0, 1))
    children = child.select(F.col(child_column).alias(KEY), one, F.lit(False).alias(FOUND))
    parents = parent.select(F.col(parent_column).alias(KEY), none, F.lit(True).alias(FOUND))
    per_key = (
        children.unionAll(parents)
        .filter(F.col(KEY).isNotNull())
        .groupBy(KEY)
        .agg(F.sum(ROWS).alias(ROWS), F.max(FOUND).alias(FOUND))
    )
    return per_key.agg(_total(F.when(~F.col(FOUND), F.col(ROWS))).alias("orphans")).select(
        F.lit(child_column).alias("child_column"),
        F.lit(parent_column).alias("parent_column"),
        "orphans",
        (F.col("orphans") == 0).alias("valid"),
    )


def childless_parents(
    parent: DataFrame, parent_column: str, child: DataFrame, child_column: str
) -> DataFrame:
    """Parent rows that no child row refers to."""
    referred = child.select(F.col(child_column).alias(KEY)).distinct()
    return parent.join(referred, on=F.col(parent_column) == F.col(KEY), how="left_anti")


def conditional_null(df: DataFrame, column: str, flag: Column) -> DataFrame:
    """Is ``column`` NULL exactly where ``flag`` holds? An unknown flag does not hold.

    One row: rows, nulls, flagged, null_without_flag, flag_without_null, valid.
    """
    is_null = F.col(column).isNull()
    flagged = F.coalesce(flag, F.lit(False))
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(is_null).alias("nulls"),
        F.count_if(flagged).alias("flagged"),
        F.count_if(is_null & ~flagged).alias("null_without_flag"),
        F.count_if(flagged & ~is_null).alias("flag_without_null"),
    ).withColumn("valid", (F.col("null_without_flag") + F.col("flag_without_null")) == 0)


@dataclass(frozen=True)
class _KeySpace:
    """Values of one key in one type: those of its table, and those that a child refers to."""

    table: str
    column: str
    kind: T.DataType
    foreign_key: ForeignKey | None = None


def _key_spaces(
    store: Mapping[str, DataFrame],
    contracts: Sequence[TableContract],
    foreign_keys: Sequence[ForeignKey],
) -> list[_KeySpace]:
    """One space per foreign key, and one per single-column primary key that no foreign key
    compares in its own type. A foreign key's type is the one in which Spark compares its
    two columns; types that it does not compare raise."""
    spaces = []
    for fk in foreign_keys:
        keys = store[fk.parent_table].select(F.col(fk.parent_column).alias(KEY))
        child = store[fk.child_table].select(F.col(fk.child_column).alias(KEY))
        kind = keys.unionAll(child).schema[KEY].dataType
        spaces.append(_KeySpace(fk.parent_table, fk.parent_column, kind, fk))
    covered = {(s.table, s.column, s.kind) for s in spaces}
    for contract in contracts:
        if len(contract.primary_key) == 1:
            column = contract.primary_key[0]
            kind = store[contract.name].schema[column].dataType
            if (contract.name, column, kind) not in covered:
                spaces.append(_KeySpace(contract.name, column, kind))
    return spaces


def _count_keys(store: Mapping[str, DataFrame], spaces: Sequence[_KeySpace]) -> DataFrame:
    """(space, rows, distinct_keys, null_keys, orphans), one row per space.

    Each table is scanned once, its keys of all spaces are stacked, and one
    grouping counts, per value, the rows of the parent and of the child. There is
    a key column for each type, and a row fills that of its space. A value that
    the type cannot hold (text beside numbers) equals no key of the other side.
    """
    types = list(dict.fromkeys(space.kind for space in spaces))
    entries: dict[str, list[tuple[int, int, str, int, int]]] = {}
    for number, space in enumerate(spaces):
        place = types.index(space.kind)
        entries.setdefault(space.table, []).append((number, place, space.column, 1, 0))
        if space.foreign_key:
            child = (number, place, space.foreign_key.child_column, 0, 1)
            entries.setdefault(space.foreign_key.child_table, []).append(child)
    keys = [f"{KEY}{place}" for place in range(len(types))]
    stacked = []
    for table, own in entries.items():
        cells = []
        for number, place, column, parent, child in own:
            same = store[table].schema[column].dataType == types[place]
            value = F.col(column) if same else F.col(column).try_cast(types[place])
            typed = [
                (value if k == place else F.lit(None).cast(kind)).alias(keys[k])
                for k, kind in enumerate(types)
            ]
            lost = F.lit(False) if same else F.col(column).isNotNull() & value.isNull()
            cells.append(
                F.struct(
                    F.lit(number).alias(SPACE),
                    *typed,
                    lost.alias(LOST),
                    F.lit(parent).cast("bigint").alias(PARENTS),
                    F.lit(child).cast("bigint").alias(ROWS),
                )
            )
        stacked.append(store[table].select(F.inline(F.array(*cells))))
    per_key = (
        reduce(DataFrame.unionAll, stacked)
        .groupBy(SPACE, *keys, LOST)
        .agg(F.sum(PARENTS).alias(PARENTS), F.sum(ROWS).alias(ROWS))
    )
    known = reduce(or_, [F.col(k).isNotNull() for k in keys])
    orphan = F.col(LOST) | (known & (F.col(PARENTS) == 0))
    counted = per_key.groupBy(SPACE).agg(
        F.sum(PARENTS).alias("rows"),
        F.count_if(F.col(PARENTS) > 0).alias("distinct_keys"),
        F.sum(F.when(~known & ~F.col(LOST), F.col(PARENTS))).alias("null_keys"),
        F.sum(F.when(orphan, F.col(ROWS))).alias("orphans"),
    )
    spark = next(iter(store.values())).sparkSession
    every = spark.range(len(spaces), numPartitions=1).select(F.col("id").cast("int").alias(SPACE))
    return every.join(counted, SPACE, "left").na.fill(0)


def key_report(
    store: Mapping[str, DataFrame],
    contracts: Sequence[TableContract],
    foreign_keys: Sequence[ForeignKey],
) -> list[DataFrame]:
    """Primary- and foreign-key results as (table, check, column, metric, value).

    All keys of one column are counted in a single grouping, each in its own type,
    or in the common type of child and parent; a key of several columns has a
    grouping of its own.
    """
    parts = [
        _composite_report(contract.name, store[contract.name], contract.primary_key)
        for contract in contracts
        if len(contract.primary_key) > 1
    ]
    spaces = _key_spaces(store, contracts, foreign_keys)
    if not spaces:
        return parts
    keys = {
        (c.name, c.primary_key[0], store[c.name].schema[c.primary_key[0]].dataType)
        for c in contracts
        if len(c.primary_key) == 1
    }
    listed = []
    for space in spaces:
        cells = []
        if (space.table, space.column, space.kind) in keys:
            keys.discard((space.table, space.column, space.kind))
            cells += _primary_key_cells(space.table, space.column)
        if space.foreign_key:
            child, relation = space.foreign_key.child_table, space.foreign_key.relation
            orphans = F.col("orphans")
            cells.append(_report_cell(child, "foreign_key", relation, "orphans", orphans))
            cells.append(_report_cell(child, "foreign_key", relation, "valid", orphans == 0))
        listed.append(F.array(*cells))
    counts = _count_keys(store, spaces)
    parts.append(counts.select(F.inline(F.element_at(F.array(*listed), F.col(SPACE) + 1))))
    return parts


def _primary_key_cells(table: str, column: str) -> list[Column]:
    rows, distinct, nulls = (F.col(c) for c in ("rows", "distinct_keys", "null_keys"))
    values = {
        "rows": rows,
        "distinct_keys": distinct,
        "duplicate_rows": rows - distinct,
        "null_keys": nulls,
        "valid": (rows == distinct) & (nulls == 0),
    }
    return [_report_cell(table, "primary_key", column, m, v) for m, v in values.items()]


def _composite_report(table: str, df: DataFrame, key: Sequence[str]) -> DataFrame:
    return check_primary_key(df, key).select(F.inline(F.array(*_primary_key_cells(table, ", ".join(key)))))


def _report_cell(table: str, check: str, column: str, metric: str, value: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table"),
        F.lit(check).alias("check"),
        F.lit(column).cast("string").alias("column"),
        F.lit(metric).alias("metric"),
        value.cast("bigint").alias("value"),
    )


def _of_table(table: str, long: DataFrame) -> DataFrame:
    return long.select(F.lit(table).alias("table"), "*")


def table_measures(contract: TableContract, rules: Sequence[RowRule]) -> list[Measure]:
    """Null profile and rule counts of one typed table."""
    own = [r for r in rules if r.table == contract.name]
    return [*null_measures(contract.output_columns), *rule_measures(own)]


def store_measures(
    contract: TableContract, rules: Sequence[RowRule], audit_values: bool = False
) -> list[Measure]:
    """All counts of one typed table that need no grouping, over ``conform_with_text``."""
    lost = [*cast_failure_measures(contract), *imputed_date_measures(contract)]
    changed = value_measures(contract) if audit_values else []
    return [*table_measures(contract, rules), *lost, *changed]


def exceeded(report: DataFrame, limits: Sequence[Limit]) -> DataFrame:
    """Report rows that break a limit, with the most that it allows as ``at_most``.

    A share is of the rows that the table has in the report's store layer.
    """
    sizes = report.where("check = 'layer' and column = 'store' and metric = 'rows'").select(
        "table", F.col("value").alias("__rows_of_table")
    )
    sized = report.join(sizes, "table", "left")
    parts = []
    for limit in limits:
        named = {"check": limit.check, "metric": limit.metric, "table": limit.table, "column": limit.column}
        own = reduce(and_, [F.col(c) == v for c, v in named.items() if v is not None])
        of_rows = F.floor(F.col("__rows_of_table") * F.lit(limit.share))
        most = F.lit(limit.at_most) if limit.share is None else of_rows
        parts.append(sized.where(own).withColumn("at_most", most.cast("bigint")))
    broken = reduce(DataFrame.unionAll, parts).where(F.col("value") > F.col("at_most"))
    return broken.select(*report.columns, "at_most")


def union_report(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def quality_report(
    raw: Mapping[str, DataFrame],
    contracts: Sequence[TableContract],
    foreign_keys: Sequence[ForeignKey] = (),
    rules: Sequence[RowRule] = (),
    store: Mapping[str, DataFrame] | None = None,
    audit_values: bool = False,
) -> DataFrame:
    """All checks as (table, check, column, metric, value).

    Per table one pass over the raw rows for nulls, rules, failed casts and
    completed dates; all single-column keys come from one grouping, in which each
    table is scanned once. Typed tables already written can be given as
    ``store``, so that the key checks read only key columns. An end-to-end run
    takes the first part from the writes themselves.
    """
    parts = []
    typed = dict(store or {})
    for contract in contracts:
        rows = raw[contract.name]
        typed.setdefault(contract.name, conform(rows, contract))
        measures = store_measures(contract, rules, audit_values)
        profile = measure(conform_with_text(rows, contract), measures)
        parts.append(_of_table(contract.name, profile))
    return union_report([*parts, *key_report(typed, contracts, foreign_keys)])
