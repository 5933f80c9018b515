"""Grouped questions over a fact table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.enrich import null_label
from strata.sources import write_layer

TIED = "__tied"
POSITION = "__position"
ADDED, COUNTED = "__added", "__counted"
GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def revenue_by_year(
    fact: DataFrame,
    dimension: DataFrame,
    key: str,
    date: Column | str,
    amount: Column | str,
    by: Sequence[str],
    year_name: str = "OrderYear",
    value_name: str = "Revenue",
    even: bool = False,
) -> DataFrame:
    """Sum of ``amount`` per year of ``date`` and ``by``; a missing year is a group.

    ``by`` may name columns of either side. Lines without a dimension row drop
    out. Only ``key`` and the grouping columns of the dimension enter the join.

    ``even`` adds the lines of a key up before the join, in every task before they
    move, so that a key with a large share of them brings one row per year and group
    to the join. It pays where a key has many lines; exact amounts give the same sums.
    """
    wanted = [c for c in by if c in dimension.columns]
    if even:
        own = [c for c in by if c not in wanted]
        sums = fact.where(F.col(key).isNotNull()).groupBy(key, F.year(date).alias(year_name), *own)
        added = sums.agg(F.sum(amount).alias(value_name))
        joined = added.join(dimension.select(key, *wanted), on=key, how="inner")
        total = F.sum(value_name).cast(added.schema[value_name].dataType)
        return joined.groupBy(year_name, *by).agg(total.alias(value_name))
    return (
        fact.join(dimension.select(key, *wanted), on=key, how="inner")
        .groupBy(F.year(date).alias(year_name), *by)
        .agg(F.sum(amount).alias(value_name))
    )


def top_by_group(
    df: DataFrame,
    group: str,
    value: str,
    ranks: int = 1,
    rank_name: str | None = None,
    folder: str | None = None,
) -> DataFrame:
    """Rows whose ``value`` ranks within ``ranks`` in their group, every tie kept.

    Ranking follows SQL ``rank``: descending, NULL last, ties share a rank and
    leave a gap. Sorted by group, by rank where ``rank_name`` asks for it, and
    then by the other columns, which keeps tied rows in a fixed order and lets
    the sort spread a large tie over several tasks.

    Only the distinct values of a group are ranked, carrying how many rows share
    each, so neither a large group nor a large tie is ever gathered in one task:
    ties collapse before the shuffle and Spark cuts each task's output to
    ``ranks`` values per group. It does so up to a threshold (1,000 unless
    spark.sql.optimizer.windowGroupLimitThreshold says otherwise), and more
    ``ranks`` than that are refused. The winning values are then joined back.
    ``df`` appears twice in the plan, hence the demand for exact values (sums of
    floating-point numbers may differ between two evaluations). With a ``folder``
    it is first written there, so what is ranked and joined is evaluated once.
    """
    if isinstance(df.schema[value].dataType, (T.FloatType, T.DoubleType)):
        raise ValueError(f"{value!r} is inexact; rank on a decimal or an integer")
    most = int(df.sparkSession.conf.get(GROUP_LIMIT))
    if ranks > most:
        raise ValueError(f"{ranks} ranks: Spark cuts groups early up to {most}; raise {GROUP_LIMIT}")
    if folder is not None:
        df = write_layer(df, folder).frame
    levels = df.groupBy(group, value).agg(F.count(F.lit(1)).alias(TIED))
    within = Window.partitionBy(group).orderBy(F.col(value).desc_nulls_last())
    above = F.coalesce(
        F.sum(TIED).over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    rank = rank_name or POSITION
    winners = (
        levels.withColumn(POSITION, F.row_number().over(within))
        .filter(F.col(POSITION) <= ranks)
        .withColumn(rank, (above + 1).cast("int"))
        .filter(F.col(rank) <= ranks)
        .select(F.col(group).alias("__group"), F.col(value).alias("__value"), F.col(rank))
    )
    same = F.col(group).eqNullSafe(F.col("__group")) & F.col(value).eqNullSafe(F.col("__value"))
    kept = [*df.columns, *([rank_name] if rank_name else [])]
    order = [group, *([rank_name] if rank_name else []), *[c for c in df.columns if c != group]]
    return df.join(winners, on=same, how="inner").select(*kept).orderBy(*order)


def average_by_group(
    fact: DataFrame,
    dimension: DataFrame,
    key: str,
    group: str,
    value: str,
    average_name: str,
    count_name: str,
    label: str = "(Uncategorized)",
    digits: int = 2,
    even: bool = False,
) -> DataFrame:
    """Rounded average and number of non-null values per group.

    The label for a missing group is set after grouping, so a real group of that
    name stays apart. Sorted by the rounded average, highest first, then name.
    ``even`` adds up the lines of a key before the join, as in ``revenue_by_year``;
    the values must then be integers, whose sums are exact.
    """
    average, count = F.avg(value), F.count(value)
    if even:
        if not isinstance(fact.schema[value].dataType, T.IntegralType):
            raise ValueError(f"{value!r} is no integer column; its average depends on the order of sums")
        keyed = fact.where(F.col(key).isNotNull()).groupBy(key)
        fact = keyed.agg(F.sum(value).alias(ADDED), F.count(value).alias(COUNTED))
        count = F.sum(COUNTED)
        average = F.sum(ADDED).cast("double") / F.when(count > 0, count)
    grouped = (
        fact.join(dimension.select(key, group), on=key, how="inner")
        .groupBy(group)
        .agg(F.round(average, digits).alias(average_name), count.alias(count_name))
    )
    return null_label(grouped, [group], label).orderBy(
        F.col(average_name).desc(), F.col(group).asc()
    )


def lag_histogram(
    df: DataFrame, start: Column | str, end: Column | str, lag_name: str = "lag_days"
) -> DataFrame:
    """Rows per number of calendar days from ``start`` to ``end``."""
    return df.groupBy(F.datediff(end, start).alias(lag_name)).agg(F.count(F.lit(1)).alias("rows"))


def date_span(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, first, last) for each date column, in one pass."""
    bounds = df.agg(
        *[F.min(c).alias(f"{c}__first") for c in columns],
        *[F.max(c).alias(f"{c}__last") for c in columns],
    )
    spans = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"{c}__first").alias("first"),
            F.col(f"{c}__last").alias("last"),
        )
        for c in columns
    ]
    return bounds.select(F.inline(F.array(*spans)))
