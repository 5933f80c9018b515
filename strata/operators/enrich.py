"""Filling in labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.contracts import ValueRule


def null_label(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Replace NULL by ``label`` in the given columns, which must hold text."""
    return df.withColumns({c: labelled(df, c, label) for c in columns})


def labelled(df: DataFrame, column: str, label: str) -> Column:
    """A text column with ``label`` for NULL; a column of another type has no place for it."""
    if not isinstance(df.schema[column].dataType, T.StringType):
        raise ValueError(f"{column!r} is not text, so it cannot hold {label!r}")
    return F.coalesce(F.col(column), F.lit(label))


def map_values(df: DataFrame, target: str, source: str, rules: Sequence[ValueRule]) -> DataFrame:
    """Fill NULLs of ``target`` from ``source`` by the first rule that matches.

    Matching is case-sensitive. A given value is never replaced, and a source
    that no rule matches leaves NULL.
    """
    text = F.col(source)

    def matches(rule: ValueRule) -> Column:
        hit = text.isin(*rule.equals)
        for token in rule.contains:
            hit = hit | text.contains(token)
        return hit

    candidates = [F.when(matches(rule), rule.label) for rule in rules]
    return df.withColumn(target, F.coalesce(F.col(target), *candidates))
