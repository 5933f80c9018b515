"""Named counts that share one pass and come out one per row."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LONG_SCHEMA = "check string, column string, metric string, value bigint"


@dataclass(frozen=True)
class Measure:
    """One aggregate of a table; ``column`` is NULL for counts of whole rows."""

    check: str
    column: str | None
    metric: str
    value: Column

    @property
    def name(self) -> str:
        return ":".join(part or "" for part in (self.check, self.column, self.metric))


def _cell(m: Measure, value: Column) -> Column:
    return F.struct(
        F.lit(m.check).alias("check"),
        F.lit(m.column).cast("string").alias("column"),
        F.lit(m.metric).alias("metric"),
        F.coalesce(value.cast("bigint"), F.lit(0).cast("bigint")).alias("value"),
    )


def unfold(row: DataFrame, measures: Iterable[Measure]) -> DataFrame:
    """Turn a one-row aggregate holding ``measures`` by name into long rows."""
    return row.select(F.inline(F.array(*[_cell(m, F.col(f"`{m.name}`")) for m in measures])))


def measure(df: DataFrame, measures: list[Measure]) -> DataFrame:
    """Evaluate all measures in a single aggregation; an empty table gives zeros."""
    if not measures:
        return df.sparkSession.createDataFrame([], LONG_SCHEMA)
    return unfold(df.agg(*[m.value.alias(m.name) for m in measures]), measures)
