"""Declarative descriptions of tables: what a run is told, not how it computes."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from strata.functions.text import NULL_TOKENS


@dataclass(frozen=True)
class TableContract:
    """Declared columns of one typed table.

    ``columns`` maps a column to its Spark SQL type, in output order.
    ``primary_key`` is checked and reported, never enforced.
    ``partial_dates`` maps a DATE column that may arrive as ``YYYY-MM`` to the
    name of the precision column added right after it.
    ``null_tokens`` are the texts that stand for "no value", in any spelling.
    """

    name: str
    columns: Mapping[str, str]
    primary_key: tuple[str, ...]
    partial_dates: Mapping[str, str] = field(default_factory=dict)
    null_tokens: tuple[str, ...] = NULL_TOKENS

    def __post_init__(self) -> None:
        for column in (*self.primary_key, *self.partial_dates):
            if column not in self.columns:
                raise ValueError(f"{self.name}: column {column!r} is not declared")
        for column, precision in self.partial_dates.items():
            if self.columns[column].upper() != "DATE":
                raise ValueError(f"{self.name}: partial date {column!r} must be a DATE")
            if precision in self.columns:
                raise ValueError(f"{self.name}: precision column {precision!r} is already declared")

    @property
    def cast_columns(self) -> list[str]:
        """Columns whose text can fail to convert."""
        return [c for c, t in self.columns.items() if t.upper() != "STRING"]

    @property
    def loose_dates(self) -> list[str]:
        """DATE columns whose text the cast completes where month or day are missing."""
        dates = [c for c, t in self.columns.items() if t.upper() == "DATE"]
        return [c for c in dates if c not in self.partial_dates]

    @property
    def output_columns(self) -> list[str]:
        names: list[str] = []
        for column in self.columns:
            names.append(column)
            if column in self.partial_dates:
                names.append(self.partial_dates[column])
        return names

    @property
    def raw_schema(self) -> T.StructType:
        """The same columns as they arrive: text only."""
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])


@dataclass(frozen=True)
class ForeignKey:
    child_table: str
    child_column: str
    parent_table: str
    parent_column: str

    @property
    def relation(self) -> str:
        return f"{self.child_table}.{self.child_column} -> {self.parent_table}.{self.parent_column}"


@dataclass(frozen=True)
class RowRule:
    """A named SQL predicate over one table; matching rows are reported.

    ``list_by`` names the columns that identify a matching row when the rows
    themselves are wanted; leave it empty for a rule that is only counted.
    """

    table: str
    name: str
    predicate: str
    list_by: tuple[str, ...] = ()


@dataclass(frozen=True)
class ValueRule:
    """Text values that map to ``label``: any exact match or any substring."""

    label: str
    equals: tuple[str, ...] = ()
    contains: tuple[str, ...] = ()


@dataclass(frozen=True)
class Limit:
    """How much of something a run may report before it publishes anything.

    Every report row of ``check`` and ``metric`` is judged, or those of one table
    and column where they are named. More than ``at_most``, or more than ``share``
    of the table's rows, breaks the limit; one of the two must be given.
    """

    check: str
    metric: str
    table: str | None = None
    column: str | None = None
    at_most: int | None = None
    share: float | None = None

    def __post_init__(self) -> None:
        if (self.at_most is None) == (self.share is None):
            raise ValueError(f"{self.check}, {self.metric}: give either at_most or share")


Builder = Callable[[Mapping[str, DataFrame]], DataFrame]


@dataclass(frozen=True)
class StagedQuestion:
    """A question whose figures are used more than once.

    ``figures`` is computed and stored once; ``answer`` reads what was stored.
    """

    figures: Builder
    answer: Callable[[DataFrame], DataFrame]

    def __call__(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        return self.answer(self.figures(tables))


@dataclass(frozen=True)
class RunPlan:
    """What a run does with a set of tables.

    ``publish`` builds each published table from the typed ones, ``questions``
    each answer from the published ones. ``rules`` hold for typed tables,
    ``publish_rules`` for published ones. ``duplicate_lists`` names a list of
    repeated primary keys and its table. ``input_files`` are the extracts' usual
    file names. ``limits`` stop a run after its checks and before it publishes.
    ``audit_values`` adds to the report which values the casts rounded or shortened.
    """

    contracts: tuple[TableContract, ...]
    foreign_keys: tuple[ForeignKey, ...] = ()
    rules: tuple[RowRule, ...] = ()
    duplicate_lists: Mapping[str, str] = field(default_factory=dict)
    publish: Mapping[str, Builder] = field(default_factory=dict)
    publish_rules: tuple[RowRule, ...] = ()
    questions: Mapping[str, Builder] = field(default_factory=dict)
    input_files: Mapping[str, str] = field(default_factory=dict)
    limits: tuple[Limit, ...] = ()
    audit_values: bool = False

    def __post_init__(self) -> None:
        tables = {c.name for c in self.contracts}
        named = [
            *((fk.child_table, tables) for fk in self.foreign_keys),
            *((fk.parent_table, tables) for fk in self.foreign_keys),
            *((rule.table, tables) for rule in self.rules),
            *((table, tables) for table in self.duplicate_lists.values()),
            *((rule.table, set(self.publish)) for rule in self.publish_rules),
            *((limit.table, tables) for limit in self.limits if limit.table),
        ]
        unknown = sorted({name for name, known in named if name not in known})
        if unknown:
            raise ValueError(f"tables that the plan does not have: {unknown}")

    def contract(self, table: str) -> TableContract:
        return next(c for c in self.contracts if c.name == table)
