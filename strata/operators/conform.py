"""From all-string rows to declared types, with an account of what was lost."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.contracts import TableContract
from strata.functions import date_precision, normalize_text, partial_date, safe_cast
from strata.operators.measures import Measure, measure

TEXT_SUFFIX = "__text"
# Characters around a value that Spark's casts pass over, dates without a day,
# which the cast completes, dates with a time of day, which it cuts off, and decimal numbers.
BLANKS = r"[\x00-\x20\x7f]*"
INCOMPLETE_DATE = rf"^{BLANKS}[+-]?[0-9]{{4,7}}(-[0-9]{{1,2}})?{BLANKS}\z"
DATE_WITH_TIME = rf"^{BLANKS}[^T\x00-\x20\x7f]+[T ].*[^\x00-\x20\x7f]"
DECIMAL_TEXT = rf"^{BLANKS}[+-]?([0-9]*)\.?([0-9]*)(?:[eE]([+-]?[0-9]+))?{BLANKS}\z"


def normalise(raw: DataFrame, contract: TableContract) -> DataFrame:
    """The declared columns, still text, with null tokens turned into NULL.

    Columns that are not declared disappear; a declared one that is missing
    fails the analysis.
    """
    tokens = contract.null_tokens
    return raw.select(*[normalize_text(F.col(c), tokens).alias(c) for c in contract.columns])


def _typed(contract: TableContract, text: Callable[[str], Column]) -> list[Column]:
    out: list[Column] = []
    for column, sql_type in contract.columns.items():
        if column in contract.partial_dates:
            out.append(partial_date(text(column)).alias(column))
            out.append(date_precision(text(column)).alias(contract.partial_dates[column]))
        else:
            out.append(safe_cast(text(column), sql_type).alias(column))
    return out


def conform(raw: DataFrame, contract: TableContract) -> DataFrame:
    """Exactly the declared columns, in order and typed. No row is added or dropped."""
    return normalise(raw, contract).select(*_typed(contract, F.col))


def conform_with_text(raw: DataFrame, contract: TableContract) -> DataFrame:
    """``conform`` plus the cleaned text of each cast column under ``<name>__text``."""
    texts = [F.col(c).alias(c + TEXT_SUFFIX) for c in contract.cast_columns]
    return normalise(raw, contract).select(*_typed(contract, F.col), *texts)


def text_columns(contract: TableContract) -> tuple[str, ...]:
    return tuple(c + TEXT_SUFFIX for c in contract.cast_columns)


def cast_failure_measures(contract: TableContract) -> list[Measure]:
    """Per cast column, values present as text but NULL once typed.

    To be evaluated over ``conform_with_text``. A partial date that parses is
    no failure.
    """
    return [
        Measure(
            "cast_failures",
            c,
            "failures",
            F.count_if(F.col(c + TEXT_SUFFIX).isNotNull() & F.col(c).isNull()),
        )
        for c in contract.cast_columns
    ]


def imputed_date_measures(contract: TableContract) -> list[Measure]:
    """Per date column that is not declared partial, values given as YYYY or YYYY-MM.

    The cast takes such text for the first day of its year or month, and passes over
    tabs and other control characters around it. To be evaluated over ``conform_with_text``.
    """
    return [
        Measure(
            "imputed_dates",
            c,
            "imputed",
            F.count_if(F.col(c + TEXT_SUFFIX).rlike(INCOMPLETE_DATE) & F.col(c).isNotNull()),
        )
        for c in contract.loose_dates
    ]


def decimals_needed(text: Column) -> Column:
    """Decimals that the number in ``text`` has, trailing zeros apart; 0 for a whole number.

    Read off the text itself, so it is exact for any number of digits: the digits
    behind the point, less the exponent and the zeros at the end. NULL for any
    other text.
    """
    whole, part = (F.regexp_extract(text, DECIMAL_TEXT, k) for k in (1, 2))
    exponent = F.coalesce(F.regexp_extract(text, DECIMAL_TEXT, 3).try_cast("int"), F.lit(0))
    digits = F.concat(whole, part)
    solid = F.rtrim(digits, F.lit("0"))
    needed = F.length(part) - exponent - (F.length(digits) - F.length(solid))
    is_number = text.rlike(DECIMAL_TEXT) & (digits != "")
    return F.when(is_number, F.when(solid == "", 0).otherwise(F.greatest(needed, F.lit(0))))


def value_measures(contract: TableContract) -> list[Measure]:
    """Per column, values that the cast changed without failing.

    ``rounded``: numbers with more decimals than their type keeps. ``shortened``:
    dates given with a time of day. To be evaluated over ``conform_with_text``.
    """
    found = []
    for column, sql_type in contract.columns.items():
        text, typed = F.col(column + TEXT_SUFFIX), F.col(column)
        kind = T.DataType.fromDDL(sql_type)
        if isinstance(kind, T.DecimalType):
            changed, metric = decimals_needed(text) > kind.scale, "rounded"
        elif isinstance(kind, T.DateType) and column not in contract.partial_dates:
            changed, metric = text.rlike(DATE_WITH_TIME), "shortened"
        else:
            continue
        found.append(Measure("changed_values", column, metric, F.count_if(changed & typed.isNotNull())))
    return found


def changed_values(raw: DataFrame, contract: TableContract) -> DataFrame:
    """(column, metric, values) of values that casts completed, rounded or shortened.

    One pass over ``raw``; columns whose type changes nothing have no row.
    """
    audited = conform_with_text(raw, contract)
    measures = [*imputed_date_measures(contract), *value_measures(contract)]
    return measure(audited, measures).select("column", "metric", F.col("value").alias("values"))


def cast_failures(raw: DataFrame, contract: TableContract) -> DataFrame:
    """(column, failures), one row per cast column, in one pass over ``raw``."""
    audited = conform_with_text(raw, contract)
    return measure(audited, cast_failure_measures(contract)).select(
        "column", F.col("value").alias("failures")
    )
