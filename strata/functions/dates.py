"""Calendar expressions. All are built-ins, so they stay in generated code."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted date texts. \z instead of $ so that a trailing newline
# does not pass.
DAY_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
MONTH_PATTERN = r"^[0-9]{4}-[0-9]{2}\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_precision(text: Column | str) -> Column:
    """'day' for YYYY-MM-DD text, 'month' for YYYY-MM text, else NULL.

    Judges the shape only: '2021-02-30' is 'day' although it is no date.
    """
    text = _col(text)
    return F.when(text.rlike(DAY_PATTERN), "day").when(text.rlike(MONTH_PATTERN), "month")


def partial_date(text: Column | str) -> Column:
    """DATE of a full date, or the first of the month for YYYY-MM; else NULL.

    The shape is matched before the cast because Spark's own cast also accepts
    '2021' and '2021-5'.
    """
    text = _col(text)
    full = F.when(text.rlike(DAY_PATTERN), text).when(
        text.rlike(MONTH_PATTERN), F.concat(text, F.lit("-01"))
    )
    return full.try_cast("date")


def business_days(start: Column | str, end: Column | str, reversed_range: str = "null") -> Column:
    """Mondays to Fridays after ``start`` up to and including ``end`` (INT).

    NULL when either side is NULL. When ``end`` precedes ``start`` the result is
    NULL, or with ``reversed_range="negate"`` minus the count of the swapped range.

    Constant work per row: shifting both dates back to the Monday of their week
    leaves whole weeks of five working days, and each date then adds the working
    days it has itself used up in its week.
    """
    if reversed_range not in ("null", "negate"):
        raise ValueError("reversed_range must be 'null' or 'negate'")
    start, end = _col(start), _col(end)
    start_day, end_day = F.weekday(start), F.weekday(end)  # Monday 0 .. Sunday 6
    between_mondays = F.datediff(end, start) - end_day + start_day  # multiple of 7
    days = (
        (between_mondays / 7 * 5).cast("int")
        + F.least(end_day, F.lit(4))
        - F.least(start_day, F.lit(4))
    )
    return days if reversed_range == "negate" else F.when(end >= start, days)


def lead_time(
    start: Column | str,
    end: Column | str,
    precision: Column | str,
    end_precision: Column | str | None = None,
) -> Column:
    """Business days, but NULL when a date is only known to the month.

    ``precision`` belongs to the start; that of the end is looked at where given.
    """
    known = [_col(p) for p in (precision, end_precision) if p is not None]
    is_month = reduce(or_, [F.coalesce(p == "month", F.lit(False)) for p in known])
    return F.when(~is_month, business_days(start, end))
