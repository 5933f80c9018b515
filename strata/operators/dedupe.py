"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

POSITION = "__position"


def keep_best(
    df: DataFrame,
    key: Sequence[str],
    complete: Sequence[str],
    order: Sequence[str] = (),
    rank: str = "additive",
) -> DataFrame:
    """The most complete row of every key; NULL keys count as one key.

    ``rank="additive"`` prefers fewer NULLs among ``complete``, whichever they
    are. ``rank="lexicographic"`` settles the first of ``complete`` before it
    looks at the next. Rows still level are ordered by ``order``, NULLs last,
    and then by all other columns, so the choice never depends on the layout.

    Spark cuts each input partition to one row per key before the shuffle, so
    a key with very many copies sends one row per task.
    """
    gaps = [F.col(c).isNull().cast("int") for c in complete]
    if rank == "additive":
        preference = [reduce(add, gaps)]
    elif rank == "lexicographic":
        preference = gaps
    else:
        raise ValueError("rank must be 'additive' or 'lexicographic'")
    rest = [c for c in df.columns if c not in {*key, *order}]
    ordering = preference + [F.col(c).asc_nulls_last() for c in [*order, *rest]]
    position = F.row_number().over(Window.partitionBy(*key).orderBy(*ordering))
    return df.withColumn(POSITION, position).filter(F.col(POSITION) == 1).drop(POSITION)
