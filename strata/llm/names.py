"""Names for helper columns that an input table does not have."""

from __future__ import annotations

from pyspark.sql import DataFrame


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many underscores before it as it takes to be new in ``df``."""
    taken = {column.lower() for column in df.columns}
    free = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        free.append(name)
    return free
