"""Fact tables at the grain of the lines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.heavy import SPREAD, dealt, heavy_keys

PARTS = 1 << 20  # over which lines without a key, or of a heavy one, are dealt out


def build_fact(
    lines: DataFrame,
    headers: DataFrame,
    key: str,
    rename: Mapping[str, str] | None = None,
    derived: Mapping[str, Column] | None = None,
    spread_by: Sequence[str] = (),
    even: bool = False,
) -> DataFrame:
    """All line columns, then the header columns without ``key``, then ``derived``.

    A line without a header is kept with NULLs. ``rename`` applies to header
    columns; ``derived`` expressions see the joined row.

    Lines without a key match nothing, yet a join on the key alone would bring
    them all to one task. So a second join column is 0 for every key, and deals
    lines without one out by a hash of ``spread_by`` (all columns but the key
    where none are named; name some that are read anyway). No hint is given: a
    header table below the session's broadcast threshold is broadcast, a larger
    one is sort-merged, and adaptive execution splits the line side of a
    partition that one key has blown up.

    That splitting starts at 256 MB by default and only where nothing behind the
    join needs its partitioning. ``even`` does without it: a pass over the key column,
    made at once, finds the keys with many lines, and these are dealt out as well, each
    to as many tasks as it fills, with its headers repeated there (see ``heavy``).
    """
    renamed = headers.withColumnsRenamed(dict(rename or {}))
    added = [c for c in renamed.columns if c != key]
    clash = {c.lower() for c in added} & {c.lower() for c in lines.columns}
    if clash:
        raise ValueError(f"columns on both sides, rename them: {sorted(clash)}")
    others = list(spread_by) or [c for c in lines.columns if c.lower() != key.lower()]
    part = F.pmod(F.xxhash64(*others), F.lit(PARTS)) if others else F.lit(0)
    heavy = heavy_keys(lines, key) if even else []
    if heavy:
        left, right = dealt(lines, renamed, key, part, heavy)
    else:
        left = lines.withColumn(SPREAD, F.when(F.col(key).isNull(), part + 1).otherwise(0))
        # Zero for every header, but not a constant, which would take the column out of the join.
        right = renamed.withColumn(SPREAD, F.pmod(F.xxhash64(key), F.lit(1)))
    joined = left.join(right, on=[key, SPREAD], how="left").select(*lines.columns, *added)
    for name, expression in (derived or {}).items():
        joined = joined.withColumn(name, expression)
    return joined
