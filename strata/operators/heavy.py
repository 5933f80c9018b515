"""Keys that hold more rows than a task should, and joins that deal them out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

PIECES = 16  # parts of a mean task into which a heavy key's rows are cut
TRACKED = 1_000_000  # keys that a sketch follows at most, by its own limit
SPREAD, HEAVY, CUTS = "__spread", "__heavy", "__cuts"


def heavy_keys(df: DataFrame, key: str, tasks: int | None = None) -> list[Row]:
    """(key, cuts) of keys with more rows than a sixteenth of a mean task's.

    One pass over the key column: every task sends a sketch of its most frequent keys,
    not its keys, and the merged sketch is one row. A sketch that follows m keys is off
    by less than 4/m of all rows, and m is chosen for half of the share looked for, so
    every key above one and a half times that share is found. ``cuts`` is into how many
    parts a key's rows are to be dealt. ``tasks`` is the number of shuffle partitions
    unless given; from 7,813 tasks on the share stays the same. NULL is no key.

    The driver gets a row for each key found, ``16 * tasks`` at most and 125,000 in
    any case. They are fixed here, because two evaluations of a sketch may differ.
    """
    tasks = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = min(PIECES * tasks, TRACKED // 8)
    keys = df.select(F.col(key).alias(HEAVY)).where(F.col(HEAVY).isNotNull())
    sketch = F.expr(f"approx_top_k({HEAVY}, {most}, {8 * most})")
    top = keys.agg(sketch.alias("top"), F.count(F.lit(1)).alias("n")).select("n", F.inline("top"))
    share = F.col("count") * most / F.col("n")
    return top.where(share > 1).select(F.col("item").alias(HEAVY), F.ceil(share).alias(CUTS)).collect()


def dealt(
    lines: DataFrame, headers: DataFrame, key: str, by: Column, heavy: list[Row]
) -> tuple[DataFrame, DataFrame]:
    """Both sides of an equi-join with a second join column ``SPREAD``.

    It is 0 for ordinary keys. Lines of a heavy key get one of its ``cuts`` numbers by
    ``by``, a number from 0 on that differs between them, and its headers are repeated
    once for each: ``2 * 16 * tasks`` more headers at most where their key is unique.
    Lines without a key are dealt out by ``by`` as well. Lines look heavy keys up in a
    broadcast, whose size is that of ``heavy``.
    """
    kind = T.StructType([T.StructField(HEAVY, lines.schema[key].dataType), T.StructField(CUTS, T.LongType())])
    found = F.broadcast(lines.sparkSession.createDataFrame(heavy, kind))
    flagged = lines.join(found, F.col(key) == F.col(HEAVY), "left")
    part = F.when(F.col(CUTS).isNotNull(), F.pmod(by, F.col(CUTS)))
    part = part.when(F.col(key).isNull(), by + 1).otherwise(F.lit(0)).cast("long")
    repeated = headers.join(found, F.col(key) == F.col(HEAVY), "left")
    numbers = F.sequence(F.lit(0).cast("long"), F.coalesce(CUTS, F.lit(1)) - 1)
    return (
        flagged.select(*lines.columns, part.alias(SPREAD)),
        repeated.select(*headers.columns, F.explode(numbers).alias(SPREAD)),
    )
