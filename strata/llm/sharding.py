"""Reproducible shuffling and sharding by a Feistel permutation of global row numbers.

Rows get gapless numbers; a Feistel network permutes the numbers; the permuted
number names shard and slot. Given the row count and a seed, the place of any row
and the row at any place are computed without touching data.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.sources import layer_path, scratch_dir, write_layer

BUCKETS = 16_384  # parts that are numbered independently; their counts are one small table
CHUNK = 4_096  # copies of one row that are numbered together
ROUNDS = 6


def feistel(number: Column, n: int, seed: int = 0) -> Column:
    """Permutes 0 .. n-1: a long in that range becomes another one."""
    return _walked(number, n, seed, forward=True)


def feistel_inverse(number: Column, n: int, seed: int = 0) -> Column:
    """Undoes ``feistel``."""
    return _walked(number, n, seed, forward=False)


def _walked(number: Column, n: int, seed: int, forward: bool) -> Column:
    """Cycle walking: the network permutes 0 .. rows * columns - 1, at least n.

    Results of n and more are permuted again. Such numbers are fewer than the
    square root of n, and a walk meets none twice, so a walk has no more steps
    than there are such numbers, and hardly any row starts one. The steps are
    counted in two nested loops, whose product covers the longest walk.
    """
    if n < 1:
        return number.cast("long")
    high = math.isqrt(n - 1) + 1
    low = -(-n // high)
    outside = high * low - n
    first = _network(number.cast("long"), high, low, seed, forward)
    if not outside:
        return first
    loop = F.sequence(F.lit(1), F.lit(math.isqrt(outside) + 1))

    def step(at: Column, _: Column) -> Column:
        return F.when(at < n, at).otherwise(_network(at, high, low, seed, forward))

    def steps(at: Column, _: Column) -> Column:
        return F.when(at < n, at).otherwise(F.aggregate(loop, at, step))

    return F.when(first < n, first).otherwise(F.aggregate(loop, first, steps))


def _network(number: Column, high: int, low: int, seed: int, forward: bool) -> Column:
    """Feistel rounds on the two digits of a number: each shifts one by a hash of the other."""
    left, right = _div(number, low), number % low
    for k in range(ROUNDS) if forward else reversed(range(ROUNDS)):
        source, size = (right, high) if k % 2 == 0 else (left, low)
        shift = F.pmod(F.xxhash64(F.lit(seed), F.lit(k), source), F.lit(size))
        moved = left if k % 2 == 0 else right
        moved = (moved + (shift if forward else size - shift)) % size
        left, right = (moved, right) if k % 2 == 0 else (left, moved)
    return left * low + right


def place(number: Column, n: int, shards: int, seed: int = 0) -> tuple[Column, Column]:
    """Shard and slot of a row number; shard sizes differ by one at most, slots have no gaps."""
    at = feistel(number, n, seed)
    return (at % shards).cast("int"), _div(at, shards)


def row_at(shard: Column, slot: Column, n: int, shards: int, seed: int = 0) -> Column:
    """Row number at a place: the inverse of ``place``."""
    return feistel_inverse(slot.cast("long") * shards + shard, n, seed)


def _div(number: Column, by: int) -> Column:
    """Integral division of longs, exact beyond the 53 bits of a double."""
    return F.call_function("div", number, F.lit(by).cast("long"))


def number_rows(df: DataFrame, folder: str | None = None) -> tuple[DataFrame, int]:
    """``df`` with a gapless ``row_number`` from 0 on, and the number of rows.

    The number depends on the rows' values alone, not on files, partitions or
    tasks, so it is the same after a retry and in every run. Equal rows are counted
    before the shuffle and numbered in chunks, which the hash spreads, so however
    often a row is repeated it fills no task. An input column of the name
    ``row_number`` is replaced. Columns must be comparable (no maps). An empty
    table stays empty.
    """
    df = df.drop("row_number")
    folder = folder or scratch_dir(df.sparkSession)
    columns = df.columns
    alias = [f"_c{i}" for i in range(len(columns))]
    counted = df.toDF(*alias).groupBy(*alias).agg(F.count("*").alias("_copies"))
    chunks = F.sequence(F.lit(0).cast("long"), _div(F.col("_copies") - 1, CHUNK))
    chunked = (
        counted.withColumn("_chunk", F.explode(chunks))
        .withColumn("_copies", F.least(F.lit(CHUNK), F.col("_copies") - F.col("_chunk") * CHUNK))
        .withColumn("_bucket", F.pmod(F.xxhash64(*alias, "_chunk"), F.lit(BUCKETS)))
    )
    sizes = write_layer(
        chunked.groupBy("_bucket").agg(F.sum("_copies").alias("_size")),
        layer_path(folder, "sharding", "buckets"),
        {"total": F.sum("_size")},
    )
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.frame.select("_bucket", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))
    within = (
        Window.partitionBy("_bucket")
        .orderBy(*alias, "_chunk")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    numbered = (
        chunked.withColumn("_before", F.coalesce(F.sum("_copies").over(within), F.lit(0)))
        .join(starts, "_bucket")
        .withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)))
    )
    number = (F.col("_start") + F.col("_before") + F.col("_copy")).alias("row_number")
    named = [F.col(a).alias(c) for a, c in zip(alias, columns)]
    return numbered.select(*named, number), sizes.metrics["total"]


def shard_rows(
    df: DataFrame, shards: int, seed: int = 0, folder: str | None = None
) -> DataFrame:
    """``df`` with ``row_number``, ``shard`` (0 .. shards-1) and ``slot``, in shuffled order.

    Input columns of these names are replaced. Shard sizes differ by one at most;
    with fewer rows than shards the last shards stay empty. Nulls are values like
    any other, and repeated rows get places of their own.
    """
    numbered, n = number_rows(df.drop("row_number", "shard", "slot"), folder)
    shard, slot = place(F.col("row_number"), n, shards, seed)
    return numbered.withColumns({"shard": shard, "slot": slot})
