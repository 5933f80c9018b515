"""Connected components of an edge table, by large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.sources import layer_path, write_layer


def connected_components(edges: DataFrame, folder: str) -> DataFrame:
    """(node, component) for each node of ``edges`` (a, b); component is the least node.

    Each round hangs the larger neighbours of every node below its least
    neighbour, then does the same with the smaller ones, and writes the edges it
    leaves. The edges never outnumber the first ones, a hub's least neighbour is
    a partial aggregate, and nothing but two sums a round reaches the driver.
    Loops and repeated edges are harmless; an empty table gives an empty one.
    """
    a, b = F.col("a"), F.col("b")
    current = edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    before = None
    round_no = 0
    while True:
        both = current.select("a", "b").union(current.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
        large = (
            both.join(least, "a")
            .where((b > a) & (F.col("b") != F.col("least")))
            .select(b.alias("a"), F.col("least").alias("b"))
            .union(least.where("a != least").select("a", F.col("least").alias("b")))
            .distinct()
        )
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = (
            large.join(least, "a")
            .where("b != least")
            .select(b.alias("a"), F.col("least").alias("b"))
            .union(least.select("a", F.col("least").alias("b")))
            .distinct()
        )
        marks = {"mark": F.sum(F.xxhash64("a", "b") % 1_000_000_007)}
        written = write_layer(small, layer_path(folder, "components", f"{round_no}"), marks)
        current = written.frame
        after = (written.rows, written.metrics["mark"])
        if after == before:
            break
        before, round_no = after, round_no + 1
    roots = current.select(b.alias("node"), b.alias("component")).distinct()
    return current.select(a.alias("node"), b.alias("component")).union(roots)
