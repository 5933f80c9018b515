"""Tables that a stage writes and the next stage reads back."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class LayerTable:
    """A written table, read back, with the figures taken while writing it."""

    path: str
    frame: DataFrame
    metrics: Mapping[str, int]

    @property
    def rows(self) -> int:
        return self.metrics["rows"]


def layer_path(root: str, layer: str, name: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{layer}_{name}"


def write_layer(
    df: DataFrame,
    path: str,
    metrics: Mapping[str, Column] | None = None,
    drop: tuple[str, ...] = (),
) -> LayerTable:
    """Replace the Parquet table at ``path`` and scan it back.

    The row count and any further aggregate ``metrics`` are observed during the
    write, so they cost no extra job. ``drop`` names columns the metrics need
    but the table does not keep. The observation sits above the last shuffle,
    that is in the writing stage, whose tasks report exactly once even when an
    executor is lost and its partitions are recomputed.

    Reading back with the known schema starts the next stage from files: its
    plan does not grow, and a lost executor costs no recomputation upstream.
    """
    observation = Observation()
    named = {"rows": F.count(F.lit(1)), **(metrics or {})}
    observed = df.observe(observation, *[agg.alias(name) for name, agg in named.items()])
    kept = observed.drop(*drop)
    kept.write.mode("overwrite").parquet(path)
    back = df.sparkSession.read.schema(kept.schema).parquet(path)
    return LayerTable(path, back, {name: int(v or 0) for name, v in observation.get.items()})


def row_hash(df: DataFrame) -> Column:
    """Sum of the rows' hashes as a decimal: equal for equal rows in any order.

    Repeated rows count each time, and NULL differs from every value.
    """
    cells = [cell for c in df.columns for cell in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    hashes = F.xxhash64(*cells) if cells else F.lit(0)
    return F.sum(hashes.cast("decimal(20,0)"))
