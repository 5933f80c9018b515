"""Equal rows left out before they move."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

SEEN = 1 << 20  # keys that a task remembers


def without_copies(df: DataFrame, key: str) -> DataFrame:
    """``df`` without rows whose ``key`` the same task has just had.

    A task remembers the last ``SEEN`` keys or so, so some copies may stay: this spares
    a join the rows of a text that is copied a million times, and replaces no grouping.
    """

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            fresh = []
            for value in batch.column(key).to_pylist():
                fresh.append(value not in seen)
                seen.add(value)
            if len(seen) > SEEN:
                seen = set()
            yield batch if all(fresh) else batch.filter(pa.array(fresh))

    return df.mapInArrow(first, df.schema)
