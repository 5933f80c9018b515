"""Tables in versions: a reader sees a whole version or the one before, never half of one.

A table's folder holds a folder for each version and one small file that names the
current one. A version is written first, and the file is replaced last, by a rename; a
write that dies leaves a folder that no reader looks at. Beside the version's name the
file keeps the schema, the figures taken during the write and, where order matters, the
version's part files in order.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from strata.sources.files import delete, list_files, list_folders, read_small, replace_small
from strata.sources.layers import LayerTable, write_layer

POINTER = "_current"


def publish_layer(
    df: DataFrame,
    path: str,
    metrics: Mapping[str, Column] | None = None,
    drop: tuple[str, ...] = (),
    in_order: bool = False,
    keep: int = 2,
) -> LayerTable:
    """Write ``df`` as the next version of the table at ``path`` and make it the current one.

    ``metrics`` and ``drop`` are those of ``write_layer``. ``in_order`` notes the part
    files in the order of ``df``'s partitions, so that a sorted answer is read back
    sorted. Versions beyond the last ``keep`` are removed once the new one is current;
    two let readers of the former one finish. Of two writers at once the later one's
    version is current, and both are whole.
    """
    spark = df.sparkSession
    before = _pointer(spark, path)
    history = [before["version"], *before["earlier"]] if before else []
    number = int(history[0][1:].split("-")[0]) + 1 if history else 1
    version = f"v{number:06d}-{uuid.uuid4().hex[:8]}"
    table = write_layer(df, f"{path}/{version}", metrics, drop)
    entry = {
        "version": version,
        "earlier": history[: max(keep - 1, 0)],
        "schema": table.frame.schema.jsonValue(),
        "metrics": dict(table.metrics),
        "files": _part_files(spark, table.path) if in_order else None,
    }
    replace_small(spark, f"{path}/{POINTER}", json.dumps(entry))
    for old in history[max(keep - 1, 0) :]:
        delete(spark, f"{path}/{old}")
    return _opened(spark, path, entry)


def read_layer(spark: SparkSession, path: str) -> LayerTable:
    """The current version of the table at ``path``, with the figures of its write.

    A version that was written in order is read in order, with a scan for each part
    file; ask for order of answers that someone reads, not of tables of many files.
    """
    entry = _pointer(spark, path)
    if entry is None:
        raise FileNotFoundError(f"no published table at {path}")
    return _opened(spark, path, entry)


def drop_abandoned(spark: SparkSession, path: str, hours: float = 24) -> list[str]:
    """Remove version folders that writes which died have left, and return their names.

    The current version and those it names as earlier stay, and so does any folder that
    changed within the last ``hours``, since a write may still be going on in it.
    """
    entry = _pointer(spark, path)
    named = {entry["version"], *entry["earlier"]} if entry else set()
    left = [
        name
        for name, age in list_folders(spark, path)
        if re.fullmatch(r"v[0-9]{6,}-[0-9a-f]{8}", name) and name not in named and age >= 3600 * hours
    ]
    for name in left:
        delete(spark, f"{path}/{name}")
    return sorted(left)


def _opened(spark: SparkSession, path: str, entry: dict) -> LayerTable:
    folder = f"{path}/{entry['version']}"
    reader = spark.read.schema(T.StructType.fromJson(entry["schema"]))
    files = entry["files"]
    if files:
        frame = reduce(DataFrame.unionAll, [reader.parquet(f"{folder}/{name}") for name in files])
    else:
        frame = reader.parquet(folder)
    return LayerTable(folder, frame, entry["metrics"])


def unordered(spark: SparkSession, table: LayerTable) -> LayerTable:
    """The same version in one scan, for work that does not need its order."""
    return replace(table, frame=spark.read.schema(table.frame.schema).parquet(table.path))


def _pointer(spark: SparkSession, path: str) -> dict | None:
    text = read_small(spark, f"{path}/{POINTER}")
    return None if text is None else json.loads(text)


def _part_files(spark: SparkSession, folder: str) -> list[str]:
    """Names of a version's part files; Spark numbers them by partition."""
    names = [file.rsplit("/", 1)[1] for file in list_files(spark, folder)]
    return sorted(name for name in names if name.startswith("part-"))
