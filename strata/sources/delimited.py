"""All-string scans of delimited files."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources.files import list_files, read_head

# How the files are written.
DELIMITED_OPTIONS = {"header": "true", "sep": ",", "encoding": "UTF-8"}


def header_columns(spark: SparkSession, path: str | list[str], **options: str) -> list[str]:
    """Column names from the header line; reads the first line only."""
    settings = {**DELIMITED_OPTIONS, **options, "inferSchema": "false"}
    return spark.read.options(**settings).csv(path).columns


def scan_delimited(
    spark: SparkSession,
    path: str | list[str],
    columns: list[str] | None = None,
    corrupt_column: str | None = None,
    multi_line: bool = False,
    **options: str,
) -> DataFrame:
    """Every column as text, nothing inferred or cleaned.

    ``columns`` saves the look at the header when the names are known; the
    header of every file must then agree with them, or the read fails.
    ``corrupt_column`` keeps the full text of lines with too few or too many
    fields. It needs every field of a line, so column pruning in the parser is
    switched off with it; without that, Spark flags such lines only when all
    columns happen to be selected. Spark refuses a query of raw files that reads
    this column alone; ask for another one beside it, or write the rows first.
    ``multi_line`` accepts quoted line breaks. Such files cannot be split, so
    one file is one task: leave it off unless the files are known to be small.
    A broken-up quoted line is otherwise caught by ``corrupt_column``.

    A missing path raises when the scan is built.
    """
    settings = {**DELIMITED_OPTIONS, "enforceSchema": "false", **options}
    if multi_line:
        settings["multiLine"] = "true"
    names = columns if columns is not None else header_columns(spark, path, **options)
    fields = [T.StructField(name, T.StringType()) for name in names]
    if corrupt_column is not None:
        if corrupt_column in names:
            raise ValueError(f"{corrupt_column!r} is also a column of the file")
        fields.append(T.StructField(corrupt_column, T.StringType()))
        settings |= {
            "mode": "PERMISSIVE",
            "columnNameOfCorruptRecord": corrupt_column,
            "columnPruning": "false",
        }
    return spark.read.schema(T.StructType(fields)).options(**settings).csv(path)


def header_groups(spark: SparkSession, path: str, **options: str) -> dict[tuple[str, ...], list[str]]:
    """The files below ``path`` by the columns of their header lines.

    The driver reads the first line of each file, several at a time, and keeps the
    files' names, as Spark does when it lists them. Empty files have no columns and
    no rows, and are left out.
    """
    settings = {**DELIMITED_OPTIONS, **options}
    files = list_files(spark, path)
    with ThreadPoolExecutor(max_workers=16) as pool:
        heads = pool.map(lambda file: read_head(spark, file, settings["encoding"]), files)
        groups: dict[tuple[str, ...], list[str]] = {}
        for file, head in zip(files, heads):
            if head:
                fields = next(csv.reader([head], delimiter=settings["sep"], quotechar=settings.get("quote", '"')))
                groups.setdefault(tuple(fields), []).append(file)
    return groups


def scan_drifting(
    spark: SparkSession,
    path: str,
    corrupt_column: str | None = None,
    multi_line: bool = False,
    rename: Mapping[str, str] | None = None,
    **options: str,
) -> DataFrame:
    """The files of one table whose headers have drifted apart, united by column name.

    Files with the same header line are one scan, whatever their number; columns that
    a file does not have are NULL, and a line is malformed by its own file's header.
    Columns come in the order in which the first file that has them gives them, files
    being taken by name. ``rename`` maps a header's name to the table's; two
    columns of one file with one name raise. A header line that cannot be united
    (no name in common with the others) raises as well, since such a file has most
    likely lost its header.
    """
    groups = header_groups(spark, path, **options)
    if not groups:
        raise ValueError(f"no header line in any file at {path}")
    names = dict(rename or {})
    order: list[str] = []
    scans: list[DataFrame] = []
    for header, files in groups.items():
        own = [names.get(c, c) for c in header]
        if len({c.lower() for c in own}) < len(own):
            raise ValueError(f"a column stands twice in the header of {files[0]}: {list(header)}")
        if order and not {c.lower() for c in own} & {c.lower() for c in order}:
            raise ValueError(f"{files[0]} has no column in common with the files before it: {list(header)}")
        order += [c for c in own if c.lower() not in {known.lower() for known in order}]
        scan = scan_delimited(spark, files, own, corrupt_column, multi_line, **{**options, "enforceSchema": "true"})
        scans.append(scan)
    marks = [corrupt_column] if corrupt_column else []
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)
    return united.select(*[F.col(f"`{c}`") for c in [*order, *marks]])


def drift_report(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """(column, files, missing): in how many files each column is, and in how many not."""
    groups = header_groups(spark, path, **options)
    total = sum(map(len, groups.values()))
    holders: dict[str, int] = {}
    for header, files in groups.items():
        for column in header:
            holders[column] = holders.get(column, 0) + len(files)
    rows: Sequence[tuple] = [(c, n, total - n) for c, n in holders.items()]
    return spark.createDataFrame(rows, "column string, files int, missing int")
