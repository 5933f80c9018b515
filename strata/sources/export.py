"""Results as CSV that reads back as it was."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources.layers import row_hash

# How results are written. Quotes are doubled, empty text is quoted and NULL is
# not, blanks stay, times keep their microseconds.
EXPORT_OPTIONS = {
    "header": "true",
    "sep": ",",
    "encoding": "UTF-8",
    "lineSep": "\n",
    "quote": '"',
    "escape": '"',
    "charToEscapeQuoteEscaping": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
# Fixed value: NULL for the reader, and in a table of one column also in the file, where
# nothing at all would be a line that readers skip.
NULL_TEXT = "\\N"


def export_csv(df: DataFrame, path: str, verify: int | None = None) -> None:
    """Write a result as CSV with a header, keeping its order across part files.

    There is no coalesce(1): it would squeeze the whole upstream stage into one
    task. Adaptive execution already merges the partitions of a small sorted
    result, which then lands in a single file.

    ``verify`` is the ``row_hash`` that ``df`` had when its layer was written: the
    files are then read back, and anything but the same rows raises. That can only
    happen to text that is the mark for NULL itself.
    """
    alone = len(df.columns) == 1
    settings = EXPORT_OPTIONS | {"nullValue": NULL_TEXT if alone else "", "emptyValue": '""'}
    df.write.mode("overwrite").options(**settings).csv(path)
    if verify is not None:
        back = read_export(df.sparkSession, path, df.schema)
        found = back.agg(F.coalesce(row_hash(back), F.lit(0))).first()[0]
        if int(found) != verify:
            raise ValueError(f"the CSV at {path} does not hold the rows of its layer")


def read_export(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of ``export_csv``: every text, line breaks included, and every NULL.

    Quoted line breaks keep a file from being split, so a file is a task.
    """
    settings = EXPORT_OPTIONS | {"multiLine": "true", "nullValue": NULL_TEXT, "emptyValue": ""}
    return spark.read.schema(schema).options(**settings).csv(path)
