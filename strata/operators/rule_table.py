"""Category maps of any size: rules as rows of a table, matched by equi-joins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.contracts import ValueRule
from strata.operators.fact import build_fact

CROWD = 16  # patterns that may be filed under one of their pieces
FEW = 10_000  # patterns of a size that are looked up apart from larger sizes
RULE_COLUMNS = "rule bigint, label string, kind string, pattern string"
VALUE, LABEL, PIECE, SIZE = "__value", "__label", "__piece", "__size"


def rule_table(df: DataFrame, rules: Sequence[ValueRule]) -> DataFrame:
    """``rules`` as a table of ``RULE_COLUMNS``, numbered in their order."""
    rows = [
        (number, rule.label, kind, pattern)
        for number, rule in enumerate(rules)
        for kind, patterns in (("equals", rule.equals), ("contains", rule.contains))
        for pattern in patterns
    ]
    return df.sparkSession.createDataFrame(rows, RULE_COLUMNS)


def map_values_table(
    df: DataFrame,
    target: str,
    source: str,
    rules: DataFrame,
    spread_by: Sequence[str] = (),
    folder: str | None = None,
) -> DataFrame:
    """Fill NULLs of ``target`` from ``source`` by the matching rule of the least number.

    ``rules`` has the columns ``rule``, ``label``, ``kind`` ('equals' or 'contains')
    and ``pattern``; a rule may have several rows. Matching is that of
    ``map_values``: case-sensitive, a given value is never replaced, a source that no
    rule matches leaves NULL, and rows without label or pattern match nothing. Of two
    rules with one number the lesser label wins.

    The distinct sources of rows without a target are labelled, and the labels joined
    back, so a rule costs a row of a join and not a branch for every row of ``df``;
    the first of the two looks at ``df`` reads these two columns only. Equal
    texts meet by the text. A substring is filed under one of its pieces, a value looks
    up its own pieces, and only what it finds is compared with it. Pieces have 1, 2, 4,
    8 ... characters, as many as the pattern has room for, and of a pattern's pieces the
    one that the fewest others of such a length have is taken. Patterns of which more
    than ``CROWD`` would meet there are filed under themselves. So a piece leads to a
    handful of patterns however many rules there are, and a value costs a row for each
    of its pieces of a size in use: as many sizes as the lengths of patterns have powers
    of two, and the lengths of crowded ones.

    No side is forced to be broadcast: whether the rules are small is left to Spark's own
    check. It sees a size only in what is written, so with a ``folder``, which must not
    exist, the filed patterns are written there first, at once, and sizes that few of
    them have are looked up in a join of their own, mostly without moving the values.
    ``spread_by`` names columns that deal rows with a given target over tasks.
    """
    wanted = F.when(F.col(target).isNull(), F.col(source))
    values = df.select(wanted.alias(VALUE)).where(F.col(VALUE).isNotNull()).distinct()
    listed = rules.where("label is not null and pattern is not null")
    first = F.min(F.struct("rule", "label")).alias("first")
    equal = listed.where("kind = 'equals'").groupBy("pattern").agg(first)
    found = values.join(equal, F.col(VALUE) == F.col("pattern")).select(VALUE, "first")
    inside = _substring_matches(values, listed.where("kind = 'contains'"), folder)
    labels = found.unionAll(inside).groupBy(VALUE).agg(F.min("first").alias("first"))
    labels = labels.select(VALUE, F.col("first.label").alias(LABEL))
    others = list(spread_by) or [c for c in df.columns if c not in (target, source)]
    joined = build_fact(df.withColumn(VALUE, wanted), labels, VALUE, spread_by=others)
    filled = F.coalesce(F.col(target), F.col(LABEL)).alias(target)
    return joined.select(*[filled if c == target else c for c in df.columns])


def _pieces(text: Column, size: Column) -> Column:
    """Every run of ``size`` characters of a text that has as many."""
    runs = F.transform(F.sequence(F.lit(1), F.length(text) - size + 1), lambda at: F.substring(text, at, size))
    return F.when(F.length(text) >= size, runs).otherwise(F.array().cast("array<string>"))


def _filed(rules: DataFrame) -> DataFrame:
    """Every pattern with its first rule, the piece it is filed under and the piece's size."""
    pattern = F.col("pattern")
    length = F.length(pattern)
    size = F.least(length, F.pow(F.lit(2), F.length(F.bin(length)) - 1).cast("int"))
    patterns = rules.groupBy("pattern").agg(F.min(F.struct("rule", "label")).alias("first"))
    pieces = patterns.select("pattern", "first", F.explode(F.array_distinct(_pieces(pattern, size))).alias(PIECE))
    common = pieces.groupBy(PIECE).agg(F.count(F.lit(1)).alias("n"))
    rarest = F.min(F.struct("n", PIECE))[PIECE].alias(PIECE)
    filed = pieces.join(common, PIECE).groupBy("pattern", "first").agg(rarest)
    crowded = filed.groupBy(PIECE).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CROWD)
    piece = F.when(F.col("n").isNull(), F.col(PIECE)).otherwise(pattern).alias(PIECE)
    filed = filed.join(crowded, PIECE, "left").select("pattern", "first", piece)
    return filed.withColumn(SIZE, F.length(PIECE))


def _substring_matches(values: DataFrame, rules: DataFrame, folder: str | None) -> DataFrame:
    """(value, first) for every value and piece that leads to a rule whose pattern it holds."""
    filed = _filed(rules)
    if folder is None:
        return _met(values, filed, filed.agg(F.collect_set(SIZE)).scalar())
    filed.write.partitionBy(SIZE).parquet(folder)
    written = filed.sparkSession.read.schema(filed.schema).parquet(folder)
    counts = {row[SIZE]: row["count"] for row in written.groupBy(SIZE).count().collect()}
    few = [size for size, n in counts.items() if n <= FEW]
    many = [size for size, n in counts.items() if n > FEW]
    parts = [
        _met(values, written.where(F.col(SIZE).isin(sizes)), F.array(*map(F.lit, sizes)).cast("array<int>"))
        for sizes in (few, many)
        if sizes or sizes is few
    ]
    return reduce(DataFrame.unionAll, parts)


def _met(values: DataFrame, filed: DataFrame, sizes: Column) -> DataFrame:
    """(value, first) for every value and a piece of ``sizes`` that leads to a pattern it holds."""
    text, at, size = F.col(VALUE), F.col("at"), F.col("size")
    sized = values.select(VALUE, F.explode(sizes).alias("size")).where(F.length(text) >= size)
    places = sized.select(VALUE, "size", F.explode(F.sequence(F.lit(1), F.length(text) - size + 1)).alias("at"))
    pieces = places.select(VALUE, "at", F.substring(text, at, size).alias(PIECE))
    # A piece that stands in a text twice is asked for once.
    asked = pieces.where(F.instr(text, F.col(PIECE)) == at).select(VALUE, PIECE)
    met = asked.join(filed, PIECE).where(F.contains(text, F.col("pattern")))
    return met.groupBy(VALUE).agg(F.min("first").alias("first"))
