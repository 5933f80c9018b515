"""Source divergence audit: how far the term shares of two groups of documents lie apart.

The terms that a space (a language) keeps are dealt out to blocks. Within a block
every group's counts are the leaves of a segment tree over the block's term ids, and
trees are hash-consed: equal stretches of counts are one node, in whichever group and
place they stand. Two groups are compared by walking their trees together from the
roots down; a pair of nodes that comes up again is not walked again but counted.
Prices of the distinct pairs of leaves, times how often each came up, make the
distance. The walk of a group beside its whole space, without the subtrees in which
the group has nothing, gives the terms that the group has too much of.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.words import utf8
from strata.sources import layer_path, scratch_dir, write_layer

HELD = 400_000  # entries that a task counts before it hands them on
PIECE = 1 << 20  # bytes of a text that are split at once
PARTS = 32  # into which the rows of one group or space are dealt for a join
#: Letters A-Z as a-z, other ASCII as blanks; bytes of other characters stay.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


@dataclass(frozen=True)
class Divergence:
    """``min_docs``: documents of a space that a kept term stands in. A term's share is
    1 + floor(10**9 * (count + smoothing) / (all counts + smoothing * kept terms)).
    ``top``: ranks of terms that are reported. Blocks hold up to about ``block_terms``
    terms and ``block_groups`` groups, which bounds a task's memory."""

    min_docs: int = 30
    smoothing: int = 5
    top: int = 50
    block_terms: int = 2048
    block_groups: int = 64


def term_pieces(text: bytes | None) -> Iterator[list[bytes]]:
    """Terms of a text, some at a time: runs of ASCII letters and non-ASCII characters."""
    start = 0
    while text and start < len(text):
        piece = text[start : start + PIECE].translate(_LETTERS)
        if start + PIECE < len(text):
            cut = piece.rfind(b" ")
            if cut < 0:  # a term longer than a piece: up to its end
                rest = text[start:].translate(_LETTERS)
                cut = rest.find(b" ")
                piece = rest if cut < 0 else rest[:cut]
            else:
                piece = piece[: cut + 1]
        yield piece.split()
        start += len(piece)


def term_counts(docs: DataFrame, space: str = "lang", group: str = "source") -> DataFrame:
    """(space, group, term, n, docs): occurrences of each term and documents that hold it.

    Null spaces, groups and texts count as empty. Every space and group has a row
    with an empty term and zeros besides. Each task adds up its own documents first,
    so what is shuffled does not grow with a hot group or a frequent term.
    """
    schema = pa.schema([("space", pa.string()), ("group", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])

    def rows(held: dict) -> Iterator[pa.RecordBatch]:
        for (own_space, own_group), (times, documents) in held.items():
            terms, n = list(times), list(times.values())
            for at in range(0, len(terms), 50_000):
                part = terms[at : at + 50_000]
                columns = [
                    pa.array([own_space] * len(part), pa.string()),
                    pa.array([own_group] * len(part), pa.string()),
                    pa.array(part, pa.binary()).cast(pa.string()),
                    pa.array(n[at : at + 50_000], pa.int64()),
                    pa.array([documents[t] for t in part], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            keys = zip(batch.column("space").to_pylist(), batch.column("group").to_pylist())
            for key, text in zip(keys, utf8(batch.column("text"))):
                if key not in held:
                    held[key] = (Counter({b"": 0}), Counter())
                times, documents = held[key]
                before, seen = len(times), set()
                for terms in term_pieces(text):
                    times.update(terms)
                    seen.update(terms)
                documents.update(seen)
                size += len(times) - before + 1
                if size > HELD:
                    yield from rows(held)
                    held, size = {}, 0
        yield from rows(held)

    named = {"space": space, "group": group, "text": "text"}
    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for n, c in named.items()])
    counted = texts.mapInArrow(count, "space string, group string, term string, n long, docs long")
    return counted.groupBy("space", "group", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def divergence(
    docs: DataFrame,
    rules: Divergence = Divergence(),
    space: str = "lang",
    group: str = "source",
    folder: str | None = None,
) -> DataFrame:
    """(space, group, part, item, value, rank) of every group that occurs.

    Part ``pair``: every other group of the space with the sum of the differences of
    shares over all kept terms; 0 where the space keeps none. Part ``term``: terms of
    which the group's share is greater than the space's, the first ``top``. Ranks run
    from the greatest value; equal values by item in UTF-8 order.

    Null, empty and very long texts, and null spaces and groups, are as in
    ``term_counts``; a repeated row is one more document. An empty table gives no
    rows. Extra columns are ignored, whatever their names.
    """
    folder = folder or scratch_dir(docs.sparkSession)

    def stored(df: DataFrame, name: str) -> DataFrame:
        return write_layer(df, layer_path(folder, "divergence", name)).frame

    counts = stored(term_counts(docs, space, group), "counts")
    real = counts.where("term <> ''")
    terms = (
        real.groupBy("space", "term")
        .agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"))
        .where(F.col("docs") >= rules.min_docs)
        .drop("docs")
    )
    terms = stored(terms, "terms")
    markers = counts.where("term = ''").select("space", "group")
    spaces = stored(_spaces(markers, terms, rules), "spaces")
    kept = stored(_numbered_terms(terms, spaces), "kept")
    cells = real.join(kept, ["space", "term"]).select("space", "group", "block", "term_no", "n")
    cells = stored(cells, "cells")
    groups = stored(_numbered_groups(markers, cells, spaces, rules), "groups")
    priced = _work(cells, kept, groups, spaces).groupBy("space", "block", "a", "b").applyInArrow(
        _price_block(rules), "space string, group_no int, other_no int, item string, value long"
    )
    priced = stored(priced, "priced")
    return _ranked(priced, groups, rules, space, group)


def _spaces(markers: DataFrame, terms: DataFrame, rules: Divergence) -> DataFrame:
    """(space, kept, total, blocks, chunks), a row for each space."""
    found = markers.groupBy("space").agg(F.count("*").alias("groups"))
    sums = terms.groupBy("space").agg(F.count("*").alias("kept"), F.sum("total").alias("total"))

    def parts(n: Column, size: int) -> Column:
        return F.greatest(F.ceil(n / size), F.lit(1)).cast("int")

    return found.join(sums, "space", "left").na.fill(0).select(
        "space",
        "kept",
        "total",
        parts(F.col("kept"), rules.block_terms).alias("blocks"),
        parts(F.col("groups"), rules.block_groups).alias("chunks"),
    )


def _dealt_join(large: DataFrame, small: DataFrame, on: list[str], by: str) -> DataFrame:
    """Inner join in which the rows of one key are dealt out over ``PARTS`` tasks."""
    part = F.pmod(F.xxhash64(by), F.lit(PARTS)).cast("int")
    copies = small.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    return large.withColumn("part", part).join(copies, [*on, "part"]).drop("part")


def _numbered_terms(terms: DataFrame, spaces: DataFrame) -> DataFrame:
    """Terms with a block by hash and a number in it, frequent ones first, so that counts
    of rare terms, which are often equal, lie together."""
    dealt = _dealt_join(terms, spaces.select("space", "blocks", "chunks"), ["space"], "term")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("term"), "blocks").cast("int"))
    within = Window.partitionBy("space", "block").orderBy(F.col("total").desc(), "term")
    number = (F.row_number().over(within) - 1).alias("term_no")
    return dealt.select("space", "term", "total", "block", "chunks", number)


def _numbered_groups(
    markers: DataFrame, cells: DataFrame, spaces: DataFrame, rules: Divergence
) -> DataFrame:
    """Groups with their sum of counts. A space's groups are numbered in one task: their
    pairs, which are the result, are the square of their number."""
    sums = cells.groupBy("space", "group").agg(F.sum("n").alias("total"))
    within = Window.partitionBy("space").orderBy("group")
    return (
        markers.join(sums, ["space", "group"], "left")
        .withColumn("total", F.coalesce("total", F.lit(0)))
        .withColumn("group_no", F.row_number().over(within) - 1)
        .withColumn("chunk", F.floor(F.col("group_no") / rules.block_groups).cast("int"))
        .join(spaces.select("space", "kept", "blocks", "chunks"), "space")
    )


def _work(cells: DataFrame, kept: DataFrame, groups: DataFrame, spaces: DataFrame) -> DataFrame:
    """What a task needs: counts of two chunks of groups in one block of terms.

    Rows of group -1 are the space's. Rows of term -1 hold a group's sum of counts
    and the number of terms that its space keeps.
    """

    def numbers(n: str) -> Column:
        return F.sequence(F.lit(0), F.col(n) - 1)

    def beside(df: DataFrame) -> DataFrame:
        other = df.withColumn("other", F.explode(numbers("chunks")))
        return other.withColumns({"a": F.least("chunk", "other"), "b": F.greatest("chunk", "other")})

    def pairs(df: DataFrame) -> DataFrame:
        first = df.withColumn("a", F.explode(numbers("chunks")))
        return first.withColumn("b", F.explode(F.sequence("a", F.col("chunks") - 1)))

    def columns(group_no: Column, term_no: Column, n: str, of: Column, term: Column) -> list[Column]:
        named = {"group_no": group_no, "term_no": term_no, "n": F.col(n), "kept": of, "term": term}
        return ["space", "block", "a", "b", *[c.alias(name) for name, c in named.items()]]

    whole, none = F.lit(-1), F.lit(None)
    text, number = none.cast("string"), none.cast("long")
    numbered = _dealt_join(cells, groups.select("space", "group", "group_no", "chunk", "chunks"), ["space", "group"], "term_no")
    own_term = F.when(F.col("a") == F.col("b"), F.col("term"))
    blocks = F.explode(numbers("blocks"))
    parts = [
        beside(numbered).select(*columns(F.col("group_no"), F.col("term_no"), "n", number, text)),
        beside(groups.withColumn("block", blocks)).select(
            *columns(F.col("group_no"), whole, "total", F.col("kept"), text)
        ),
        pairs(kept).select(*columns(whole, F.col("term_no"), "total", number, own_term)),
        pairs(spaces.withColumn("block", blocks)).select(
            *columns(whole, whole, "total", F.col("kept"), text)
        ),
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])


class CountTrees:
    """Hash-consed segment trees over the rows of a matrix of counts.

    ``leaves`` holds the count of each leaf node, -1 beyond the last term.
    ``levels[k]`` holds the two children of each node of height k + 1, and
    ``roots`` each row's root.
    """

    def __init__(self, counts: np.ndarray):
        rows, size = counts.shape
        width = 1 << max(size - 1, 0).bit_length()
        padded = np.full((rows, width), -1, dtype=np.int64)
        padded[:, :size] = counts
        self.leaves, nodes = np.unique(padded, return_inverse=True)
        nodes = nodes.reshape(rows, width)
        self.levels: list[np.ndarray] = []
        self.occupied = [self.leaves > 0]
        known = len(self.leaves)
        while nodes.shape[1] > 1:
            keys, places = np.unique(nodes[:, ::2] * known + nodes[:, 1::2], return_inverse=True)
            children = np.stack([keys // known, keys % known], axis=1)
            self.levels.append(children)
            self.occupied.append(self.occupied[-1][children].any(axis=1))
            nodes, known = places.reshape(rows, -1), len(keys)
        self.roots = nodes[:, 0]


def shares(counts: np.ndarray, whole: np.ndarray, smoothing: int) -> np.ndarray:
    """1 + floor(10**9 * (count + smoothing) / whole), exact for ``whole`` up to 9 * 10**15.

    Three digits at a time, since the product does not fit 64 bits."""
    quotient, rest = np.zeros_like(counts), counts + smoothing
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, whole)
        quotient = quotient * 1000 + digits
    return quotient + 1


def pair_prices(
    trees: CountTrees, left: np.ndarray, right: np.ndarray, whole: np.ndarray, smoothing: int
) -> np.ndarray:
    """Sum of differences of shares for each pair of rows ``left[i]``, ``right[i]``."""
    pair, x, y = np.arange(len(left)), trees.roots[left], trees.roots[right]
    times = np.ones(len(left), dtype=np.int64)
    heights = [len(trees.leaves), *map(len, trees.levels)]
    for height in range(len(trees.levels) - 1, -1, -1):
        children, known = trees.levels[height], heights[height]
        keys = ((np.repeat(pair, 2) * known) + children[x].ravel()) * known + children[y].ravel()
        times = np.repeat(times, 2)
        order = np.argsort(keys, kind="stable")
        keys, times = keys[order], times[order]
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        times = np.add.reduceat(times, first)
        rest, y = np.divmod(keys[first], known)
        pair, x = np.divmod(rest, known)
    here = trees.leaves[x] >= 0  # beyond the last term both are empty
    pair, x, y, times = pair[here], trees.leaves[x[here]], trees.leaves[y[here]], times[here]
    apart = np.abs(
        shares(x, whole[left[pair]], smoothing) - shares(y, whole[right[pair]], smoothing)
    )
    prices = np.zeros(len(left), dtype=np.int64)
    np.add.at(prices, pair, apart * times)
    return prices


def surplus_terms(
    trees: CountTrees, rows: np.ndarray, beside: int, whole: np.ndarray, smoothing: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, value) of terms that stand in a row and have a greater share there than
    in the row ``beside``."""
    row, place = rows, np.zeros(len(rows), dtype=np.int64)
    x, y = trees.roots[rows], np.full(len(rows), trees.roots[beside])
    for height in range(len(trees.levels) - 1, -1, -1):
        children = trees.levels[height]
        row, x, y = np.repeat(row, 2), children[x].ravel(), children[y].ravel()
        place = (place[:, None] * 2 + [0, 1]).ravel()
        here = trees.occupied[height][x]
        row, x, y, place = row[here], x[here], y[here], place[here]
    here = trees.leaves[x] > 0
    row, x, y, place = row[here], x[here], y[here], place[here]
    known = len(trees.leaves)
    keys, where = np.unique((row * known + x) * known + y, return_inverse=True)
    rest, y = np.divmod(keys, known)
    of, x = np.divmod(rest, known)
    ahead = shares(trees.leaves[x], whole[of], smoothing)
    ahead -= shares(trees.leaves[y], np.full(len(y), whole[beside]), smoothing)
    value = ahead[where.ravel()]
    return row[value > 0], place[value > 0], value[value > 0]


def _price_block(rules: Divergence):
    """Arrow function: pair sums and surplus terms of two chunks of groups in one block."""
    names = ["space", "group_no", "other_no", "item", "value"]
    types = [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int64()]

    def price(key: tuple, table: pa.Table) -> pa.Table:
        own_space, _, a, b = (k.as_py() for k in key)
        group_no, term_no, n, kept = (
            table.column(c).to_numpy().astype(np.int64) if c != "kept" else table.column(c).fill_null(0).to_numpy()
            for c in ("group_no", "term_no", "n", "kept")
        )
        heads = np.flatnonzero(term_no < 0)
        heads = heads[np.argsort(group_no[heads])]  # the space first, then the groups
        numbers = group_no[heads]
        whole = n[heads] + rules.smoothing * kept[heads]
        size = int(term_no.max(initial=-1)) + 1
        body = term_no >= 0
        counts = np.zeros((len(heads), size), dtype=np.int64)
        counts[np.searchsorted(numbers, group_no[body]), term_no[body]] = n[body]
        chunks = numbers // rules.block_groups
        firsts, seconds = np.flatnonzero((chunks == a) & (numbers >= 0)), np.flatnonzero(chunks == b)
        seconds = seconds[numbers[seconds] >= 0]
        trees = CountTrees(counts) if size else None
        out: list[tuple] = []
        for first in firsts:
            right = seconds[seconds > first]
            left = np.full(len(right), first)
            prices = pair_prices(trees, left, right, whole, rules.smoothing) if size else np.zeros(len(right), int)
            out += [
                (own_space, int(numbers[first]), int(numbers[r]), None, int(v)) for r, v in zip(right, prices)
            ]
        if size and a == b:
            terms: list = [None] * size
            own = np.flatnonzero(body & (group_no < 0))
            for at, term in zip(term_no[own], table.column("term").take(pa.array(own)).to_pylist()):
                terms[at] = term
            place_in_order = np.empty(size, dtype=np.int64)
            place_in_order[sorted(range(size), key=lambda i: terms[i].encode())] = np.arange(size)
            row, place, value = surplus_terms(trees, firsts, 0, whole, rules.smoothing)
            order = np.lexsort((place_in_order[place], -value, row))
            row, place, value = row[order], place[order], value[order]
            start = np.searchsorted(row, row)  # a group's first entry
            best = np.flatnonzero(np.arange(len(row)) - start < rules.top)
            out += [
                (own_space, int(numbers[row[i]]), None, terms[place[i]], int(value[i])) for i in best
            ]
        columns = list(zip(*out)) if out else [()] * len(names)
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return price


def _ranked(
    priced: DataFrame, groups: DataFrame, rules: Divergence, space: str, group: str
) -> DataFrame:
    names = groups.select("space", "group_no", "group")
    sums = (
        priced.where("item is null")
        .groupBy("space", "group_no", "other_no")
        .agg(F.sum("value").alias("value"))
    )
    sides = F.array(F.struct("group_no", "other_no"), F.struct(F.col("other_no").alias("group_no"), F.col("group_no").alias("other_no")))
    both = sums.select("space", "value", F.inline(sides))
    others = names.withColumnsRenamed({"group_no": "other_no", "group": "item"})
    pairs = both.join(others, ["space", "other_no"]).select("space", "group_no", F.lit("pair").alias("part"), "item", "value")
    terms = priced.where("item is not null").select("space", "group_no", F.lit("term").alias("part"), "item", "value")
    order = [F.col("value").desc(), F.col("item").asc()]
    rank = F.row_number().over(Window.partitionBy("space", "group_no", "part").orderBy(*order))
    rank_terms = terms.withColumn("rank", rank).where(F.col("rank") <= rules.top)
    ranked = pairs.withColumn("rank", rank).unionByName(rank_terms).join(names, ["space", "group_no"])
    return ranked.select(
        F.col("space").alias(space), F.col("group").alias(group), "part", "item", "value", "rank"
    )
