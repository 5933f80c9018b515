"""Benchmark decontamination by SimHash of item-sized windows.

Every window of a document that is as long as some benchmark item, and that holds
enough of such items' shingles to be able to match one, gets a fingerprint of
weighted shingles, each counted once. Fingerprints are cut into blocks; two within the radius differ
by at most ``radius // blocks`` bits in some block, so looking up each block with
that many bits flipped finds every item within the radius. Candidates within the
radius are verified by exact similarity of their weighted shingle sets. Items whose
matches may lie outside the radius, because few or heavy shingles decide, are held
against every window that has enough of their weight.
"""

from __future__ import annotations

import itertools
import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyarrow import parquet
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.token_files import open_fs
from strata.llm.words import mix, utf8, windows, word_hashes
from strata.sources import layer_path, scratch_dir, write_layer


@dataclass(frozen=True)
class LeakRule:
    """Windows within ``radius`` bits are candidates; from ``similarity`` on they are leaks.

    With equal weights and a similarity of 0.8 a fingerprint differs in 39 of 256 bits
    on average, with a standard deviation of 6; the radius lies four deviations
    above. With 16 blocks it allows 3 flipped bits in the nearest one. Items of fewer
    than ``few`` shingles, or with a larger radius by their weights, do without it.
    """

    width: int = 5
    similarity: float = 0.8
    bits: int = 256
    blocks: int = 16
    radius: int = 63
    few: int = 16


BLOCK_SHINGLES = 1_000_000  # item shingles that one index holds on average; more items make more indexes
RUN_WINDOWS = 1 << 12  # window starts whose votes are held at once
TIE = 1e-3  # votes nearer to zero than rounding reaches count as none
LEAK = "array<struct<item_id: long, start: int, n_words: int, similarity: double, distance: int>>"


@dataclass
class SizeIndex:
    """Items of one number of words, and their fingerprints."""

    words: int
    items: list[int] = field(default_factory=list)
    shingles: list[np.ndarray] = field(default_factory=list)
    weights: list[np.ndarray] = field(default_factory=list)
    prints: np.ndarray | None = None
    known: np.ndarray | None = None
    known_weights: np.ndarray | None = None
    wide: list[int] = field(default_factory=list)
    least: float = 0.0


def shingle_weights(items: DataFrame, rule: LeakRule, text: str = "text") -> DataFrame:
    """(item_id, n_words, shingles, weights): a shingle weighs log2(1 + items / items with it).

    Items without words (null, empty) have no shingles and are left out. Repeated
    items count each time.
    """
    schema = pa.schema(
        [("item_id", pa.int64()), ("n_words", pa.int32()), ("shingles", pa.list_(pa.int64()))]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item_id, raw in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                words = word_hashes(raw)
                if len(words):
                    shingles = np.unique(windows(words, rule.width)).view(np.int64)
                    rows.append((item_id, len(words), shingles))
            columns = list(zip(*rows)) if rows else [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
            )

    named = items.select(F.col("item_id").cast("long"), F.col(text).cast("string"))
    cut_items = named.mapInArrow(cut, "item_id long, n_words int, shingles array<long>")
    cut_items = cut_items.withColumn("_item", F.monotonically_increasing_id())
    path = layer_path(scratch_dir(items.sparkSession), "decontaminate", "items")
    stored = write_layer(cut_items, path)
    single = stored.frame.select("_item", "item_id", "n_words", F.explode("shingles").alias("shingle"))
    held = single.groupBy("shingle").agg(F.count("*").alias("_held"))
    return (
        single.join(held, "shingle")
        .groupBy("_item", "item_id", "n_words")
        .agg(
            F.collect_list("shingle").alias("shingles"),
            F.collect_list(F.log2(1 + stored.rows / F.col("_held"))).alias("weights"),
        )
        .withColumn("total", F.lit(stored.rows))
    )


def store_indexes(items: DataFrame, rule: LeakRule) -> list[tuple[str, int]]:
    """Write indexes of bounded size that together hold every item; (file, block) of each.

    Items are dealt to blocks by a hash, a task builds the index of a block and writes
    it below the shared folder. The driver only learns where each block is.
    """
    weighted = shingle_weights(items, rule)
    folder = scratch_dir(items.sparkSession)
    stored = write_layer(
        weighted, layer_path(folder, "decontaminate", "weighted"), {"shingles": F.sum(F.size("shingles"))}
    )
    blocks = -(-stored.metrics["shingles"] // BLOCK_SHINGLES)
    if not blocks:
        return []
    names = ["n_words", "item_id", "shingles", "weights", "total"]

    def build(key: tuple, table: pa.Table) -> pa.Table:
        sizes: dict[int, SizeIndex] = {}
        table = table.sort_by([("n_words", "ascending"), ("item_id", "ascending"), ("_item", "ascending")])
        other = 1.0
        for row in zip(*(table.column(name).to_pylist() for name in names)):
            words, item_id, shingles, weights, total = row
            size = sizes.setdefault(words, SizeIndex(words))
            shingles = np.array(shingles, dtype=np.int64).view(np.uint64)
            order = np.argsort(shingles)
            size.items.append(item_id)
            size.shingles.append(shingles[order])
            size.weights.append(np.array(weights)[order])
            other = float(np.log2(1 + total))
        index = pickle.dumps({words: vars(size) for words, size in _finished(sizes, rule, other).items()})
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "index": pa.array([index], pa.binary())})

    block = F.pmod(F.xxhash64("_item"), F.lit(blocks)).cast("int").alias("block")
    dealt = stored.frame.select(block, "_item", *names).groupBy("block")
    path = layer_path(folder, "decontaminate", "indexes")
    indexes = write_layer(dealt.applyInArrow(build, "block int, index binary"), path).frame
    places = indexes.select(F.input_file_name().alias("file"), "block").orderBy("block").collect()
    return [(row["file"], row["block"]) for row in places]


def _finished(sizes: dict[int, SizeIndex], rule: LeakRule, other: float) -> dict[int, SizeIndex]:
    for size in sizes.values():
        together = np.concatenate(size.shingles)
        size.known, at = np.unique(together, return_index=True)
        size.known_weights = np.concatenate(size.weights)[at]
        size.least = rule.similarity * min(w.sum() for w in size.weights) - 1e-9
        rows = [signs(s, w, rule).sum(axis=0) > TIE for s, w in zip(size.shingles, size.weights)]
        size.prints = np.packbits(np.array(rows), axis=1)
        size.wide = [
            k for k, w in enumerate(size.weights) if len(w) < rule.few or needed_radius(w, other, rule) > rule.radius
        ]
    sizes[-1] = SizeIndex(-1, least=other)  # weight of shingles that no item has
    return sizes


def needed_radius(weights: np.ndarray, heaviest: float, rule: LeakRule) -> float:
    """Bits within which an item's matches lie, four standard deviations above the mean.

    A match may lack some of the item's weight, at worst its heaviest shingles, and
    hold other shingles, at worst of the ``heaviest`` weight.
    """
    order = np.sort(weights)[::-1]
    whole, squares = order.sum(), np.square(order).sum()
    lost = np.linspace(0, (1 - rule.similarity) * whole, 33)
    lost_squares = np.interp(lost, np.cumsum([0, *order]), np.cumsum([0, *np.square(order)]))
    added = np.maximum((1 - rule.similarity) * whole - lost, 0) / rule.similarity
    common = squares - lost_squares
    cosine = common / np.sqrt(squares * (common + added * heaviest))
    share = float(np.arccos(np.clip(cosine.min(), -1, 1)) / np.pi)
    return rule.bits * share + 4 * math.sqrt(rule.bits * share * (1 - share))


def window_votes(own: np.ndarray, signed: np.ndarray, span: int) -> np.ndarray:
    """Sums of ``signed`` over each window of ``span``, with repeated values of ``own`` once."""
    n = len(own)
    order = np.argsort(own, kind="stable")
    again = np.flatnonzero(own[order][1:] == own[order][:-1])
    later, earlier = order[again + 1], order[again]
    near = later - earlier < span
    later, earlier = later[near], earlier[near]
    steps = np.zeros((n + span, signed.shape[1]))
    steps[:n] = signed
    steps[later] = 0  # a repeated value enters when the one before it leaves
    steps[earlier + span] += signed[later]
    steps[span:] -= signed
    return np.cumsum(steps, axis=0)[span - 1 : n]


def signs(shingles: np.ndarray, weights: np.ndarray, rule: LeakRule) -> np.ndarray:
    """Each shingle's weight with the sign of each bit of its hash."""
    lanes = [mix(shingles + np.uint64(k + 1)) for k in range(rule.bits // 64)]
    bits = np.unpackbits(np.stack(lanes, axis=1).view(np.uint8), axis=1)
    return (bits.astype(np.float32) * 2 - 1) * weights[:, None].astype(np.float32)


def _blocks(prints: np.ndarray, rule: LeakRule) -> np.ndarray:
    """Blocks of packed fingerprints as numbers, one column for each."""
    if rule.bits // rule.blocks != 16:
        raise ValueError("blocks must have 16 bits")
    return prints.view(np.uint16)


class BlockTables:
    """Multi-index of all fingerprints: for each block, which items have which value."""

    def __init__(self, sizes: list[SizeIndex], rule: LeakRule):
        self.rule = rule
        self.prints = np.concatenate([size.prints for size in sizes])
        self.size = np.concatenate([np.full(len(s.items), k) for k, s in enumerate(sizes)])
        self.first = np.cumsum([0, *(len(s.items) for s in sizes)])
        blocks = _blocks(self.prints, rule)
        self.order = np.argsort(blocks, axis=0, kind="stable").T
        self.values = np.take_along_axis(blocks, self.order.T, axis=0).T.copy()
        self.present = np.zeros((rule.blocks, 1 << 16), dtype=bool)
        for block, values in zip(self.present, self.values):
            block[values] = True
        width = rule.bits // rule.blocks
        flips = [
            sum(1 << b for b in bits)
            for n in range(rule.radius // rule.blocks + 1)
            for bits in itertools.combinations(range(width), n)
        ]
        self.flips = np.array(flips, dtype=np.uint16)

    def within(self, own: np.ndarray, size: int) -> list[tuple[int, int]]:
        """(item of the size, distance) of fingerprints within the radius."""
        fetched = []
        for k, value in enumerate(_blocks(own[None], self.rule)[0]):
            near = value ^ self.flips
            near = near[self.present[k][near]]
            if len(near):
                low = np.searchsorted(self.values[k], near, side="left")
                high = np.searchsorted(self.values[k], near, side="right")
                fetched += [self.order[k][a:b] for a, b in zip(low.tolist(), high.tolist())]
        if not fetched:
            return []
        items = np.unique(np.concatenate(fetched))
        items = items[self.size[items] == size]
        distance = np.bitwise_count(self.prints[items] ^ own).sum(axis=1)
        close = distance <= self.rule.radius
        return list(zip((items[close] - self.first[size]).tolist(), distance[close].tolist()))


class LeakFinder:
    """Leaks of one text, from an index of items."""

    def __init__(self, sizes: dict[int, SizeIndex], rule: LeakRule):
        self.rule = rule
        self.other = sizes[-1].least
        self.sizes = [size for words, size in sorted(sizes.items()) if words > 0]
        self.tables = BlockTables(self.sizes, rule)
        owners = np.concatenate([np.full(len(s.known), k) for k, s in enumerate(self.sizes)])
        known = np.concatenate([size.known for size in self.sizes])
        order = np.argsort(known, kind="stable")
        self.known, first = np.unique(known[order], return_index=True)
        self.owners = owners[order].astype(np.int32)  # sizes that have a shingle, shingle by shingle
        self.first_owner, self.n_owners = first, np.diff(first, append=len(owners))
        self.weights = np.concatenate([size.known_weights for size in self.sizes])[order][first]
        self.maybe = np.zeros(1 << 22, dtype=bool)
        self.maybe[known >> np.uint64(42)] = True
        self.widths = sorted({min(rule.width, size.words) for size in self.sizes})

    def __call__(self, text: bytes | None) -> list[tuple]:
        words = word_hashes(text)
        if not len(words):
            return []
        found = []
        for width in self.widths:
            shingles = windows(words, width)
            at = np.flatnonzero(self.maybe[shingles >> np.uint64(42)])
            place = np.minimum(np.searchsorted(self.known, shingles[at]), len(self.known) - 1)
            same = self.known[place] == shingles[at]
            at, place = at[same], place[same]
            if not len(at):
                continue
            weights = np.full(len(shingles), self.other)
            weights[at] = self.weights[place]
            for k, positions in self._by_size(at, place):
                if min(self.rule.width, self.sizes[k].words) == width:
                    span = min(self.sizes[k].words, len(words)) - min(width, len(words)) + 1
                    found += self._of_size(shingles, weights, positions, k, span, len(words))
        return found

    def _by_size(self, at: np.ndarray, place: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(size, positions ``at`` of shingles ``place`` that some item of the size has)."""
        counts = self.n_owners[place]
        positions = np.repeat(at, counts)
        first = np.repeat(self.first_owner[place] - np.cumsum(counts) + counts, counts)
        owners = self.owners[first + np.arange(len(positions))]
        order = np.argsort(owners, kind="stable")
        owners, positions = owners[order], positions[order]
        cuts = np.flatnonzero(np.diff(owners)) + 1
        for own, group in zip(np.split(owners, cuts), np.split(positions, cuts)):
            if len(own):
                yield int(own[0]), group

    def _of_size(
        self,
        shingles: np.ndarray,
        weights: np.ndarray,
        held: np.ndarray,
        number: int,
        span: int,
        n: int,
    ) -> list[tuple]:
        """The best verified window of each item of one size.

        ``held`` are the places of shingles that items of the size have; a window
        in which these weigh too little can match none of them.
        """
        size = self.sizes[number]
        total = np.zeros(len(shingles) + 1)
        total[held + 1] = weights[held]
        total = np.cumsum(total)
        able = np.flatnonzero(total[span:] - total[:-span] >= size.least)
        best: dict[int, tuple] = {}
        for group in _runs(able, span):
            low, high = int(group[0]), int(group[-1]) + span
            signed = signs(shingles[low:high], weights[low:high], self.rule)
            votes = window_votes(shingles[low:high], signed, span)
            prints = np.packbits(votes[group - low] > TIE, axis=1)
            near = [self.tables.within(own, number) for own in prints]
            for k in size.wide:
                item = size.shingles[k]
                place = np.minimum(np.searchsorted(item, shingles[low:high]), len(item) - 1)
                has = np.where(item[place] == shingles[low:high], weights[low:high], 0)
                has = np.concatenate([[0], np.cumsum(has)])
                enough = has[group - low + span] - has[group - low] >= self.rule.similarity * size.weights[k].sum() - 1e-9
                for i in np.flatnonzero(enough).tolist():
                    distance = int(np.bitwise_count(size.prints[k] ^ prints[i]).sum())
                    if distance > self.rule.radius:  # others have been found
                        near[i].append((k, distance))
            for start, close in zip(group.tolist(), near):
                for k, distance in close:
                    alike = self._similarity(shingles[start : start + span], weights[start : start + span], size, k)
                    if alike >= self.rule.similarity and alike > best.get(k, (0,))[0]:
                        best[k] = (alike, start, distance)
        return [
            (size.items[k], start, min(size.words, n), float(alike), distance)
            for k, (alike, start, distance) in sorted(best.items())
        ]

    def _similarity(self, shingles: np.ndarray, weights: np.ndarray, size: SizeIndex, k: int) -> float:
        """Weight in common over weight in all, of the two sets."""
        own, at = np.unique(shingles, return_index=True)
        mine, theirs = weights[at].sum(), size.weights[k].sum()
        item = size.shingles[k]
        place = np.minimum(np.searchsorted(item, own), len(item) - 1)
        common = size.weights[k][place[item[place] == own]].sum()
        return common / (mine + theirs - common)


def _runs(able: np.ndarray, span: int) -> Iterator[np.ndarray]:
    """Window starts that overlap, up to ``RUN_WINDOWS`` at once, which bounds the memory
    that the votes of a long text need."""
    for group in np.split(able, np.flatnonzero(np.diff(able) > span) + 1) if len(able) else []:
        while len(group):
            stop = int(np.searchsorted(group, group[0] + RUN_WINDOWS))
            yield group[:stop]
            group = group[stop:]


def leaks_of(text: Column, items: DataFrame, rule: LeakRule = LeakRule()) -> Column:
    """Array of the leaks in a text: (item_id, start, n_words, similarity, distance).

    ``start`` counts words from 0. A text without words, and a null one, has none; a
    text shorter than an item is compared as a whole. Of several windows that match
    an item the most similar one, then the first, is given. Repeated items are
    found each. No document row moves, so no source, copy or passage can be too
    frequent. Texts of any length are searched whole, a few thousand windows at a time.

    Items are no limit either: they lie in the shared folder in blocks of about
    ``BLOCK_SHINGLES`` shingles, and a task holds one block's index at a time.
    """
    places = store_indexes(items, rule)
    if not places:
        return F.array().cast(LEAK)
    return _leak_function(places, rule)(text)


def load_index(file: str, block: int) -> dict[int, SizeIndex]:
    """The index of a block, read from the shared folder."""
    files, path = open_fs(unquote(file))
    with files.open_input_file(path) as source:
        table = parquet.read_table(source, columns=["index"], filters=[("block", "=", block)])
    sizes = pickle.loads(table.column("index")[0].as_py())
    return {words: SizeIndex(**fields) for words, fields in sizes.items()}


def _leak_function(places: list[tuple[str, int]], rule: LeakRule):
    loaded: dict[int, LeakFinder] = {}  # the block that was used last
    fields = [
        ("item_id", pa.int64()),
        ("start", pa.int32()),
        ("n_words", pa.int32()),
        ("similarity", pa.float64()),
        ("distance", pa.int32()),
    ]
    kind = pa.list_(pa.struct(fields))

    @F.arrow_udf(LEAK)
    def find(text: pa.Array) -> pa.Array:
        names = [name for name, _ in fields]
        found: list[list[dict]] = [[] for _ in range(len(text))]
        for file, block in places:
            if block not in loaded:
                loaded.clear()
                loaded[block] = LeakFinder(load_index(file, block), rule)
            for leaks, raw in zip(found, utf8(text)):
                leaks += [dict(zip(names, leak)) for leak in loaded[block](raw)]
        return pa.array(found, kind)

    return find


def find_leaks(docs: DataFrame, items: DataFrame, rule: LeakRule = LeakRule()) -> DataFrame:
    """(doc_id, item_id, start, n_words, similarity, distance) of every leak."""
    leaks = leaks_of(F.col("text"), items, rule)
    return docs.select("doc_id", F.explode(leaks).alias("leak")).select("doc_id", "leak.*")


def without_leaks(docs: DataFrame, items: DataFrame, rule: LeakRule = LeakRule()) -> DataFrame:
    """The documents in which no benchmark item was found, with all their columns."""
    return docs.where(F.size(leaks_of(F.col("text"), items, rule)) == 0)
