"""Repeated passages by suffixes at content-selected positions.

Of each run of windows the position with the least hash is kept (a minimiser), so
equal passages keep equal positions, and a passage of the wanted length holds at
least one. A kept position stands for the windows that selected it, so only the
words of these windows are compared; longer matches come out as chains of positions.
Suffixes that begin alike come together. Where they are few, each is compared with all
others, and matches are extended to the right and to the left. Where they are many, no
order helps: a passage may lie mostly left of the kept position, and its holders need
not be neighbours among suffixes sorted by what lies right of it. There every window
of the passage's length is hashed, and equal windows are grouped, which finds the same
repeats exactly. So this is a suffix array only in what it keeps; it is never sorted
as a whole, and no repeat depends on who stands beside whom.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.copies import without_copies
from strata.llm.words import mix, powers, utf8, windows, word_hashes
from strata.sources import layer_path, scratch_dir, write_layer


@dataclass(frozen=True)
class RepeatRule:
    """Passages of ``least`` words; positions are chosen by runs of ``gram`` words.

    A suffix is compared with ``neighbours`` others. Where more begin alike, equal
    windows are grouped instead.
    """

    least: int = 50
    gram: int = 8
    neighbours: int = 4

    @property
    def window(self) -> int:
        """Runs among which one position is kept."""
        return self.least - self.gram + 1


_FACTOR = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(_FACTOR), -1, 1 << 64))


@dataclass
class Positions:
    """Kept positions of a text, with the stretch of words that each stands for."""

    at: np.ndarray
    start: np.ndarray
    stop: np.ndarray


def kept_positions(words: np.ndarray, rule: RepeatRule) -> Positions:
    """Leftmost least run of each window; none in texts shorter than a passage."""
    if len(words) < rule.least:
        none = np.zeros(0, dtype=np.int64)
        return Positions(none, none, none)
    grams = windows(words, rule.gram)
    n_windows = len(words) - rule.least + 1
    chosen = np.empty(n_windows, dtype=np.int64)
    for low in range(0, n_windows, 4096):
        high = min(low + 4096, n_windows)
        view = np.lib.stride_tricks.sliding_window_view(grams[low : high + rule.window - 1], rule.window)
        chosen[low:high] = view.argmin(axis=1) + np.arange(low, high)
    first = np.flatnonzero(np.diff(chosen, prepend=-1))
    last = np.append(first[1:], n_windows) - 1
    return Positions(chosen[first], first, last + rule.least)


def stretch_hashes(words: np.ndarray, positions: Positions) -> np.ndarray:
    """Hash of each position's stretch and of the position within it."""
    n = len(words)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(words * powers(_FACTOR, n), dtype=np.uint64)])
    start, stop = positions.start, positions.stop
    values = (sums[stop] - sums[start]) * powers(_INVERSE, n)[start]
    sizes = (stop - start).astype(np.uint64) << np.uint64(32) | (positions.at - start).astype(np.uint64)
    return mix(values ^ mix(sizes))


def window_hashes(words: np.ndarray, rule: RepeatRule) -> np.ndarray:
    """Hash of each passage of ``least`` words."""
    n = len(words)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(words * powers(_FACTOR, n), dtype=np.uint64)])
    return mix((sums[rule.least :] - sums[: -rule.least]) * powers(_INVERSE, n)[: n - rule.least + 1])


MEMBERS = "gram long, stretch long, at int, before int, after int"


def _members(docs: DataFrame, rule: RepeatRule) -> DataFrame:
    """(key, gram, stretch, at, before, after) of kept positions; a row without gram
    gives each text's number of words in ``at``."""
    schema = pa.schema(
        [
            ("key", pa.binary()),
            ("gram", pa.int64()),
            ("stretch", pa.int64()),
            ("at", pa.int32()),
            ("before", pa.int32()),
            ("after", pa.int32()),
        ]
    )

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, parts = [], [np.zeros((0, 5), dtype=np.int64)]
            for key, text in zip(batch.column("key").to_pylist(), utf8(batch.column("text"))):
                words = word_hashes(text)
                kept = kept_positions(words, rule)
                n = len(kept.at)
                if not n:
                    continue
                rows = np.zeros((n + 1, 5), dtype=np.int64)
                rows[:n, 0] = windows(words, rule.gram)[kept.at].view(np.int64)
                rows[:n, 1] = stretch_hashes(words, kept).view(np.int64)
                rows[:n, 2] = kept.at
                rows[:n, 3] = kept.at - kept.start
                rows[:n, 4] = kept.stop - kept.at
                rows[n] = (0, 0, len(words), 0, 0)
                parts.append(rows)
                keys += [key] * (n + 1)
            rows = np.concatenate(parts)
            whole = rows[:, 4] == 0
            columns = [pa.array(keys, pa.binary()), pa.array(rows[:, 0], mask=whole), pa.array(rows[:, 1], mask=whole)]
            columns += [pa.array(rows[:, k].astype(np.int32)) for k in (2, 3, 4)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return _keyed(docs).mapInArrow(keep, f"key binary, {MEMBERS}")


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.unhex(F.md5(F.coalesce(text, F.lit("")))).alias("key"), text.alias("text"))


def repeated_spans(
    docs: DataFrame, rule: RepeatRule = RepeatRule(), folder: str | None = None
) -> DataFrame:
    """(key, spans): for texts with repeated passages, their spans as (start, stop) in words.

    ``key`` is the MD5 of the text. A span is a union of passages of ``least`` words
    and more that some other text holds as well, compared with A-Z lower-cased and
    white space ignored; a text that several rows hold is one span from end to end.
    Repeats within one text alone do not count. Texts of fewer words, empty and null
    ones have no spans. Extra columns are ignored.

    Equal stretches are counted before they move, so copies and passages however
    frequent become one suffix each.
    """
    folder = folder or scratch_dir(docs.sparkSession)
    members = write_layer(_members(docs, rule), layer_path(folder, "suffixes", "members")).frame
    placed = members.where("gram is not null")
    stretches = placed.groupBy("gram", "stretch").agg(
        F.min("key").alias("low"),
        F.max("key").alias("high"),
        F.min(F.struct("key", "at", "before", "after")).alias("one"),
    )
    grams = (
        stretches.groupBy("gram")
        .agg(
            F.min("low").alias("_low"),
            F.max("high").alias("_high"),
            F.count("*").alias("_n"),
            F.max((F.col("low") == F.col("high")).cast("int")).alias("_open"),
        )
        .where("_low != _high")
    )
    repeated = stretches.join(grams.drop("_low", "_high"), "gram")
    repeated = write_layer(repeated, layer_path(folder, "suffixes", "stretches")).frame
    context = _with_context(docs, repeated.where("_n > 1 and _open = 1"), rule)
    context = write_layer(context, layer_path(folder, "suffixes", "context")).frame
    compared = _by_gram(context.where("windows is null")).mapInArrow(
        NeighbourComparison(rule), "gram long, stretch long, left int, right int"
    )
    marks = compared.union(_equal_windows(context.where("windows is not null"), rule, folder))
    marks = marks.groupBy("gram", "stretch").agg(F.max("left").alias("left"), F.max("right").alias("right"))
    marks = write_layer(marks, layer_path(folder, "suffixes", "marks")).frame
    shared = repeated.where("low != high").select("gram", "stretch").withColumns(
        {"left": F.lit(None).cast("int"), "right": F.lit(None).cast("int")}
    )
    found = (
        placed.join(shared.union(marks.select("gram", "stretch", "left", "right")), ["gram", "stretch"])
        .select(
            "key",
            (F.col("at") - F.coalesce("left", "before")).alias("start"),
            (F.col("at") + F.coalesce("right", "after")).alias("stop"),
        )
        .distinct()
    )
    copied = (
        members.where("gram is null")
        .groupBy("key")
        .agg(F.count("*").alias("n"), F.max("at").alias("stop"))
        .where("n > 1")
        .select("key", F.lit(0).alias("start"), "stop")
    )
    return found.union(copied).groupBy("key").agg(_merged(F.collect_list(F.struct("start", "stop"))).alias("spans"))


def _merged(spans: Column) -> Column:
    """Overlapping and touching spans joined, in order."""
    empty = F.array().cast("array<struct<start: int, stop: int>>")

    def join(done: Column, span: Column) -> Column:
        last = F.element_at(done, -1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["stop"], span["stop"]).alias("stop"))
        touches = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["stop"] >= span["start"])
        return F.when(touches, F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(longer))).otherwise(
            F.concat(done, F.array(span))
        )

    return F.aggregate(F.sort_array(spans), empty, join)


def _with_context(docs: DataFrame, stretches: DataFrame, rule: RepeatRule) -> DataFrame:
    """Stretches with their words right and left of the position, or, where a gram has
    more of them than are compared, with the hashes of their windows instead."""
    many = (F.col("_n") > rule.neighbours + 1).alias("many")
    wanted = stretches.groupBy(F.col("one.key").alias("key")).agg(
        F.collect_list(
            F.struct("gram", "stretch", "low", "high", "one.at", "one.before", "one.after", many)
        ).alias("wanted")
    )
    texts = without_copies(_keyed(docs), "key").join(wanted, "key").groupBy("key").agg(
        F.first("text").alias("text"), F.first("wanted").alias("wanted")
    )
    schema = pa.schema(
        [
            ("gram", pa.int64()),
            ("stretch", pa.int64()),
            ("low", pa.binary()),
            ("high", pa.binary()),
            ("before", pa.int32()),
            ("right", pa.binary()),
            ("left", pa.binary()),
            ("windows", pa.list_(pa.int64())),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, places in zip(utf8(batch.column("text")), batch.column("wanted").to_pylist()):
                hashes = word_hashes(text)
                words = (hashes >> np.uint64(32)).astype(">u4")
                held = window_hashes(hashes, rule).view(np.int64) if any(p["many"] for p in places) else None
                for p in places:
                    at, start, stop = p["at"], p["at"] - p["before"], p["at"] + p["after"]
                    if p["many"]:
                        sides = (None, None, held[start : stop - rule.least + 1])
                    else:
                        sides = (words[at:stop].tobytes(), words[start:at][::-1].tobytes(), None)
                    rows.append((p["gram"], p["stretch"], p["low"], p["high"], p["before"], *sides))
                    if len(rows) > 20_000:
                        yield _rows(rows, schema)
                        rows = []
            yield _rows(rows, schema)

    return texts.select("text", "wanted").mapInArrow(
        cut,
        "gram long, stretch long, low binary, high binary, before int, right binary, left binary, windows array<long>",
    )


def _by_gram(context: DataFrame) -> DataFrame:
    """Stretches of a gram in one partition, side by side; only for grams of few stretches."""
    context = context.select("gram", "stretch", "low", "high", "right", "left")
    return context.repartition("gram").sortWithinPartitions("gram")


def _equal_windows(context: DataFrame, rule: RepeatRule, folder: str) -> DataFrame:
    """(gram, stretch, left, right) of windows that another text holds as well.

    Equal windows keep equal positions, so they have the same gram. Their holders are
    counted in every task before anything moves, so no window is too frequent.
    """
    single = context.select(
        "gram", "stretch", "low", "high", "before", F.posexplode("windows").alias("nth", "window")
    )
    held = single.groupBy("gram", "window").agg(F.min("low").alias("_low"), F.max("high").alias("_high"))
    held = held.where("_low != _high").select("gram", "window")
    held = write_layer(held, layer_path(folder, "suffixes", "windows")).frame
    found = single.where("low = high").join(held, ["gram", "window"])
    left = F.col("before") - F.col("nth")
    return found.select("gram", "stretch", left.alias("left"), (rule.least - left).alias("right"))


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


class NeighbourComparison:
    """Matches of each suffix with all others of its gram, extended to both sides.

    The suffixes of a gram stand side by side, and there are not more of them than
    a suffix and its neighbours. The last ones of a batch are carried over to the next.
    """

    def __init__(self, rule: RepeatRule):
        self.rule = rule

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            fresh = 0 if held is None else len(held)
            table = table if held is None else pa.concat_tables([held, table])
            yield self.compare(table, fresh)
            held = table.slice(max(0, len(table) - self.rule.neighbours))

    def compare(self, table: pa.Table, fresh: int) -> pa.RecordBatch:
        """Marks from pairs whose later suffix is number ``fresh`` or above."""
        n = len(table)
        gram, stretch = table.column("gram").to_numpy(), table.column("stretch").to_numpy()
        low, high = (np.array(table.column(c).to_pylist(), dtype="S16") for c in ("low", "high"))
        right, right_size = self._matrix(table.column("right").to_pylist())
        left, left_size = self._matrix(table.column("left").to_pylist())
        marks = [np.zeros((0, 4), dtype=np.int64)]
        for step in range(1, min(self.rule.neighbours, n - 1) + 1):
            i = np.arange(max(0, fresh - step), n - step)
            i = i[gram[i] == gram[i + step]]
            j = i + step
            after = self._common(right, right_size, i, j)
            before = self._common(left, left_size, i, j)
            enough = after + before >= self.rule.least
            for own, other in ((i, j), (j, i)):
                single = low[own] == high[own]
                apart = (low[other] != low[own]) | (high[other] != low[own])
                ok = enough & single & apart
                marks.append(np.stack([gram[own[ok]], stretch[own[ok]], before[ok], after[ok]], axis=1))
        found = np.concatenate(marks)
        columns = [pa.array(found[:, 0]), pa.array(found[:, 1])]
        columns += [pa.array(found[:, k].astype(np.int32)) for k in (2, 3)]
        return pa.RecordBatch.from_arrays(columns, names=["gram", "stretch", "left", "right"])

    def _matrix(self, sides: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(s) // 4 for s in sides], dtype=np.int64)
        width = int(sizes.max(initial=0)) + 1
        padded = b"".join(s.ljust(4 * width, b"\0") for s in sides)
        return np.frombuffer(padded, np.uint32).reshape(len(sides), width), sizes

    def _common(self, side: np.ndarray, sizes: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words in common from the position on; the last column ends every comparison."""
        same = side[i] == side[j]
        same[:, -1] = False
        return np.minimum(same.argmin(axis=1), np.minimum(sizes[i], sizes[j]))


def find_repeats(docs: DataFrame, rule: RepeatRule = RepeatRule(), folder: str | None = None) -> DataFrame:
    """(doc_id, start_word, n_words) of every repeated passage of every document."""
    spans = repeated_spans(docs, rule, folder)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select("doc_id", F.unhex(F.md5(text)).alias("key"))
    found = keyed.join(spans, "key").select("doc_id", F.explode("spans").alias("span"))
    return found.select(
        "doc_id",
        F.col("span.start").alias("start_word"),
        (F.col("span.stop") - F.col("span.start")).alias("n_words"),
    )
