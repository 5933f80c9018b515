"""Quality rules by cross-document line frequency.

Lines are normalised and hashed; a line that stands in too many of a host's distinct
documents is boilerplate of that host and is removed, and a document that loses too
much by it is rejected. A few base counts of the text itself reject documents that are
too short or repeat themselves.

Documents are distinct where at least a fifth of their words is their own. Copies, also
with words changed here and there, are left to near-duplicate removal, which keeps one
of them: their common lines say nothing about the host. Words are a document's own in
lines that begin, or end, with four words as no line of another text of the host does;
the fewer of the two counts are taken. A changed word spoils one end of a long line at
most, so near copies of any line length have few words of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.names import unused
from strata.llm.words import WHITE, utf8, windows, word_hashes
from strata.sources import layer_path, scratch_dir, write_layer


@dataclass(frozen=True)
class LineRules:
    """Limits of the base rules and of the line frequency.

    A document is distinct where at least ``min_own`` of its words is its own. Of n
    distinct documents of a host, more than ``max_share * n + sqrt(n)`` must hold a
    line for it to be removed: 6 of 20, 10 of 50, 43 of 500, 2,224 of 50,000. The root
    is what chance adds to the count of a line that is just as frequent as allowed; it
    is the same rule at every size. A document is depleted when less than ``min_left``
    of its words stay.
    """

    min_words: int = 50
    max_repeated: float = 0.5
    max_share: float = 0.04
    min_own: float = 0.2
    min_left: float = 0.5


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
VERDICT = (*COUNTS, "n_removed_words", "base_failed", "kept", "clean_text")
SYMBOLS = b"#*$%&|<>"
EDGE = 4  # words at an end of a line by which it is known again
_DIGITS = bytes.maketrans(b"0123456789", b"0000000000")


def judge_quality(
    docs: DataFrame,
    rules: LineRules = LineRules(),
    host: str = "source",
    folder: str | None = None,
) -> DataFrame:
    """``docs`` with counts, ``n_removed_words``, ``base_failed``, ``kept`` and ``clean_text``.

    Input columns of these names are replaced, all others stay. A null text counts
    as empty and fails for want of words; its clean_text stays null. Documents
    without a host form a host of their own. Copies and near copies of a text do not
    make its lines boilerplate, and repeated rows get equal results. The list of a
    host's boilerplate has fewer lines than its documents have on average, divided by
    ``max_share``. Lines are compared after lower-casing A-Z, turning digits into 0 and
    joining words by one space; lines without a word are never removed. Texts of any
    length are judged whole.
    """
    docs = docs.drop(*VERDICT)
    folder = folder or scratch_dir(docs.sparkSession)
    frequent = write_layer(_frequent_lines(docs, rules, host), layer_path(folder, "quality", "lines"))
    own_host, lines, found = unused(docs, "_host", "_lines", "_found")
    lists = frequent.frame.groupBy("_host").agg(F.collect_list("line").alias(lines))
    lists = write_layer(lists.withColumnRenamed("_host", own_host), layer_path(folder, "quality", "hosts"))
    judged = docs.join(lists.frame, _host_key(F.col(host)) == F.col(own_host), "left")
    judged = judged.withColumn(found, _count_text(rules)(F.col("text").cast("string"), F.col(own_host), F.col(lines)))
    clean = F.coalesce(F.col(f"{found}.clean_text"), F.col("text").cast("string"))
    verdict = [f"{found}.{name}" for name in VERDICT if name != "clean_text"]
    return judged.select(*docs.columns, *verdict, clean.alias("clean_text"))


def normal_line(line: bytes) -> bytes:
    return b" ".join(line.lower().translate(_DIGITS).split())


def line_hash(line: bytes) -> int:
    value = xxhash.xxh3_64_intdigest(line)
    return value - (1 << 64) if value >> 63 else value


def line_ends(normal: bytes) -> tuple[bytes, bytes]:
    """The first and the last four words of a normal line, or all of a shorter one."""
    line = normal.split(b" ")
    return b" ".join(line[:EDGE]), b" ".join(line[-EDGE:])


def _host_key(host: Column) -> Column:
    """A number for each host; a missing host is one of its own."""
    name = host.cast("string")
    return F.xxhash64(F.coalesce(name, F.lit("")), name.isNull())


def _frequent_lines(docs: DataFrame, rules: LineRules, host: str) -> DataFrame:
    """(_host, line) of lines above the limits; counts are pre-aggregated in every task.

    An edge is the hash of a line's first words, made even, or of its last, made odd."""
    names = ("h", "text_hash", "line", "head", "tail", "words", "of")
    kinds = [pa.int32() if name in ("words", "of") else pa.int64() for name in names]

    def rows(columns: list[list[int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=list(names))

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[int]] = [[] for _ in names]
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                lines = {n for n in map(normal_line, (text or b"").split(b"\n")) if n}
                if not lines:
                    continue
                text_hash = line_hash(text)
                sizes = [n.count(b" ") + 1 for n in lines]
                ends = [line_ends(n) for n in lines]
                for column, values in zip(
                    held,
                    (
                        [key] * len(lines),
                        [text_hash] * len(lines),
                        map(line_hash, lines),
                        [line_hash(head) & ~1 for head, _ in ends],
                        [line_hash(tail) | 1 for _, tail in ends],
                        sizes,
                        [sum(sizes)] * len(lines),
                    ),
                ):
                    column.extend(values)
                if len(held[0]) > 20_000:
                    yield rows(held)
                    held = [[] for _ in names]
        yield rows(held)

    hosted = docs.select(_host_key(F.col(host)).alias("h"), F.col("text").cast("string"))
    held = hosted.mapInArrow(
        explode, "h long, text_hash long, line long, head long, tail long, words int, of int"
    ).distinct()
    edges = held.select("h", "text_hash", "words", "of", F.explode(F.array("head", "tail")).alias("edge"))
    known = edges.groupBy("h", "edge").agg(
        F.min("text_hash").alias("text_hash"),
        F.max("text_hash").alias("last"),
        F.sum("words").alias("words"),
        F.max("of").alias("of"),
    )
    is_tail = F.col("edge").bitwiseAND(F.lit(1)) == 1
    sides = [F.sum(F.when(side, F.col("words")).otherwise(0)) for side in (~is_tail, is_tail)]
    distinct = (
        known.where("text_hash = last")
        .groupBy("h", "text_hash")
        .agg(F.least(*sides).alias("own"), F.max("of").alias("of"))
        .where((F.col("own") > 0) & (F.col("own") >= F.col("of") * rules.min_own))
        .select("h", "text_hash")
    )
    sizes = distinct.groupBy("h").agg(F.count("*").alias("n"))
    lines = held.select("h", "text_hash", "line").join(distinct, ["h", "text_hash"])
    lines = lines.groupBy("h", "line").agg(F.count("*").alias("times"))
    limit = F.col("n") * rules.max_share + F.sqrt("n")
    frequent = lines.join(sizes, "h").where(F.col("times") > limit)
    return frequent.select(F.col("h").alias("_host"), "line")


def _count_text(rules: LineRules):
    """Arrow function of a text, its host and the host's frequent lines.

    Texts that lose no line come back as null, which saves sending them twice. It
    counts as non-deterministic, lest a filter on the verdict judges every text again.
    """
    fields = [(name, pa.int64()) for name in (*COUNTS, "n_removed_words")]
    fields += [("base_failed", pa.bool_()), ("kept", pa.bool_()), ("clean_text", pa.string())]
    kind = pa.struct(fields)
    @F.arrow_udf(
        ", ".join(f"{name} long" for name in (*COUNTS, "n_removed_words"))
        + ", base_failed boolean, kept boolean, clean_text string"
    )
    def count(text: pa.Array, host: pa.Array, lines: pa.Array) -> pa.Array:
        rows, known = [], {}  # a host's list is read once for a batch
        for at, (raw, name) in enumerate(zip(utf8(text), host.to_pylist())):
            if name not in known:
                known[name] = frozenset(lines[at].as_py() or ())
            frequent = known[name]
            counts = count_text(raw or b"")
            clean, removed = remove_lines(raw, frequent) if raw and frequent else (None, 0)
            n_words, repeated = counts[0], counts[4]
            failed = n_words < rules.min_words or repeated > rules.max_repeated * n_words
            kept = not failed and n_words - removed >= rules.min_left * n_words
            rows.append((*counts, removed, failed, kept, clean if removed else None))
        columns = list(zip(*rows)) if rows else [()] * len(fields)
        clean = pa.array(columns[-1], pa.binary()).cast(pa.string())
        arrays = [pa.array(v, f[1]) for v, f in zip(columns[:-1], fields)]
        return pa.StructArray.from_arrays([*arrays, clean], fields=list(kind))

    return count.asNondeterministic()


def count_text(text: bytes) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, repeated lines, words in repeated 3-word windows."""
    words = word_hashes(text, lower=False)
    solid = text.translate(None, WHITE)
    letters = np.frombuffer(solid, dtype=np.uint8)
    chars = int(np.count_nonzero((letters & 0xC0) != 0x80))
    symbols = len(solid) - len(solid.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip()]
    repeated = 0
    if len(words) > 2:
        runs = windows(words, 3)
        _, place, times = np.unique(runs, return_inverse=True, return_counts=True)
        twice = times[place] > 1
        covered = np.zeros(len(words), dtype=bool)
        for k in range(3):
            covered[k : len(runs) + k] |= twice
        repeated = int(covered.sum())
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated


def remove_lines(text: bytes, frequent: frozenset[int]) -> tuple[bytes, int]:
    """The text without its frequent lines, and the words they held."""
    kept, removed = [], 0
    for line in text.split(b"\n"):
        normal = normal_line(line)
        if normal and line_hash(normal) in frequent:
            removed += len(normal.split())
        else:
            kept.append(line)
    return b"\n".join(kept), removed
