"""Best-fit packing of token pieces into sequences of a fixed capacity.

Pieces above one third of the capacity come two to a sequence at most, so they
are matched greedily: the largest with the largest that still fits. Smaller ones
then fill the tightest remaining gaps, largest first. Only lengths decide, so the
plan is made on the counts of each length, and a piece finds its place by its rank
among the pieces of its length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.names import unused
from strata.llm.tokens import TextEncoder, as_bytes
from strata.sources import layer_path, scratch_dir, write_layer

PARTS = 1024  # parts in which the pieces of one length are ranked


@dataclass(frozen=True)
class Placement:
    """Pieces of one length, by rank, that go to as many sequences at one offset."""

    length: int
    rank: int
    count: int
    sequence: int
    offset: int


def plan_sequences(counts: Mapping[int, int], capacity: int) -> tuple[list[Placement], int]:
    """Places for ``counts`` pieces of each length, and the number of sequences.

    The number of placements depends on the lengths only, not on how many pieces
    there are. Lengths are 1 .. capacity.
    """
    if any(not 1 <= length <= capacity for length in counts):
        raise ValueError("lengths must lie between 1 and the capacity")
    left = dict(counts)
    used = dict.fromkeys(counts, 0)
    gaps: dict[int, list[tuple[int, int]]] = {}
    placements: list[Placement] = []
    sequences = 0

    def put(length: int, count: int, sequence: int, offset: int) -> None:
        placements.append(Placement(length, used[length], count, sequence, offset))
        used[length] += count
        left[length] -= count

    def fill(length: int, start: int, bins: int, gap: int, each: int) -> None:
        for k in range(each):
            put(length, bins, start, capacity - gap + k * length)
        gaps.setdefault(gap - each * length, []).append((start, bins))

    for length in sorted((n for n in counts if 3 * n > capacity), reverse=True):
        for partner in range(min(length, capacity - length), capacity // 3, -1):
            pairs = left[length] // 2 if partner == length else min(left[length], left.get(partner, 0))
            if pairs > 0:
                put(length, pairs, sequences, 0)
                put(partner, pairs, sequences, length)
                gaps.setdefault(capacity - length - partner, []).append((sequences, pairs))
                sequences += pairs
        if left[length]:
            alone = left[length]
            put(length, alone, sequences, 0)
            gaps.setdefault(capacity - length, []).append((sequences, alone))
            sequences += alone
    for length in sorted((n for n in counts if 3 * n <= capacity), reverse=True):
        for gap in [*sorted(g for g in gaps if g >= length), capacity]:
            open_bins = gaps.pop(gap, []) if gap < capacity else []
            if gap == capacity and left[length]:
                fresh = -(-left[length] // (capacity // length))
                open_bins = [(sequences, fresh)]
                sequences += fresh
            while open_bins:
                start, bins = open_bins.pop()
                each = gap // length
                full = min(bins, left[length] // each)
                if full:
                    fill(length, start, full, gap, each)
                    start, bins = start + full, bins - full
                if bins and left[length]:  # fewer pieces than one more sequence takes
                    fill(length, start, 1, gap, left[length])
                    start, bins = start + 1, bins - 1
                if bins:
                    gaps.setdefault(gap, []).append((start, bins))
    return placements, sequences


def tokenized_pieces(
    docs: DataFrame, vocabulary: str, end_id: int, capacity: int, with_ids: bool = False
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, place_key[, ids]) of whole texts.

    Each text's ids are followed by ``end_id``; a null text has that id alone.
    Documents longer than ``capacity`` are cut so that all pieces but the first are
    full. ``place_key`` tells rows apart, also rows that are equal otherwise.
    ``ids`` are little-endian unsigned 32-bit integers. Extra columns are ignored.
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "place_key"]
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("piece", pa.int32()),
            *((name, pa.int64()) for name in names[2:]),
            *([("ids", pa.binary())] if with_ids else []),
        ]
    )
    end = as_bytes([end_id])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TextEncoder(vocabulary)
        key = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text"))):
                ids += end
                total = len(ids) // 4
                start, stop, piece = 0, (total - 1) % capacity + 1, 0
                while start < total:
                    own = ids[4 * start : 4 * stop]
                    row = (doc_id, piece, start, stop - start, zlib.crc32(own), key)
                    rows.append((*row, own) if with_ids else row)
                    start, stop, piece, key = stop, stop + capacity, piece + 1, key + 1
            columns = list(zip(*rows)) if rows else [()] * len(schema)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
            )

    kinds = "doc_id long, piece int, start long, length long, ids_crc32 long, place_key long"
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(cut, kinds + ", ids binary" * with_ids)


def pack_pieces(pieces: DataFrame, capacity: int, folder: str | None = None) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset`` in place of ``place_key``.

    Pieces of one length are ranked in parts, so a length that holds most of the
    rows is spread; the driver gets one count per length, ``capacity`` at most,
    and the plan that tasks share is bounded in the same way. Equal pieces get
    places of their own. An empty table stays empty.
    """
    folder = folder or scratch_dir(pieces.sparkSession)
    pieces = pieces.drop("sequence_id", "offset")
    own_part, size, start, rank, place = unused(pieces, "_part", "_size", "_start", "_rank", "_place")
    part = F.pmod(F.xxhash64("place_key"), F.lit(PARTS)).cast("int")
    stored = write_layer(pieces.withColumn(own_part, part), layer_path(folder, "packing", "pieces")).frame
    sizes = stored.groupBy("length", own_part).agg(F.count("*").alias(size))
    sizes = write_layer(sizes, layer_path(folder, "packing", "sizes")).frame
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum(size).alias("n")).collect()}
    placements, _ = plan_sequences(counts, capacity)
    earlier = Window.partitionBy("length").orderBy(own_part).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "length", own_part, F.coalesce(F.sum(size).over(earlier), F.lit(0)).alias(start)
    )
    within = Window.partitionBy("length", own_part).orderBy("place_key")
    ranked = (
        stored.withColumn(rank, F.row_number().over(within).cast("long") - 1)
        .join(starts, ["length", own_part])
        .withColumn(place, _finder(placements)(F.col("length"), F.col(start) + F.col(rank)))
    )
    kept = [c for c in pieces.columns if c != "place_key"]
    return ranked.select(*kept, f"{place}.*")


def _finder(placements: list[Placement]):
    """Arrow function from length and rank to sequence and offset."""
    ordered = sorted(placements, key=lambda p: (p.length, p.rank))
    keys = np.array([(p.length << 44) | p.rank for p in ordered], dtype=np.int64)
    sequence = np.array([p.sequence - p.rank for p in ordered], dtype=np.int64)
    offset = np.array([p.offset for p in ordered], dtype=np.int64)
    fields = [pa.field("sequence_id", pa.int64()), pa.field("offset", pa.int64())]

    @F.arrow_udf("sequence_id long, offset long")
    def find(length: pa.Array, rank: pa.Array) -> pa.Array:
        ranks = rank.to_numpy(zero_copy_only=False).astype(np.int64)
        lengths = length.to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.searchsorted(keys, (lengths << 44) | ranks, side="right") - 1
        found = [pa.array(sequence[at] + ranks), pa.array(offset[at])]
        return pa.StructArray.from_arrays(found, fields=fields)

    return find


def pack_documents(
    docs: DataFrame,
    vocabulary: str,
    end_id: int,
    capacity: int = 1024,
    with_ids: bool = False,
    folder: str | None = None,
) -> DataFrame:
    """Pieces of whole documents with their sequence and offset.

    A null doc_id stays null in its pieces, which are packed like others; so are pieces
    of repeated rows, each at a place of its own."""
    return pack_pieces(tokenized_pieces(docs, vocabulary, end_id, capacity, with_ids), capacity, folder)
