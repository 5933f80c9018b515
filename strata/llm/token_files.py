"""Token ids in binary files: one concatenated id array and Elias-Fano boundaries.

A file holds, in this order, the magic, the ids of its documents without gaps (16
or 32 bits each, little-endian), the coded ends of the documents, the coded
doc_ids, and a fixed footer with the sections' sizes. Files follow each other in
ascending doc_id order; their first id's place in the whole is in the manifest.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.elias_fano import EliasFano
from strata.llm.tokens import TextEncoder, as_bytes
from strata.sources import layer_path, scratch_dir, write_layer

MAGIC = b"TOKENS01"
FOOTER = "<BQQQqQQ8s"  # id width, ids, documents, null doc_ids, least doc_id, sizes
BLOCK_DOCS = 1 << 14  # documents whose ends are decoded at once
FILE_IDS = 1 << 26  # ids after which a task starts another file
MANIFEST = "partition int, part int, path string, n_docs long, n_ids long"


class TokenFileWriter:
    """Writes one file, a document at a time; only boundaries and doc_ids are held."""

    def __init__(self, stream, width: int):
        self.stream, self.width = stream, width
        self.ends: list[int] = []
        self.doc_ids: list[int] = []
        self.nulls = self.ids = 0
        stream.write(MAGIC)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """``ids`` are 32 bits wide; null doc_ids come first."""
        values = np.frombuffer(ids, np.uint32)
        if self.width == 2 and values.max(initial=0) > 0xFFFF:
            raise ValueError(f"id {values.max()} does not fit 2 bytes; write 4")
        self.stream.write(values.astype(np.uint16).tobytes() if self.width == 2 else ids)
        self.ids += len(values)
        self.ends.append(self.ids)
        if doc_id is None:
            self.nulls += 1
        else:
            self.doc_ids.append(doc_id)

    def close(self) -> None:
        least = self.doc_ids[0] if self.doc_ids else 0
        ends = EliasFano.encode(np.array(self.ends, dtype=np.uint64)).to_bytes()
        named = np.array([d - least for d in self.doc_ids], dtype=np.uint64)
        named = EliasFano.encode(named).to_bytes()
        self.stream.write(ends)
        self.stream.write(named)
        sizes = (len(ends), len(named), MAGIC)
        self.stream.write(
            struct.pack(FOOTER, self.width, self.ids, len(self.ends), self.nulls, least, *sizes)
        )
        self.stream.close()


class TokenFile:
    """Random access to a file: ids of document i, found by two selects."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        footer_size = struct.calcsize(FOOTER)
        if size < footer_size + len(MAGIC) or source.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError("not a token file")
        footer = struct.unpack(FOOTER, source.read_at(footer_size, size - footer_size))
        self.width, self.n_ids, self.n_docs, self.nulls, self.least, n_ends, n_named, magic = footer
        sections = len(MAGIC) + self.width * self.n_ids
        if magic != MAGIC or sections + n_ends + n_named + footer_size != size:
            raise ValueError("a damaged token file")
        self.ends = EliasFano.from_bytes(source.read_at(n_ends, sections))
        self.named = EliasFano.from_bytes(source.read_at(n_named, sections + n_ends))

    def ids(self, i: int) -> np.ndarray:
        start = self.ends.select(i - 1) if i else 0
        return self._between(start, self.ends.select(i))

    def doc_id(self, i: int) -> int | None:
        return None if i < self.nulls else self.least + self.named.select(i - self.nulls)

    def _between(self, start: int, stop: int) -> np.ndarray:
        kind = np.uint16 if self.width == 2 else np.uint32
        at = len(MAGIC) + self.width * start
        return np.frombuffer(self.source.read_at(self.width * (stop - start), at), kind)

    def documents(self, block: int = 1 << 20) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, start in the file, ids) of every document, read in blocks of ids.

        Ends and doc_ids are decoded some thousand at a time, from the places that the
        select samples name; no table of all of them is made."""
        start = 0
        for first in range(0, self.n_docs, BLOCK_DOCS):
            stop = min(first + BLOCK_DOCS, self.n_docs)
            ends = self.ends.between(first, stop).astype(np.int64)
            without = max(min(self.nulls, stop) - first, 0)
            named = self.named.between(first + without - self.nulls, stop - self.nulls) if stop > self.nulls else []
            doc_ids = [None] * without + [self.least + int(v) for v in named]
            at = 0
            while at < len(ends):
                last = max(int(np.searchsorted(ends, start + block, side="right")), at + 1)
                base, ids = start, self._between(start, int(ends[last - 1]))
                for i in range(at, last):
                    yield doc_ids[i], start, ids[start - base : int(ends[i]) - base]
                    start = int(ends[i])
                at = last


def open_fs(address: str) -> tuple[fs.FileSystem, str]:
    """The file system of an address, and the path in it; a bare path is a local one."""
    if "://" in address or address.startswith("file:"):
        return fs.FileSystem.from_uri(address.replace("file:/", "file:///", 1) if "://" not in address else address)
    return fs.LocalFileSystem(), address


def write_token_files(
    docs: DataFrame, vocabulary: str, end_id: int, path: str, id_bytes: int = 2
) -> DataFrame:
    """Write ids of all texts in ascending doc_id order; return the manifest.

    The manifest has a row for each file: (partition, part, path, n_docs, n_ids,
    first_id), where ``first_id`` counts the ids of all earlier files. Null doc_ids
    come first. A null text is its end id alone. Rows of one doc_id are spread over
    partitions by a running number, so repeats of one value fill no task; their
    order among each other is free. A task writes under names that hold its attempt
    number, so a retried task leaves a file that no manifest names. An empty table
    gives an empty manifest. ``id_bytes`` is 2 or 4; ids must fit. Extra columns
    are ignored.
    """
    schema = pa.schema(
        [
            ("partition", pa.int32()),
            ("part", pa.int32()),
            ("path", pa.string()),
            ("n_docs", pa.int64()),
            ("n_ids", pa.int64()),
        ]
    )
    end = as_bytes([end_id])
    root = f"{path.rstrip('/')}/ids"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        files, base = open_fs(root)
        files.create_dir(base, recursive=True)
        encoder = TextEncoder(vocabulary)
        writer, name, part = None, "", 0

        def closed() -> pa.RecordBatch:
            writer.close()
            row = (context.partitionId(), part, name, len(writer.ends), writer.ids)
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text"))):
                if writer is None:
                    name = f"part-{context.partitionId():06d}-{part:04d}-{context.taskAttemptId()}.tokens"
                    writer = TokenFileWriter(files.open_output_stream(f"{base}/{name}"), id_bytes)
                writer.add(doc_id, ids + end)
                if writer.ids >= FILE_IDS:
                    yield closed()
                    writer, part = None, part + 1
        if writer is not None:
            yield closed()

    ordered = (
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .withColumn("_row", F.monotonically_increasing_id())
        .repartitionByRange("doc_id", "_row")
        .sortWithinPartitions("doc_id", "_row")
        .drop("_row")
    )
    manifest = write_layer(ordered.mapInArrow(write, MANIFEST), layer_path(path, "tokens", "files")).frame
    earlier = Window.orderBy("partition", "part").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).alias("first_id")
    return manifest.withColumn("path", F.concat(F.lit(f"{root}/"), "path")).select("*", first)


def read_token_files(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the manifest's files.

    ``start`` counts the ids of all documents before; the checksum is over the ids
    as little-endian unsigned 32-bit integers.
    """
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "n_tokens", "ids_crc32")])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, first in zip(*(batch.column(c).to_pylist() for c in ("path", "first_id"))):
                files, place = open_fs(path)
                with files.open_input_file(place) as source:
                    rows = []
                    for doc_id, start, ids in TokenFile(source).documents():
                        crc = zlib.crc32(ids.astype(np.uint32).tobytes())
                        rows.append((doc_id, first + start, len(ids), crc))
                        if len(rows) == 50_000:
                            yield _batch(rows, schema)
                            rows = []
                    yield _batch(rows, schema)

    spread = manifest.select("path", "first_id").repartition("path")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def token_files(
    docs: DataFrame, vocabulary: str, end_id: int, path: str | None = None, id_bytes: int = 2
) -> DataFrame:
    """Write the files and describe every document as it is read back from them."""
    path = path or scratch_dir(docs.sparkSession)
    return read_token_files(write_token_files(docs, vocabulary, end_id, path, id_bytes))
