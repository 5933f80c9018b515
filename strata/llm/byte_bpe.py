"""Byte-level byte-pair encoding and decoding of whole texts, over Arrow batches.

A rank file lists byte strings with their ids; a lower id merges earlier. The tokenizers
library gets these strings with every byte written as a letter, and each way to halve
one into two others as a merge, so it merges whatever neighbours make a listed string,
lowest id first. Texts of an Arrow batch share the work for the chunks they share. Decoding turns letters back to bytes and joins them; characters whose
bytes several tokens share are put together again.
"""

from __future__ import annotations

import base64
import codecs
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Regex, Tokenizer, models, pre_tokenizers

from strata.llm.chunks import LOOSE_SPACE, ODD_SPACE, Units, encode_column, units_of_bytes

BATCH = 1 << 19  # characters that the library gets at once; it takes 30 to 40 bytes for each
CACHE = 0  # chunks that the library remembers: it gets each but once
GROUP = 1 << 22  # bytes of texts whose chunks are encoded together
ROWS = 2_000  # texts whose ids a task holds before it hands them on
DECODED = 1 << 20  # ids that are decoded at once
LONG = 1 << 19  # characters from which a text is encoded in parts


def byte_letters() -> list[str]:
    """A printable letter for each byte: Latin-1's own where it has one, else from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in printable}
    others = (b for b in range(256) if b not in letters)
    letters |= {b: chr(0x100 + k) for k, b in enumerate(others)}
    return [letters[b] for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Byte strings and ids of a rank file: base64 and a number on each line."""
    with open(path, "rb") as file:
        pairs = (line.split() for line in file if line.strip())
        return {base64.b64decode(token): int(number) for token, number in pairs}


class ByteBpe:
    """Encoder and decoder of one rank file; each match of ``pattern`` is encoded by itself,
    and what no match covers is left out."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        letters = byte_letters()
        self._written = {token: "".join(letters[b] for b in token) for token in ranks}
        self._ranks, self._pattern = ranks, pattern
        self._library: Tokenizer | None = None  # made for the first text
        byte_of = {letter: byte for byte, letter in enumerate(letters)}
        self._bytes: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
        for token, number in ranks.items():
            self._bytes[number] = bytes(map(byte_of.__getitem__, self._written[token]))
        self._sizes = np.array([len(token or b"") for token in self._bytes], dtype=np.int64)
        self._places = np.cumsum(self._sizes) - self._sizes
        self._all_bytes = np.frombuffer(b"".join(token or b"" for token in self._bytes), np.uint8)
        self._known = np.array([token is not None for token in self._bytes], dtype=bool)

    def _make_library(self) -> Tokenizer:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on every core
        ranks, written = self._ranks, self._written
        merges = [
            (written[token[:k]], written[token[k:]])
            for token in sorted(ranks, key=ranks.get)
            for k in range(1, len(token))
            if token[:k] in ranks and token[k:] in ranks
        ]
        vocabulary = {written[token]: number for token, number in ranks.items()}
        library = Tokenizer(models.BPE(vocabulary, merges, ignore_merges=True, cache_capacity=CACHE))
        library.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.Split(Regex(self._pattern), "removed", invert=True),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        return library

    def encode(self, column: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text of a column; a null has none.

        The library gets every chunk between two spaces once for all texts of a batch that
        hold it: neither the usual patterns nor merges reach over a space between two words.
        """
        spaced = lambda text: bool(LOOSE_SPACE.search(text))
        odd = lambda text: bool(ODD_SPACE.search(text))
        yield from encode_column(column, self._units, self._alone, spaced, odd, group=GROUP)

    def _units(self, firsts: list[bytes], words: pa.Array) -> Units:
        apart = lambda units: self._run([unit.decode() for unit in units])
        return units_of_bytes(firsts, words, self._alone, apart, self._sizes)

    def _alone(self, text: bytes) -> np.ndarray:
        parts = self._run([part for _, part in text_parts(text.decode())])
        return parts[0] if len(parts) == 1 else np.concatenate(parts)

    def _run(self, texts: list[str]) -> list[np.ndarray]:
        self._library = self._library or self._make_library()
        found = []
        for group in _groups(texts):
            encoded = self._library.encode_batch_fast(group, add_special_tokens=False)
            found += [np.array(own.ids, dtype=np.uint32) for own in encoded]
        return found

    def encode_with_offsets(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(ids, starts, ends) of each text, in code points. Tokens that share a character
        all have that character's offsets."""
        self._library = self._library or self._make_library()
        for text in texts:
            ids, spans = [], []
            for at, part in text_parts(text or ""):
                own = self._library.encode(part, add_special_tokens=False)
                ids.append(np.array(own.ids, dtype=np.uint32))
                spans.append(np.array(own.offsets, dtype=np.int64).reshape(-1, 2) + at)
            both = np.concatenate(spans)
            yield np.concatenate(ids), both[:, 0], both[:, 1]

    def decode(self, ids: list[int] | np.ndarray) -> bytes:
        """The bytes of ids; an id that the ranks do not have raises."""
        own = np.asarray(ids, dtype=np.int64)
        if len(own) and not (own.min() >= 0 and own.max() < len(self._known) and self._known[own].all()):
            raise ValueError("an id that the ranks do not have")
        done = []
        for start in range(0, len(own), DECODED):
            part = own[start : start + DECODED]
            sizes = self._sizes[part]
            ends = np.cumsum(sizes)
            places = np.repeat(self._places[part] - ends + sizes, sizes)
            places += np.arange(len(places))
            done.append(self._all_bytes[places].tobytes())
        return done[0] if len(done) == 1 else b"".join(done)

    def token_texts(self, ids: list[int]) -> list[str]:
        """Each token's share of the text: a character that several tokens make up goes to the
        one that completes it, the others get ''. Bytes that make up none become U+FFFD."""
        decoder = codecs.getincrementaldecoder("utf-8")("replace")
        texts = [decoder.decode(self.decode([i])) for i in ids]
        if texts:
            texts[-1] += decoder.decode(b"", final=True)
        return texts


def _groups(texts: list[str]) -> Iterator[list[str]]:
    group: list[str] = []
    size = 0
    for text in texts:
        group.append(text)
        size += len(text) + 16
        if size >= BATCH:
            yield group
            group, size = [], 0
    if group:
        yield group


def text_parts(text: str) -> Iterator[tuple[int, str]]:
    """(start, part) of a long text, cut before a space between two characters that are none.

    No match of the usual patterns reaches over such a place: only white space may go
    before more of it, and a match may begin with one space. A stretch without such a
    place stays whole."""
    start = 0
    while len(text) - start > LONG:
        cut = text.find(" ", start + LONG)
        while 0 < cut < len(text) - 1 and (text[cut - 1].isspace() or text[cut + 1].isspace()):
            cut = text.find(" ", cut + 1)
        if not 0 < cut < len(text) - 1:
            break
        yield start, text[start:cut]
        start = cut
    yield start, text[start:] if start else text


def encode_text(text: Column, ranks: str, pattern: str) -> Column:
    """array<int>: ids of each whole text; a null or empty text has none.

    ``ranks`` is a path that every executor can open. Special tokens do not exist: their
    strings are ordinary text. Long texts are encoded in parts, with the same ids. The
    column counts as non-deterministic, lest Spark encodes anew for every use of the ids."""

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        return _lists(list(_loaded(ranks, pattern).encode(texts)))

    return encode.asNondeterministic()(text.cast("string"))


def encode_documents(
    docs: DataFrame, ranks: str, pattern: str, text: str = "text", ids: str = "ids", decoded: str | None = None
) -> DataFrame:
    """``docs`` with the column ``ids`` in place of its texts, as in ``encode_text``.

    With ``decoded``, a column of that name holds the bytes that the ids decode to, made
    in the same pass. Some thousand texts are held at a time, whatever the batches. Other
    columns stay; those of these names are replaced. Repeated rows get equal results,
    and an empty table stays empty.
    """
    added = [ids, *([decoded] if decoded else [])]
    kept = [c for c in docs.columns if c not in (text, *added)]
    texts = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(text).cast("string").alias(text))
    out = T.StructType([texts.schema[c] for c in kept]).add(ids, T.ArrayType(T.IntegerType()))
    out = out.add(decoded, T.BinaryType()) if decoded else out

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(ranks, pattern)
        for batch in batches:
            for start in range(0, len(batch), ROWS):
                part = batch.slice(start, ROWS)
                found = list(bpe.encode(part.column(text)))
                columns = [part.column(c) for c in kept] + [_lists(found)]
                if decoded:
                    columns.append(pa.array((bpe.decode(own) for own in found), pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, *added])

    return texts.mapInArrow(encode, out)


def encode_with_offsets(text: Column, ranks: str, pattern: str) -> Column:
    """struct(ids, starts, ends): as ``encode_text``, with each token's code points in the text."""

    @F.arrow_udf("ids array<int>, starts array<int>, ends array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        found = list(_loaded(ranks, pattern).encode_with_offsets(texts.to_pylist()))
        lists = [_lists([row[k] for row in found]) for k in range(3)]
        return pa.StructArray.from_arrays(lists, names=["ids", "starts", "ends"])

    return encode.asNondeterministic()(text.cast("string"))


def decode_ids(ids: Column, ranks: str, pattern: str) -> Column:
    """binary: the bytes of each list of ids, also where they are no valid text. Null gives null."""

    @F.arrow_udf("binary")
    def decode(lists: pa.Array) -> pa.Array:
        bpe = _loaded(ranks, pattern)
        return pa.array((None if own is None else bpe.decode(own) for own in _values(lists)), pa.binary())

    return decode(ids)


def decode_tokens(ids: Column, ranks: str, pattern: str) -> Column:
    """array<string>: the text that each token adds, see ``ByteBpe.token_texts``."""

    @F.arrow_udf("array<string>")
    def decode(lists: pa.Array) -> pa.Array:
        bpe = _loaded(ranks, pattern)
        texts = [None if own is None else bpe.token_texts(own) for own in _values(lists)]
        return pa.array(texts, pa.list_(pa.string()))

    return decode(ids)


_LOADED: dict[tuple[str, str], ByteBpe] = {}


def _loaded(ranks: str, pattern: str) -> ByteBpe:
    """One encoder for each task and rank file."""
    if (ranks, pattern) not in _LOADED:
        _LOADED[ranks, pattern] = ByteBpe(read_ranks(ranks), pattern)
    return _LOADED[ranks, pattern]


def _values(lists: pa.Array) -> Iterator[list[int] | None]:
    for start in range(0, len(lists), 64):
        yield from lists.slice(start, 64).to_pylist()


def _lists(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(row) for row in rows])]).astype(np.int32)
    values = np.concatenate(rows).astype(np.int32, copy=False) if rows else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
