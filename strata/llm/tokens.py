"""Token ids of whole texts, with one encoder for each task.

The ids are those of the tokenizers library's plain call: strings of special tokens
get their ids. Two kinds of byte-pair vocabularies have a faster way to the same ids:
texts fall into chunks that cannot influence each other, and the distinct chunks of a
batch are encoded once, by tiktoken with the vocabulary's own ranks. Any other
vocabulary, any text with a special string, and any chunk with characters on which the
libraries' tables might differ, is left to tokenizers.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from tokenizers import Tokenizer

from strata.llm.chunks import (
    LOOSE_SPACE,
    ODD_SPACE,
    Inseparable,
    Units,
    encode_column,
    merged_units,
    units_of_bytes,
)
from strata.llm.words import utf8

#: Characters on which lower-casing and classes are the same everywhere: Latin letters and signs.
_PLAIN = re.compile(r"[\x21-\x7e¡-įı-ɏ]*\Z")
_PLAIN_LINES = re.compile(r"[\n\x21-\x7e¡-įı-ɏ]*\Z")
_NONE = np.zeros(0, dtype=np.uint32)
_TO_SPACE = bytes.maketrans(b"\t\n\r\x0b\x0c", b"     ")

# The splitting patterns of the two kinds of vocabularies.
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""


def as_bytes(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return array("I", ids).tobytes()


class TextEncoder:
    """Ids of texts as little-endian unsigned 32-bit integers.

    Strings of special tokens get these tokens' ids, or with ``special_strings=False``
    count as ordinary text.
    """

    def __init__(self, path: str, special_strings: bool = True):
        self._path = path
        self._plain: Tokenizer | None = None  # loaded for the first text that needs it
        self._special_strings = special_strings
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        special = [re.escape(token["content"].encode()) for token in spec.get("added_tokens", [])]
        self._special = re.compile(b"|".join(special)) if special and special_strings else None
        self._units = None
        if _is_byte_level(spec):
            ranks = _ranks(spec)
            self._core = tiktoken.Encoding("byte", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={})
            self._units = self._byte_units
        elif _is_word_level(spec):
            ranks = _word_ranks(spec)
            self._core = tiktoken.Encoding("word", pat_str=r"[^\x00\n]*\x00", mergeable_ranks=ranks, special_tokens={})
            self._piece = regex.compile(WORD_PATTERN)
            self._units = self._word_units
        if self._units:
            known = {number: len(token) for token, number in ranks.items() if number < 1 << 30}
            self._sizes = np.zeros(max(known) + 1, dtype=np.int64)
            self._sizes[list(known)] = list(known.values())

    def __call__(self, text: bytes | None) -> bytes:
        return next(self.encode(pa.array([text], pa.large_binary())))

    def encode(self, column: pa.Array) -> Iterator[bytes]:
        """The ids of each text of a column; none for a null or empty one."""
        if self._units is None:
            ids = (self._by_library(text) if text else _NONE for text in utf8(column))
        elif self._units == self._word_units:
            to_space = lambda text: text.translate(_TO_SPACE)
            ids = encode_column(column, self._units, self._alone, self._is_special, prepare=to_space)
        else:
            ids = encode_column(column, self._units, self._alone, self._is_loose, self._is_odd)
        for own in ids:
            yield own.astype("<u4", copy=False).tobytes()

    def _is_special(self, text: bytes) -> bool:
        return bool(self._special and self._special.search(text))

    def _is_loose(self, text: bytes) -> bool:
        """Texts with a special string, or with white space that splitting would change."""
        return bool(LOOSE_SPACE.search(text)) or self._is_special(text)

    def _is_odd(self, text: bytes) -> bool:
        try:
            text.decode()
        except UnicodeDecodeError:
            return True
        return bool(ODD_SPACE.search(text))

    def _alone(self, text: bytes) -> np.ndarray:
        if self._units == self._byte_units and not self._is_special(text):
            return self._at_once(text)
        return self._by_library(text)

    def _at_once(self, text: bytes) -> np.ndarray:
        return self._core.encode_to_numpy(text.decode(errors="replace"), disallowed_special=())

    def _by_library(self, text: bytes) -> np.ndarray:
        if self._plain is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on every core
            self._plain = Tokenizer.from_file(self._path)
            self._plain.encode_special_tokens = not self._special_strings
        ids = self._plain.encode(text.decode(errors="replace"), add_special_tokens=False).ids
        return np.array(ids, dtype=np.uint32)

    def _byte_units(self, firsts: list[bytes], words: pa.Array) -> Units:
        def joined(text: bytes) -> np.ndarray:
            try:
                return self._core.encode_to_numpy(text.decode(), disallowed_special=())
            except UnicodeDecodeError:  # bytes that are no text change their length when they are read
                raise Inseparable from None

        def apart(some: list[bytes]) -> list[np.ndarray]:
            return [self._at_once(unit) if unit else _NONE for unit in some]

        return units_of_bytes(firsts, words, joined, apart, self._sizes)

    def _word_units(self, firsts: list[bytes], words: pa.Array) -> Units:
        """White space of any kind only parts words; pieces of a word end in a zero byte."""
        units = firsts + words.to_pylist()
        text = b"\n".join(units).decode(errors="replace")
        apart = np.zeros(len(units), dtype=bool)
        if not _PLAIN_LINES.match(text):
            apart[:] = [not _PLAIN.match(line) for line in text.split("\n")]
            text = "\n".join(line for line, odd in zip(text.split("\n"), apart) if not odd)
        marked = self._piece.sub("\\g<0>\0", text.lower())
        ids = self._core.encode_to_numpy(marked, disallowed_special=())
        ends = np.flatnonzero(np.frombuffer(marked.encode() + b"\n", np.uint8) == 10)
        ends = (ends - np.arange(len(ends)))[: int((~apart).sum())]
        stops = np.searchsorted(np.cumsum(self._sizes[ids]), ends, side="right")
        return merged_units(ids, stops, apart, [self._by_library(units[i]) for i in np.flatnonzero(apart)])


def _kinds(step: dict | None) -> list[str]:
    if not step:
        return []
    inner = step.get("pretokenizers") or step.get("normalizers") or [step]
    return [part["type"] for part in inner]


def _is_byte_level(spec: dict) -> bool:
    split = spec.get("pre_tokenizer") or {}
    return (
        spec["model"]["type"] == "BPE"
        and _kinds(split) == ["ByteLevel"]
        and not spec.get("normalizer")
        and not split.get("add_prefix_space")
        and split.get("use_regex", True)
        and not spec["model"].get("end_of_word_suffix")
    )


def _is_word_level(spec: dict) -> bool:
    split = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    return (
        spec["model"]["type"] == "BPE"
        and _kinds(spec.get("pre_tokenizer")) == ["Split", "ByteLevel"]
        and (split[0].get("pattern") or {}).get("Regex") == WORD_PATTERN
        and _kinds(spec.get("normalizer")) == ["NFC", "Replace", "Lowercase"]
        and spec["model"].get("end_of_word_suffix") == "</w>"
    )


def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write each byte as a letter: printable Latin-1 as itself,
    the others as the letters from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(0x100 + k): b for k, b in enumerate(others)}


def _ranks(spec: dict) -> dict[bytes, int]:
    letters = _byte_letters()
    special = {token["content"] for token in spec.get("added_tokens", [])}
    vocabulary = spec["model"]["vocab"].items()
    return {bytes(letters[c] for c in t): i for t, i in vocabulary if t not in special}


def _word_ranks(spec: dict) -> dict[bytes, int]:
    """Ranks with the end of a word as a zero byte, which no encoded chunk holds."""
    letters = _byte_letters()
    special = {token["content"] for token in spec.get("added_tokens", [])}
    ranks = {}
    for token, number in spec["model"]["vocab"].items():
        if token not in special:
            end = token.endswith("</w>")
            body = bytes(letters[c] for c in token.removesuffix("</w>"))
            ranks[body + b"\0" * end] = number
    ranks[b"\0"] = 1 << 30  # never an id: every last letter of a word has its own token
    return ranks
