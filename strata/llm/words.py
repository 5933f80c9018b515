"""Words of a text as 64-bit hashes, for tasks that work on numpy arrays."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_PRIME = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BLOCK = 1 << 17  # bytes that are hashed at once
WHITE = b" \t\n\r\x0b\x0c"
_IS_WHITE = np.isin(np.arange(256), list(WHITE))
_SAME = np.arange(1, 257, dtype=np.uint64)
_LOWER = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), _SAME + np.uint64(32), _SAME)
_WHITE_RUN = re.compile(b"[" + WHITE + b"]")
_POWERS: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) in 64 bits; those of one block are remembered."""
    known = _POWERS.get(int(base))
    if known is None or len(known) < n:
        known = np.ones(max(n, _BLOCK + 1), dtype=np.uint64)
        known[1:] = base
        known = np.multiply.accumulate(known)
        if n <= _BLOCK + 1:
            _POWERS[int(base)] = known
    return known[:n]


def word_hashes(text: bytes | None, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each word, in order, without making the words.

    Words are runs of anything but ASCII white space; ``lower`` takes A-Z as a-z. A
    word's hash comes from running sums over the bytes. Long texts are taken in
    blocks that end at white space.
    """
    if not text:
        return np.zeros(0, dtype=np.uint64)
    parts, start = [], 0
    while start < len(text):
        stop = len(text)
        if stop - start > _BLOCK:
            found = _WHITE_RUN.search(text, start + _BLOCK)
            stop = found.start() if found else stop
        parts.append(_block_hashes(np.frombuffer(text, np.uint8, stop - start, start), lower))
        start = stop
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def _block_hashes(raw: np.ndarray, lower: bool) -> np.ndarray:
    edges = np.flatnonzero(np.diff(_IS_WHITE[raw], prepend=True, append=True))
    start, stop = edges[::2], edges[1::2]
    n = len(raw)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((_LOWER if lower else _SAME)[raw] * powers(_PRIME, n), out=sums[1:])
    values = (sums[stop] - sums[start]) * powers(_INVERSE, n + 1)[start]
    return mix(values ^ (stop - start).astype(np.uint64) * _PRIME)


def utf8(column: pa.Array, step: int = 256) -> Iterator[bytes | None]:
    """The values of a string column as UTF-8 bytes, a few at a time."""
    for start in range(0, len(column), step):
        yield from pc.cast(column.slice(start, step), pa.large_binary()).to_pylist()


def mix(values: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values one to one."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def windows(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words; of all words where there are fewer; empty for none."""
    n = len(words)
    if n == 0:
        return words
    span = min(width, n)
    total = np.full(n - span + 1, span, dtype=np.uint64)
    for k in range(span):
        total = total * _PRIME + words[k : n - span + 1 + k]
    return mix(total)


def shingle_set(words: np.ndarray, width: int) -> np.ndarray:
    """Distinct window hashes, ascending."""
    return np.unique(windows(words, width))
