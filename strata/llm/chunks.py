"""Token ids of many texts by way of their distinct chunks.

Byte-pair vocabularies of the usual kind cut a text before its spaces: what lies
between cannot influence what lies beyond. So the texts of a batch are split there by
Arrow, each distinct chunk is encoded once, together with the others in one long
string, and every text's ids are gathered by array offsets. No Python object is made
for a word that was seen before in the batch.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from strata.llm.words import utf8

GROUP = 1 << 22  # bytes of texts whose chunks are encoded together
WHITE = b" \t\n\r\x0b\x0c"
_SPACE = rb"[ \t\n\r\x0b\x0c]"
#: A space whose neighbours decide whether it is a token of its own.
LOOSE_SPACE = re.compile(_SPACE + rb" (?:" + _SPACE + rb"|\Z)")
#: White space and separators outside of ASCII's usual ones.
ODD_SPACE = re.compile(
    rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80"
)
_IS_WHITE = np.isin(np.arange(256), list(WHITE))
_INNER_SPACE = re.compile(rb"(?<![ \t\n\r\x0b\x0c]) (?![ \t\n\r\x0b\x0c])")

#: Ids of the units one after another, and where each unit's begin and the last one's end.
Units = tuple[np.ndarray, np.ndarray]


class Inseparable(Exception):
    """Some of the texts have to be looked at before they are split."""


def encode_column(
    column: pa.Array,
    encode_units: Callable[[list[bytes], pa.Array], Units],
    alone: Callable[[bytes], np.ndarray],
    whole: Callable[[bytes], bool],
    whole_after_all: Callable[[bytes], bool] = lambda text: False,
    prepare: Callable[[bytes], bytes] = lambda text: text,
    group: int | None = None,
) -> Iterator[np.ndarray]:
    """Ids of each text of a string column, in order; none for a null.

    ``encode_units(firsts, words)`` encodes chunks by themselves, those of ``words``
    with a space before each; texts are split as ``prepare`` leaves them. Texts for
    which ``whole`` holds are not split but go to ``alone``, and where the units turn
    out ``Inseparable``, those for which ``whole_after_all`` holds as well. Chunks of
    about ``group`` bytes of texts are encoded together.
    """
    group = group or GROUP
    held: list[tuple[bytes, bool, bool]] = []  # a piece, whether it is split, whether more of its text follows
    size = 0

    def encoded() -> Iterator[np.ndarray]:
        try:
            return iter(list(_encode_group(held, encode_units, alone, prepare)))
        except Inseparable:
            again = [(t, is_split and not whole_after_all(t), more) for t, is_split, more in held]
            return _encode_group(again, encode_units, alone, prepare)

    for raw in utf8(column):
        raw = raw or b""
        if whole(raw):
            held.append((raw, False, False))
        else:
            *parts, last = pieces(raw, group)
            held += [(part, True, True) for part in parts]
            held.append((last, True, False))
        size += len(raw)
        if size >= group:
            yield from encoded()
            held, size = [], 0
    yield from encoded()


def pieces(raw: bytes, size: int) -> Iterator[bytes]:
    """A text in pieces of about ``size`` bytes that begin with a space between two words."""
    start = 0
    while len(raw) - start > size:
        found = _INNER_SPACE.search(raw, start + size)
        if not found or found.start() == len(raw) - 1:
            break
        yield raw[start : found.start()]
        start = found.start()
    yield raw[start:] if start else raw


def _encode_group(held, encode_units, alone, prepare) -> Iterator[np.ndarray]:
    split = iter(_split([prepare(piece) for piece, is_split, _ in held if is_split], encode_units))
    parts: list[np.ndarray] = []
    for piece, is_split, more in held:
        parts.append(next(split) if is_split else alone(piece))
        if not more:
            yield parts[0] if len(parts) == 1 else np.concatenate(parts)
            parts = []


def _split(texts: list[bytes], encode_units) -> Iterator[np.ndarray]:
    if not texts:
        return
    lists = pc.split_pattern(pa.array(texts, pa.large_binary()), b" ")
    edges = lists.offsets.to_numpy()
    coded = lists.flatten().dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int64)
    firsts, which = np.unique(codes[edges[:-1]], return_inverse=True)
    codes += len(firsts)
    codes[edges[:-1]] = which
    values, bounds = encode_units(coded.dictionary.take(pa.array(firsts)).to_pylist(), coded.dictionary)
    lengths = (bounds[1:] - bounds[:-1])[codes]
    stops = np.concatenate([[0], np.cumsum(lengths)])
    places = np.repeat(bounds[codes] - stops[:-1], lengths)
    places += np.arange(stops[-1])
    ids = values[places]
    ends = stops[edges].tolist()
    for start, stop in zip(ends[:-1], ends[1:]):
        yield ids[start:stop]


def sizes_and_white_edges(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of each word, and whether it is empty or begins or ends with white space: a
    space before it, or one behind it, could then merge with that."""
    wide = words.cast(pa.large_binary())
    edges = np.frombuffer(wide.buffers()[1], np.int64, len(wide) + 1, 8 * wide.offset)
    data = wide.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    sizes = np.diff(edges)
    white = sizes == 0
    solid = ~white
    for at in (edges[:-1][solid], edges[1:][solid] - 1):
        white[solid] |= _IS_WHITE[raw[at]]
    return sizes, white


def merged_units(ids: np.ndarray, stops: np.ndarray, apart: np.ndarray, lone: list[np.ndarray]) -> Units:
    """All units in their order: ``ids`` up to each of ``stops`` for the joined ones, ``lone``
    for those ``apart``."""
    lengths = np.empty(len(apart), dtype=np.int64)
    lengths[~apart] = np.diff(stops, prepend=0)
    lengths[apart] = [len(own) for own in lone]
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    values = np.empty(bounds[-1], dtype=np.uint32)
    from_lone = np.repeat(apart, lengths)
    values[~from_lone] = ids
    if lone:
        values[from_lone] = np.concatenate(lone)
    return values, bounds


def units_of_bytes(
    firsts: list[bytes],
    words: pa.Array,
    encode_joined: Callable[[bytes], np.ndarray],
    encode_apart: Callable[[list[bytes]], list[np.ndarray]],
    sizes_of_ids: np.ndarray,
) -> Units:
    """``Units`` of a byte-level vocabulary whose tokens may begin with a space.

    All words become one string, each behind a space, and the bytes of its tokens tell
    whose they are. Firsts, and words with white space at an edge, are encoded apart.
    """
    sizes, white = sizes_and_white_edges(words)
    listed = words.to_pylist()
    odd = np.flatnonzero(white)
    together = listed if not len(odd) else [listed[i] for i in np.flatnonzero(~white)]
    text = b" " + b" ".join(together) if together else b""
    if ODD_SPACE.search(text) or any(ODD_SPACE.search(listed[i]) for i in odd):
        raise Inseparable
    ids = encode_joined(text)
    ends = np.cumsum(sizes[~white] + 1)
    stops = np.searchsorted(np.cumsum(sizes_of_ids[ids]), ends, side="right")
    apart = np.concatenate([np.ones(len(firsts), dtype=bool), white])
    return merged_units(ids, stops, apart, encode_apart(firsts + [b" " + listed[i] for i in odd]))
