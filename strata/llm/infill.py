"""Fill-in-middle by displacement scatter.

A text is cut into prefix, middle and suffix, and rewritten with a marker before each
part, the middle last. All texts of an Arrow batch lie in one buffer: one scan finds the
bytes of the cuts, a difference array over the batch holds the change of the output
shift at every cut, its cumulative sum gives each byte's shift, and one scatter moves
all bytes. Restoring is the inverse gather: cuts are found at the markers.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

SLICE = 1 << 24  # bytes of texts that are rewritten together
WINDOW = 1 << 21  # bytes whose shifts are held at once, also of a longer text
FORMS = ("plain", "psm", "spm")
_PLAIN, _PSM, _SPM = range(3)


@dataclass(frozen=True)
class Infill:
    """Texts stay plain from ``plain_from`` of 100 on, others take suffix, prefix, middle
    below ``spm_below`` of 100. ``markers`` stand before prefix, suffix and middle; no two
    may overlap, so that a text without them holds each exactly once afterwards. ``salt``
    goes before the key in the hash that draws cuts and forms."""

    markers: tuple[str, str, str] = ("<P>", "<S>", "<M>")
    plain_from: int = 90
    spm_below: int = 20
    salt: str = "1:"

    def __post_init__(self) -> None:
        for a in self.markers:
            for b in self.markers:
                overlap = any(a.endswith(b[:k]) for k in range(1, min(len(a), len(b)) + (a != b)))
                if not a or overlap or (a != b and b in a):
                    raise ValueError("markers must be distinct and must not overlap")
        if len(set(self.markers)) != 3:
            raise ValueError("markers must be distinct and must not overlap")

    @property
    def pattern(self) -> re.Pattern:
        return re.compile(b"|".join(re.escape(m.encode()) for m in self.markers))


def infill(key: Column, text: Column, rules: Infill = Infill()) -> Column:
    """struct(n, form, prefix_chars, middle_chars, output) of each text.

    The first four 8-digit groups of the hex SHA-256 of salt and key draw the two cuts
    and the form, so equal keys and texts give equal results wherever they stand. A null
    text counts as empty, a null key as an empty string. Empty texts and texts that hold
    a marker stay plain, with null lengths. Texts of any length are taken whole; memory
    is a few times the longest text and does not depend on where it is cut. The column
    counts as non-deterministic, lest Spark rewrites anew for every field that is used.
    """
    seed = F.sha2(F.concat(F.lit(rules.salt), F.coalesce(key.cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(seed, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]
    fields = [
        pa.field("n", pa.int64()),
        pa.field("form", pa.string()),
        pa.field("prefix_chars", pa.int64()),
        pa.field("middle_chars", pa.int64()),
        pa.field("output", pa.string()),
    ]

    @F.arrow_udf("n long, form string, prefix_chars long, middle_chars long, output string")
    def rewrite(text: pa.Array, h1: pa.Array, h2: pa.Array, h3: pa.Array, h4: pa.Array) -> pa.Array:
        drawn = np.stack([h.to_numpy(zero_copy_only=False).astype(np.int64) for h in (h1, h2, h3, h4)])
        parts = []
        for start, stop in slices(text):
            columns = rewritten(text.slice(start, stop - start), drawn[:, start:stop], rules)
            parts.append(pa.StructArray.from_arrays(columns, fields=fields))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.struct(fields))

    return rewrite.asNondeterministic()(text.cast("string"), *draws)


def restore(output: Column, form: Column, rules: Infill = Infill()) -> Column:
    """The text that ``infill`` rewrote, from its output and form alone. Nulls give null."""

    @F.arrow_udf("string")
    def gather(output: pa.Array, form: pa.Array) -> pa.Array:
        codes = pc.index_in(form, pa.array(FORMS)).fill_null(_PLAIN).to_numpy(zero_copy_only=False)
        parts = []
        for start, stop in slices(output):
            part = output.slice(start, stop - start)
            parts.append(restored(part, codes[start:stop], rules))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    return gather(output, form)


def slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows with up to ``SLICE`` bytes, or one longer text."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < len(sizes):
        base = ends[start] - sizes[start]
        stop = max(int(np.searchsorted(ends, base + SLICE, side="right")), start + 1)
        yield start, stop
        start = stop


def _buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, and where each begins and the last ends."""
    wide = pc.cast(pc.fill_null(texts, ""), pa.large_binary())
    edges = np.frombuffer(wide.buffers()[1], np.int64, len(wide) + 1, 8 * wide.offset)
    data = wide.buffers()[2]
    size = int(edges[-1] - edges[0])
    raw = np.frombuffer(data, np.uint8, size, int(edges[0])) if size else np.zeros(0, np.uint8)
    return raw, edges - edges[0]


def _texts(raw: np.ndarray, edges: np.ndarray, valid: np.ndarray | None = None) -> pa.Array:
    offsets = pa.py_buffer(edges.astype(np.int32).tobytes())
    mask, nulls = None, 0
    if valid is not None and not valid.all():
        mask = pa.py_buffer(np.packbits(valid, bitorder="little").tobytes())
        nulls = int((~valid).sum())
    return pa.Array.from_buffers(pa.string(), len(edges) - 1, [mask, offsets, pa.py_buffer(raw)], nulls)


def _shifts(size: int, at: np.ndarray, change: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(start, stop, place + shift of each byte) in windows; shifts change by ``change`` at ``at``."""
    order = np.argsort(at, kind="stable")
    at, change = at[order], change[order]
    carried = 0
    for start in range(0, size, WINDOW):
        stop = min(start + WINDOW, size)
        first, last = np.searchsorted(at, [start, stop])
        difference = np.ones(stop - start, dtype=np.int64)
        difference[0] = start + carried
        np.add.at(difference, at[first:last] - start, change[first:last])
        carried += int(change[first:last].sum())
        yield start, stop, np.cumsum(difference)


def _marks(raw: np.ndarray, edges: np.ndarray, rules: Infill) -> tuple[np.ndarray, np.ndarray]:
    """Places of markers within a text, and which text."""
    spans = np.array([m.span() for m in rules.pattern.finditer(raw)], dtype=np.int64).reshape(-1, 2)
    row = np.searchsorted(edges, spans[:, 0], side="right") - 1
    whole = spans[:, 1] <= edges[row + 1]
    return spans[whole, 0], row[whole]


def _layout(form: np.ndarray, sizes: np.ndarray, rules: Infill) -> tuple[np.ndarray, np.ndarray]:
    """Where parts and their markers begin in each output; parts are prefix, middle, suffix.

    Rows are parts, columns texts. Plain texts have no markers, and their parts follow
    each other."""
    prefix, middle, suffix = sizes
    p, s, m = (len(marker.encode()) for marker in rules.markers)
    parts = np.stack([np.zeros_like(prefix), prefix, prefix + middle])
    marks = np.zeros_like(parts)
    psm, spm = form == _PSM, form == _SPM
    behind = p + prefix + s
    parts[:, psm] = np.stack([np.full_like(prefix, p), behind + suffix + m, behind])[:, psm]
    marks[:, psm] = np.stack([np.zeros_like(prefix), behind + suffix, p + prefix])[:, psm]
    ahead = s + suffix + p
    parts[:, spm] = np.stack([ahead, ahead + prefix + m, np.full_like(prefix, s)])[:, spm]
    marks[:, spm] = np.stack([s + suffix, ahead + prefix, np.zeros_like(prefix)])[:, spm]
    return parts, marks


def rewritten(texts: pa.Array, drawn: np.ndarray, rules: Infill) -> list[pa.Array]:
    """Columns n, form, prefix_chars, middle_chars and output of the texts."""
    raw, edges = _buffer(texts)
    firsts, n = _character_starts(raw, edges)
    form = np.where(drawn[3] % 100 < rules.spm_below, _SPM, _PSM)
    form[(n == 0) | (drawn[2] % 100 >= rules.plain_from)] = _PLAIN
    form[_marks(raw, edges, rules)[1]] = _PLAIN
    cuts = np.sort(drawn[:2] % (n + 1), axis=0)
    cuts[:, form == _PLAIN] = 0
    places = _byte_places(raw, edges, firsts, cuts)
    bounds = np.stack([edges[:-1], places[0], places[1], edges[1:]])
    parts, marks = _layout(form, np.diff(bounds, axis=0), rules)
    added = sum(len(m.encode()) for m in rules.markers) * (form != _PLAIN)
    outs = np.concatenate([[0], np.cumsum(np.diff(edges) + added)])
    out = np.empty(outs[-1], dtype=np.uint8)
    shift = parts + outs[:-1] - bounds[:3]
    change = np.diff(shift.T.ravel(), prepend=0)
    for start, stop, target in _shifts(len(raw), bounds[:3].T.ravel(), change):
        out[target] = raw[start:stop]
    marked = form != _PLAIN
    for part, marker in zip((0, 2, 1), rules.markers):
        letters = np.frombuffer(marker.encode(), np.uint8)
        begin = (outs[:-1] + marks[part])[marked]
        out[begin[:, None] + np.arange(len(letters))] = letters
    lengths = [
        pa.array(values, pa.int64(), mask=~marked) for values in (cuts[0], cuts[1] - cuts[0])
    ]
    named = pa.array(FORMS).take(pa.array(form))
    return [pa.array(n, pa.int64()), named, *lengths, _texts(out, outs)]


def _character_starts(raw: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Characters before each text in the buffer, and in each text."""
    before = np.zeros(len(edges), dtype=np.int64)
    counted = 0
    for start in range(0, len(raw), WINDOW):
        stop = min(start + WINDOW, len(raw))
        sums = np.cumsum((raw[start:stop] & 0xC0) != 0x80)
        inside = (edges > start) & (edges <= stop)
        before[inside] = counted + sums[edges[inside] - start - 1]
        counted += int(sums[-1])
    return before[:-1], np.diff(before)


def _byte_places(
    raw: np.ndarray, edges: np.ndarray, firsts: np.ndarray, cuts: np.ndarray
) -> np.ndarray:
    """The byte at which each text's character ``cuts`` begins; its end for the last cut."""
    wanted = (firsts + cuts).ravel()
    ends = np.tile(edges[1:], len(cuts))
    order = np.argsort(wanted, kind="stable")
    places = ends.copy()
    counted = 0
    for start in range(0, len(raw), WINDOW):
        at = np.flatnonzero((raw[start : start + WINDOW] & 0xC0) != 0x80)
        first, last = np.searchsorted(wanted, [counted, counted + len(at)], sorter=order)
        own = order[first:last]
        places[own] = start + at[wanted[own] - counted]
        counted += len(at)
    return np.minimum(places, ends).reshape(cuts.shape)


def restored(outputs: pa.Array, form: np.ndarray, rules: Infill) -> pa.Array:
    """The texts of rewritten ``outputs``, gathered part by part."""
    raw, edges = _buffer(outputs)
    at, row = _marks(raw, edges, rules)
    marked = np.flatnonzero(form != _PLAIN)
    at = at[np.isin(row, marked)].reshape(-1, 3)  # each holds its three markers once
    if len(at) != len(marked):
        raise ValueError("an output without its three markers")
    p, s, m = (len(marker.encode()) for marker in rules.markers)
    begins, ends = edges[:-1], edges[1:]
    bounds = np.stack([begins, ends, ends, ends, ends, ends])  # first and end of each part
    first, second, third = at.T
    spm = form[marked] == _SPM
    prefix = np.where(spm, second, first) + p
    suffix = np.where(spm, first, second) + s
    bounds[:, marked] = np.stack(
        [prefix, np.where(spm, third, second), third + m, ends[marked], suffix, np.where(spm, second, third)]
    )
    sizes = bounds[1::2] - bounds[::2]
    outs = np.concatenate([[0], np.cumsum(sizes.sum(axis=0))])
    starts = outs[:-1] + np.stack([np.zeros_like(sizes[0]), sizes[0], sizes[0] + sizes[1]])
    text = np.empty(outs[-1], dtype=np.uint8)
    change = np.diff((bounds[::2] - starts).T.ravel(), prepend=0)
    for start, stop, source in _shifts(len(text), starts.T.ravel(), change):
        text[start:stop] = raw[source]
    valid = ~outputs.is_null().to_numpy(zero_copy_only=False)
    return _texts(text, outs, valid)
