"""Elias-Fano coding of ascending integers, with a select structure.

The low bits of every value are stored side by side; the high bits are a bit
vector in which value i sets bit ``(value >> low_bits) + i``. The i-th set bit
gives a value back. Every 256th set bit's place is kept, so a lookup scans a few
words instead of the vector.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 256
_HEADER = "<QQBQQQ"


class EliasFano:
    """Ascending (repeats allowed) unsigned integers below a limit."""

    def __init__(self, n: int, limit: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples):
        self.n, self.limit, self.low_bits = n, limit, low_bits
        self.low, self.high, self.samples = low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        limit = int(values[-1]) + 1 if n else 1
        low_bits = max(0, (limit // max(n, 1)).bit_length() - 1)
        shifts = np.arange(low_bits, dtype=np.uint64)
        bits = ((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
        low = np.packbits(bits.reshape(-1), bitorder="little")
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        vector = np.zeros((int(ones[-1]) // 64 + 1 if n else 0) * 64, dtype=np.uint8)
        vector[ones] = 1
        high = np.packbits(vector, bitorder="little").view(np.uint64)
        return cls(n, limit, low_bits, low, high, ones[::SAMPLE].astype(np.uint64))

    def to_bytes(self) -> bytes:
        head = struct.pack(
            _HEADER, self.n, self.limit, self.low_bits, len(self.low), len(self.high), len(self.samples)
        )
        return head + self.low.tobytes() + self.high.tobytes() + self.samples.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        n, limit, low_bits, n_low, n_high, n_samples = struct.unpack_from(_HEADER, data)
        at = struct.calcsize(_HEADER)
        low = np.frombuffer(data, np.uint8, n_low, at)
        high = np.frombuffer(data, np.uint64, n_high, at + n_low)
        samples = np.frombuffer(data, np.uint64, n_samples, at + n_low + 8 * n_high)
        return cls(n, limit, low_bits, low, high, samples)

    def select(self, i: int) -> int:
        """Value ``i``, from one sample, the words after it, and its low bits."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        place = int(self.samples[i // SAMPLE])
        left = i % SAMPLE
        word = place // 64
        bits = int(self.high[word]) >> (place % 64) << (place % 64)
        while left >= bits.bit_count():
            left -= bits.bit_count()
            word += 1
            bits = int(self.high[word])
        for _ in range(left):
            bits &= bits - 1
        one = word * 64 + (bits & -bits).bit_length() - 1
        return ((one - i) << self.low_bits) | self._low(i)

    def _low(self, i: int) -> int:
        start = i * self.low_bits
        stop = start + self.low_bits
        raw = int.from_bytes(self.low[start // 8 : -(-stop // 8)].tobytes(), "little")
        return (raw >> (start % 8)) & ((1 << self.low_bits) - 1)

    def between(self, start: int, stop: int) -> np.ndarray:
        """Values ``start`` to ``stop - 1``, from the words of the bit vector that hold them."""
        start, stop = max(start, 0), min(stop, self.n)
        if start >= stop:
            return np.zeros(0, dtype=np.uint64)
        sample, after = start // SAMPLE, -(-stop // SAMPLE)
        place = int(self.samples[sample])
        first = place // 64
        last = int(self.samples[after]) // 64 + 1 if after < len(self.samples) else len(self.high)
        bits = np.unpackbits(self.high[first:last].view(np.uint8), bitorder="little")
        ones = np.flatnonzero(bits[place - 64 * first :]) + place
        skipped = sample * SAMPLE
        ones = ones[start - skipped : stop - skipped]
        values = (ones - np.arange(start, stop)).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            head = start * self.low_bits
            count = (stop - start) * self.low_bits
            raw = self.low[head // 8 : -(-(head + count) // 8)]
            low = np.unpackbits(raw, bitorder="little")[head % 8 : head % 8 + count]
            low = low.reshape(-1, self.low_bits).astype(np.uint64)
            values += (low << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        return values

    def decode(self) -> np.ndarray:
        """All values."""
        return self.between(0, self.n)
