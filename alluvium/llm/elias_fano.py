"""Elias-Fano coding of a sorted list of n integers below u: 2 + log2(u / n) bits each, with select.

The low bits of each value stand packed; the high parts stand in unary in a bit vector, the i-th value's bit at
high + i. Every SAMPLE-th one bit's place is kept, so select(i) scans a bounded stretch.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 256
HEAD = struct.Struct("<QQBQQQ")  # n, first value, low bits, bytes of low, bytes of high, samples


def _pack(values: np.ndarray, bits: int) -> bytes:
    if not bits or not len(values):
        return b""
    out = np.zeros((len(values), bits), np.uint8)
    for b in range(bits):
        out[:, b] = (values >> np.uint64(b)) & np.uint64(1)
    return np.packbits(out.reshape(-1), bitorder="little").tobytes()


def _unpack(data: bytes, bits: int, n: int, at: int = 0) -> np.ndarray:
    """n values from the at-th on."""
    if not bits or not n:
        return np.zeros(n, np.uint64)
    lo, hi = at * bits // 8, -(-(at + n) * bits // 8)
    flat = np.unpackbits(np.frombuffer(data, np.uint8, hi - lo, lo), bitorder="little")[at * bits - lo * 8 :][: n * bits].reshape(n, bits)
    out = np.zeros(n, np.uint64)
    for b in range(bits):
        out |= flat[:, b].astype(np.uint64) << np.uint64(b)
    return out


def encode(values: np.ndarray) -> bytes:
    """values: sorted 64-bit integers, repeats allowed."""
    n = len(values)
    first = int(values[0]) if n else 0
    rel = values.astype(np.int64).view(np.uint64) - np.uint64(first % 2**64)
    span = int(rel[-1]) if n else 0
    bits = max(0, (span // n).bit_length() - 1) if n else 0
    high = (rel >> np.uint64(bits)).astype(np.int64) + np.arange(n)
    vector = np.zeros((int(high[-1]) + 1) if n else 0, np.uint8)
    vector[high] = 1
    low, unary = _pack(rel & np.uint64((1 << bits) - 1), bits), np.packbits(vector, bitorder="little").tobytes()
    samples = high[::SAMPLE].astype("<u4" if len(vector) < 2**32 else "<u8")
    return HEAD.pack(n, first % 2**64, bits, len(low), len(unary), len(samples)) + low + unary + bytes([samples.itemsize]) + samples.tobytes()


class EliasFano:
    def __init__(self, data: bytes, at: int = 0):
        self.n, self.first, self.bits, n_low, n_high, n_samples = HEAD.unpack_from(data, at)
        at += HEAD.size
        self.low, self.high = data[at : at + n_low], np.frombuffer(data, np.uint8, n_high, at + n_low)
        at += n_low + n_high
        width = data[at]
        self.samples = np.frombuffer(data, f"<u{width}", n_samples, at + 1)
        self.end = at + 1 + n_samples * width

    def _value(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        return ((high.astype(np.uint64) << np.uint64(self.bits)) + low + np.uint64(self.first)).view(np.int64)

    def select(self, i: int, to: int | None = None) -> np.ndarray | int:
        """The i-th value, or those from the i-th to before the to-th; reads only the stretch between their samples."""
        if to is None:
            if not 0 <= i < self.n:
                raise IndexError(i)
            return int(self.select(i, i + 1)[0])
        to = min(to, self.n)
        if i >= to:
            return np.zeros(0, np.int64)
        s, e = i // SAMPLE, -(-to // SAMPLE)
        start = int(self.samples[s])
        end = int(self.samples[e]) if e < len(self.samples) else len(self.high) * 8
        bits = np.unpackbits(self.high[start // 8 : -(-end // 8)], bitorder="little")
        ones = start // 8 * 8 + np.flatnonzero(bits)
        first = int(np.searchsorted(ones, start)) + i - s * SAMPLE
        places = ones[first : first + to - i]
        return self._value(places - np.arange(i, to), _unpack(self.low, self.bits, to - i, i))
