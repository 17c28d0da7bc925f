"""Non-decreasing integers in near-minimal space, with access by position.

A sequence of ``n`` values below ``u`` takes ``log2(u / n) + 2`` bits a value: the low bits
of each value stand side by side, and the high bits are written in unary, value ``i`` as a
one at bit ``(value >> low_bits) + i``. A sample of every 64th one makes ``select``, and so
the access to a single value, a search in a bounded neighbourhood instead of a table of
64-bit offsets.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

SAMPLE = 64
HEADER = struct.Struct("<QQBxxxxxxx")  # values, largest value, low bits


def _pack_low(values: np.ndarray, bits: int) -> bytes:
    if not bits:
        return b""
    table = (values[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(table.astype(np.uint8).ravel(), bitorder="little").tobytes()


def encode(values: np.ndarray) -> bytes:
    values = np.asarray(values, dtype=np.uint64)
    n, last = len(values), int(values[-1]) if len(values) else 0
    bits = max(0, ((last + 1) // n).bit_length() - 1) if n else 0
    high = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
    unary = np.zeros(int(high[-1]) + 1 if n else 0, np.uint8)
    unary[high] = 1
    low = b"".join(_pack_low(values[i : i + 65536], bits) for i in range(0, n, 65536))
    samples = high[::SAMPLE].astype("<u4" if len(unary) < 1 << 32 else "<u8")
    parts = [low, np.packbits(unary, bitorder="little").tobytes(), samples.tobytes()]
    return HEADER.pack(n, last, bits) + b"".join(struct.pack("<Q", len(p)) + p for p in parts)


@dataclass
class EliasFano:
    n: int
    bits: int
    low: np.ndarray
    high: np.ndarray
    samples: np.ndarray

    @classmethod
    def decode(cls, data: bytes) -> EliasFano:
        n, _, bits = HEADER.unpack_from(data)
        at, parts = HEADER.size, []
        for _ in range(3):
            (size,) = struct.unpack_from("<Q", data, at)
            parts.append(data[at + 8 : at + 8 + size])
            at += 8 + size
        count = -(-n // SAMPLE)
        wide = "<u8" if count and len(parts[2]) == 8 * count else "<u4"
        return cls(n, bits, *(np.frombuffer(p, np.uint8) for p in parts[:2]), np.frombuffer(parts[2], wide))

    def select(self, i: int) -> int:
        """Position of one number ``i`` among the high bits: from the sampled one before it,
        through as many bytes as needed."""
        at = int(self.samples[i // SAMPLE])
        left, byte = i % SAMPLE, at // 8
        skip, width = at % 8, 64
        while True:
            ones = np.flatnonzero(np.unpackbits(self.high[byte : byte + width], bitorder="little")[skip:])
            if len(ones) > left:
                return 8 * byte + skip + int(ones[left])
            left -= len(ones)
            byte, skip, width = byte + width, 0, 2 * width

    def low_of(self, first: int, count: int) -> np.ndarray:
        if not self.bits:
            return np.zeros(count, np.int64)
        start = first * self.bits
        own = np.unpackbits(self.low[start // 8 : (start + count * self.bits + 7) // 8], bitorder="little")
        table = own[start % 8 : start % 8 + count * self.bits].reshape(count, self.bits).astype(np.int64)
        return table @ (np.int64(1) << np.arange(self.bits, dtype=np.int64))

    def __getitem__(self, i: int) -> int:
        return (self.select(i) - i << self.bits) | int(self.low_of(i, 1)[0])

    def block(self, first: int, count: int) -> np.ndarray:
        """``count`` values from number ``first`` on."""
        if not count:
            return np.zeros(0, np.int64)
        start, stop = self.select(first), self.select(first + count - 1)
        ones = np.unpackbits(self.high[start // 8 : stop // 8 + 1], bitorder="little")
        high = np.flatnonzero(ones)
        high = high[high + start // 8 * 8 >= start][:count] + start // 8 * 8
        return ((high - np.arange(first, first + count)) << self.bits) | self.low_of(first, count)
