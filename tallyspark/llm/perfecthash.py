"""Minimal perfect hashing of 64-bit keys, in levels of bit arrays.

A level gives each key still without a place one bit of its array; keys that are alone on their bit
are placed there, the others go on to the next, smaller level. A key's number is how many bits are
set before its own, so n keys get 0 to n - 1. A level takes some two bits for each key it is given.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from tallyspark.llm.batches import mix

SLACK = 2


def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return mix(keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) % np.uint64(size)


@dataclass
class PerfectHash:
    sizes: list[int]
    bits: list[np.ndarray]
    before: list[np.ndarray]

    @classmethod
    def build(cls, keys: np.ndarray) -> "PerfectHash":
        """For distinct keys."""
        left, sizes, bits = keys.astype(np.uint64), [], []
        while len(left):
            size = -(-max(64, SLACK * len(left)) // 64) * 64
            at = _places(left, len(sizes), size)
            alone = np.bincount(at.astype(np.int64), minlength=size) == 1
            sizes.append(size)
            bits.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = left[~alone[at.astype(np.int64)]]
        return cls._ranked(sizes, bits)

    @classmethod
    def _ranked(cls, sizes, bits):
        before, done = [], 0
        for words in bits:
            counts = np.bitwise_count(words).astype(np.int64)
            before.append(done + np.cumsum(counts) - counts)
            done += int(counts.sum())
        return cls(sizes, bits, before)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """Each key's number. A key that was not built in gets any number, or -1."""
        out = np.full(len(keys), -1, dtype=np.int64)
        todo = np.arange(len(keys))
        keys = keys.astype(np.uint64)
        for level, (size, words, before) in enumerate(zip(self.sizes, self.bits, self.before)):
            if not len(todo):
                break
            at = _places(keys[todo], level, size)
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            value = words[word]
            found = (value >> bit & np.uint64(1)).astype(bool)
            below = value & ((np.uint64(1) << bit) - np.uint64(1))
            out[todo[found]] = (before[word] + np.bitwise_count(below))[found]
            todo = todo[~found]
        return out

    def to_bytes(self) -> bytes:
        head = np.asarray([len(self.sizes), *self.sizes], dtype="<u8").tobytes()
        return head + b"".join(w.tobytes() for w in self.bits)

    @classmethod
    def from_bytes(cls, data: bytes) -> "PerfectHash":
        count = int(np.frombuffer(data, "<u8", 1)[0])
        sizes = np.frombuffer(data, "<u8", count, 8).astype(int).tolist()
        bits, at = [], 8 * (count + 1)
        for size in sizes:
            bits.append(np.frombuffer(data, "<u8", size // 64, at))
            at += size // 8
        return cls._ranked(sizes, bits)
