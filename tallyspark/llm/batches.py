"""Text columns as flat byte arrays, for the operators whose tasks work on Arrow batches.

A word is a run of bytes other than blank and the control characters 9 to 13. Nulls count as empty.
Hashes are 64-bit and depend on the bytes alone, so that every task and every run agrees on them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_SEED = np.uint64(0x9E3779B97F4A7C15)
_FIRST = np.uint64(0xD6E8FEB86659FD93)
_SECOND = np.uint64(0xA0761D6478BD642F)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _next(state: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The state after one more 64-bit word."""
    state = (state ^ word) * _FIRST
    state ^= state >> np.uint64(32)
    state *= _SECOND
    state ^= state >> np.uint64(29)
    return state


#: Spans beyond this many bytes are hashed one by one.
_LONG = 512
_TAILS = np.array([0] + [(1 << 8 * n) - 1 for n in range(1, 8)], dtype=np.uint64)


def slices(batch: pa.RecordBatch, column: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with at most ``limit`` bytes of text, or a single longer row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in sequence, and where each text starts (with the end at the last)."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    column = pa.concat_arrays([column])
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or at[-1] == at[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0]:at[-1]], at - at[0]


def word_spans(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word in ``data`` and the text it belongs to. No word spans two texts."""
    inside = ~_SPACE[data]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    heads = at[:-1][at[:-1] < len(data)]
    before[heads] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(inside), dtype=bool)
    after[:-1] = inside[1:]
    tails = at[1:][(at[1:] > 0)] - 1
    after[tails] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(at, starts, side="right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each span of bytes, from its length and its 64-bit words one after the other.

    Spans without regular structure in common and spans of repeated patterns are told apart alike:
    every step mixes the state with the word, so no sum over places can cancel.
    """
    sizes = ends - starts
    out = mix(sizes.astype(np.uint64) * _SEED + _FIRST)
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    words = np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))
    todo = np.flatnonzero((sizes > 0) & (sizes <= _LONG))
    at, left, state = starts[todo], sizes[todo], out[todo]
    while len(todo):
        word = words[at]
        short = left < 8
        word[short] &= _TAILS[left[short]]
        state = _next(state, word)
        done = left <= 8
        out[todo[done]] = state[done]
        more = ~done
        todo, at, left, state = todo[more], at[more] + 8, left[more] - 8, state[more]
    for i in np.flatnonzero(sizes > _LONG).tolist():
        part = np.ascontiguousarray(data[starts[i]:ends[i]])
        out[i] = int.from_bytes(hashlib.blake2b(part, digest_size=8).digest(), "little")
    return out


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each ``size`` consecutive values, one for each start that has that many."""
    count = len(words) - size + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(count, _SEED, dtype=np.uint64)
    for i in range(size):
        out = _next(out, words[i:i + count].astype(np.uint64))
    return out


def code_points(data: np.ndarray) -> np.ndarray:
    """True at the first byte of each code point."""
    return (data & 0xC0) != 0x80


def visible(data: np.ndarray) -> np.ndarray:
    """True at each byte of a word."""
    return ~_SPACE[data]


def per_text(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many flags are set within each text."""
    marks = np.flatnonzero(flags)
    return np.searchsorted(marks, at[1:]) - np.searchsorted(marks, at[:-1])


class ChainedWords(dict):
    """Words of one slice of texts in front of a table that is full and stays as it is."""

    def __init__(self, behind: dict):
        super().__init__()
        self.behind = behind

    def __missing__(self, word):
        return self.behind[word]
