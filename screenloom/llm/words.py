"""Words of whole columns of texts as numpy arrays.

A word is a run of bytes other than the six ASCII white-space characters.  All
functions take an Arrow string array and work on its bytes at once, so that no
Python loop runs per word; hashes are the same on every machine.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text hashed at once; bounds the 8-byte-per-byte work arrays.
SLICE_BYTES = 1 << 21

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def stream(seed: int, n: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(seed))


BYTE_CODES = [stream(11, 256), stream(12, 256)]
BASES = [int(stream(21 + i, 1)[0]) | 1 for i in range(2)]
STEPS = [int(stream(31 + i, 1)[0]) | 1 for i in range(2)]


@dataclass
class Words:
    """row: of each word; start, end: its bytes in data; first[i]..first[i+1]: the words of row i."""

    data: np.ndarray
    offsets: np.ndarray
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def raw(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and the offsets of its rows; null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], texts.type)
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    at = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32, len(texts) + 1 + texts.offset)[texts.offset :].astype(np.int64)
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8)[at[0] : at[-1]] if body is not None and at[-1] > at[0] else np.empty(0, np.uint8)
    return data, at - at[0]


def split(texts: pa.Array | pa.ChunkedArray, lower: bool = False) -> Words:
    """The words of every text; lower: A-Z as a-z."""
    data, at = raw(texts)
    if lower:
        data = LOWER[data]
    n = len(data)
    inside = ~SPACE[data]
    begins, ends = inside.copy(), inside.copy()
    if n:
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        edge = at[(at > 0) & (at < n)]
        begins[edge] |= inside[edge]
        ends[edge - 1] |= inside[edge - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, at)
    row = np.repeat(np.arange(len(at) - 1), np.diff(first))
    return Words(data, at, row, start, end, first)


def word_hashes(words: Words, which: int = 0) -> np.ndarray:
    """A 64-bit hash of each word; which: 0 or 1, two independent functions."""
    out = np.empty(len(words), U)
    if not len(words):
        return out
    codes, base = BYTE_CODES[which].copy(), BASES[which]
    codes[SPACE] = 0
    marks = np.searchsorted(words.start, np.arange(0, words.end[-1] + SLICE_BYTES, SLICE_BYTES))
    with np.errstate(over="ignore"):
        for a, b in zip(marks[:-1], marks[1:], strict=True):
            if a == b:
                continue
            lo, hi = words.start[a], words.start[b] if b < len(words) else words.end[-1]
            begin = words.start[a:b] - lo
            reach = np.diff(np.append(begin, hi - lo))
            place = np.arange(hi - lo) - np.repeat(begin, reach)
            powers = np.cumprod(np.full(int(place.max()) + 1, base, U))
            out[a:b] = np.add.reduceat(codes[words.data[lo:hi]] * powers[place], begin)
        return mix(out ^ ((words.end - words.start).astype(U) * U(0xD6E8FEB86659FD93)))


def windows(words: Words, hashes: np.ndarray, size: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word and the hash of each window of `size` words inside one row."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, U)
    at = np.flatnonzero(words.row[:n] == words.row[size - 1 :])
    step, acc = U(STEPS[which]), np.full(n, size, U)
    with np.errstate(over="ignore"):
        for i in range(size):
            acc *= step
            acc += hashes[i : i + n]
    return at, mix(acc[at])


def sequences(words: Words, hashes: np.ndarray, rows: np.ndarray, which: int = 0) -> np.ndarray:
    """The hash of the whole word sequence of each of these rows, equal to windows() of that size."""
    out = np.empty(len(rows), U)
    step = U(STEPS[which])
    with np.errstate(over="ignore"):
        for i, r in enumerate(rows):
            a, b = words.first[r], words.first[r + 1]
            acc = np.full(1, b - a, U)
            for h in hashes[a:b]:
                acc = acc * step + h
            out[i] = mix(acc)[0]
    return out


def text_bytes(words: Words, row: int) -> bytes:
    """The text of a row."""
    return words.data[words.offsets[row] : words.offsets[row + 1]].tobytes()
