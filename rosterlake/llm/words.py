"""Words of many texts at a time, and hashes over them, in numpy.

A batch is held as one byte buffer in which every text is followed by a space, so no word crosses a text. Hashes are
polynomials modulo 2^64 over table values, taken from prefix sums; a pass costs some 30 bytes of memory per byte of
text, and batches are cut so that a pass sees a few MB, or one text where that is longer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text in one pass.
PASS_BYTES = 2 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``x`` (the finalizer of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def mixed_range(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


class _Powers:
    """Powers of an odd number and of its inverse modulo 2^64, as far as they were asked for."""

    def __init__(self, base: int):
        self.base = (base, pow(base, -1, 1 << 64))
        self.values = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.values[0]) < n:
            for k, base in enumerate(self.base):
                steps = np.full(max(n, PASS_BYTES + 1), base, np.uint64)
                steps[0] = 1
                self.values[k] = np.multiply.accumulate(steps)
        return self.values[0][:n], self.values[1][:n]


_BYTE = _Powers(0x9E3779B97F4A7C15)
_WORD = _Powers(0xD6E8FEB86659FD93)
_BYTE_VALUES = mixed_range(256, 11)

_ALL = np.arange(256)
#: Bytes of words: all but blanks (space, tab to carriage return).
NOT_BLANK = ~np.isin(_ALL, [0x20, *range(0x09, 0x0E)])
#: Bytes of words: digits, small letters and everything beyond ASCII.
LETTERS = ((_ALL >= 0x30) & (_ALL <= 0x39)) | ((_ALL >= 0x61) & (_ALL <= 0x7A)) | (_ALL >= 0x80)
#: Bytes with A-Z made a-z.
LOWER = np.where((_ALL >= 0x41) & (_ALL <= 0x5A), _ALL + 32, _ALL).astype(np.uint8)


class Prefix:
    """Hashes of any stretch of a sequence of values, from one pass of prefix sums."""

    def __init__(self, values: np.ndarray, powers: _Powers):
        up, self.down = powers.upto(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


class Texts:
    """Texts of one pass: ``data`` bytes, ``bounds`` of the texts in it, ``start`` and ``end`` of the words, ``first``
    word of each text (one more entry at the end), ``doc`` of each word."""

    def __init__(self, texts: pa.Array, letters: np.ndarray = NOT_BLANK, lower: bool = False):
        self.data, self.bounds = text_bytes(texts)
        n = len(self)
        if lower:
            self.data = LOWER[self.data]
        inside = letters[self.data]
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if len(inside) and inside[0]:
            edges = np.concatenate([[0], edges])
        self.start, self.end = edges[0::2], edges[1::2]
        self.first = np.searchsorted(self.start, self.bounds)
        self.doc = np.repeat(np.arange(n), np.diff(self.first))

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        return Prefix(_BYTE_VALUES[self.data], _BYTE)(self.start, self.end)

    def within(self, n: int) -> np.ndarray:
        """Of each word that at least ``n - 1`` words follow in the batch: whether its text holds them."""
        return self.doc[: max(0, len(self.doc) - n + 1)] == self.doc[n - 1 :]

    def per_text(self, of_words: np.ndarray) -> np.ndarray:
        """Sums by text of a number per word."""
        sums = np.concatenate([[0], np.cumsum(of_words, dtype=np.int64)])
        return sums[self.first[1:]] - sums[self.first[:-1]]

    def bytes_per_text(self, marked: np.ndarray) -> np.ndarray:
        """Marked bytes by text."""
        sums = np.concatenate([[0], np.cumsum(marked, dtype=np.int64)])
        return sums[self.bounds[1:]] - sums[self.bounds[:-1]]

    def joined(self, keep: np.ndarray) -> pa.Array:
        """Per text its words that are kept, unchanged, with one space between."""
        kept = np.flatnonzero(keep)
        last = kept[np.flatnonzero(np.diff(self.doc[kept], append=-1))] if len(kept) else kept
        edges = np.zeros(2 * len(self.start) + 1, np.int64)
        edges[0:-1:2], edges[1:-1:2], edges[-1] = self.start, self.end + 1, len(self.data)
        flags = np.zeros(2 * len(self.start) + 1, bool)
        flags[1::2] = keep
        mask = np.repeat(flags, np.diff(edges, prepend=0))
        mask[self.end[last]] = False
        data = np.where(NOT_BLANK[self.data], self.data, np.uint8(0x20))[mask]
        sizes = self.per_text(np.where(keep, self.end - self.start + 1, 0))
        sizes -= sizes > 0
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        return pa.LargeStringArray.from_buffers(len(self), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data.tobytes()))


def sequence(word_hashes: np.ndarray) -> Prefix:
    """Hashes of stretches of words."""
    return Prefix(mix(word_hashes + np.uint64(0x632BE59BD9B4E019)), _WORD)


def grams(prefix: Prefix, n_words: int, n: int) -> np.ndarray:
    """The hash of the ``n`` words from each word that has so many after it in the batch."""
    at = np.arange(max(0, n_words - n + 1))
    return prefix(at, at + n)


def rightmost_minimum(values: np.ndarray, n: int) -> np.ndarray:
    """For each stretch of ``n`` values the place of its smallest, the last such one. Winnowing picks these."""
    best, at, width = values, np.arange(len(values)), 1

    def merged(left, right):
        take = best[right] <= best[left]
        return np.where(take, best[right], best[left]), np.where(take, at[right], at[left])

    while width < n and len(best) > 0:
        step = min(width, n - width)
        m = max(0, len(best) - step)
        best, at = merged(slice(0, m), slice(step, step + m))
        width += step
    return at


def slid_minimum(values: np.ndarray, n: int) -> np.ndarray:
    """The smallest of each stretch of ``n`` values."""
    width = 1
    while width < n and len(values):
        step = min(width, n - width)
        values = np.minimum(values[: max(0, len(values) - step)], values[step:])
        width += step
    return values


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes, each text followed by a space, and where each begins (one more entry at the end)."""
    space, nothing = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
    joined = pc.binary_join_element_wise(pc.fill_null(texts.cast(pa.large_string()), ""), nothing, space)
    n = len(joined)
    bounds = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset : joined.offset + n + 1]
    low = int(bounds[0])
    bounds = bounds - low
    return (np.frombuffer(joined.buffers()[2], np.uint8)[low : low + int(bounds[-1])] if n else np.zeros(0, np.uint8)), bounds


def passes(batch: pa.RecordBatch, column: str = "text", size: int = PASS_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of ``size`` bytes of text or one row."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    ends, done = np.cumsum(lengths), 0
    while done < batch.num_rows:
        used = ends[done - 1] if done else 0
        upto = max(done + 1, int(np.searchsorted(ends, used + size, side="right")))
        yield batch.slice(done, upto - done)
        done = upto
