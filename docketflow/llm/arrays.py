"""Vectorised text kernels: whole batches of texts as one byte array.

A batch is cut into slices of about ``SLICE_BYTES`` (one text at least), so memory follows the
slice and the longest text, never the batch.  Words are runs of bytes outside ``[\\x20\\x09-\\x0D]``;
these bytes never occur inside a multi-byte UTF-8 sequence, so bytes and characters agree.
Hashes are 64-bit polynomial prefix hashes, finished by a mixing step: equal strings have equal
hashes everywhere, and different ones collide about once in 2^64 pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_WORD_BASE = np.uint64(0xD6E8FEB86659FD93)


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self, base: np.uint64):
        self.base, self.back = int(base), _inverse(int(base))
        self._up = self._down = np.ones(1, np.uint64)

    def _grown(self, base: int, size: int) -> np.ndarray:
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)

    def upto(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        if size > len(self._up):
            size = max(size, 2 * len(self._up))
            self._up, self._down = self._grown(self.base, size), self._grown(self.back, size)
        return self._up, self._down


BYTE_POWERS, WORD_POWERS = Powers(_BASE), Powers(_WORD_BASE)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finishing step over uint64."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hashes(prefix, down, starts, ends) -> np.ndarray:
    """Hashes of [start, end) spans; the length takes part."""
    h = (prefix[ends] - prefix[starts]) * down[starts]
    return mixed(h + (ends - starts).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def prefix_sums(values: np.ndarray, up: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values.astype(np.uint64) * up[: len(values)], out=out[1:])
    return out


def counts_before(flags: np.ndarray) -> np.ndarray:
    """Running count with a leading zero, to count flags in spans."""
    out = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=out[1:])
    return out


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def byte_batch(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and the texts' offsets; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if len(column) \
        else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets


@dataclass
class Slice:
    """Consecutive texts of a batch: ``first`` is the row of the first one."""

    first: int
    data: np.ndarray
    bounds: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.bounds) - 1

    @cached_property
    def space(self) -> np.ndarray:
        return is_space(self.data)

    @cached_property
    def _words(self) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.data)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        word = ~self.space
        cut = np.zeros(n + 1, bool)  # a text's start ends the word before it
        cut[self.bounds] = True
        begin = word.copy()
        begin[1:] &= ~word[:-1] | cut[1:n]
        end = word.copy()
        end[:-1] &= ~word[1:] | cut[1:n]
        return np.flatnonzero(begin), np.flatnonzero(end) + 1

    @property
    def starts(self) -> np.ndarray:
        return self._words[0]

    @property
    def ends(self) -> np.ndarray:
        return self._words[1]

    @cached_property
    def word_bounds(self) -> np.ndarray:
        """Index of the first word of each text, and the number of words at the end."""
        return np.searchsorted(self.starts, self.bounds)

    @cached_property
    def word_rows(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), np.diff(self.word_bounds))

    @cached_property
    def prefix(self) -> np.ndarray:
        up, _ = BYTE_POWERS.upto(len(self.data) + 1)
        return prefix_sums(self.data, up)

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        _, down = BYTE_POWERS.upto(len(self.data) + 1)
        return span_hashes(self.prefix, down, starts, ends)

    @cached_property
    def word_hashes(self) -> np.ndarray:
        return self.hashes(self.starts, self.ends)

    @cached_property
    def word_prefix(self) -> np.ndarray:
        up, _ = WORD_POWERS.upto(len(self.starts) + 1)
        return prefix_sums(self.word_hashes, up)

    def gram_hashes(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hashes of the word sequences [first, last)."""
        _, down = WORD_POWERS.upto(len(self.starts) + 1)
        return span_hashes(self.word_prefix, down, first, last)

    def windows(self, n: int) -> np.ndarray:
        """First words of all windows of n words that lie inside one text."""
        if len(self.starts) < n:
            return np.zeros(0, np.int64)
        first = np.arange(len(self.starts) - n + 1)
        return first[self.word_rows[first] == self.word_rows[first + n - 1]]

    @cached_property
    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, start, end) of every line; a text of k newlines has k + 1 lines."""
        return self.cut(np.flatnonzero(self.data == 10))

    def cut(self, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, start, end) of the pieces of all texts between the bytes at ``breaks``."""
        starts = np.sort(np.concatenate([self.bounds[:-1], breaks + 1]), kind="stable")
        ends = np.sort(np.concatenate([self.bounds[1:], breaks]), kind="stable")
        texts = np.repeat(
            np.arange(self.rows),
            np.searchsorted(breaks, self.bounds[1:]) - np.searchsorted(breaks, self.bounds[:-1]) + 1,
        )
        return texts, starts, ends


def slices(column, fold_case: bool = False, size: int = SLICE_BYTES) -> Iterator[Slice]:
    """The texts of a column, in slices; with ``fold_case`` A-Z become a-z."""
    data, offsets = byte_batch(column)
    rows, first = len(offsets) - 1, 0
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        part = data[offsets[first] : offsets[last]]
        if fold_case:
            part = np.where((part >= 65) & (part <= 90), part + np.uint8(32), part)
        yield Slice(first, part, offsets[first : last + 1] - offsets[first])
        first = last


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(value occurs more than once, is not its first occurrence), per element."""
    more, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    if len(keys) < 2:
        return more, later
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    later[order[1:][same]] = True
    more[order[1:][same]] = True
    more[order[:-1][same]] = True
    return more, later


def per_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values between consecutive bounds."""
    total = counts_before(values)
    return total[bounds[1:]] - total[bounds[:-1]]
