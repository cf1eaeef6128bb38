"""Texts as pieces that tokenise alone, and a bounded cache of what is known about pieces.

White space is ``WHITE``, Unicode's property, as the tokenizer libraries have it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa

# The characters of Unicode's White_Space property.
WHITE = "\t-\r \x85\xa0  -     　"
_RUNS = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
_SOLID = re.compile(f"[^{WHITE}]+")
_CONTROL = "\x1c\x1d\x1e\x1f"  # str.split() takes these for white space, the libraries don't

#: Texts handled together, in characters; entries of each of a cache's two generations.
TOGETHER = 1 << 20
GENERATION = 350_000


def texts_of(column: pa.Array) -> list[str]:
    """The texts of a column; nulls are empty, bytes that are no UTF-8 become U+FFFD."""
    try:
        return [x or "" for x in column.to_pylist()]
    except UnicodeDecodeError:
        raw = column.cast(pa.binary()).to_pylist()
        return [(x or b"").decode("utf-8", "replace") for x in raw]


def solid_words(text: str) -> list[str]:
    """Runs without white space."""
    return _SOLID.findall(text) if any(c in text for c in _CONTROL) else text.split()


def led_words(text: str) -> list[str]:
    """Pieces of a white-space run and the word after it; a last run of white space stands alone.

    A byte-level pre-tokenizer never joins a word with white space after it, so the pieces'
    pre-tokens are the text's.  Texts of words with single separators take the quick way.
    """
    if not text:
        return []
    if text.split() == text.replace("\n", " ").split(" "):
        words = text.replace("\n", " \n").split(" ")
        return [words[0], *[x if x[0] == "\n" else " " + x for x in words[1:]]]
    return _RUNS.findall(text)


def parts(batches: Iterable[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in parts of fewer rows, where several copies of a batch would be too much."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


class PieceCache:
    """Values of pieces, computed in bulk and kept in two generations of bounded size."""

    def __init__(self, compute: Callable[[list[str]], list[Any]], size: int = GENERATION):
        self.compute, self.size = compute, size
        self.young: dict[str, Any] = {}
        self.old: dict[str, Any] = {}

    def values(self, pieces: list[str]) -> list[Any]:
        found = list(map(self.young.get, pieces))
        if None not in found:
            return found
        fresh: dict[str, Any] = {}
        unknown: list[str] = []
        for piece in {p for p, v in zip(pieces, found, strict=True) if v is None}:
            value = self.old.get(piece)
            if value is None:
                unknown.append(piece)
            else:
                fresh[piece] = value
        fresh.update(zip(unknown, self.compute(unknown), strict=True))
        found = [fresh[p] if v is None else v for p, v in zip(pieces, found, strict=True)]
        if len(self.young) + len(fresh) > self.size:
            self.old, self.young = self.young, {}
        self.young.update(fresh)
        return found


def together(texts: list[str], split: Callable[[str], list[str]],
             cache: PieceCache) -> Iterator[tuple[list[Any], np.ndarray]]:
    """Values of the pieces of several texts at a time, and the texts' bounds in them."""
    pieces: list[str] = []
    bounds, held = [0], 0
    for text in texts:
        pieces += split(text)
        bounds.append(len(pieces))
        held += len(text)
        if held > TOGETHER:
            yield cache.values(pieces), np.array(bounds)
            pieces, bounds, held = [], [0], 0
    if len(bounds) > 1:
        yield cache.values(pieces), np.array(bounds)


def id_bytes(texts: list[str], split: Callable[[str], list[str]],
             cache: PieceCache) -> Iterator[bytes]:
    """For every text its ids, as little-endian unsigned 32-bit integers."""
    for values, bounds in together(texts, split, cache):
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            yield b"".join(values[lo:hi])


def library_ids(tokenizer, pieces: list[str], mark: str, mark_id: int,
                alone: Callable[[str], bool], group: int = 64) -> list[bytes]:
    """Ids of pieces by the tokenizers library, many in one call: ``mark`` stands between them.

    ``mark`` must be a token of its own wherever it stands; pieces for which ``alone`` holds
    are encoded by themselves.
    """
    out: dict[str, bytes] = {}
    single = [p for p in pieces if alone(p)]
    joined = [p for p in pieces if not alone(p)]
    groups = [joined[i : i + group] for i in range(0, len(joined), group)]
    for names, found in zip(groups, tokenizer.encode_batch_fast(
            [mark.join(g) for g in groups], add_special_tokens=False), strict=True):
        ids = np.array(found.ids, "<u4")
        cuts = np.flatnonzero(ids == mark_id)
        if len(cuts) != len(names) - 1:
            single += names
            continue
        raw, lo = ids.tobytes(), 0
        for name, cut in zip(names, [*cuts.tolist(), len(ids)], strict=True):
            out[name] = raw[4 * lo : 4 * cut]
            lo = cut + 1
    for name, found in zip(single, tokenizer.encode_batch_fast(
            single, add_special_tokens=False), strict=True):
        out[name] = np.array(found.ids, "<u4").tobytes()
    return [out[p] for p in pieces]


def id_lists(rows: Iterable[bytes]) -> pa.ListArray:
    """Rows of little-endian ids as an Arrow list column."""
    rows = list(rows)
    bounds = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(x) // 4 for x in rows], out=bounds[1:])
    values = np.frombuffer(b"".join(rows), "<i4")
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(values))
