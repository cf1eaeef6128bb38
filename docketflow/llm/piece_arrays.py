"""Ids of whole Arrow columns of texts: pieces are split and told apart in Arrow, and only words not yet
known become Python strings.

A text is cut into pieces that tokenise alone.  Texts whose white space is single spaces and line
breaks are cut by Arrow, others by the slower functions of ``pieces``; both give the same pieces.
"""

from __future__ import annotations

import ctypes
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from docketflow.llm.pieces import led_words, solid_words, texts_of

#: Bytes of text handled together, and of words remembered with their ids.
SLICE_BYTES, TOKEN_BYTES = 2 << 20, 32 << 20
#: Marks a key whose piece has no space before it.
BARE = "\x1f"

# White space, by Python or the libraries, other than a space and a line break.
_RARE = r"\t\r\x{0B}\x{0C}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_ODD_SOLID = f"[{_RARE}]"
_ODD_LED = rf"[{_RARE}]|[ \n][ \n]|^[ \n]|[ \n]$"


#: Characters up to here have one form, and their classes are spelled out in ``letters`` and ``numbers``.
NARROW = "\u024f"


def _of_class(major: str) -> str:
    return "".join(c for c in map(chr, range(ord(NARROW) + 1)) if unicodedata.category(c)[0] == major)


LETTERS, NUMBERS = _of_class("L"), _of_class("N")


#: A plain key: letters, at most with ``LONGEST`` of ``STOPS`` after and, if led, a line break or the mark before.
STOPS, LONGEST = "!#$%&)*+,./:;=?@^`|}~", 8
WORD = f"{BARE}?[{LETTERS}]+"
_STOPPED = rf"[{re.escape(STOPS)}]{{0,{LONGEST}}}$"
_PLAIN_LED = rf"^(\n|{BARE}?)[{LETTERS}]+{_STOPPED}"
# These may be put in lower case: no letter whose lower case ends in a mark, which the stops would join.
_PLAIN_SOLID = f"^[{''.join(c for c in LETTERS if c.lower().isalpha())}]+{_STOPPED}"


class WordTable:
    """Ids of pieces, as arrays; words are remembered with theirs, up to ``keep`` bytes.

    The pre-tokenizers cut letters off what follows, and a byte-level one a line break off the
    letters after it, so a plain key is up to three words: the line break, the letters, the stops.
    A word is a key too; ``compute`` gives the ids of distinct ones, and where each one's end.  With
    ``lower`` the letters of plain keys are one word in either case.
    """

    def __init__(self, compute: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]],
                 keep: int | None = None, lower: bool = False):
        self.compute, self.keep, self.lower = compute, keep, lower
        self.forget()

    def places(self, words: pa.Array) -> np.ndarray:
        """Where the words are in the table; new ones are added."""
        found = pc.index_in(words, value_set=self.words)
        at = found.fill_null(-1).to_numpy().astype(np.int64)
        if found.null_count:
            held = self.words.nbytes + self.ids.nbytes + self.ends.nbytes
            if len(self.words) and held > (self.keep or TOKEN_BYTES):
                self.forget()
                return self.places(words)
            fresh = words.filter(found.is_null()).dictionary_encode()
            at[at < 0] = len(self.words) + fresh.indices.to_numpy().astype(np.int64)
            ids, ends = self.compute(fresh.dictionary)
            self.ends = np.concatenate([self.ends, len(self.ids) + ends])
            self.ids = np.concatenate([self.ids, ids])
            self.words = pa.concat_arrays([self.words, fresh.dictionary])
        return at

    def arrays(self, keys: pa.Array, led: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, starts, lengths): key i has ids[starts[i] : starts[i] + lengths[i]]."""
        plain = pc.match_substring_regex(keys, _PLAIN_LED if led else _PLAIN_SOLID)
        stems = pc.ascii_rtrim(keys, STOPS)
        tail = np.where(plain, pc.subtract(pc.binary_length(keys), pc.binary_length(stems)), 0)
        tailed, tails, which = _tails(keys, tail)
        bare = BARE if led else ""  # alone, a word of no ids
        if led:
            stems = pc.replace_substring(stems, "\n", BARE)
        words = pc.if_else(plain, pc.ascii_lower(stems) if self.lower else stems, keys)
        others = [*(bare + t for t in tails), *(["\n"] if led else []), bare]
        at = self.places(pa.concat_arrays([words, pa.array(others, words.type)]))
        parts = np.full((len(keys), 3), at[-1])
        if led:
            line = pc.and_(plain, pc.starts_with(keys, "\n")).to_numpy(zero_copy_only=False)
            parts[line, 0] = at[-2]
        parts[:, 1] = at[: len(keys)]
        parts[tailed, 2] = at[len(keys) :][which]
        first, size = self.ends[parts], self.ends[parts + 1] - self.ends[parts]
        ids, _ = _gathered(self.ids, first.ravel(), size.ravel())
        length = size.sum(1)
        return ids, np.cumsum(length) - length, length

    def forget(self) -> None:
        self.words = pa.array([], pa.large_string())
        self.ids, self.ends = np.zeros(0, "<u4"), np.zeros(1, np.int64)


def _tails(keys: pa.Array, size: np.ndarray) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Which keys end with ``size`` stops, those endings as distinct keys, and the ending of each."""
    offsets = np.frombuffer(keys.buffers()[1], np.int64, len(keys) + 1, 8 * keys.offset)
    raw = np.frombuffer(keys.buffers()[2] or b"", np.uint8)
    tailed = np.flatnonzero(size)
    packed = np.zeros(len(tailed), np.uint64)  # the last character in the lowest byte
    for j in range(LONGEST):
        have = size[tailed] > j
        packed[have] |= raw[offsets[tailed[have] + 1] - 1 - j].astype(np.uint64) << np.uint64(8 * j)
    values, which = np.unique(packed, return_inverse=True)
    return tailed, [v.to_bytes(8, "big").lstrip(b"\0").decode() for v in values.tolist()], which


def _gathered(data: np.ndarray, starts: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans of ``data`` one after another, and their bounds."""
    ends = np.concatenate([[0], np.cumsum(length)])
    return data[np.repeat(starts - ends[:-1], length) + np.arange(ends[-1])], ends


def give_back() -> None:
    """Return free memory to the system, as Python workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


def led_keys(text: str) -> list[str]:
    """The pieces of ``led_words`` as keys: without the space before them, others marked."""
    return [p if p[0] == "\n" else p[1:] if p[0] == " " and p[1:2] not in ("", BARE, "\n") else BARE + p
            for p in led_words(text)]


def led_piece(key: str) -> str:
    return key[1:] if key[:1] == BARE else key if key[:1] == "\n" else " " + key


def _slices(column: pa.Array, size: int) -> Iterator[pa.Array]:
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset) if len(
        column) else np.zeros(1, np.int64)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        part = column.slice(first, last - first)
        try:
            part.validate(full=True)
        except pa.ArrowInvalid:
            part = pa.array(texts_of(part), pa.large_string())
        yield part
        first = last


def _split(texts: pa.Array, led: bool) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Codes of all pieces, bounds of the texts in them, and the distinct keys."""
    lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n" if led else " "), " ")
    bounds = lists.offsets.to_numpy().astype(np.int64)
    pieces = lists.flatten().dictionary_encode()
    bounds -= bounds[0]
    codes, keys = pieces.indices.to_numpy().astype(np.int64), pieces.dictionary
    if led:  # the first piece of a text has no space before it
        first = bounds[:-1]
        firsts = pa.array([BARE + k for k in keys.take(pa.array(codes[first])).to_pylist()], keys.type)
        codes[first] = len(keys) + np.arange(len(firsts))
        return codes, bounds, pa.concat_arrays([keys, firsts])
    full = (pc.binary_length(keys).to_numpy() > 0)[codes]
    kept = np.concatenate([[0], np.cumsum(full)])
    return codes[full], kept[bounds], keys


def ids_of(column: pa.Array, led: bool, store: WordTable,
           size: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, bounds) of consecutive texts of ``column``: text i has ids[bounds[i] : bounds[i + 1]].

    With ``led`` pieces are words with the white space before them, else words alone.
    """
    for texts in _slices(column, size or SLICE_BYTES):
        odd = pc.match_substring_regex(texts, _ODD_LED if led else _ODD_SOLID).to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(odd), "", texts) if odd.any() else texts
        codes, bounds, keys = _split(plain, led)
        if odd.any():
            split, at = led_keys if led else solid_words, {}
            parts = [codes[lo:hi] for lo, hi in zip(bounds[:-1], bounds[1:], strict=True)]
            for i in np.flatnonzero(odd):
                found = split(texts[int(i)].as_py())
                parts[i] = np.array([at.setdefault(k, len(keys) + len(at)) for k in found], np.int64)
            keys = pa.concat_arrays([keys, pa.array(list(at), keys.type)])
            codes = np.concatenate(parts)
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in parts])])
        data, starts, length = store.arrays(keys, led)
        ids, ends = _gathered(data, starts[codes], length[codes])
        yield ids, ends[bounds]
