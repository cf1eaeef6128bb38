"""Packing documents into sequences by length patterns (operator 7).

The histogram of piece lengths (at most ``CAPACITY`` bins, however large the corpus) is all that
the plan needs.  Patterns of two to four lengths that fill a sequence are enumerated; non-negative
least squares fits how often each is used to the histogram; the repeats are rounded down, and
what is left is packed best-fit, longest first, group by group of equal sequences.  The plan is
a list of intervals: pieces number lo to hi - 1 of a length go to consecutive sequences at one
offset.  Pieces are numbered within their length without any task seeing all of them.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docketflow.llm.frames import mapped, settle
from docketflow.llm.piece_arrays import LETTERS, NARROW, NUMBERS, WordTable, give_back, ids_of
from docketflow.llm.token_counts import byte_characters

CAPACITY = 4096
#: Tokens that a pattern may leave empty, and lengths tried for its second and third document.
SLACK, SECOND, THIRD = 4, 160, 24
STEPS = 300


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordTable:
    """The ids of words by a tokenizers file that drops white space.

    The library's model encodes each distinct pre-token once.  Words of wider scripts are cut by the
    library's own pre-tokenizer, and words with special strings go through the whole library.
    """
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    library, chars = Tokenizer.from_file(path), dict(enumerate(byte_characters()))
    model, normal, splitter = library.model, library.normalizer, library.pre_tokenizer
    # The pre-tokenizer's pattern, over lower-case words of characters up to NARROW.
    pattern = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^{LETTERS}{NUMBERS}]+")

    def by_model(text: str) -> list[int]:
        return [t.id for t in model.tokenize(text)]

    def encode(token: str) -> list[int]:
        plain = token.isascii() and token.isalnum()
        return by_model(token if plain else token.encode().decode("latin-1").translate(chars))

    def compute(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        words = column.to_pylist()
        special = iter(library.encode_batch_fast(
            [w for w in words if "<|" in w], add_special_tokens=False))
        parts: dict[str, list[int]] = {}  # the ids of words' parts, which many words share
        ids, ends = array("I"), []
        for word in words:
            low = word.lower()
            if "<|" in word:
                ids.extend(next(special).ids)
            elif not low.isascii() and max(low) > NARROW:
                for token, _ in splitter.pre_tokenize_str(normal.normalize_str(word)):
                    ids.extend(by_model(token))
            elif low.isalpha():
                ids.extend(encode(low))
            else:
                for token in pattern.findall(low):
                    if token not in parts:
                        parts[token] = encode(token)
                    ids.extend(parts[token])
            ends.append(len(ids))
        return np.array(ids, "<u4"), np.array(ends, np.int64)

    return WordTable(compute, lower=True)


def _pieces(ids: np.ndarray, bounds: np.ndarray, end_id: int, capacity: int) -> tuple[np.ndarray, ...]:
    """Ids with the end id after each text, and of every piece: text, number, start, place, length."""
    closed = np.insert(ids, bounds[1:], end_id)
    size = np.diff(bounds) + 1
    first = np.cumsum(size) - size
    count = -(-size // capacity)
    text = np.repeat(np.arange(len(size)), count)
    number = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    start = number * capacity
    return closed, text, number, start, first[text] + start, np.minimum(capacity, size[text] - start)


def _cutter(path: str, end_id: int, capacity: int, keep_ids: bool) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, part = word_encoder(path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        try:
            for batch in batches:
                row = 0
                for ids, bounds in ids_of(batch.column(1), False, store):
                    closed, text, number, start, place, length = _pieces(ids, bounds, end_id, capacity)
                    raw = memoryview(closed.astype("<u4")).cast("B")
                    spans = [raw[4 * lo : 4 * (lo + n)] for lo, n in zip(place, length, strict=True)]
                    # The number of each piece among those of its length in this task.
                    order = np.argsort(length, kind="stable")
                    first = np.searchsorted(length[order], length[order])
                    nth = np.empty(len(length), np.int64)
                    nth[order] = np.arange(len(length)) - first + seen[length[order]]
                    seen += np.bincount(length, minlength=capacity + 1)
                    columns = {
                        "doc_id": batch.column(0).take(pa.array(row + text, pa.int64())),
                        "piece": pa.array(number.astype(np.int32)), "start": pa.array(start),
                        "length": pa.array(length),
                        "ids_crc32": pa.array([zlib.crc32(x) for x in spans], pa.int64()),
                        "part": pa.array(np.full(len(text), part, np.int64)), "nth": pa.array(nth),
                    }
                    if keep_ids:
                        columns["ids"] = pa.array([bytes(x) for x in spans], pa.binary())
                    yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
                    row += len(bounds) - 1
        finally:
            store.forget()
            give_back()

    return run


def cut(docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY,
        keep_ids: bool = False) -> DataFrame:
    """The pieces of all documents, numbered within (task, length)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, "
              "part bigint, nth bigint" + (", ids binary" if keep_ids else ""))
    return mapped(docs.select("doc_id", "text"), _cutter(path, end_id, capacity, keep_ids), schema)


def _spread(values: np.ndarray, weights: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` of the values, at even steps of their weight."""
    if len(values) <= most:
        return values
    total = np.cumsum(weights)
    at = np.searchsorted(total, np.linspace(0, total[-1], most, endpoint=False), "right")
    return values[np.unique(at)]


def patterns(counts: np.ndarray, capacity: int) -> np.ndarray:
    """Rows of up to four lengths (descending, zeros last) that fill a sequence but for SLACK."""
    have = np.flatnonzero(counts[:capacity])
    have = have[have > 0]
    if not len(have):
        return np.zeros((0, 4), np.int64)
    best = np.zeros(capacity + 1, np.int64)  # the largest present length up to each size
    best[have] = have
    best = np.maximum.accumulate(best)
    rows = [np.stack([have, best[capacity - have], 0 * have, 0 * have], 1)]
    second = _spread(have, counts[have] * have, SECOND)
    a, b = np.meshgrid(have, second, indexing="ij")
    a, b = a[a + b < capacity], b[a + b < capacity]
    rows.append(np.stack([a, b, best[capacity - a - b], 0 * a], 1))
    third = _spread(have, counts[have], THIRD)
    a, b, c = np.meshgrid(second, third, third, indexing="ij")
    fits = a + b + c < capacity
    a, b, c = a[fits], b[fits], c[fits]
    rows.append(np.stack([a, b, c, best[capacity - a - b - c]], 1))
    table = -np.sort(-np.concatenate(rows), axis=1)
    table = np.unique(table, axis=0)
    total = table.sum(1)
    return table[(table[:, 1] > 0) & (total <= capacity) & (total >= capacity - SLACK)]


def fitted(table: np.ndarray, counts: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Non-negative repeats x that bring the patterns' use of lengths near the histogram.

    Projected gradient with Nesterov's momentum on |A x - h|^2, started again whenever the step
    points uphill; A is never built, a pattern is its four lengths.
    """
    used = (table > 0).astype(float)
    h = counts.astype(float)

    def apply(x: np.ndarray) -> np.ndarray:
        return np.bincount(table.ravel(), (used * x[:, None]).ravel(), len(counts))

    def back(r: np.ndarray) -> np.ndarray:
        return (r[table] * used).sum(1)

    v = np.ones(len(table))
    for _ in range(12):  # the largest eigenvalue of A'A, for the step
        v = back(apply(v))
        norm = np.linalg.norm(v)
        v /= norm
    step = 1 / (1.1 * norm)
    x = y = np.zeros(len(table))
    t = 1.0
    for _ in range(steps):
        gradient = back(apply(y) - h)
        new = np.maximum(0, y - step * gradient)
        if gradient @ (new - x) > 0:
            t = 1.0
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        x, y, t = new, new + (t - 1) / after * (new - x), after
    return x


class Plan:
    """Intervals (length, lo, hi, sequence, offset) and the number of sequences."""

    def __init__(self, counts: np.ndarray, capacity: int):
        self.capacity, self.sequences = capacity, 0
        self.left = counts.astype(np.int64).copy()
        self.next = np.zeros(len(counts), np.int64)
        self.rows: list[tuple[int, int, int, int, int]] = []
        self.open: dict[int, list[tuple[int, int]]] = {}  # room -> groups (first sequence, how many)
        self.rooms: list[int] = []

    def _place(self, length: int, count: int, sequence: int, offset: int) -> None:
        lo = int(self.next[length])
        self.rows.append((length, lo, lo + count, sequence, offset))
        self.next[length] += count
        self.left[length] -= count

    def _offer(self, room: int, sequence: int, count: int) -> None:
        if room:
            if not self.open.get(room):
                insort(self.rooms, room)
            self.open.setdefault(room, []).append((sequence, count))

    def start(self, lengths: list[int], count: int) -> None:
        """``count`` new sequences that begin with these lengths."""
        offset = 0
        for length in lengths:
            self._place(length, count, self.sequences, offset)
            offset += length
        self._offer(self.capacity - offset, self.sequences, count)
        self.sequences += count

    def use(self, table: np.ndarray, repeats: np.ndarray) -> None:
        """Use patterns as often as fitted, rounded down, and as the pieces allow."""
        for i in np.argsort(-repeats, kind="stable"):
            n = int(repeats[i])
            if not n:
                break
            lengths = [int(x) for x in table[i] if x]
            n = min(n, *(int(self.left[x]) // lengths.count(x) for x in lengths))
            if n:
                self.start(lengths, n)

    def rest(self) -> None:
        """Best fit, longest first; equal sequences are filled as one group."""
        for length in range(self.capacity, 0, -1):
            while self.left[length]:
                at = bisect_left(self.rooms, length)
                if at == len(self.rooms):
                    each = self.capacity // length
                    whole = int(self.left[length]) // each
                    self.start([length] * (each if whole else int(self.left[length])), whole or 1)
                    continue
                room = self.rooms[at]
                sequence, count = self.open[room].pop()
                if not self.open[room]:
                    self.rooms.pop(at)
                n = min(count, int(self.left[length]))
                self._place(length, n, sequence, self.capacity - room)
                self._offer(room - length, sequence, n)
                if n < count:
                    self._offer(room, sequence + n, count - n)


def planned(counts: np.ndarray, capacity: int = CAPACITY) -> Plan:
    plan = Plan(counts, capacity)
    table = patterns(counts, capacity)
    if len(table):
        plan.use(table, np.floor(fitted(table, counts) + 1e-6))
    plan.rest()
    return plan


def _placer(rows: list[tuple[int, int, int, int, int]]) -> Callable:
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.int64(48)
        keys = table[:, 0] << bits | table[:, 1]
        for batch in batches:
            length, number = batch.column("length").to_numpy(), batch.column("number").to_numpy()
            at = np.searchsorted(keys, length << bits | number, "right") - 1
            _, lo, _, sequence, offset = table[at].T
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(x) for x in names), pa.array(sequence + number - lo), pa.array(offset)],
                names=[*names, "sequence_id", "offset"])

    return run


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The sequence and offset of every piece of a written table of ``cut``."""
    here = settle(pieces.groupBy("part", "length").count())
    histogram = here.groupBy("length").agg(F.sum("count").alias("n")).collect()  # a row a length
    counts = np.zeros(capacity + 1, np.int64)
    for row in histogram:
        counts[row.length] = row.n
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = settle(here.select(
        "part", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before")))
    numbered = pieces.join(offsets, ["part", "length"]).withColumn("number", F.col("before") + F.col("nth"))
    kind = pieces.schema["doc_id"].dataType.simpleString()
    return mapped(
        numbered.select("doc_id", "piece", "start", "length", "ids_crc32", "number"),
        _placer(planned(counts, capacity).rows),
        f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, "
        "sequence_id bigint, offset bigint")


def pack(docs: DataFrame, path: str, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for all of ``docs``.

    A document's ids are those of the tokenizers file at ``path`` without added tokens, then
    ``end_id``; null and empty texts are the end id alone.  Longer ones are cut at multiples of
    ``capacity``.  Null and repeated doc_ids are packed like others; other columns are ignored;
    an empty table gives an empty result.
    """
    return place(settle(cut(docs, path, end_id, capacity)), capacity)


def sequences(docs: DataFrame, path: str, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """(sequence_id, ids array<int>): the packed sequences themselves.

    Pieces carry their ids here; a sequence gathers at most ``capacity`` of them.
    """
    pieces = settle(
        cut(docs, path, end_id, capacity, keep_ids=True).withColumn("doc_id", F.struct("doc_id", "ids")))
    rows = place(pieces, capacity).groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", F.col("doc_id.ids").alias("ids")))).alias("held"))

    def joined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.frombuffer(b"".join(x["ids"] for x in row), "<i4")
                   for row in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["sequence_id", "ids"])

    return mapped(rows, joined, "sequence_id bigint, ids array<int>")
