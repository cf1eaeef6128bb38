"""Line deduplication by shared blocks (operator 10).

A text is cut into pieces in two ways: after sentences (words that end with ``.``, ``!`` or ``?``),
whatever stands between the words, and after sentences and at newlines.  Keys are hashes of word
sequences, so equal words have equal keys in every layout.  These are indexed, by (hash,
occurrence in its document), so that a key stands once in a document:

* blocks: the shortest runs of pieces, from each piece on and back from each, that hold
  ``BLOCK_WORDS`` words and two pieces, or ``PASSAGE_WORDS`` words.  Any longer run that two
  documents share is covered by the blocks inside it, however short its pieces are and whichever
  document had each of them first;
* single pieces of ``LINE_WORDS`` words or more.

Every key is looked up in the first document that has it: a key that thousands share still costs
one row per holder, so none is too frequent to be used.  A block that an earlier document has
is deleted, in whatever order blocks stand there.  The single pieces that a document shares with
one earlier document are aligned by patience: all are unique in both, and of the longest run
of them that stands in the same order in both, pieces of ``BLOCK_WORDS`` words or more are deleted.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketflow.llm.arrays import Slice, counts_before, mixed, per_row, slices
from docketflow.llm.frames import mapped, settle

LINE_WORDS, BLOCK_WORDS = 5, 8
#: A single piece of so many words is a block by itself.
PASSAGE_WORDS = 50
_LAST = (1 << 63) - 1


class Pieces:
    """The words of the texts of a slice, and after which of them pieces end."""

    def __init__(self, part: Slice):
        self.part = part
        self.rows, first = part.word_rows, part.word_bounds
        last = np.zeros(len(part.starts), bool)
        last[first[1:][np.diff(first) > 0] - 1] = True
        newlines = counts_before(part.data == 10)
        broken = last.copy()
        broken[:-1] |= newlines[part.starts[1:]] > newlines[part.ends[:-1]]
        stop = np.isin(part.data[part.ends - 1], np.frombuffer(b".!?", np.uint8))
        self.sentence_ends, self.ends = stop | last, stop | broken

    def _runs(self, ends: np.ndarray, rows: np.ndarray, least: int, block: int) -> list[np.ndarray]:
        """Codes of the blocks (twice (first, last word)) and of the single pieces (and one) between
        ``ends`` in some of the texts."""
        to = np.flatnonzero(ends) + 1
        start = np.concatenate([[0], to])[:-1].astype(np.int64)
        row = self.rows[start]
        start, to, row = start[rows[row]], to[rows[row]], row[rows[row]]
        at = np.arange(len(to))
        on = np.maximum(np.searchsorted(to, start + block), at + 1)
        on = np.minimum(on, np.searchsorted(to, start + PASSAGE_WORDS))
        back = np.minimum(np.searchsorted(start, to - block, "right") - 1, at - 1)
        back = np.maximum(back, np.searchsorted(start, to - PASSAGE_WORDS, "right") - 1)
        low = np.concatenate([at, np.maximum(back, 0)])
        high = np.concatenate([np.minimum(on, len(to) - 1), at])
        inside = np.concatenate([on < len(to), back >= 0]) & (row[low] == row[high])
        scale = 2 * len(ends) + 2
        low, high = low[inside], high[inside]
        alone = to - start >= least
        return [start[low] * scale + 2 * to[high], (start * scale + 2 * to + 1)[alone]]

    def units(self, least: int, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first word, word after the last one, is a block) of all that is indexed."""
        every = np.ones(self.part.rows, bool)
        broken = np.zeros(self.part.rows, bool)  # has a newline inside a sentence
        broken[self.rows[self.ends != self.sentence_ends]] = True
        codes = np.sort(np.concatenate([
            *self._runs(self.ends, every, least, block),
            *self._runs(self.sentence_ends, broken, least, block)]))
        new = np.ones(len(codes), bool)
        new[1:] = codes[1:] >> 1 != codes[:-1] >> 1
        start, to = np.divmod(codes[new] >> 1, len(self.ends) + 1)
        return start, to, (codes[new] & 1) == 0

    def keys(self, start: np.ndarray, to: np.ndarray) -> np.ndarray:
        """Hashes of (words, how many equal ones begin above them)."""
        h, row = self.part.gram_hashes(start, to), self.rows[start].astype(np.uint64)
        same = mixed(h ^ mixed(row + np.uint64(1)))
        order = np.argsort(same, kind="stable")
        new = np.ones(len(same), bool)
        new[1:] = same[order][1:] != same[order][:-1]
        nth = np.empty(len(same), np.int64)
        nth[order] = np.arange(len(same)) - np.flatnonzero(new)[np.cumsum(new) - 1] if len(same) else 0
        return mixed(h ^ mixed(nth.astype(np.uint64) + np.uint64(7)))


_LINES = "doc bigint, text_hash bigint, start int, size int, key bigint, block boolean"


def _line_reader(least: int, block: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(2)):
                x = Pieces(part)
                start, to, is_block = x.units(least, block)
                rows = x.rows[start]
                at = pa.array(part.first + rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at),
                     pa.array((start - part.word_bounds[rows]).astype(np.int32)),
                     pa.array((to - start).astype(np.int32)),
                     pa.array(x.keys(start, to).view(np.int64)), pa.array(is_block)],
                    names=["doc", "text_hash", "start", "size", "key", "block"])

    return run


def in_order(places: np.ndarray) -> np.ndarray:
    """Flags of a longest increasing subsequence (of the earliest ends)."""
    if (places[1:] > places[:-1]).all():
        return np.ones(len(places), bool)
    tails: list[int] = []
    ends: list[int] = []
    back = np.full(len(places), -1)
    for i, p in enumerate(places.tolist()):
        k = bisect_left(tails, p)
        back[i] = ends[k - 1] if k else -1
        tails[k : k + 1], ends[k : k + 1] = [p], [i]
    keep = np.zeros(len(places), bool)
    i = ends[-1]
    while i >= 0:
        keep[i] = True
        i = int(back[i])
    return keep


def _aligner(least: int) -> Callable:
    """Rows (doc, text_hash, first, start, ...) sorted -> the single pieces to delete."""
    names = ["doc", "text_hash", "start", "size"]
    pair = ["doc", "text_hash", "first"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def done(rows: pa.Table) -> pa.RecordBatch:
            # Rows of one id and text come once.
            rows = rows.filter(pa.array(changes(rows, [*pair, "start", "size"])))
            begin = np.flatnonzero(changes(rows, pair))
            size = rows.column("size").to_numpy()
            other = (rows.column("other").to_numpy().astype(np.int64) << 32) + size  # as rows are sorted
            flags = size >= least
            for lo, hi in zip(begin, np.append(begin[1:], len(other)), strict=True):
                if hi - lo > 1:
                    flags[lo:hi] &= in_order(other[lo:hi])
            return rows.select(names).filter(pa.array(flags)).combine_chunks().to_batches()

        def changes(rows: pa.Table, columns: list[str]) -> np.ndarray:
            new = np.ones(rows.num_rows, bool)
            new[1:] = False
            for name in columns:
                x = rows.column(name).to_numpy()
                new[1:] |= x[1:] != x[:-1]
            return new

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            if not rows.num_rows:
                continue
            last = int(np.flatnonzero(changes(rows, pair))[-1])
            held = rows.slice(last)
            if last:
                yield from done(rows.slice(0, last))
        if held is not None and held.num_rows:
            yield from done(held)

    return run


def shared_lines(docs: DataFrame, line_words: int = LINE_WORDS,
                 block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc, text_hash, start, size): the runs of words to delete, by their first word."""
    lines = settle(mapped(
        docs.select("doc", "text_hash", "text"), _line_reader(line_words, block_words), _LINES))
    keys = settle(
        lines.groupBy("key").agg(
            F.min("doc").alias("first"), F.max("doc").alias("last"), F.min("block").alias("blocks"))
        .where("first < last").select("key", "first", "blocks"))
    held = settle(lines.join(keys, "key"))
    of_first = settle(
        held.where("doc = first and not blocks").groupBy("key").agg(F.min("start").alias("other")))
    names = ["doc", "text_hash", "start", "size"]
    pairs = held.where("doc > first and not block").join(of_first, "key").select(
        *names, "first", "other")
    pairs = pairs.repartition("doc", "text_hash").sortWithinPartitions(
        "doc", "text_hash", "first", "start", "size")
    alone = mapped(pairs, _aligner(block_words),
                   "doc bigint, text_hash bigint, start int, size int")
    return held.where("doc > first and block").select(*names).unionAll(alone)


def _without(part: Slice, marks: np.ndarray, rows: np.ndarray) -> Iterator[tuple[bytes, int, int]]:
    """Every text of a slice without its marked words; the numbers of pieces and of words deleted."""
    bounds = part.word_bounds
    start = bounds[rows] + (marks >> 32)
    n = len(part.starts)
    edges = np.bincount(start, minlength=n + 1) - np.bincount(
        start + (marks & 0xFFFFFFFF), minlength=n + 1)
    gone = np.cumsum(edges[:-1]) > 0
    pieces, words = per_row(gone & Pieces(part).ends, bounds), per_row(gone, bounds)
    out = np.ones(1, bool)
    for i in range(part.rows):
        lo, hi = int(bounds[i]), int(bounds[i + 1])
        top, raw = part.bounds[i], part.data[part.bounds[i] : part.bounds[i + 1]].tobytes()
        starts, ends = part.starts[lo:hi] - top, part.ends[lo:hi] - top
        turns = np.flatnonzero(np.diff(np.concatenate([out, gone[lo:hi], out])))
        kept = []
        for k in range(0, len(turns), 2):
            a, b = turns[k], turns[k + 1]
            if not a:
                kept.append(raw[: starts[0]])
            elif k:  # what stood above the deleted words, or below them if there are more newlines
                above = turns[k - 1]
                kept.append(max(raw[ends[above - 1] : starts[above]], raw[ends[a - 1] : starts[a]],
                                key=lambda x: x.count(b"\n")))
            kept.append(raw[starts[a] : ends[b - 1]])
            if b == hi - lo:
                kept.append(raw[ends[-1] :])
        yield b"".join(kept), int(pieces[i]), int(words[i])


def _rewriter(schema: list[str]) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count = pc.fill_null(pc.list_value_length(batch.column("marks")), 0).to_numpy(
                zero_copy_only=False)
            marks = batch.column("marks").flatten().to_numpy()
            text = batch.column("text")
            n = np.zeros((2, len(count)), np.int64)
            hit = np.flatnonzero(count)
            if len(hit):
                row = np.repeat(np.arange(len(hit)), count[hit])
                new = []
                for part in slices(text.take(pa.array(hit))):
                    lo, hi = np.searchsorted(row, [part.first, part.first + part.rows])
                    new += _without(part, marks[lo:hi], row[lo:hi] - part.first)
                n[:, hit] = np.array([x[1:] for x in new]).T
                fresh = pa.array([x[0] for x in new], pa.binary()).cast(text.type)
                text = pc.replace_with_mask(text, pa.array(count > 0), fresh)
            columns = [text if x == "text" else batch.column(x) for x in schema]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(n[0]), pa.array(n[1])],
                names=[*schema, "lines_deleted", "words_deleted"])

    return run


def _key(doc_id: str) -> Column:
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(_LAST))


def without_shared_lines(docs: DataFrame, line_words: int = LINE_WORDS,
                         block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` (doc_id, text, ...) with shared lines deleted, and two columns more:
    ``lines_deleted`` and ``words_deleted``, which replace columns of those names.

    Of two documents the one with the larger doc_id is the later; rows without an id are later than
    all others and not compared among themselves, nor are rows that share an id.  Null and
    empty texts stay as they are.  All other columns are returned unchanged.
    """
    docs = docs.drop("lines_deleted", "words_deleted")
    names = docs.columns
    mine = {x: f"__{i}_of_docs" for i, x in enumerate(names)}  # so that no name can clash
    keyed = docs.select(
        _key("doc_id").alias("doc"), F.xxhash64("text").alias("text_hash"), "text",
        *(F.col(f"`{x}`").alias(mine[x]) for x in names if x != "text"))
    marks = shared_lines(keyed, line_words, block_words).groupBy("doc", "text_hash").agg(
        F.collect_set(F.shiftleft(F.col("start").cast("long"), 32).bitwiseOR(
            F.col("size").cast("long"))).alias("marks"))  # a text's own words
    rows = keyed.join(settle(marks), ["doc", "text_hash"], "left")
    order = [("text" if x == "text" else mine[x]) for x in names]
    kinds = {x: docs.schema[x].dataType.simpleString() for x in names}
    schema = ", ".join(f"`{a}` {kinds[x]}" for a, x in zip(order, names, strict=True))
    out = mapped(rows.select(*order, "marks"), _rewriter(order),
                 schema + ", lines_deleted bigint, words_deleted bigint")
    return out.select(
        *(F.col(a).alias(x) for a, x in zip(order, names, strict=True)),
        "lines_deleted", "words_deleted")
