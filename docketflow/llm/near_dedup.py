"""MinHash near-deduplication by a multi-index Hamming join (operator 2).

A document is the set of its distinct word shingles; documents whose sets are similar enough
are linked, and each connected group keeps its smallest id.

1. Sketch: every text gets a 128-bit fingerprint of its set and a signature of ``bands`` chunks
   of four 16-bit minima.  Equal sets become one node.
2. Multi-index: two signatures within ``2 * bands - 1`` differing minima have, by pigeonhole, a
   chunk with at most one difference.  Every chunk is indexed four times, each time without
   one of its minima, which enumerates all chunks with at most one error: all pairs within
   the distance share a key.  ``bands`` is chosen so that a pair at the similarity limit exceeds
   the distance with a probability of at most ``MISS``.
3. Inside a key, nodes within the distance (and of possible sizes) are tied by a spanning
   forest, never by all pairs.  Keys with more than ``BLOCK`` nodes tie all of them to their
   smallest, which can only make the groups of the next step coarser.
4. Tied groups are candidates: their full sets are compared, and a group too large for one
   task is cut.  It is first compared inside random blocks, twice; then pairs of blocks are
   compared, except where both are known to be one component already.  So every pair that
   could join two components is tested on full sets, and near copies by the thousand cost about
   as many tests as they have members.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketflow.llm.arrays import Slice, mixed, slices
from docketflow.llm.frames import components, mapped, settle
from docketflow.llm.piece_arrays import give_back

PER_BAND = 4
MISS = 1e-5
#: Nodes of one block, and shingles of one block: what one task holds of a group.
BLOCK, BLOCK_SHINGLES = 1024, 2_000_000


def beyond(trials: int, p: float, most: int) -> float:
    """The chance of more than ``most`` of ``trials`` events of probability p."""
    return math.fsum(
        math.comb(trials, k) * p**k * (1 - p) ** (trials - k) for k in range(most + 1, trials + 1)
    )


def bands_for(percent: int) -> int:
    """The fewest bands that lose a pair at the limit with a probability of at most MISS."""
    bands = 1
    while beyond(PER_BAND * bands, 1 - percent / 100, 2 * bands - 1) > MISS:
        bands += 1
    return bands


def _constants(bands: int) -> tuple[np.ndarray, np.ndarray]:
    n = PER_BAND * bands
    seed = mixed(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return seed[:n] | np.uint64(1), seed[n:]


def shingle_sets(part: Slice, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of all texts, and how many each text has."""
    first = part.windows(words)
    h, rows = part.gram_hashes(first, first + words), part.word_rows[first]
    count = np.diff(part.word_bounds)
    short = np.flatnonzero((count > 0) & (count < words))
    if len(short):
        whole = part.gram_hashes(part.word_bounds[short], part.word_bounds[short + 1])
        h, rows = np.concatenate([h, whole]), np.concatenate([rows, short])
    order = np.lexsort((h, rows))
    h, rows = h[order], rows[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])
    return h[new], np.bincount(rows[new], minlength=part.rows)


def fingerprints(h: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (
        np.add.reduceat(mixed(h), starts).view(np.int64),
        np.add.reduceat(mixed(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)), starts).view(np.int64),
    )


def signatures(h: np.ndarray, starts: np.ndarray, bands: int) -> np.ndarray:
    """Minima of the non-empty sets that begin at ``starts``: a row of uint16 for each."""
    scale, shift = _constants(bands)
    out = np.empty((len(starts), len(scale)), np.uint16)
    for k in range(len(scale)):
        low = np.minimum.reduceat(h * scale[k] + shift[k], starts)
        out[:, k] = (low * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(48)).astype(np.uint16)
    return out


def _band_names(bands: int) -> list[str]:
    return [f"band_{i}" for i in range(bands)]


def _sketcher(words: int, bands: int) -> Callable:
    names = ["n_shingles", "f1", "f2", *_band_names(bands)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros((len(names), batch.num_rows), np.int64)
            for part in slices(batch.column(1), fold_case=True):
                h, count = shingle_sets(part, words)
                rows = np.flatnonzero(count)
                out[0, part.first : part.first + part.rows] = count
                if len(rows):
                    starts = (np.cumsum(count) - count)[rows]
                    out[1:3, part.first + rows] = fingerprints(h, starts)
                    chunks = signatures(h, starts, bands).view(np.int64)
                    out[3:, part.first + rows] = chunks.T
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x) for x in out)], names=["doc_id", *names]
            )

    return run


def sketch(docs: DataFrame, words: int, bands: int) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["n_shingles", "f1", "f2", *_band_names(bands)]
    schema = f"doc_id {kind}, " + ", ".join(f"{x} bigint" for x in names)
    return mapped(docs.select("doc_id", "text"), _lean(_sketcher(words, bands)), schema)


def _keys(bands: int) -> Column:
    """All keys of a signature: every chunk without each one of its minima."""
    keys = []
    for i, name in enumerate(_band_names(bands)):
        for at in range(PER_BAND):
            mask = ~(0xFFFF << (16 * at)) & 0xFFFFFFFFFFFFFFFF
            signed = mask - (1 << 64) if mask >> 63 else mask
            keys.append(F.xxhash64(F.lit(PER_BAND * i + at), F.col(name).bitwiseAND(F.lit(signed))))
    return F.explode(F.array(*keys))


def possible_sizes(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    return 100 * np.minimum(a, b) >= percent * np.maximum(a, b)


def _groups(
    batches: Iterable[pa.RecordBatch], by: int
) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of whole groups, and where the groups begin; rows come sorted by the first ``by``
    columns."""
    held: pa.Table | None = None

    def cut(rows: pa.Table) -> np.ndarray:
        new = np.zeros(rows.num_rows, bool)
        new[:1] = True
        for i in range(by):
            x = rows.column(i).to_numpy()
            new[1:] |= x[1:] != x[:-1]
        return np.flatnonzero(new)

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        if not rows.num_rows:
            continue
        last = int(cut(rows)[-1])
        held = rows.slice(last)
        if last:
            yield rows.slice(0, last).combine_chunks(), cut(rows.slice(0, last))
    if held is not None and held.num_rows:
        yield held.combine_chunks(), cut(held)


def _edge_batch(a: list[np.ndarray], b: list[np.ndarray]) -> pa.RecordBatch:
    empty = [np.zeros(0, np.int64)]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(a or empty)), pa.array(np.concatenate(b or empty))],
        names=["a", "b"],
    )


def _forest(bands: int, percent: int) -> Callable:
    """Rows (key, node, n, bands...) sorted by key -> edges that tie nodes within the distance."""
    most = 2 * bands - 1

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, begin in _groups(batches, 1):
            node, n = rows.column("node").to_numpy(), rows.column("n").to_numpy()
            sig = np.stack([rows.column(x).to_numpy() for x in _band_names(bands)], 1)
            sig = np.ascontiguousarray(sig).view(np.uint16)
            size = np.diff(np.append(begin, len(node)))
            two = begin[size == 2]
            near = ((sig[two] != sig[two + 1]).sum(1) <= most) & possible_sizes(
                n[two], n[two + 1], percent)
            a, b = [node[two[near]]], [node[two[near] + 1]]
            for lo, count in zip(begin[size > 2], size[size > 2], strict=True):
                left = np.arange(lo, lo + count)
                while len(left):
                    root, queue, left = left[0], [left[0]], left[1:]
                    while queue and len(left):
                        at = queue.pop()
                        hit = ((sig[left] != sig[at]).sum(1) <= most) & possible_sizes(
                            n[left], n[at], percent)
                        if hit.any():
                            queue += list(left[hit])
                            a.append(np.full(int(hit.sum()), node[root]))
                            b.append(node[left[hit]])
                            left = left[~hit]
            yield _edge_batch(a, b)

    return run


def candidates(nodes: DataFrame, bands: int, percent: int) -> DataFrame:
    """Edges (a, b) whose components hold every pair of nodes within the signature distance."""
    keys = nodes.select("node", _keys(bands).alias("key"))
    shared = settle(
        keys.groupBy("key").agg(F.count("*").alias("size"), F.min("node").alias("least"))
        .where("size > 1")
    )
    rows = settle(keys.join(shared, "key"))
    hubs = rows.where(F.col("size") > BLOCK).select(
        F.col("least").alias("a"), F.col("node").alias("b"))
    small = (
        rows.where(F.col("size") <= BLOCK).select("key", "node")
        .join(nodes.select("node", "n", *_band_names(bands)), "node")
        .select("key", "node", "n", *_band_names(bands))
        .repartition("key").sortWithinPartitions("key")
    )
    forest = mapped(small, _lean(_forest(bands, percent)), "a bigint, b bigint")
    return hubs.unionAll(forest).where("a <> b").distinct()


#: Shingles of other sets that one comparison holds at a time.
TOGETHER = 250_000


def _lean(run: Callable) -> Callable:
    """``run``, whose worker returns its memory when a task ends."""
    def whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole


def _overlaps(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, one: int,
              others: np.ndarray) -> np.ndarray:
    """How many shingles each of ``others`` shares with ``one``, a bounded number of sets at a time."""
    own = values[starts[one] : starts[one] + sizes[one]]
    out, total, first = [], np.cumsum(sizes[others]), 0
    while first < len(others):
        done = total[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(total, done + TOGETHER, "right")))
        part = others[first:last]
        count = sizes[part]
        ends = np.cumsum(count)
        x = values[np.arange(ends[-1]) + np.repeat(starts[part] - (ends - count), count)]
        hit = own[np.minimum(np.searchsorted(own, x), len(own) - 1)] == x
        out.append(np.add.reduceat(hit.astype(np.int64), ends - count))
        first = last
    return np.concatenate(out)


def linked(prior: np.ndarray, sizes: np.ndarray, values: np.ndarray, bands: int,
           percent: int) -> np.ndarray:
    """Labels of the components of a block, by full sets.

    ``prior`` labels what is known to be connected.  Each node outside the largest known part
    is compared with all nodes not yet connected to it: no pair of two components is left out.
    """
    starts = np.cumsum(sizes) - sizes
    _, label = np.unique(prior, return_inverse=True)
    main = label == np.argmax(np.bincount(label))
    sig = signatures(values, starts, bands)
    most = 2 * bands - 1
    loose = np.flatnonzero(~main) if main.sum() > 1 else np.arange(len(label))
    for at in loose:
        others = np.flatnonzero(label != label[at])
        others = others[main[others] | (others > at)]
        others = others[possible_sizes(sizes[others], sizes[at], percent)]
        others = others[(sig[others] != sig[at]).sum(1) <= most]
        if not len(others):
            continue
        both = _overlaps(values, starts, sizes, at, others)
        hit = others[100 * both >= percent * (sizes[others] + sizes[at] - both)]
        if len(hit):
            label[np.isin(label, np.unique(label[hit]))] = label[at]
    return label


def _linker(bands: int, percent: int) -> Callable:
    """Rows (g1, g2, node, label, shingles) sorted by group -> edges node - smallest of its component."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, begin in _groups(batches, 2):
            node, prior = rows.column("node").to_numpy(), rows.column("label").to_numpy()
            lists = rows.column("shingles").combine_chunks()
            lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
            offsets = lists.offsets.to_numpy()
            values = lists.values.to_numpy().view(np.uint64)
            a, b = [], []
            for lo, hi in zip(begin, np.append(begin[1:], len(node)), strict=True):
                if hi - lo < 2:
                    continue
                label = linked(prior[lo:hi], np.diff(offsets[lo : hi + 1]).astype(np.int64),
                               values[offsets[lo] : offsets[hi]], bands, percent)
                root = np.full(label.max() + 1, np.iinfo(np.int64).max)
                np.minimum.at(root, label, node[lo:hi])
                own = root[label]
                a.append(own[own != node[lo:hi]])
                b.append(node[lo:hi][own != node[lo:hi]])
            yield _edge_batch(a, b)

    return run


def _link(rows: DataFrame, bands: int, percent: int) -> DataFrame:
    rows = rows.select("g1", "g2", "node", "label", "shingles")
    rows = rows.repartition("g1", "g2").sortWithinPartitions("g1", "g2", "node")
    return mapped(rows, _lean(_linker(bands, percent)), "a bigint, b bigint")


def _set_reader(words: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f1, f2 = batch.column(4).to_numpy(), batch.column(5).to_numpy()
            for part in slices(batch.column(0), fold_case=True):
                h, count = shingle_sets(part, words)
                ends = np.cumsum(count)
                rows = np.flatnonzero(count)
                if not len(rows):
                    continue
                g1, g2 = fingerprints(h, (ends - count)[rows])
                at = part.first + rows
                right = (g1 == f1[at]) & (g2 == f2[at])  # an id may stand on other texts too
                bounds = np.concatenate([[0], ends]).astype(np.int32)
                sets = pa.ListArray.from_arrays(pa.array(bounds), pa.array(h.view(np.int64)))
                take = pa.array(rows[right])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).take(pa.array(at[right])) for i in (1, 2, 3)),
                     sets.take(take)],
                    names=["node", "root", "n", "shingles"],
                )

    return run


def _blocks(sets: DataFrame, columns: list[str]) -> DataFrame:
    """The groups by ``columns`` and the number of blocks that each needs."""
    return sets.groupBy(*columns).agg(
        F.greatest(
            F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)
        ).cast("long").alias("blocks")
    )


def verified(docs: DataFrame, nodes: DataFrame, tied: DataFrame, words: int, bands: int,
             percent: int) -> DataFrame:
    """Edges (a, b) with the components of the links confirmed on full sets."""
    wanted = tied.join(nodes, "node").select("node", "root", "n", "f1", "f2", "first_id")
    texts = docs.select("doc_id", "text")
    read = texts.join(wanted, texts.doc_id.eqNullSafe(wanted.first_id)).select(
        "text", "node", "root", "n", "f1", "f2")
    sets = settle(
        mapped(read, _lean(_set_reader(words)),
               "node bigint, root bigint, n bigint, shingles array<bigint>")
        # Copies under one id give one node: rows of equal sets, any of them will do.
        .dropDuplicates(["node"])
    )
    size = settle(_blocks(sets, ["root"]))
    small = sets.join(size, "root").where("blocks = 1")
    edges = _link(
        small.select(F.col("root").alias("g1"), F.lit(0).cast("long").alias("g2"), "node",
                     F.col("node").alias("label"), "shingles"), bands, percent)
    if size.where("blocks > 1").isEmpty():
        return edges
    large = settle(sets.join(size.where("blocks > 1"), "root"))
    for turn in (1, 2):
        block = F.pmod(F.xxhash64(F.lit(turn), "node"), F.col("blocks"))
        edges = edges.unionAll(_link(
            large.select(F.col("root").alias("g1"), block.alias("g2"), "node",
                         F.col("node").alias("label"), "shingles"), bands, percent))
    edges = settle(edges)
    known = settle(
        large.select("node", "root", "n").join(
            components(edges).select("node", F.col("root").alias("label")), "node", "left")
        .withColumn("label", F.coalesce("label", "node"))
    )
    return edges.unionAll(_across(large, known, bands, percent))


def _across(large: DataFrame, known: DataFrame, bands: int, percent: int) -> DataFrame:
    """Compare the parts of large groups that are not known to be connected, block by block."""
    whole = _blocks(known, ["root", "label"]).select("root", "label", F.col("blocks").alias("own"))
    rest = known.join(whole, ["root", "label"])
    pieces = _blocks(rest.where("own = 1"), ["root"]).select("root", F.col("blocks").alias("mix"))
    # Blocks of one component carry its label; the small components of a group share mixed ones.
    placed = settle(
        rest.join(pieces, "root", "left").select(
            "node", "root", "label",
            F.when(F.col("own") > 1, F.col("label")).otherwise(-1).alias("of"),
            F.when(F.col("own") > 1, F.pmod(F.xxhash64("node"), F.col("own")))
            .otherwise(F.pmod(F.xxhash64("label"), F.coalesce("mix", F.lit(1)))).alias("part"),
        )
    )
    blocks = placed.select("root", "of", "part").distinct()
    left = blocks.select("root", F.col("of").alias("of_1"), F.col("part").alias("part_1"))
    right = blocks.select("root", F.col("of").alias("of_2"), F.col("part").alias("part_2"))
    pairs = left.join(right, "root").where(
        "(of_1 < of_2) or (of_1 = -1 and of_2 = -1 and part_1 <= part_2)")
    pairs = settle(pairs.select(
        "root", F.xxhash64("of_1", "part_1", "of_2", "part_2").alias("g2"),
        F.explode(F.array_distinct(F.array(
            F.struct(F.col("of_1").alias("of"), F.col("part_1").alias("part")),
            F.struct(F.col("of_2").alias("of"), F.col("part_2").alias("part"))))).alias("side"),
    ).select("root", "g2", "side.of", "side.part"))
    rows = (
        placed.join(pairs, ["root", "of", "part"]).select("node", "root", "g2", "label")
        .join(large.select("node", "shingles"), "node")
    )
    return _link(rows.withColumnRenamed("root", "g1"), bands, percent)


def near_groups(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text).

    A-Z are lower-cased, words are ``[^\\x20\\x09-\\x0D]+``, a set holds distinct ``words``-word
    shingles (of a shorter text, its whole word sequence as one).  Two texts are linked when
    ``100 * |A and B| >= percent * |A or B|``; ``component_id`` is the smallest doc_id reachable.
    Texts without words, nulls included, have no shingles and only themselves.  Repeated rows
    are each returned, with one component.  A null doc_id takes part, is never the
    smallest while there is another, and is kept only where a component has no id at all.
    Other columns are ignored.  An empty table gives an empty result.
    """
    bands = bands_for(percent)
    sketches = settle(sketch(docs, words, bands))
    names = _band_names(bands)
    nodes = settle(
        sketches.where("n_shingles > 0").groupBy("f1", "f2").agg(
            F.min("doc_id").alias("first_id"), F.max("n_shingles").alias("n"),
            *(F.first(x).alias(x) for x in names))
        .withColumn("node", F.monotonically_increasing_id())
    )
    tied = components(candidates(nodes, bands, percent))
    edges = verified(docs, nodes, tied, words, bands, percent)
    roots = components(edges).join(nodes.select("node", "first_id"), "node")
    smallest = roots.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_node = settle(
        roots.join(smallest, "root").select("node", "component_id"))
    of_set = settle(
        nodes.select("f1", "f2", "node", "first_id").join(of_node, "node", "left")
        .select("f1", "f2", F.coalesce("component_id", "first_id").alias("component_id")))
    full = sketches.where("n_shingles > 0").join(of_set, ["f1", "f2"])
    bare = sketches.where("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "n_shingles", "component_id"]
    return full.select(*columns).unionAll(bare.select(*columns)).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
