"""Trie of conversation prefixes, from padded matrices of turn ids.

Conversations are sequences of turns; a node is a distinct sequence of first turns.  Sequences are
cut into blocks of turns (16, 32, 64, 128, then 256 each).  The rows of a block are dealt by ranges of (class,
turns, conversation), where a class holds the conversations whose earlier blocks are equal, and every
Arrow batch of a sorted range is a shard of its own: a matrix of turn ids padded with -1, in
lexicographic order.  Its columns' changes, OR-accumulated from the left, mark where nodes start, and
``reduceat`` over the starts aggregates every depth.  Only nodes on the way to a shard's first or last
row can reach into other shards; these boundary nodes are recombined by the digest of their path.

Later blocks hold only conversations that still share all their turns with another one, and the number
of rounds follows the longest sequence that two conversations share.  A conversation alone in its
class is a chain, written row by row however long it is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketflow.llm.frames import importable, mapped, settle
from docketflow.llm.ranks import numbered

FIRST_WIDTH, DOUBLINGS = 16, 4
LAST_WIDTH = FIRST_WIDTH << DOUBLINGS
#: Cells of a shard's matrix.
CELLS = 1 << 18

EMPTY = hashlib.sha256(b"").hexdigest()

NODE = ("conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
        "n_leaves bigint, saved_tokens bigint, ends_sha256 string")
NAMES = [x.split()[0] for x in NODE.split(", ")]
#: Nodes that one shard holds whole have no key; others have their path's keys, and what the shard knows.
SHARD = (f"{NODE}, shard bigint, side int, keys array<string>, chars bigint, first_end bigint, "
         "ends string")


def block_start(block: int) -> int:
    """The turns before a block."""
    if block <= DOUBLINGS:
        return FIRST_WIDTH * ((1 << block) - 1)
    return block_start(DOUBLINGS) + LAST_WIDTH * (block - DOUBLINGS)


def block_of(turn: Column) -> Column:
    """The block of a turn, counted from 0."""
    wide = (turn - block_start(DOUBLINGS)) / LAST_WIDTH
    out = F.floor(wide).cast("int") + DOUBLINGS
    for block in reversed(range(DOUBLINGS)):
        out = F.when(turn < block_start(block + 1), block).otherwise(out)
    return out


def _codes(digests: np.ndarray) -> np.ndarray:
    """Dense ids of 16-byte digests, in the order of their bytes."""
    high, low = digests[:, 0].astype(np.uint64), digests[:, 1].astype(np.uint64)
    order = np.lexsort((low, high))
    new = np.ones(len(order), bool)
    new[1:] = (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new) - 1
    return out


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).cast(pa.int64()).fill_null(0).to_numpy()


class _Shard:
    """The matrix of one shard and the nodes in it; depth 0 is the root of a class."""

    def __init__(self, batch: pa.RecordBatch, first_depth: int):
        self.first_depth = first_depth
        conv, cls = _column(batch, "conv_id"), _column(batch, "cls")
        turns = batch.column("turns")
        sizes = np.diff(turns.offsets.to_numpy())
        cells = turns.flatten()
        raw = b"".join(cells.field("digest").to_pylist())
        width = int(sizes.max(initial=0))
        digests = np.frombuffer(raw, ">u8").reshape(-1, 2)
        ids = np.full((len(conv), width), -1, np.int64)
        chars = np.zeros((len(conv), width), np.int64)
        filled = np.arange(width) < sizes[:, None]
        ids[filled] = _codes(digests)
        chars[filled] = cells.field("chars").to_numpy(zero_copy_only=False)
        order = np.lexsort((conv, *ids.T[::-1], cls))
        self.raw, self.cell = raw, np.concatenate([[0], np.cumsum(sizes)])[order]
        self.conv, self.cls, self.sizes = conv[order], cls[order], sizes[order]
        self.more = _column(batch, "more").astype(bool)[order]
        self.carried = [_column(batch, c)[order] for c in ("children", "leaves", "saved")]
        self.chars = np.hstack([np.zeros((len(conv), 1), np.int64), chars[order]])
        ids = ids[order]
        self.valid = np.hstack([np.ones((len(conv), 1), bool), ids >= 0])
        change = np.ones((len(conv), width + 1), bool)
        change[1:, 0] = self.cls[1:] != self.cls[:-1]
        change[1:, 1:] = ids[1:] != ids[:-1]
        self.marks = np.logical_or.accumulate(change, axis=1)
        self.starts = self.marks & self.valid
        # A node is on the boundary if it holds the first row or the last one.
        self.of_last = np.zeros(width + 1, np.int64)
        for k in range(width + 1):
            self.of_last[k] = np.flatnonzero(self.marks[:, k])[-1]

    def keys(self, row: int) -> list[str]:
        """The digests of the paths from the class's root to every node above ``row``."""
        path = hashlib.md5(f"{self.first_depth}:{self.cls[row]}".encode())
        out, at = [path.hexdigest()], 16 * int(self.cell[row])
        for k in range(int(self.sizes[row])):
            path.update(self.raw[at + 16 * k : at + 16 * k + 16])
            out.append(path.hexdigest())
        return out

    def batch(self) -> pa.RecordBatch:
        n, width = self.starts.shape
        whole = self.starts.copy()
        whole[0] = False
        ended = ~self.more
        cols: dict[str, list] = {k: [] for k in (
            "row", "depth", "n", "conv", "ends", "children", "parent", "whole")}
        own_saved, own_leaf = np.zeros((n, width), np.int64), np.zeros((n, width), np.int64)
        for k in range(width):
            runs = np.flatnonzero(self.marks[:, k])
            real = self.valid[runs, k]
            starts = runs[real]
            if not len(starts):
                continue
            counts = np.diff([*runs, n])[real]
            ends = np.add.reduceat((self.sizes == k) & ended, runs, dtype=np.int64)[real]
            kids = np.add.reduceat(
                self.starts[:, k + 1] if k + 1 < width else np.zeros(n, bool), runs, dtype=np.int64)
            kids = (kids + np.add.reduceat(
                np.where(self.more & (self.sizes == k), self.carried[0], 0), runs))[real]
            last = self.of_last[k]
            whole[starts[starts == last], k] = False
            inside = whole[starts, k]
            own_saved[starts, k] = np.where(inside, (counts - 1) * self.chars[starts, k], 0)
            own_leaf[starts, k] = inside & (kids == 0)
            cols["row"].append(starts)
            cols["depth"].append(np.full(len(starts), k))
            cols["n"].append(counts)
            cols["conv"].append(np.minimum.reduceat(self.conv, runs)[real])
            cols["ends"].append(ends)
            cols["children"].append(kids)
            cols["whole"].append(inside)
        row, depth, count, conv, ends, kids, inside = (
            np.concatenate(cols[k]) for k in ("row", "depth", "n", "conv", "ends", "children", "whole"))
        # What rows of continued conversations bring from later blocks belongs to all nodes above.
        tip = np.where(self.more, self.sizes, 0)
        own_saved[np.arange(n), tip] += np.where(self.more, self.carried[2], 0)
        own_leaf[np.arange(n), tip] += np.where(self.more, self.carried[1], 0)
        saved, leaves = np.zeros(len(row), np.int64), np.zeros(len(row), np.int64)
        kids_whole = kids.copy()
        for values, out in ((own_saved, saved), (own_leaf, leaves)):
            below = np.cumsum(values[:, ::-1], axis=1)[:, ::-1]
            for k in range(width):
                runs = np.flatnonzero(self.marks[:, k])
                out[depth == k] = np.add.reduceat(below[:, k], runs)[self.valid[runs, k]]
        # Children on the boundary are counted when the shards are recombined.
        edge = np.flatnonzero(~inside)
        place = {(int(row[i]), int(depth[i])): i for i in range(len(row))} if len(edge) else {}
        up = self._parents(row, depth, place)
        for i in edge:
            if depth[i]:
                kids_whole[up[i]] -= 1
        return self._record(row, depth, conv, count, ends, kids_whole, leaves, saved, inside, up)

    def _parents(self, row, depth, place) -> np.ndarray:
        """The index of every node's parent; a class's root has none (-1)."""
        n, width = self.starts.shape
        out = np.full(len(row), -1, np.int64)
        index = np.full((n, width), -1, np.int64)
        index[row, depth] = np.arange(len(row))
        for k in range(1, width):
            here = np.flatnonzero(depth == k)
            if len(here):
                starts = np.flatnonzero(self.marks[:, k - 1])
                out[here] = index[starts[np.searchsorted(starts, row[here], "right") - 1], k - 1]
        return out

    def _record(self, row, depth, conv, count, ends, kids, leaves, saved, inside, up):
        first, last = self.keys(0), self.keys(len(self.conv) - 1)
        on_first = row == 0
        parent_edge = (up >= 0) & ~inside[up]
        side = np.where(inside, np.where(parent_edge, np.where(on_first[up], 0, 1), -1),
                        np.where(on_first, 0, 1))
        shas, keys, first_end, texts = [], [], [], []
        names = self.conv.astype(str) if ends.any() else np.array([])
        for i in range(len(row)):
            said = ""
            if ends[i]:
                said = ",".join(names[row[i] : row[i] + ends[i]])
            if inside[i]:
                shas.append(hashlib.sha256(said.encode()).hexdigest() if said else EMPTY)
                keys.append(None)
                first_end.append(None)
                texts.append(None)
            else:
                shas.append(None)
                keys.append((first if on_first[i] else last)[: depth[i] + 1])
                first_end.append(int(self.conv[row[i]]) if said else None)
                texts.append(said or None)
        known = inside & (up >= 0) & ~parent_edge
        return pa.RecordBatch.from_arrays([
            pa.array(conv, pa.int64()), pa.array(depth + self.first_depth, pa.int64()),
            pa.array(conv[up], pa.int64(), mask=~known), pa.array(count, pa.int64()),
            pa.array(kids, pa.int64()), pa.array(leaves, pa.int64()), pa.array(saved, pa.int64()),
            pa.array(shas, pa.string()), pa.array(np.full(len(row), self.conv[0]), pa.int64()),
            pa.array(side, pa.int32()), pa.array(keys, pa.list_(pa.string())),
            pa.array(self.chars[row, depth], pa.int64()), pa.array(first_end, pa.int64()),
            pa.array(texts, pa.string())],
            names=[x.split()[0] for x in SHARD.split(", ")])


def _shards(block: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def nodes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = max(2, CELLS // (block_start(block + 1) - block_start(block)))
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                yield _Shard(batch.slice(at, rows), block_start(block)).batch()

    return nodes


def _ends_digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of the members that end at a node, from runs of them in ascending order."""
    key, state = None, hashlib.sha256()

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([key]), pa.array([state.hexdigest()])], names=["key", "ends_sha256"])

    for batch in batches:
        for now, text in zip(*(batch.column(c).to_pylist() for c in ("key", "ends")), strict=True):
            if now == key:
                state.update(b",")
            else:
                if key is not None:
                    yield row()
                key, state = now, hashlib.sha256()
            state.update(text.encode())
    if key is not None:
        yield row()


def _recombined(shards: DataFrame, first_depth: int) -> tuple[DataFrame, DataFrame]:
    """(nodes below the classes' roots, the roots) of a block from what its shards hold."""
    key = F.element_at("keys", -1)
    parts = shards.where("keys IS NOT NULL").withColumn("key", key)
    ends = mapped(
        parts.where("ends IS NOT NULL").select("key", "first_end", "ends")
        .repartition("key").sortWithinPartitions("key", "first_end").select("key", "ends"),
        _ends_digest, "key string, ends_sha256 string")
    merged = settle(parts.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"),
        F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"),
        F.first("chars").alias("chars"), F.first("keys").alias("keys"),
    ).withColumn("up", F.when(F.size("keys") > 1, F.element_at("keys", -2))))
    kids = merged.where("up IS NOT NULL").groupBy(F.col("up").alias("key")).agg(
        F.count("*").alias("kids"))
    whole = settle(
        merged.join(kids, "key", "left").join(ends, "key", "left")
        .withColumn("n_children", F.col("n_children") + F.coalesce("kids", F.lit(0)))
        .withColumn("own_leaf", (F.col("n_children") == 0).cast("bigint"))
        .withColumn("own_saved", (F.col("n_convs") - 1) * F.col("chars")))
    below = whole.select(F.explode("keys").alias("key"), "own_leaf", "own_saved").groupBy("key").agg(
        F.sum("own_leaf").alias("edge_leaves"), F.sum("own_saved").alias("edge_saved"))
    parents = whole.select(F.col("key").alias("up"), F.col("conv_id").alias("up_conv"))
    edge = settle(whole.join(below, "key").join(parents, "up", "left").select(
        "key", "conv_id", "depth", F.col("up_conv").alias("parent_conv_id"), "n_convs", "n_children",
        (F.col("n_leaves") + F.col("edge_leaves")).alias("n_leaves"),
        (F.col("saved_tokens") + F.col("edge_saved")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256")))
    refs = parts.select("shard", "side", F.col("depth") + 1, "key").toDF("shard", "side", "depth", "key").join(
        edge.select("key", F.col("conv_id").alias("up_conv")), "key").drop("key")
    inner = shards.where("keys IS NULL")
    hung = inner.where("side >= 0").join(refs, ["shard", "side", "depth"]).withColumn(
        "parent_conv_id", F.col("up_conv"))
    nodes = inner.where("side < 0").select(*NAMES).unionAll(hung.select(*NAMES)).unionAll(
        edge.select(*NAMES))
    return nodes.where(F.col("depth") > first_depth), nodes.where(F.col("depth") == first_depth)


def _classes(rows: DataFrame) -> DataFrame:
    """(conv_id, cls, n) after a block, for the conversations that go on: ``cls`` is the smallest of
    the ``n`` conversations with equal turns so far."""
    path = F.md5(F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), ""))
    on = rows.where("more").select("conv_id", F.col("cls").alias("before"), path.alias("path"))
    now = on.groupBy("before", "path").agg(F.min("conv_id").alias("cls"), F.count("*").alias("n"))
    return settle(on.join(now, ["before", "path"]).select("conv_id", "cls", "n"))


def trie(sequences: DataFrame) -> DataFrame:
    """Nodes of all prefixes of ``sequences``: blocks (conv_id, block, length, turns), where turns is a
    sorted array of (i, digest, chars) and block 0 is there for every conversation."""
    block = 0
    rows = sequences.where("block = 0").withColumn("cls", F.lit(0).cast("bigint"))
    levels, alone = [], None
    while True:
        rows = rows.withColumn("more", F.col("length") > block_start(block + 1))
        levels.append(rows)
        classes = _classes(rows)
        single = classes.where("n = 1").select("conv_id", F.lit(block + 1).alias("since"))
        alone = single if alone is None else alone.unionAll(single)
        shared = classes.where("n > 1").select("conv_id", "cls")
        if shared.isEmpty():
            break
        block += 1
        rows = sequences.where(F.col("block") == block).join(shared, "conv_id")
    alone = settle(alone)
    chains = sequences.where("block > 0").join(alone, "conv_id").where("block >= since").select(
        "conv_id", "length", F.explode(F.transform("turns", lambda t: t["i"] + 1)).alias("depth"))
    at_end = F.col("depth") == F.col("length")
    out = chains.select(
        "conv_id", "depth", F.col("conv_id"), F.lit(1), F.when(at_end, 0).otherwise(1), F.lit(1),
        F.lit(0), F.when(at_end, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(EMPTY)
    ).toDF(*NAMES)
    roots = None
    for block in reversed(range(len(levels))):
        carried = alone.where(F.col("since") == block + 1).select(
            "conv_id", F.lit(1).alias("children"), F.lit(1).alias("leaves"), F.lit(0).alias("saved"))
        if roots is not None:
            carried = carried.unionAll(roots.select("conv_id", "n_children", "n_leaves", "saved_tokens"))
        keys = ["cls", "turns", "conv_id"]
        ranged = levels[block].join(carried, "conv_id", "left").select(
            *keys, "more", *[F.col(c).cast("bigint") for c in ("children", "leaves", "saved")]
        ).repartitionByRange(*keys).sortWithinPartitions(*keys)
        nodes, roots = _recombined(
            settle(mapped(ranged, _shards(block), SHARD)), block_start(block))
        out = out.unionAll(nodes)
    return out.unionAll(roots)


def turn_digests(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, chars) of every turn; null roles and texts are empty."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint"), "turn",
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
        F.length(text).alias("chars"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """Blocks of the rebuilt conversations of ``turns`` (conv_id, pos, digest, chars).

    Conversation c begins with the first h turns of conversation c - c % 100 and goes on with its own
    turns after its first h, where h is the CRC-32 of c modulo 6.
    """
    base = F.expr("conv_id - conv_id % 100")
    head = F.crc32(F.col("conv_id").cast("string")) % 6
    convs = turns.groupBy("conv_id").agg((F.max("pos") + 1).alias("n"))
    starts = turns.where("pos < 5 AND conv_id % 100 = 0").groupBy(F.col("conv_id").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "digest", "chars"))).alias("start"))
    info = settle(
        convs.withColumn("base", base).withColumn("h", head).join(starts, "base", "left").select(
            "conv_id", "h", F.expr("slice(coalesce(start, array()), 1, CAST(h AS INT))").alias("start"),
            F.greatest(F.col("n") - F.col("h"), F.lit(0)).alias("rest")
        ).withColumn("k", F.size("start").cast("bigint")).withColumn("length", F.col("k") + F.col("rest")))
    own = turns.join(info.where("rest > 0").select("conv_id", "h", "k", "length"), "conv_id").where(
        "pos >= h").select("conv_id", "length", (F.col("k") + F.col("pos") - F.col("h")).alias("i"), "digest", "chars")
    begun = info.select("conv_id", "length", F.explode("start").alias("t")).select(
        "conv_id", "length", F.col("t.pos"), F.col("t.digest"), F.col("t.chars"))
    all_convs = info.select("conv_id", "length", F.lit(-1).cast("bigint"), F.lit(None).cast("binary"), F.lit(0))
    rows = own.unionAll(begun).unionAll(all_convs)
    return settle(
        rows.withColumn("block", block_of(F.greatest("i", F.lit(0)))).groupBy("conv_id", "block").agg(
            F.first("length").alias("length"),
            F.sort_array(F.collect_list(F.struct("i", "digest", "chars"))).alias("turns"),
        ).withColumn("turns", F.filter("turns", lambda t: t["i"] >= 0)))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations.

    Turns are ordered by ``turn``, null first; equal ones by the MD5 of length of role, role and text.
    Rows without a conv_id belong to no conversation; ``%`` keeps the sign of a negative conv_id.
    An empty table has no node, not even a root.  Other columns take no part.
    """
    importable(conversations.sparkSession)
    turns = settle(numbered(turn_digests(conversations), "conv_id", ["turn", "digest"]))
    return trie(rebuilt(turns.select("conv_id", "pos", "digest", "chars")))
