"""Merkle manifest of a dataset: ternary trees per group, one tree over the groups, multiproofs.

A leaf is the hash of a row's columns.  The leaves of a group, in order, form a tree in which every
three consecutive nodes become their hash; the groups' roots, in the order of the groups, form the
last tree.  Nodes have coordinates (tree, level, idx); level 0 holds the leaves.

Leaves are handled in aligned blocks of ``BLOCK``, so a group of any size spreads over tasks.  Proofs
are made as an octopus multiproof: each block of wanted leaves works out the union of the coordinates
it misses, fetches each of them once, derives the interior nodes its leaves share, and expands the
proof of every leaf locally.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketflow.llm.frames import importable, settle
from docketflow.llm.ranks import numbered

ARITY = 3
#: Levels that one task builds of a block, and the leaves of a block.
LEVELS = 7
BLOCK = ARITY**LEVELS
#: No tree has more levels: 3^39 exceeds every count of rows.
MOST_LEVELS = 39
TOP = "top"

NODES = "tree string, level int, idx bigint, digest binary"


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _field(column: Column) -> Column:
    """Length and value of a column; ``-`` for null."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*columns: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*[_field(c) for c in columns]), 256))


def tree_of(group: Column) -> Column:
    """The name of a group's tree: null sorts first, others by their bytes."""
    return F.coalesce(F.concat(F.lit("v"), group.cast("string")), F.lit("n"))


def _height(n: Column) -> Column:
    """Levels above ``n`` leaves; none above a single one."""
    return sum((F.lit(ARITY**k) < n).cast("int") for k in range(MOST_LEVELS))


@dataclass
class Manifest:
    """``leaves``: rows with tree, pos, leaf; ``trees``: tree, n, height, place, subroot (hex);
    ``nodes``: interior nodes of all trees; ``n_trees`` and ``root`` of the tree over the groups."""

    leaves: DataFrame
    trees: DataFrame
    nodes: DataFrame
    n_trees: int
    root: str | None

    @property
    def stored(self) -> DataFrame:
        """Every node with its coordinates."""
        return self.nodes.unionAll(self.leaves.select(
            "tree", F.lit(0).alias("level"), F.col("pos").alias("idx"), F.col("leaf").alias("digest")
        )).unionAll(self.trees.select(
            F.lit(TOP), F.lit(0), "place", F.unhex("subroot")))


def _grown(level: int) -> Callable[[pa.Table], pa.Table]:
    def above(block: pa.Table) -> pa.Table:
        return _above(level, block)

    return above


def _above(level: int, block: pa.Table) -> pa.Table:
    """All nodes above the nodes of one block, up to ``LEVELS`` levels or the tree's root.

    ``n`` is the number of the tree's nodes at ``level``.
    """
    order = np.argsort(block.column("idx").to_numpy())
    names = [x.hex() for x in block.column("digest").take(pa.array(order)).to_pylist()]
    first, n = int(block.column("idx").to_numpy()[order[0]]), block.column("n")[0].as_py()
    levels, places, digests = [], [], []
    for up in range(1, LEVELS + 1):
        if n == 1:
            break
        names = [digest(*names[i : i + ARITY]) for i in range(0, len(names), ARITY)]
        first, n = first // ARITY, -(-n // ARITY)
        levels += [level + up] * len(names)
        places += range(first, first + len(names))
        digests += map(bytes.fromhex, names)
    tree = block.column("tree")[0].as_py()
    return pa.table({
        "tree": pa.array([tree] * len(levels), pa.string()), "level": pa.array(levels, pa.int32()),
        "idx": pa.array(places, pa.int64()), "digest": pa.array(digests, pa.binary())})


def _numbers() -> Column:
    """The blocks that ``n`` nodes fill."""
    return F.explode(F.expr(f"sequence(0L, (n - 1) DIV {BLOCK})")).alias("block")


def _blocks(trees: DataFrame, level: int = 0) -> DataFrame:
    """A row per block of the nodes at ``level`` of every tree with more than one of them."""
    here = F.expr(f"(n + {ARITY**level - 1}) DIV {ARITY**level}")
    return trees.select("tree", here.alias("n")).where("n > 1").select("tree", "n", _numbers())


def grown(bottom: DataFrame, trees: DataFrame) -> DataFrame:
    """Interior nodes over ``bottom`` (tree, idx, digest); ``trees`` has tree, n and height.

    A pass builds ``LEVELS`` levels of every block; its highest nodes are the next one's bottom.
    """
    tallest = trees.agg(F.max("height")).first()[0] or 0
    made = []
    for level in range(0, tallest, LEVELS):
        placed = bottom.withColumn("block", F.expr(f"idx DIV {BLOCK}"))
        nodes = settle(
            placed.join(_blocks(trees, level), ["tree", "block"])
            .groupBy("tree", "block").applyInArrow(_grown(level), NODES))
        made.append(nodes)
        bottom = nodes.where(F.col("level") == level + LEVELS).select("tree", "idx", "digest")
    if not made:
        return trees.sparkSession.createDataFrame([], NODES)
    out = made[0]
    for more in made[1:]:
        out = out.unionAll(more)
    return out


def build(leaves: DataFrame) -> Manifest:
    """The manifest of ``leaves``, numbered rows with tree, pos and leaf."""
    trees = leaves.groupBy("tree").agg((F.max("pos") + 1).alias("n"))
    trees = settle(trees.withColumn("height", _height(F.col("n")).cast("int")))
    nodes = grown(leaves.select("tree", F.col("pos").alias("idx"), F.col("leaf").alias("digest")), trees)
    ends = nodes.where("idx = 0").unionAll(leaves.where("pos = 0").select(
        "tree", F.lit(0), "pos", "leaf"))
    subroots = trees.join(
        ends.withColumnRenamed("level", "height"), ["tree", "height"]
    ).select("tree", "n", "height", F.col("digest").alias("subroot"), F.lit(0).alias("all"))
    placed = settle(numbered(subroots, "all", ["tree"]).drop("all").withColumnRenamed("pos", "place"))
    n_trees = placed.count()
    top = leaves.sparkSession.range(1).select(
        F.lit(TOP).alias("tree"), F.lit(n_trees).cast("bigint").alias("n")
    ).withColumn("height", _height(F.col("n")).cast("int"))
    above = grown(
        placed.select(F.lit(TOP).alias("tree"), F.col("place").alias("idx"),
                      F.col("subroot").alias("digest")), top)
    root = None
    if n_trees == 1:
        root = placed.first().subroot
    elif n_trees:
        root = above.orderBy(F.col("level").desc()).first().digest
    return Manifest(
        leaves, placed.withColumn("subroot", F.lower(F.hex("subroot"))), nodes.unionAll(above),
        n_trees, root and bytes(root).hex())


def missing_nodes(places: np.ndarray, n: int) -> list[tuple[int, int]]:
    """The least set of (level, idx) that, with the leaves at ``places``, yields the root of ``n``."""
    have, level, out = np.unique(places), 0, []
    while n > 1:
        up = np.unique(have // ARITY)
        runs = (up[:, None] * ARITY + np.arange(ARITY)).ravel()
        runs = runs[runs < n]
        out += [(level, int(i)) for i in np.setdiff1d(runs, have, assume_unique=True)]
        have, n, level = up, -(-n // ARITY), level + 1
    return out


def _missing(n_top: int, block: pa.Table) -> pa.Table:
    tree, number = block.column("tree")[0].as_py(), block.column("block")[0].as_py()
    own = missing_nodes(block.column("pos").to_numpy(), block.column("n")[0].as_py())
    top = missing_nodes(np.array([block.column("place")[0].as_py()]), n_top)
    rows = [(tree, *x) for x in own] + [(TOP, *x) for x in top]
    columns = list(zip(*rows, strict=True)) or [[], [], []]
    return pa.table({
        "of_tree": pa.array([tree] * len(rows), pa.string()),
        "of_block": pa.array([number] * len(rows), pa.int64()),
        "tree": pa.array(columns[0], pa.string()), "level": pa.array(columns[1], pa.int32()),
        "idx": pa.array(columns[2], pa.int64())})


class _Paths:
    """Siblings before and after the nodes above some leaves, level by level.

    Interior nodes are derived once for all the leaves that share them.
    """

    def __init__(self, leaves: dict[int, str], fetched: dict[tuple[int, int], str], n: int):
        self.levels: list[dict[int, tuple[str, str]]] = []
        nodes, level = leaves, 0
        while n > 1:
            sides, above = {}, {}
            for up in sorted({i // ARITY for i in nodes}):
                run = range(up * ARITY, min(up * ARITY + ARITY, n))
                found = [nodes.get(i) or fetched[level, i] for i in run]
                above[up] = digest(*found)
                for k, i in enumerate(run):
                    if i in nodes:
                        sides[i] = ("".join(found[:k]), "".join(found[k + 1 :]))
            self.levels.append(sides)
            nodes, n, level = above, -(-n // ARITY), level + 1

    def steps(self, place: int) -> list[tuple[str, str]]:
        out = []
        for sides in self.levels:
            out.append(sides[place])
            place //= ARITY
        return out


def folded(leaf: str, steps: list[tuple[str, str]]) -> str:
    """The root that a leaf and the siblings on its way lead to."""
    for before, after in steps:
        leaf = digest(before, leaf, after)
    return leaf


def _expanded(n_top: int, keep: list[str], rows: pa.Table, nodes: pa.Table) -> pa.Table:
    """Every leaf's proof and the root that its claimed leaf folds to."""
    fetched: dict[bool, dict[tuple[int, int], str]] = {True: {}, False: {}}
    for tree, level, idx, value in zip(*(nodes.column(c).to_pylist() for c in (
            "tree", "level", "idx", "digest")), strict=True):
        fetched[tree == TOP][level, idx] = value.hex()
    places = rows.column("pos").to_pylist()
    leaves = [x.hex() for x in rows.column("leaf").to_pylist()]
    claims = [x and x.hex() for x in rows.column("claim").to_pylist()]
    if not places:
        subroot, place, n = "", 0, 1
    else:
        subroot, place, n = (rows.column(c)[0].as_py() for c in ("subroot", "place", "n"))
    own = _Paths(dict(zip(places, leaves, strict=True)), fetched[False], n)
    top = _Paths({place: subroot}, fetched[True], n_top).steps(place) if places else []
    proofs, roots = [], []
    for at, leaf, claim in zip(places, leaves, claims, strict=True):
        steps = own.steps(at) + top
        proofs.append(digest(*[x for pair in steps for x in pair]))
        roots.append(folded(claim or leaf, steps))
    out = {c: rows.column(c) for c in keep}
    out |= {"leaf": pa.array(leaves, pa.string()), "subroot": rows.column("subroot"),
            "proof_sha256": pa.array(proofs, pa.string()), "folded_root": pa.array(roots, pa.string())}
    return pa.table(out)


def proven(manifest: Manifest, wanted: DataFrame, keep: list[str]) -> DataFrame:
    """Proofs of the ``wanted`` leaves, any rows of ``manifest.leaves`` with ``claim`` beside them.

    ``claim`` is the leaf that someone asserts (null: the leaf itself); ``folded_root`` is where it
    leads by the manifest's siblings.  Returns the columns ``keep``, leaf, subroot, proof_sha256 (the
    hash of the siblings from leaf to root) and folded_root.
    """
    blocks = manifest.trees.select("tree", "n", "place", "subroot", _numbers())
    rows = wanted.withColumn("block", F.expr(f"pos DIV {BLOCK}")).join(blocks, ["tree", "block"])
    def missing(block: pa.Table) -> pa.Table:
        return _missing(n_top, block)

    def expanded(left: pa.Table, right: pa.Table) -> pa.Table:
        return _expanded(n_top, keep, left, right)

    n_top = manifest.n_trees
    needed = settle(
        rows.select("tree", "block", "pos", "n", "place").groupBy("tree", "block").applyInArrow(
            missing, "of_tree string, of_block bigint, tree string, level int, idx bigint"))
    fetched = needed.join(manifest.stored, ["tree", "level", "idx"])
    kinds = ", ".join(f"`{c}` {wanted.schema[c].dataType.simpleString()}" for c in keep)
    return rows.groupBy("tree", "block").cogroup(
        fetched.groupBy("of_tree", "of_block")
    ).applyInArrow(
        expanded, f"{kinds}, leaf string, subroot string, proof_sha256 string, folded_root string")


def document_leaves(docs: DataFrame) -> DataFrame:
    """Leaves of documents by source, ordered by doc_id, and the claims of tampered copies.

    Tampering takes the newlines out of texts whose doc_id has an even CRC-32.  Null ids come first
    and are never tampered with; equal ids are ordered by their leaves, and rows that are equal in
    all columns have any order, as nothing tells them apart.  Other columns take no part.
    """
    def leaf(text: Column) -> Column:
        return leaf_of(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)

    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    rows = docs.select(
        "doc_id", tree_of(F.col("source")).alias("tree"), leaf(F.col("text")).alias("leaf"),
        F.when(even & F.contains("text", F.lit("\n")), leaf(F.translate("text", "\n", ""))).alias("claim"))
    return settle(numbered(rows, "tree", ["doc_id", "leaf"]))


def dataset_manifest(docs: DataFrame) -> DataFrame:
    """One row per document: leaf, subroot, root, proof_sha256, folded_root and verified.

    Digests are lower-case hexadecimal.  A source with one document has its leaf as subroot; without
    documents there is no row.  A null source is a group of its own, the first one.
    """
    importable(docs.sparkSession)
    manifest = build(document_leaves(docs))
    return proven(manifest, manifest.leaves, ["doc_id"]).select(
        "doc_id", "leaf", "subroot", F.lit(manifest.root).alias("root"), "proof_sha256",
        "folded_root", (F.col("folded_root") == F.lit(manifest.root)).alias("verified"))
