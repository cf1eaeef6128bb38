"""Small Spark helpers shared by the operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketflow.session import settle

__all__ = ["components", "importable", "mapped", "settle", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it, as in local runs.

    On a cluster the package is installed or shipped, and the extra path does no harm.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [x for x in env.get("PYTHONPATH", "").split(os.pathsep) if x]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])
    return spark


def mapped(
    df: DataFrame,
    fn: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """Arrow batches of ``df`` through ``fn``."""
    return df.mapInArrow(fn, schema)


#: Edges that one task contracts at a time.
PIECE = 1_000_000


def _smaller(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("low"), F.greatest(a, b).alias("high")]


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("low", "high"))).first())


def contracted(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same components as stars: (smallest node, other node)."""
    nodes, at = np.unique(np.concatenate([low, high]), return_inverse=True)
    a, b = at[: len(low)], at[len(low) :]
    root = np.arange(len(nodes))
    while True:
        least = np.minimum(root[a], root[b])
        apart = root[a] != root[b]
        if not apart.any():
            break
        np.minimum.at(root, root[a][apart], least[apart])
        np.minimum.at(root, root[b][apart], least[apart])
        while (root[root] != root).any():
            root = root[root]
    leaf = root != np.arange(len(nodes))
    return nodes[root[leaf]], nodes[leaf]


def _contract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    if rows:
        low, high = contracted(*(np.concatenate(x) for x in zip(*rows, strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(low), pa.array(high)], names=["low", "high"])


def _star_round(now: DataFrame) -> DataFrame:
    """Hang every node's larger neighbours, then its smaller ones, on its smallest.

    Minima are aggregates with map-side reduction, and are written before they are joined, so
    that Spark can split the join of a hub of any size.
    """
    both = now.select(F.col("low").alias("u"), F.col("high").alias("v")).unionAll(
        now.select(F.col("high").alias("u"), F.col("low").alias("v"))
    )
    least = settle(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
    large = settle(
        now.join(least, now.low == least.u)
        .select(F.col("m").alias("low"), "high").distinct()
    )
    least = settle(large.groupBy("high").agg(F.min("low").alias("m")))
    return settle(
        large.join(least, "high")
        .select(F.col("m").alias("low"), F.explode(F.array("low", "high")).alias("high"))
        .where("low < high").distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root): for every node of ``edges`` (a, b), the smallest node it can reach.

    Each pass contracts the edges in pieces of ``PIECE``, a task each; the passes end when one
    piece held them all, or when a round of stars between the pieces changes nothing more.  Every
    step works on a written table.  Self-loops and null ends are ignored.
    """
    now = settle(edges.where("a <> b").select(*_smaller("a", "b")).distinct())
    before = _state(now)
    while True:
        pieces = -(-before[0] // PIECE) or 1
        now = settle(mapped(now.coalesce(pieces), _contract, "low bigint, high bigint"))
        if pieces == 1:
            break
        now = _star_round(now)
        after = _state(now)
        if after == before:
            break
        before = after
    return settle(now.select(F.col("high").alias("node"), F.col("low").alias("root")).unionAll(
        now.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
    ))
