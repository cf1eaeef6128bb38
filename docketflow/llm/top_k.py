"""Exact top-k search by pivot-table elimination (operator 4).

Inner products become distances by one more component: with M the largest norm,
x' = (x, sqrt(M^2 - |x|^2)) and q' = (q, 0) give |q' - x'|^2 = |q|^2 + M^2 - 2 q.x.  The
distances of all rows to many pivots are computed once and stored; the triangle inequality then
bounds every distance from below by the largest |d(q, p) - d(x, p)| over the pivots, and so every
score from above.  A query's candidates are evaluated in the order of their bounds, and the search
stops where the next bound is below the k-th score found.  Rows and queries are stored in
blocks, near each other by pivot; pairs of blocks whose bound rules them out never meet.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketflow.llm.frames import mapped, settle

SCALE = 256.0
#: Rows drawn (by hash) for pivots and first thresholds, pivots, rows of a block.
SAMPLE, PIVOTS = 1024, 32
ROW_BLOCK, QUERY_BLOCK = 4096, 256
CHUNK = 128
_EXACT = float(1 << 53)


def vectors(rows: DataFrame) -> DataFrame:
    """(vec_id, x array<double>) of whole numbers floor(256 * component).

    Vectors that are null, or hold null, infinite or NaN components, take no part, nor do rows
    without an id.
    """
    x = F.col("embedding").cast("array<double>")
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return (
        rows.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
        .where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & finite)
        .select("vec_id", F.transform("x", lambda c: _floor(SCALE * c)).alias("x"))
    )


def _floor(c: Column) -> Column:
    """Floor of a double as a double, for magnitudes beyond a long too."""
    return F.when(F.abs(c) < 2.0**52, F.floor(c).cast("double")).otherwise(c)


def _matrix(lists: pa.ListArray, width: int) -> np.ndarray:
    """Rows of one width; missing components are zero."""
    offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
    size = np.diff(offsets)
    out = np.zeros((len(size), width))
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(offsets[0], offsets[-1]) - np.repeat(offsets[:-1], size)] = \
        values[offsets[0] : offsets[-1]]
    return out


class Space:
    """The pivots, in the space with one more component."""

    def __init__(self, sample: np.ndarray, sample_ids: np.ndarray, largest: float, k: int):
        self.width, self.largest, self.k = sample.shape[1], largest, k
        self.sample, self.sample_ids = sample, sample_ids
        rows = self.lifted(sample)
        chosen, far = [0], np.full(len(rows), np.inf)
        while len(chosen) < min(PIVOTS, len(rows)):  # farthest first
            far = np.minimum(far, ((rows - rows[chosen[-1]]) ** 2).sum(1))
            if far.max() <= 0:
                break
            chosen.append(int(far.argmax()))
        self.pivots = rows[chosen]

    def lifted(self, x: np.ndarray) -> np.ndarray:
        rest = np.maximum(self.largest - (x * x).sum(1), 0)
        return np.concatenate([x, np.sqrt(rest)[:, None]], 1)

    def distances(self, lifted: np.ndarray) -> np.ndarray:
        square = (lifted**2).sum(1)[:, None] + (self.pivots**2).sum(1) - 2 * lifted @ self.pivots.T
        return np.sqrt(np.maximum(square, 0))

    def of_rows(self, x: np.ndarray) -> np.ndarray:
        return self.distances(self.lifted(x))

    def of_queries(self, q: np.ndarray) -> np.ndarray:
        return self.distances(np.concatenate([q, np.zeros((len(q), 1))], 1))

    def slack(self) -> float:
        """Room for rounding in squared distances."""
        return 1 + 1e-6 * self.largest

    def first_thresholds(self, q: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """A score that each query's k-th best is known to reach, from the sampled rows."""
        if len(self.sample) <= self.k:
            return np.full(len(q), -np.inf)
        scores = q @ self.sample.T
        scores[ids[:, None] == self.sample_ids[None, :]] = -np.inf
        best = np.partition(scores, -self.k, axis=1)[:, -self.k]
        return best - 1e-9 * np.abs(best) - 1


_BLOCK = ("block bigint, ids binary, x binary, dist binary, lo array<double>, hi array<double>, "
          "floor double, norm double")


def _blocker(space: Space, queries: bool, size: int) -> Callable:
    def block(nth: int, ids: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
        dist = space.of_queries(x) if queries else space.of_rows(x)
        floor = space.first_thresholds(x, ids) if queries else np.zeros(1)
        raw = ids.astype("<i8").tobytes() + (floor.astype("<f8").tobytes() if queries else b"")
        return pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId() << 32 | nth]), pa.array([raw], pa.binary()),
             pa.array([x.tobytes()], pa.binary()),
             pa.array([(dist if queries else dist.T).tobytes()], pa.binary()),  # rows: a pivot each
             pa.array([dist.min(0)], pa.list_(pa.float64())),
             pa.array([dist.max(0)], pa.list_(pa.float64())),
             pa.array([float(floor.min())]), pa.array([float((x * x).sum(1).max())])],
            names=["block", "ids", "x", "dist", "lo", "hi", "floor", "norm"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nth, ids, x = 0, np.zeros(0, np.int64), np.zeros((0, space.width))
        for batch in batches:
            ids = np.concatenate([ids, batch.column("vec_id").to_numpy()])
            x = np.concatenate([x, _matrix(batch.column("x"), space.width)])
            while len(ids) >= size:
                yield block(nth, ids[:size], x[:size])
                nth, ids, x = nth + 1, ids[size:], x[size:]
        if len(ids):
            yield block(nth, ids, x)

    return run


def _nearest(space: Space) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dist = space.of_rows(_matrix(batch.column("x"), space.width))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("x"),
                 pa.array(dist.argmin(1).astype(np.int64) if len(dist) else [], pa.int64())],
                names=["vec_id", "x", "cell"])

    return run


def _blocks(rows: DataFrame, count: int, space: Space, queries: bool, size: int) -> DataFrame:
    """Blocks of rows near the same pivot; a pivot with very many rows fills several."""
    parts = max(1, -(-count // (4 * size)))
    near = mapped(rows, _nearest(space), "vec_id bigint, x array<double>, cell bigint")
    near = near.repartitionByRange(parts, "cell", "vec_id").sortWithinPartitions("cell", "vec_id")
    return settle(mapped(near, _blocker(space, queries, size), _BLOCK))


def _exact_scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    if float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * len(q) < _EXACT:
        return x @ q
    whole = [sum(int(a) * int(b) for a, b in zip(row, q, strict=True)) for row in x]
    return np.array(whole, object)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores, ties to the smaller id, in order."""
    if len(scores) > 4 * k and scores.dtype != object:  # rows below the k-th score cannot be among them
        at = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
        scores, ids = scores[at], ids[at]
    order = np.argsort(ids, kind="stable")
    order = order[np.argsort(-scores[order], kind="stable")][:k]
    return scores[order], ids[order]


def search_block(q: np.ndarray, q_id: int, q_dist: np.ndarray, floor: float, x: np.ndarray,
                 ids: np.ndarray, dist: np.ndarray, space: Space,
                 evaluated: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Scores and ids of the k best rows of a block that can reach ``floor``, exactly.

    ``dist`` has a row for each pivot.
    """
    bound = np.zeros(len(ids))
    for of_rows, of_query in zip(dist, q_dist, strict=True):
        np.maximum(bound, np.abs(of_rows - of_query), out=bound)
    own = float(q @ q)
    most = (own + space.largest - bound**2) / 2 + space.slack() + 1e-6 * own
    order = np.flatnonzero((most >= floor) & (ids != q_id))
    order = order[np.argsort(-most[order], kind="stable")]
    scores, found = np.zeros(0), np.zeros(0, np.int64)
    lo, step = 0, CHUNK
    while lo < len(order):
        at = order[lo : lo + step]
        if len(found) == space.k and most[at[0]] < scores[-1]:
            break
        if evaluated is not None:
            evaluated[0] += len(at)
        scores, found = _best(
            np.concatenate([scores, _exact_scores(x[at], q)]), np.concatenate([found, ids[at]]), space.k)
        lo, step = lo + step, 2 * step
    return scores, found


def _searcher(space: Space) -> Callable:
    low, high = -(1 << 63), (1 << 63) - 1

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                q_block, q_raw, q_x, q_dist, raw, x, dist = (c[row].as_py() for c in batch.columns)
                qs = np.frombuffer(q_x).reshape(-1, space.width)
                q_ids = np.frombuffer(q_raw, "<i8", len(qs))
                floors = np.frombuffer(q_raw, "<f8", len(qs), 8 * len(qs))
                q_dist = np.frombuffer(q_dist).reshape(len(qs), -1)
                xs = np.frombuffer(x).reshape(-1, space.width)
                ids, dist = np.frombuffer(raw, "<i8"), np.frombuffer(dist).reshape(-1, len(xs))
                out: list[tuple[int, int, int, int, int]] = []
                for i in range(len(qs)):
                    found = search_block(qs[i], q_ids[i], q_dist[i], floors[i], xs, ids, dist, space)
                    out += [(q_block, i, int(q_ids[i]), v, min(max(int(s), low), high))
                            for s, v in zip(*(c.tolist() for c in found), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else [[]] * 5)],
                    names=["q_block", "q_row", "query_id", "vec_id", "score"])

    return run


def top_k(rows: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest integer inner products per query.

    Queries are the rows of ``rows`` (vec_id, embedding) whose vec_id is divisible by ``every``;
    candidates are all rows with another vec_id.  Ties go to the smaller vec_id.  Rows as in
    ``vectors``; vectors of different lengths are compared with zeros for what is missing;
    repeated rows are candidates each, and a repeated query gets a list each.  Scores beyond a
    long are cut to its limits.  Other columns are ignored; an empty table gives no rows.
    """
    all_rows = settle(vectors(rows))
    size = F.aggregate("x", F.lit(0.0), lambda a, c: a + c * c)
    count, width, largest = all_rows.agg(
        F.count("*"), F.max(F.size("x")), F.max(size)).first()
    empty = "query_id bigint, rank int, vec_id bigint, score bigint"
    if not count:
        return rows.sparkSession.createDataFrame([], empty)
    width = max(1, width)
    # A bounded sample, SAMPLE rows however many there are; every row is indexed below.
    drawn = all_rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow()
    sample = _matrix(drawn.column("x").combine_chunks(), width)
    space = Space(sample, drawn.column("vec_id").to_numpy(), largest, k)
    asked = all_rows.where(F.col("vec_id") % every == 0)
    n_asked = asked.count()
    queries = _blocks(asked, n_asked, space, True, QUERY_BLOCK)
    blocks = _blocks(all_rows, count, space, False, ROW_BLOCK)
    # Pairs of blocks: narrow descriptions first, then only the pairs that can hold a result.
    n_blocks = blocks.count()
    number = F.row_number().over(Window.orderBy("block")) - 1
    described = blocks.select(number.alias("n"), "block", "lo", "hi")  # a row a block
    wanted = queries.select(
        F.col("block").alias("q_block"), F.col("lo").alias("q_lo"), F.col("hi").alias("q_hi"),
        "floor", "norm", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("n"))
    apart = F.greatest(
        F.lit(0.0), F.array_max(F.zip_with("lo", "q_hi", lambda a, b: a - b)),
        F.array_max(F.zip_with("q_lo", "hi", lambda a, b: a - b)))
    reach = (F.col("norm") * (1 + 2e-6) + F.lit(largest) - apart * apart) / 2 + F.lit(space.slack())
    pairs = settle(
        wanted.join(described, "n").where(reach >= F.col("floor")).select("q_block", "block"))
    heavy = (
        pairs.join(queries.select(
            F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("x").alias("q_x"),
            F.col("dist").alias("q_dist")), "q_block")
        .join(blocks.select("block", "ids", "x", "dist"), "block")
        .select("q_block", "q_ids", "q_x", "q_dist", "ids", "x", "dist")
    )
    found = mapped(heavy, _searcher(space),
                   "q_block bigint, q_row bigint, query_id bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("q_block", "q_row").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
