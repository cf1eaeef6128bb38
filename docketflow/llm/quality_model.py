"""Quality classifier: a generalised additive model with pairwise interactions (operator 5).

Numbers measured on a text are put into bins.  Boosting goes round the features in turn; each
step fits a tree of at most three leaves to one feature's bins and adds it to that feature's
table.  Then the most promising pairs get small two-way tables in the same way.  A text's score is
the sum of the table cells of its bins.  Labels, language, source and id are no inputs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketflow.llm.arrays import Slice, counts_before, mixed, per_row, repeated, slices
from docketflow.llm.frames import mapped
from docketflow.llm.rules import slice_signals

#: The most labelled rows used for fitting, drawn by hash.
TRAINING_ROWS = 20_000
GOOD = 0.7

BINS, PAIR_BINS, PAIRS = 48, 8, 8
ROUNDS, PAIR_ROUNDS, RATE, RIDGE, LEAF = 120, 60, 0.1, 1.0, 10.0

FEATURES = (
    "log_words", "log_chars", "word_length", "upper_share", "capital_share", "digit_share",
    "symbol_share", "bang_share", "bar_share", "stop_share", "comma_share", "wide_share",
    "distinct_share", "repeat_share", "line_repeat_share", "gram_share", "next_same_share",
    "words_per_line", "words_per_stop", "long_share", "short_share", "entropy", "marked_share",
)


def _class(chars: str) -> np.ndarray:
    return np.isin(np.arange(256), np.frombuffer(chars.encode(), np.uint8))


_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_LOWER = (np.arange(256) >= 97) & (np.arange(256) <= 122)
_DIGIT = (np.arange(256) >= 48) & (np.arange(256) <= 57)
_BANG, _BAR, _STOP, _COMMA = _class("!?"), _class("|"), _class("."), _class(",;:")
_WIDE = np.arange(256) >= 0xC0
_MARK = _class("#*$%&|<>!?~^=+_@/\\{}[]")


def slice_features(part: Slice) -> np.ndarray:
    """A row of FEATURES for each text; every share is 0 where there is nothing to divide."""
    s, n = slice_signals(part), part.rows
    words, chars = s["n_words"].astype(float), s["word_chars"].astype(float)

    def share(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.divide(a, b, out=np.zeros(n), where=b > 0)

    def count(table: np.ndarray) -> np.ndarray:
        return per_row(table[part.data], part.bounds).astype(float)

    upper, lower = count(_UPPER), count(_LOWER)
    lead = counts_before(~part.space & ((part.data & 0xC0) != 0x80))
    length = lead[part.ends] - lead[part.starts]
    first, last = part.data[part.starts], part.data[part.ends - 1]
    row = part.word_rows
    keys = part.word_hashes
    _, again = repeated(keys ^ mixed(row.astype(np.uint64) + np.uint64(1)))
    same = np.zeros(len(keys), bool)
    same[1:] = (keys[1:] == keys[:-1]) & (row[1:] == row[:-1])

    def of_words(flags: np.ndarray) -> np.ndarray:
        return share(per_row(flags, part.word_bounds).astype(float), words)

    texts, starts, ends = part.lines
    lines = np.bincount(texts[lead[ends] > lead[starts]], minlength=n).astype(float)
    size = np.diff(part.bounds)
    letters = np.bincount(np.repeat(np.arange(n), size) * 256 + part.data, minlength=256 * n)
    p = share_rows(letters.reshape(n, 256).astype(float), size)
    entropy = -(p * np.log2(np.where(p > 0, p, 1))).sum(1)
    stops = count(_STOP)
    return np.stack([
        np.log1p(words), np.log1p(chars), share(chars, words), share(upper, upper + lower),
        of_words(_UPPER[first]), share(count(_DIGIT), chars), share(s["n_symbols"], chars),
        share(count(_BANG), chars), share(count(_BAR), chars), share(stops, words),
        share(count(_COMMA), words), share(count(_WIDE), chars), 1 - of_words(again),
        share(s["n_repeat_words"], words), share(s["dup_line_chars"], chars),
        share(s["dup_chars_10"], chars), of_words(same), share(words, lines),
        share(words, stops), of_words(length >= 12), of_words(length <= 2), entropy,
        of_words(_MARK[last]),
    ], 1)


def share_rows(counts: np.ndarray, size: np.ndarray) -> np.ndarray:
    return counts / np.maximum(size, 1)[:, None]


def _cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """The best cut of bins into left and right: gain and the first bin on the right."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl**2 / (hl + RIDGE) + gr**2 / (hr + RIDGE) - g.sum() ** 2 / (h.sum() + RIDGE)
    gain[(hl < LEAF / 10) | (hr < LEAF / 10)] = -1
    if not len(gain):
        return -1, 0
    at = int(gain.argmax())
    return float(gain[at]), at + 1


def shallow_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The steps of a tree of at most three leaves, per bin."""
    edges = [0, len(g)]
    for _ in range(2):
        cuts = [(*_cut(g[a:b], h[a:b]), a) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        gain, at, start = max(cuts)
        if gain <= 1e-9:
            break
        edges = sorted([*edges, start + at])
    out = np.zeros(len(g))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return out


def quadrant_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The steps of the best tree that cuts both features of a pair once."""
    def sums(x: np.ndarray) -> np.ndarray:
        out = np.zeros((x.shape[0] + 1, x.shape[1] + 1))
        out[1:, 1:] = x.cumsum(0).cumsum(1)
        return out

    G, H = sums(g), sums(h)
    a, b = np.arange(1, g.shape[0])[:, None], np.arange(1, g.shape[1])[None, :]
    parts = []
    for S in (G, H):
        tl = S[a, b]
        tr, bl = S[a, -1] - tl, S[-1, b] - tl
        parts.append((tl, tr, bl, S[-1, -1] - tl - tr - bl))
    gain = sum(x**2 / (y + RIDGE) for x, y in zip(*parts, strict=True))
    if not gain.size:
        return np.zeros_like(g)
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    out = np.zeros_like(g)
    for rows in (slice(0, i + 1), slice(i + 1, None)):
        for cols in (slice(0, j + 1), slice(j + 1, None)):
            out[rows, cols] = g[rows, cols].sum() / (h[rows, cols].sum() + RIDGE)
    return out


@dataclass
class AdditiveModel:
    """Intercept, bin edges and tables; ``pairs`` hold (feature, feature, table).

    ``rows`` is the number of rows that it was fitted to.
    """

    rows: int = 0
    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def logits(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        bins = [np.searchsorted(e, x[:, i], "right") for i, e in enumerate(self.edges)]
        for table, at in zip(self.tables, bins, strict=True):
            total += table[at]
        for i, j, table in self.pairs:
            total += table[self.coarse[i][bins[i]], self.coarse[j][bins[j]]]
        return total

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Fit to rows of features and labels 0 or 1; without rows every score is a half."""
    model = AdditiveModel(rows=len(y))
    if not len(y):
        return model
    rate = (y.sum() + 1) / (len(y) + 2)
    model.intercept = float(np.log(rate / (1 - rate)))
    if y.min() == y.max():
        return model
    grid = np.linspace(0, 1, BINS + 1)[1:-1]
    model.edges = [np.unique(np.quantile(x[:, i], grid)) for i in range(x.shape[1])]
    bins = [np.searchsorted(e, x[:, i], "right") for i, e in enumerate(model.edges)]
    size = [len(e) + 1 for e in model.edges]
    model.tables = [np.zeros(n) for n in size]
    f = np.full(len(y), model.intercept)
    for _ in range(ROUNDS):
        for i, at in enumerate(bins):
            p = 1 / (1 + np.exp(-f))
            step = RATE * shallow_tree(
                np.bincount(at, y - p, size[i]), np.bincount(at, p * (1 - p), size[i]))
            model.tables[i] += step
            f += step[at]
    # Coarse bins for pairs: neighbouring bins joined.
    model.coarse = [np.minimum(np.arange(n) * PAIR_BINS // n, PAIR_BINS - 1) for n in size]
    rough = [c[at] for c, at in zip(model.coarse, bins, strict=True)]
    p = 1 / (1 + np.exp(-f))
    cells = PAIR_BINS * PAIR_BINS
    gains = []
    for i in range(len(bins)):
        for j in range(i + 1, len(bins)):
            at = rough[i] * PAIR_BINS + rough[j]
            g, h = np.bincount(at, y - p, cells), np.bincount(at, p * (1 - p), cells)
            gains.append((float((g**2 / (h + LEAF)).sum()), i, j))
    model.pairs = [(i, j, np.zeros((PAIR_BINS, PAIR_BINS))) for _, i, j in sorted(gains)[-PAIRS:]]
    for _ in range(PAIR_ROUNDS):
        for i, j, table in model.pairs:
            at = rough[i] * PAIR_BINS + rough[j]
            p = 1 / (1 + np.exp(-f))
            step = RATE * quadrant_tree(
                np.bincount(at, y - p, cells).reshape(table.shape),
                np.bincount(at, p * (1 - p), cells).reshape(table.shape))
            table += step
            f += step.ravel()[at]
    return model


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that are never learned from; a row without id is none of them."""
    rest = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4
    return F.coalesce(rest == 2, F.lit(False))


def _measured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = np.zeros((batch.num_rows, len(FEATURES)))
        for part in slices(batch.column(0)):
            x[part.first : part.first + part.rows] = slice_features(part)
        yield pa.RecordBatch.from_arrays(
            [batch.column(1), batch.column(2), *(pa.array(c) for c in x.T)],
            names=["doc_id", "quality", *FEATURES])


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> AdditiveModel:
    """Fit on at most ``rows`` labelled documents outside the held-out ones.

    The documents are drawn by the hash of their id, so the draw depends on nothing else.  Null
    ids and labels are left out; of labels for one id the smallest counts, and of texts of one id
    the one with the least (SHA-256, text), a null text as an empty one.
    """
    known = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    # At most ``rows`` rows of two numbers: safe to broadcast.
    named = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(
        F.broadcast(known), "doc_id")
    one = named.withColumn("hash", F.sha2("text", 256)).groupBy("doc_id", "quality").agg(
        F.min(F.struct("hash", "text")).alias("least"))
    texts = one.select(F.col("least.text").alias("text"), "doc_id", "quality")
    kind = docs.schema["doc_id"].dataType.simpleString()
    measured = mapped(texts, _measured, f"doc_id {kind}, quality int, "
                      + ", ".join(f"{x} double" for x in FEATURES))
    found = measured.toArrow().sort_by("doc_id")
    x = np.stack([found.column(name).to_numpy() for name in FEATURES], 1)
    return fit(x, found.column("quality").to_numpy().astype(float))


def text_scores(model: AdditiveModel, column: pa.Array) -> np.ndarray:
    out = np.zeros(len(column))
    for part in slices(column):
        out[part.first : part.first + part.rows] = model.scores(slice_features(part))
    return out


def _scorer(model: AdditiveModel) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(text_scores(model, batch.column(1)))],
                names=["doc_id", "score"])

    return run


def scored(docs: DataFrame, model: AdditiveModel, good: float = GOOD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs`` (doc_id, text).

    Null texts are scored as empty ones; null and repeated ids are kept as they come; other
    columns are ignored.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = mapped(docs.select("doc_id", "text"), _scorer(model), f"doc_id {kind}, score double")
    return rows.select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= good).cast("int").alias("predicted"))


def keep_predicted(docs: DataFrame, model: AdditiveModel, least: float = GOOD) -> DataFrame:
    """The rows of ``docs`` that score ``least`` or more, unchanged and without a shuffle.

    A model without tables, fitted to no rows or to rows of one label alone, can't tell one document
    from another: all rows are kept.
    """
    if not model.tables:
        return docs
    where = docs.schema.fieldNames().index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(text_scores(model, batch.column(where)) >= least))

    return docs.mapInArrow(run, docs.schema)
