"""Quality rules by repetition coverage (operator 6).

Rolling hashes of several n-gram lengths mark every word inside an n-gram that its text holds
more than once, and every line that repeats an earlier one; the rules measure how much of the
text those words and lines cover.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketflow.llm.arrays import Slice, counts_before, mixed, per_row, repeated, slices
from docketflow.llm.frames import mapped

#: Per n, the largest share (percent) of the characters of words in repeated n-grams.
GRAM_LIMITS = {5: 25, 6: 24, 7: 23, 8: 22, 9: 21, 10: 20}
#: The largest share (percent) of the characters in lines that repeat an earlier line.
LINE_LIMIT = 30
MIN_WORDS, MAX_REPEAT_WORDS = 10, 20
SYMBOLS = "#*$%&|<>"

GRAMS = tuple(sorted(GRAM_LIMITS))
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars")
GRAM_COLUMNS = tuple(f"dup_chars_{n}" for n in GRAMS)
_SYMBOL = np.isin(np.arange(256), np.frombuffer(SYMBOLS.encode(), np.uint8))


def covered_words(part: Slice, n: int, rows: np.ndarray | None = None) -> np.ndarray:
    """Flags of the words inside n-word windows that occur twice or more in their text."""
    first = part.windows(n)
    if rows is not None:
        first = first[rows[part.word_rows[first]]]
    row = part.word_rows[first].astype(np.uint64)
    more, _ = repeated(part.gram_hashes(first, first + n) ^ mixed(row + np.uint64(1)))
    steps = np.zeros(len(part.starts) + 1, np.int64)
    steps[first[more]] += 1
    steps[first[more] + n] -= 1
    return np.cumsum(steps)[:-1] > 0


def slice_signals(part: Slice) -> dict[str, np.ndarray]:
    word = ~part.space
    chars = counts_before(word & ((part.data & 0xC0) != 0x80))
    word_chars = chars[part.ends] - chars[part.starts]
    texts, starts, ends = part.lines
    full = chars[ends] > chars[starts]
    texts, starts, ends = texts[full], starts[full], ends[full]
    _, later = repeated(part.hashes(starts, ends) ^ mixed(texts.astype(np.uint64) + np.uint64(1)))
    out = {
        "n_words": np.diff(part.word_bounds),
        "word_chars": chars[part.bounds[1:]] - chars[part.bounds[:-1]],
        "n_symbols": per_row(_SYMBOL[part.data], part.bounds),
        "n_dup_lines": np.bincount(texts[later], minlength=part.rows),
        "dup_line_chars": np.bincount(
            texts[later], (chars[ends] - chars[starts])[later], minlength=part.rows
        ).astype(np.int64),
    }
    rows = None
    for n in sorted({5, *GRAMS}):
        inside = covered_words(part, n, rows)
        if n == 5:
            out["n_repeat_words"] = per_row(inside, part.word_bounds)
            rows = out["n_repeat_words"] > 0  # a longer repeat holds a repeat of five words
        if n in GRAMS:
            out[f"dup_chars_{n}"] = per_row(np.where(inside, word_chars, 0), part.word_bounds)
    return out


def _signals(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = (*COUNTS, *GRAM_COLUMNS)
    for batch in batches:
        out = np.zeros((len(names), batch.num_rows), np.int64)
        for part in slices(batch.column(1)):
            found = slice_signals(part)
            for i, name in enumerate(names):
                out[i, part.first : part.first + part.rows] = found[name]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(x) for x in out)], names=["doc_id", *names]
        )


def signals(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of counts per row of ``docs``: the key and the columns COUNTS and GRAM_COLUMNS.

    A null or blank text has zeros.  Repeated rows and null keys are kept as they come; other
    columns of ``docs`` are ignored, so their names cannot clash.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{x} bigint" for x in (*COUNTS, *GRAM_COLUMNS))
    return mapped(docs.select(F.col(key).alias("doc_id"), text), _signals, schema)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_WORDS * F.col("n_words")
    )


def covered_too_much() -> Column:
    over = 100 * F.col("dup_line_chars") > LINE_LIMIT * F.col("word_chars")
    for n, limit in GRAM_LIMITS.items():
        over |= 100 * F.col(f"dup_chars_{n}") > limit * F.col("word_chars")
    return over


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Signals with ``base_failed`` and ``kept``."""
    return (
        signals(docs, key, text)
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & ~covered_too_much())
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass; all columns of ``docs`` are returned unchanged.

    The verdict is computed beside the row itself, so nothing is shuffled and rows with equal
    or null ids are judged one by one.
    """
    schema = docs.schema
    where = schema.fieldNames().index("text")
    limits = {**{f"dup_chars_{n}": x for n, x in GRAM_LIMITS.items()}, "dup_line_chars": LINE_LIMIT}

    def passing(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            for part in slices(batch.column(where)):
                x = slice_signals(part)
                ok = (x["n_words"] >= MIN_WORDS) & (
                    100 * x["n_repeat_words"] <= MAX_REPEAT_WORDS * x["n_words"]
                )
                for name, limit in limits.items():
                    ok &= 100 * x[name] <= limit * x["word_chars"]
                good[part.first : part.first + part.rows] = ok
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(passing, schema)
