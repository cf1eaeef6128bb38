"""Token counts by rank-synchronous merging of arrays (operator 3).

The pre-tokens of a batch are ragged numpy arrays of symbol ids.  In every round each sequence
applies its own lowest-ranked pair, at all places at once, until no sequence has a pair left;
the surviving symbols are counted.  A token made by a merge can only take part in merges of
higher rank, so this is the order in which the library merges.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketflow.llm.frames import mapped
from docketflow.llm.pieces import PieceCache, solid_words, texts_of, together

OVER_LIMIT = 2048
_NONE = np.int64(1) << 40


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(other)) for b in range(256)]


class RankMerger:
    """Counts the tokens of pre-tokens with the merges of a tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        pairs = np.array([(vocab[a], vocab[b]) for a, b in model["merges"]], np.int64)
        merged = np.array([vocab[a + b] for a, b in model["merges"]], np.int64)
        keys = pairs[:, 0] << 32 | pairs[:, 1]
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.merged = keys[order], order.astype(np.int64), merged
        chars = byte_characters()
        self.inner = np.array([vocab[c] for c in chars], np.int64)
        self.last = np.array([vocab[c + end] for c in chars], np.int64)
        library = Tokenizer.from_file(path)
        self.normalise, self.split_by_library = library.normalizer, library.pre_tokenizer
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(pattern)
        special = [x["content"] for x in spec["added_tokens"]]
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")")
        self.cache = PieceCache(self.count_words)

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE)

    def count(self, tokens: list[bytes]) -> np.ndarray:
        """Symbols left of each pre-token (none is empty)."""
        data = np.frombuffer(b"".join(tokens), np.uint8)
        size = np.fromiter(map(len, tokens), np.int64, len(tokens))
        left = size.copy()
        ends = np.cumsum(size)
        symbol = self.inner[data]
        symbol[ends - 1] = self.last[data[ends - 1]]
        owner = np.repeat(np.arange(len(tokens)), size)
        rank = np.full(len(symbol), _NONE)
        inside = np.flatnonzero(owner[:-1] == owner[1:])
        rank[inside] = self._rank(symbol[inside], symbol[inside + 1])
        while len(symbol):
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            count = np.diff(np.append(starts, len(owner)))
            best = np.minimum.reduceat(rank, starts)
            live = best < _NONE
            if not live.all():  # finished sequences leave the arrays
                left[owner[starts[~live]]] = count[~live]
                keep = np.repeat(live, count)
                symbol, owner, rank = symbol[keep], owner[keep], rank[keep]
                best, count = best[live], count[live]
                if not len(symbol):
                    break
            hit = np.flatnonzero(rank == np.repeat(best, count))
            # In a run of overlapping places every second one is merged, from the left.
            begin = np.concatenate([[True], hit[1:] != hit[:-1] + 1])
            nth = np.arange(len(hit)) - np.flatnonzero(begin)[np.cumsum(begin) - 1]
            hit = hit[nth % 2 == 0]
            symbol[hit] = self.merged[rank[hit]]
            keep = np.ones(len(symbol), bool)
            keep[hit + 1] = False
            at = hit - np.arange(len(hit))  # places after the gaps are closed
            symbol, owner, rank = symbol[keep], owner[keep], rank[keep]
            for i in (at, at[at > 0] - 1):
                rank[i] = _NONE
                i = i[i + 1 < len(symbol)]
                i = i[owner[i] == owner[i + 1]]
                rank[i] = self._rank(symbol[i], symbol[i + 1])
        return left

    def pre_tokens(self, words: list[str]) -> list[list[bytes]]:
        """Pre-tokens of words without white space and special strings."""
        simple = [w.lower() if w.isascii() else None for w in words]
        wide = [i for i, w in enumerate(simple) if w is None]
        together_ = self.normalise.normalize_str(" ".join(words[i] for i in wide)).split(" ")
        if wide and len(together_) != len(wide):
            together_ = [self.normalise.normalize_str(words[i]) for i in wide]
        for i, word in zip(wide, together_, strict=False):
            simple[i] = word
        out = []
        for word in simple:
            if word.isascii() or max(word) < "ɐ":
                out.append([x.encode() for x in self.pattern.findall(word)])
            else:  # rare scripts: the library's own idea of letters and numbers
                found = self.split_by_library.pre_tokenize_str(word)
                out.append([bytes(_BYTES[c] for c in x) for x, _ in found])
        return out

    def count_words(self, words: list[str]) -> list[int]:
        counts = np.zeros(len(words), np.int64)
        plain, owner = [], []
        for i, word in enumerate(words):
            if "<|" in word:
                parts = self.special.split(word)
                counts[i] += len(parts) // 2
                parts = [x for x in parts[::2] if x]
                plain += parts
                owner += [i] * len(parts)
            else:
                plain.append(word)
                owner.append(i)
        tokens = self.pre_tokens(plain)
        flat = [t for x in tokens for t in x]
        if flat:
            distinct = list(dict.fromkeys(flat))
            known = dict(zip(distinct, self.count(distinct).tolist(), strict=True))
            at = np.repeat(np.array(owner, np.int64), [len(x) for x in tokens])
            np.add.at(counts, at, [known[t] for t in flat])
        return counts.tolist()


_BYTES = {c: b for b, c in enumerate(byte_characters())}


@lru_cache(maxsize=2)
def merger(path: str) -> RankMerger:
    """One merger, with its cache, for all tasks of a Python worker."""
    return RankMerger(path)


def _counter(path: str) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = merger(path)
        for batch in batches:
            counts = [np.zeros(0, np.int64)]
            for values, bounds in together(texts_of(batch.column(1)), solid_words, ranks.cache):
                total = np.concatenate([[0], np.cumsum(np.array(values, np.int64))])
                counts.append(total[bounds[1:]] - total[bounds[:-1]])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(np.concatenate(counts))],
                names=["doc_id", "n_bytes", "n_tokens"])

    return run


def token_counts(docs: DataFrame, path: str, over: int = OVER_LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs`` (doc_id, text).

    Counts are those of the tokenizers library for the file at ``path`` without added tokens;
    special strings inside a text count as one token.  Null and empty texts have zeros; null and
    repeated ids are kept as they come; other columns are ignored.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(
        "doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    counted = mapped(rows, _counter(path), f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > over)
