"""Byte-level BPE encoding and decoding through a serialised sentencepiece model (operator 8).

The rank file becomes a sentencepiece BPE model without training: every token, its bytes
written as printable characters, is a piece whose score is its negative rank, and
normalisation is the identity.  Pre-tokens are encoded by it; ids are decoded by the inverse
mapping, as one gather over the bytes of all tokens.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketflow.llm.frames import mapped
from docketflow.llm.pieces import PieceCache, id_bytes, id_lists, led_words, parts, texts_of
from docketflow.llm.token_counts import byte_characters

# Field numbers and types of the public sentencepiece model format.
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_PIECE, _SCORE, _TYPE, _UNKNOWN = 1, 2, 3, 2
_MODEL_TYPE, _BPE, _UNK_ID, _BOS_ID, _EOS_ID, _PAD_ID = 3, 2, 40, 41, 42, 43
_NAME, _DUMMY_PREFIX, _EXTRA_SPACES, _ESCAPE_SPACES = 1, 3, 4, 5


def _varint(n: int) -> bytes:
    out = bytearray()
    n &= (1 << 64) - 1
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _bytes(field: int, data: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(data)) + data


def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def serialised_model(ranks: dict[bytes, int]) -> bytes:
    """The model file: pieces in the order of their ranks, the unknown piece last."""
    chars = byte_characters()
    out = []
    for at, (token, rank) in enumerate(sorted(ranks.items(), key=lambda x: x[1])):
        if at != rank:
            raise ValueError("ranks must be 0, 1, 2, ... without gaps")
        piece = _bytes(_PIECE, "".join(chars[b] for b in token).encode())
        score = _varint(_SCORE << 3 | 5) + struct.pack("<f", -float(rank))
        out.append(_bytes(_PIECES, piece + score))
    unknown = len(ranks)
    out.append(_bytes(_PIECES, _bytes(_PIECE, b"<unk>") + _number(_TYPE, _UNKNOWN)))
    trainer = _number(_MODEL_TYPE, _BPE) + _number(_UNK_ID, unknown)
    trainer += b"".join(_number(x, -1) for x in (_BOS_ID, _EOS_ID, _PAD_ID))
    plain = _bytes(_NAME, b"identity")
    plain += b"".join(_number(x, 0) for x in (_DUMMY_PREFIX, _EXTRA_SPACES, _ESCAPE_SPACES))
    return b"".join([*out, _bytes(_TRAINER, trainer), _bytes(_NORMALIZER, plain)])


class PieceCoder:
    """Encodes texts and decodes ids with the ranks at ``path`` and a splitting pattern."""

    def __init__(self, path: str, pattern: str):
        import sentencepiece

        self.ranks = ranks_of(path)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialised_model(self.ranks))
        self.pattern = regex.compile(pattern)
        self.chars = {b: c for b, c in enumerate(byte_characters())}
        self.cache = PieceCache(self.encode_pieces)
        tokens = sorted(self.ranks, key=self.ranks.get)
        self.sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        tokens = [self.pattern.findall(x) for x in pieces]
        known: dict[str, bytes] = {}
        unknown = []
        for token in {t for x in tokens for t in x}:
            rank = self.ranks.get(token.encode())
            if rank is None:
                unknown.append(token)
            else:
                known[token] = struct.pack("<I", rank)
        mapped_ = [t.encode().decode("latin-1").translate(self.chars) for t in unknown]
        for token, ids in zip(unknown, self.model.encode(mapped_, num_threads=1), strict=True):
            known[token] = struct.pack(f"<{len(ids)}I", *ids)
        return [known[x[0]] if len(x) == 1 else b"".join([known[t] for t in x]) for x in tokens]

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        return id_bytes(texts, led_words, self.cache)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of a sequence of ids."""
        size = self.sizes[ids]
        ends = np.cumsum(size)
        if not len(ids):
            return np.zeros(0, np.uint8)
        return self.data[np.arange(ends[-1]) + np.repeat(self.starts[ids] - (ends - size), size)]


@lru_cache(maxsize=2)
def coder(path: str, pattern: str) -> PieceCoder:
    return PieceCoder(path, pattern)


def _encoder(path: str, pattern: str) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path, pattern)
        for batch in parts(batches):
            ids = id_lists(own.encode(texts_of(batch.column(1))))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["doc_id", "ids"])

    return run


def encoded(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids array<int>) for every row of ``docs`` (doc_id, text).

    Null and empty texts have no ids; null and repeated doc_ids are kept as they come; other
    columns are ignored.  Strings of special tokens are ordinary text.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return mapped(docs.select("doc_id", "text"), _encoder(path, pattern),
                  f"doc_id {kind}, ids array<int>")


def _decoder(path: str, pattern: str) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(path, pattern)
        for batch in parts(batches):
            lists = batch.column(1)
            offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy()
            out = [own.decode(values[lo:hi]).tobytes()
                   for lo, hi in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), lists, pa.array(out, pa.binary())],
                names=["doc_id", "ids", "decoded"])

    return run


def decoded(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """``rows`` (doc_id, ids) with the bytes that the ids stand for; null ids are no ids."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    rows = rows.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return mapped(rows, _decoder(path, pattern),
                  f"doc_id {kind}, ids array<int>, decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): digests of the ids and of what they decode to."""
    rows = decoded(encoded(docs, path, pattern), path, pattern)
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
