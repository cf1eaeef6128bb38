"""Token ids in seekable zstandard files (operator 9).

A file is a row of independent zstandard frames of little-endian unsigned 32-bit ids, a
skippable frame with the document index, and the public seekable format's trailing table: the
compressed size, size and checksum (low 32 bits of XXH64) of every frame.  A reader finds a
document in the index and decompresses only the frames that hold it.
"""

from __future__ import annotations

import os
import struct
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docketflow.llm.frames import mapped, settle
from docketflow.llm.piece_arrays import BARE, WORD, WordTable, give_back, ids_of, led_piece
from docketflow.llm.pieces import library_ids
from docketflow.llm.shared_files import new_folder, opened, written
from docketflow.llm.token_counts import byte_characters

# Magic numbers of the public skippable and seekable formats.
INDEX_MAGIC, SEEK_MAGIC, FOOTER_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
CHECKSUMS = 0x80

FRAME_BYTES, FILE_BYTES = 1 << 20, 1 << 30
#: Bytes of text handled together, and of words remembered with their ids.
TEXT_BYTES, WORD_BYTES = 4 << 20, 32 << 20
_NO_ID = np.iinfo(np.int64).min


@lru_cache(maxsize=2)
def text_encoder(path: str) -> WordTable:
    """The ids of pieces by the byte-level tokenizers file at ``path``.

    The library's model encodes each distinct run of letters once, and the whole library what is no word.
    """
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    line = tokenizer.encode("\n", add_special_tokens=False).ids[0]
    chars, model = dict(enumerate(byte_characters())), tokenizer.model

    def alone(piece: str) -> bool:  # where a line break before or after could change the cut
        return "\n" in piece or "<|" in piece or piece[:2].isspace()

    def compute(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        # Letters, also with a space before them, are one pre-token, which the model encodes.
        letters = pc.match_substring_regex(words, f"^{WORD}$")
        rest = [led_piece(k) for k in words.filter(pc.invert(letters)).to_pylist()]
        others = iter(library_ids(tokenizer, rest, "\n", line, alone))
        ids, ends = array("I"), []
        for word, known in zip(words.to_pylist(), letters.to_pylist(), strict=True):
            if known:
                start, word = ("", word[1:]) if word[0] == BARE else (chars[32], word)
                if not word.isascii():
                    word = word.encode().decode("latin-1").translate(chars)
                ids.extend([t.id for t in model.tokenize(start + word)])
            else:
                ids.extend(np.frombuffer(next(others), "<u4").tolist())
            ends.append(len(ids))
        return np.array(ids, "<u4"), np.array(ends, np.int64)

    return WordTable(compute, WORD_BYTES)


class TokenWriter:
    """Writes one file; documents are appended in order."""

    def __init__(self, out):
        self.out, self.table, self.ids, self.sizes = out, [], [], []
        self.held: list[bytes] = []
        self.waiting = self.tokens = self.written = 0
        self.packer = zstandard.ZstdCompressor(level=3, write_checksum=True)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.ids.append(_NO_ID if doc_id is None else doc_id)
        self.sizes.append(len(ids) // 4)
        self.tokens += len(ids) // 4
        self.held.append(ids)
        self.waiting += len(ids)
        if self.waiting >= FRAME_BYTES:
            self._frames()

    def _frames(self) -> None:
        data = b"".join(self.held)
        for lo in range(0, len(data), FRAME_BYTES):
            raw = data[lo : lo + FRAME_BYTES]
            self._put(self.packer.compress(raw), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF)
        self.held, self.waiting = [], 0

    def _put(self, frame: bytes, size: int, checksum: int) -> None:
        self.out.write(frame)
        self.written += len(frame)
        self.table.append(struct.pack("<3I", len(frame), size, checksum))

    def close(self) -> None:
        self._frames()
        index = self.packer.compress(
            struct.pack("<Q", len(self.ids)) + np.array(self.ids, "<i8").tobytes()
            + np.array(self.sizes, "<i8").tobytes())
        self._put(struct.pack("<2I", INDEX_MAGIC, len(index)) + index, 0, 0)
        table = b"".join(self.table) + struct.pack("<IBI", len(self.table), CHECKSUMS, FOOTER_MAGIC)
        self.out.write(struct.pack("<2I", SEEK_MAGIC, len(table)) + table)


class TokenFile:
    """Reads one file; ``frames`` counts the frames decompressed so far."""

    def __init__(self, source):
        self.source, self.frames = source, 0
        self.unpacker = zstandard.ZstdDecompressor()
        end = source.size()
        count, flags, magic = struct.unpack("<IBI", self._at(end - 9, 9))
        if magic != FOOTER_MAGIC or flags != CHECKSUMS:
            raise ValueError("no seek table")
        rows = np.frombuffer(self._at(end - 9 - 12 * count, 12 * count), "<u4").reshape(-1, 3)
        packed, raw, self.checksums = rows.astype(np.int64).T
        self.packed = np.concatenate([[0], np.cumsum(packed)])
        self.raw = np.concatenate([[0], np.cumsum(raw)])
        last = len(packed) - 1
        index = self._at(self.packed[last], packed[last])
        if struct.unpack("<I", index[:4])[0] != INDEX_MAGIC:
            raise ValueError("no document index")
        index = self.unpacker.decompress(index[8:])
        n = struct.unpack("<Q", index[:8])[0]
        self.ids = np.frombuffer(index, "<i8", n, 8)
        self.sizes = np.frombuffer(index, "<i8", n, 8 + 8 * n)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def _at(self, offset: int, size: int) -> bytes:
        self.source.seek(int(offset))
        return self.source.read(int(size))

    def _frame(self, i: int) -> bytes:
        self.frames += 1
        raw = self.unpacker.decompress(self._at(self.packed[i], self.packed[i + 1] - self.packed[i]))
        if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.checksums[i]:
            raise ValueError(f"frame {i} fails its checksum")
        return raw

    def read(self, rows: Iterable[int]) -> Iterator[tuple[int, bytes]]:
        """(row, ids) of the documents at ``rows`` of the index, in ascending order."""
        at, data = -1, b""
        for row in rows:
            lo, hi, parts = 4 * self.starts[row], 4 * (self.starts[row] + self.sizes[row]), []
            while lo < hi:
                i = int(np.searchsorted(self.raw, lo, "right")) - 1
                if i != at:
                    at, data = i, self._frame(i)
                part = data[lo - self.raw[i] : hi - self.raw[i]]
                parts.append(part)
                lo += len(part)
            yield row, b"".join(parts)


def _file_writer(folder: str, path: str, end_id: int) -> Callable:
    end = struct.pack("<I", end_id)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, part, nth = text_encoder(path), TaskContext.get().partitionId(), 0

        def documents() -> Iterator[tuple[int | None, bytes]]:
            for batch in batches:
                names = iter(batch.column(0).to_pylist())
                for ids, bounds in ids_of(batch.column(1), True, store, TEXT_BYTES):
                    raw = ids.tobytes()
                    for lo, hi in zip((4 * bounds[:-1]).tolist(), (4 * bounds[1:]).tolist(), strict=True):
                        yield next(names), raw[lo:hi]
            store.forget()
            give_back()

        rows, done = documents(), False
        row = next(rows, None)
        while row is not None:
            uri = f"{folder}/ids-{part:06d}-{nth:04d}.u32.zst"
            with written(uri) as out:
                writer = TokenWriter(out)
                while row is not None and writer.written < FILE_BYTES:
                    writer.add(row[0], row[1] + end)
                    row = next(rows, None)
                writer.close()
            yield pa.RecordBatch.from_pylist(
                [{"part": part, "nth": nth, "path": uri, "docs": len(writer.ids),
                  "tokens": writer.tokens}],
                pa.schema([("part", pa.int64()), ("nth", pa.int64()), ("path", pa.string()),
                           ("docs", pa.int64()), ("tokens", pa.int64())]))
            nth += 1

    return run


def write_tokens(docs: DataFrame, path: str, end_id: int, parts: int | None = None) -> DataFrame:
    """Write all documents in ascending doc_id order; the files' manifest is returned.

    Manifest: path, docs, tokens, first (ids in all files before it).  Null and empty texts have
    the end id alone.  Rows without an id come first; rows that share one are ordered by
    text.  Special strings in a text are read as the library does by default.  No document,
    no file.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "token-files")
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    )
    files = settle(mapped(
        rows, _file_writer(folder, path, end_id),
        "part bigint, nth bigint, path string, docs bigint, tokens bigint"))
    before = Window.orderBy("part", "nth").rowsBetween(Window.unboundedPreceding, -1)  # a row a file
    first = F.coalesce(F.sum("tokens").over(before), F.lit(0))
    return files.withColumn("first", first).select("path", "docs", "tokens", "first")


def _file_reader(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            with opened(row["path"]) as source:
                file = TokenFile(source)
                digests = np.fromiter(
                    (zlib.crc32(x) for _, x in file.read(range(len(file.ids)))), np.int64,
                    len(file.ids))
            yield pa.RecordBatch.from_arrays(
                [pa.array(file.ids, mask=file.ids == _NO_ID), pa.array(row["first"] + file.starts),
                 pa.array(file.sizes), pa.array(digests), pa.array([row["path"]] * len(file.ids)),
                 pa.array(np.arange(len(file.ids)))],
                names=["doc_id", "start", "n_tokens", "ids_crc32", "path", "nth"])


def read_digests(manifest: DataFrame) -> DataFrame:
    """Read all files: (doc_id, start, n_tokens, ids_crc32, path, nth) per document."""
    manifest = settle(manifest)
    files = manifest.repartition(max(1, manifest.count()))
    return mapped(
        files, _file_reader,
        "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, path string, nth bigint")


def _fetch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at: dict[str, list[int]] = {}
        for row in batch.to_pylist():
            at.setdefault(row["path"], []).append(row["nth"])
        for path, rows in at.items():
            with opened(path) as source:
                file = TokenFile(source)
                for row, ids in file.read(sorted(set(rows))):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([path]), pa.array([row]),
                         pa.array([np.frombuffer(ids, "<i4")], pa.list_(pa.int32()))],
                        names=["path", "nth", "ids"])


def fetch_tokens(places: DataFrame) -> DataFrame:
    """(path, nth, ids) of the documents at ``places`` (path, nth); other frames stay packed."""
    places = places.select("path", "nth").distinct().repartition("path", F.expr("nth div 4096"))
    return mapped(places.sortWithinPartitions("path", "nth"), _fetch,
                  "path string, nth bigint, ids array<int>")
