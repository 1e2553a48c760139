"""Token ids in binary files of independent zstandard frames.

Each file holds consecutive documents. A document is one frame, or several if it is very
long; a frame's content is ids as little-endian unsigned 32-bit integers. Two skippable
frames end a file: an index of documents, and the seek table of the public seekable format,
with the sizes and a checksum of every frame. Decoders that know neither still read the
file; readers of this module decompress only the frames of the documents they want, and
raise an error for a frame whose checksum differs.

Files are written by tasks over ranges of doc_id. A file's name is new in each attempt, and
only files of attempts that succeeded are in the manifest, so lost executors cost a retry.

* A null text counts as empty; each document ends with ``end_id``, so no document is empty.
* Null doc_ids come first; rows of one doc_id are ordered by their text's hash and text.
* An empty table gives an empty manifest.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from packetlens.llm.common import slices
from packetlens.llm.pieces import cut, memory

# Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
HAS_CHECKSUMS = 0x80
# Fixed value: a skippable frame of another number holds the index of documents.
INDEX_MAGIC = 0x184D2A50
LEVEL = 3
# Ids per frame at most.
FRAME_IDS = 1 << 26
# Pieces joined to one text, and pieces of one call of the tokenizer.
TOGETHER = 200
AT_ONCE = 20_000
# Fixed value: the sign that stands for a space in the vocabulary of a tokenizer of bytes.
SPACE = "\u0120"
MANIFEST = "shard int, path string, n_docs bigint, n_ids bigint"


def checksum(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


def place(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if ":/" in path else (pafs.LocalFileSystem(), path)


class Writer:
    """Appends documents to one file."""

    def __init__(self, path: str, frame_ids: int = FRAME_IDS):
        fs, where = place(path)
        fs.create_dir(os.path.dirname(where), recursive=True)
        self.out = fs.open_output_stream(where, compression=None)
        self.compress = zstandard.ZstdCompressor(level=LEVEL).compress
        self.frame_bytes, self.table, self.docs, self.n_ids = 4 * frame_ids, [], [], 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append((doc_id is not None, doc_id or 0, len(self.table)))
        self.n_ids += len(ids) // 4
        for start in range(0, max(1, len(ids)), self.frame_bytes):
            part = ids[start:start + self.frame_bytes]
            frame = self.compress(part)
            self.out.write(frame)
            self.table.append((len(frame), len(part), checksum(part)))

    def close(self) -> None:
        index = np.array(self.docs, "<i8").tobytes()
        self.out.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        seek = np.array(self.table, "<u4").tobytes()
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(seek) + 9) + seek)
        self.out.write(struct.pack("<IBI", len(self.table), HAS_CHECKSUMS, SEEKABLE_MAGIC))
        self.out.close()


class Reader:
    """Reads documents of one file by number."""

    def __init__(self, path: str):
        fs, where = place(path)
        self.file = fs.open_input_file(where)
        size = self.file.size()
        frames, flags, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEKABLE_MAGIC or flags != HAS_CHECKSUMS:
            raise ValueError(f"{path} has no seek table with checksums")
        seek_at = size - 9 - 12 * frames
        self.table = np.frombuffer(self.file.read_at(12 * frames, seek_at), "<u4").reshape(-1, 3)
        self.at = np.concatenate([[0], np.cumsum(self.table[:, 0], dtype="i8")])
        index_at = int(self.at[-1])
        magic, length = struct.unpack("<II", self.file.read_at(8, index_at))
        if magic != INDEX_MAGIC:
            raise ValueError(f"{path} has no index of documents")
        self.docs = np.frombuffer(self.file.read_at(length, index_at + 8), "<i8").reshape(-1, 3)
        self.decompress = zstandard.ZstdDecompressor().decompress

    def __len__(self) -> int:
        return len(self.docs)

    def doc_id(self, i: int) -> int | None:
        return int(self.docs[i, 1]) if self.docs[i, 0] else None

    def ids(self, i: int) -> bytes:
        """The ids of document ``i``; only its frames are read."""
        first = int(self.docs[i, 2])
        last = int(self.docs[i + 1, 2]) if i + 1 < len(self.docs) else len(self.table)
        raw = memoryview(self.file.read_at(int(self.at[last] - self.at[first]), int(self.at[first])))
        parts = []
        for k in range(first, last):
            start = int(self.at[k] - self.at[first])
            size = int(self.table[k, 1])
            part = self.decompress(raw[start:start + int(self.table[k, 0])], max_output_size=size)
            if len(part) != size or checksum(part) != self.table[k, 2]:
                raise ValueError(f"frame {k} is damaged")
            parts.append(part)
        return b"".join(parts)


def encoder(tokenizer):
    """A function from pieces to their ids as bytes.

    Pieces that begin with their only space are encoded joined, as they are: a tokenizer of bytes
    that lets white space only begin a token gives a token that begins with a space at the start
    of each and nowhere else. If their number differs, and for pieces without a space, the pieces
    are joined by line feeds, whose token tells where each ends. Others are encoded alone."""
    mark = tokenizer.encode("\n", add_special_tokens=False).ids
    vocabulary = tokenizer.get_vocab(with_added_tokens=True)
    begins = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
    begins[[i for token, i in vocabulary.items() if token.startswith(SPACE)]] = True

    def encoded(texts: list[str]) -> np.ndarray:
        found = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return np.fromiter(chain.from_iterable(e.ids for e in found), "<u4")

    def alone(piece: str) -> bytes:
        return np.array(tokenizer.encode(piece, add_special_tokens=False).ids, "<u4").tobytes()

    def by_spaces(pieces: list[str]) -> list[bytes]:
        ids = encoded(["".join(pieces[i:i + TOGETHER]) for i in range(0, len(pieces), TOGETHER)])
        starts = np.flatnonzero(begins[ids])
        if len(starts) != len(pieces) or starts[0] != 0:
            return by_lines(pieces)
        raw, at = ids.tobytes(), [*(4 * starts).tolist(), 4 * len(ids)]
        return [raw[i:j] for i, j in pairwise(at)]

    def by_lines(pieces: list[str]) -> list[bytes]:
        out = []
        for start in range(0, len(pieces), TOGETHER):
            part = pieces[start:start + TOGETHER]
            ids = encoded(["\n".join(part)])
            ends = np.append(np.flatnonzero(ids == mark[0]), len(ids)) if len(mark) == 1 else ()
            if len(ends) == len(part):
                raw, begin = ids.tobytes(), 0
                for end in ends.tolist():
                    out.append(raw[4 * begin:4 * end])
                    begin = end + 1
            else:
                out += map(alone, part)
        return out

    def encode(pieces: list[str]) -> list[bytes]:
        spaced, plain, out = [], [], {}
        for p in pieces:
            if not p or p[-1].isspace() or "\n" in p:
                out[p] = alone(p)
            elif p[0] == " " and p.rfind(" ") == 0 and not p[1].isspace():
                spaced.append(p)
            else:
                plain.append(p)
        for start in range(0, len(spaced), AT_ONCE):
            part = spaced[start:start + AT_ONCE]
            out.update(zip(part, by_spaces(part), strict=True))
        out.update(zip(plain, by_lines(plain), strict=True))
        return [out[p] for p in pieces]

    return encode


def write_token_files(docs: DataFrame, path: str, tokenizer_file: str, end_id: int) -> None:
    """Encode ``text`` and write files in ascending doc_id order below ``path``, with their
    manifest in ``path/manifest``."""
    tie = F.xxhash64("text")
    ordered = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").repartitionByRange(
        "doc_id", tie).sortWithinPartitions("doc_id", tie, "text")

    def write(batches: Iterator[pa.RecordBatch]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        known = memory(f"ids {tokenizer_file}", lambda: encoder(Tokenizer.from_file(tokenizer_file)))
        end, shard, writer = struct.pack("<I", end_id), TaskContext.get().partitionId(), None
        name = f"{path}/shard-{shard:06d}-{uuid.uuid4().hex[:8]}.zst"
        for batch in batches:
            for part in slices(batch, "text"):
                writer = writer or Writer(name)
                pieces = [cut(t or "") for t in part["text"].to_pylist()]
                known.learn(chain.from_iterable(pieces))
                for doc_id, text in zip(part["doc_id"].to_pylist(), pieces, strict=True):
                    writer.add(doc_id, b"".join(map(known.__getitem__, text)) + end)
        if writer:
            writer.close()
            yield pa.RecordBatch.from_pylist([{
                "shard": shard, "path": name, "n_docs": len(writer.docs), "n_ids": writer.n_ids}],
                pa.schema([("shard", pa.int32()), ("path", pa.string()),
                           ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    ordered.mapInArrow(write, MANIFEST).write.parquet(f"{path}/manifest")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, path and number
    in its file of every document, from the files."""
    manifest = spark.read.parquet(f"{path}/manifest")
    # One row per file, so the running sum is over few rows.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start"))
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
              ("ids_crc32", pa.int64()), ("path", pa.string()), ("number", pa.int64())]

    def read(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for row in batch.to_pylist():
                reader, start, out = Reader(row["path"]), row["start"], []
                for i in range(len(reader)):
                    ids = reader.ids(i)
                    out.append((reader.doc_id(i), start, len(ids) // 4, zlib.crc32(ids), row["path"], i))
                    start += len(ids) // 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, (_, t) in zip(zip(*out, strict=True), fields, strict=True)],
                    [n for n, _ in fields])

    return files.repartition(max(1, manifest.count())).mapInArrow(
        read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, path string, number bigint")
