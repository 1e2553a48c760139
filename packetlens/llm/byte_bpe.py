"""Byte-level byte-pair encoding and decoding with two tiers.

A minimal perfect hash over the vocabulary resolves pre-tokens that are tokens themselves.
Others are merged pair by pair: bytes are linked both ways, and a heap gives the pair of
least rank, leftmost first, in O(n log n) for n bytes. Ids and ranks are one number.

* A null text counts as empty: no ids, and the digests of nothing. Repeated rows are encoded
  alike; extra columns are passed through, and a column added beside one of its name gets a longer
  name. An empty table gives an empty result.
* Strings that look like special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StructField, StructType

from packetlens.llm.common import fresh, map_texts
from packetlens.llm.pieces import cut, memory

# Pieces remembered by one Python process.
REMEMBERED = 1_000_000
# Keys per bucket of the perfect hash.
BUCKET = 2
# Displacements tried at a time.
TRIES = np.arange(1, 129, dtype="u8")
SPREAD = np.uint64(0x9E3779B97F4A7C15)
SCHEMA = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class PerfectHash:
    """Maps n keys to the slots 0..n-1, each to its own (hash and displace)."""

    def __init__(self, keys: list[bytes]):
        n = self.n = len(keys)
        self.buckets = max(1, n // BUCKET)
        hashes = self.hashes(keys)
        members: list[list[int]] = [[] for _ in range(self.buckets)]
        for i, b in enumerate((hashes % np.uint64(self.buckets)).tolist()):
            members[b].append(i)
        self.displace = np.zeros(self.buckets, "i8")
        taken = np.zeros(n, bool)
        self.slot_of = np.zeros(n, "i8")
        for b in sorted(range(self.buckets), key=lambda b: -len(members[b])):
            own = members[b]
            if len(own) < 2:
                break
            mine, d = hashes[own], TRIES
            while True:
                slots = self._slots(mine, d[:, None])
                fits = ~taken[slots].any(1) & (np.diff(np.sort(slots, 1), axis=1) > 0).all(1)
                if fits.any():
                    break
                d = d + np.uint64(len(TRIES))
            best = int(fits.argmax())
            d, slots = int(d[best]), slots[best]
            taken[slots] = True
            self.displace[b], self.slot_of[own] = d, slots
        free = np.flatnonzero(~taken).tolist()
        for b in range(self.buckets):
            if len(members[b]) == 1:
                # A bucket of one key names its slot.
                slot = free.pop()
                self.displace[b], self.slot_of[members[b][0]] = -slot - 1, slot
        self.keys: list[bytes] = [b""] * n
        for key, slot in zip(keys, self.slot_of.tolist(), strict=True):
            self.keys[slot] = key

    @staticmethod
    def hashes(keys: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), "u8", len(keys))

    def _slots(self, hashes: np.ndarray, d: np.ndarray) -> np.ndarray:
        mixed = (hashes ^ (d * SPREAD)) * SPREAD
        return ((mixed >> np.uint64(32)) % np.uint64(max(1, self.n))).astype("i8")

    def find(self, keys: list[bytes]) -> np.ndarray:
        """The slot of each key, or -1 for a key that is not in the set."""
        if not self.n or not keys:
            return np.full(len(keys), -1)
        hashes = self.hashes(keys)
        d = self.displace[(hashes % np.uint64(self.buckets)).astype("i8")]
        slots = np.where(d < 0, -d - 1, self._slots(hashes, np.maximum(d, 0).astype("u8")))
        own = self.keys
        same = [own[s] == k for s, k in zip(slots.tolist(), keys, strict=True)]
        return np.where(same, slots, -1)


class Codec:
    """A vocabulary of byte strings by rank, and the pattern that splits texts."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, pattern
        self.name = hashlib.sha256(repr((pattern, sorted(ranks.items()))).encode()).hexdigest()
        tokens = list(ranks)
        self.whole = PerfectHash(tokens)
        self.id_of_slot = np.zeros(len(tokens), "i8")
        self.id_of_slot[self.whole.slot_of] = list(ranks.values())
        self.token_of = {i: t for t, i in ranks.items()}

    def merge(self, word: bytes) -> tuple[int, ...]:
        """The ids of a pre-token that is no token."""
        rank_of, n = self.ranks.get, len(word)
        end = list(range(1, n + 1))  # where the part that starts here ends; 0 when merged away
        before = list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := rank_of(word[i:i + 2])) is not None]
        heapify(heap)
        while heap:
            rank, i = heappop(heap)
            j = end[i]
            # A pair is stale once either part has changed: its rank differs then.
            if not j or j == n or rank_of(word[i:end[j]]) != rank:
                continue
            k = end[i] = end[j]
            end[j] = 0
            if k < n:
                before[k] = i
                if (r := rank_of(word[i:end[k]])) is not None:
                    heappush(heap, (r, i))
            h = before[i]
            if h >= 0 and (r := rank_of(word[h:k])) is not None:
                heappush(heap, (r, h))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[word[i:end[i]]])
            i = end[i]
        return tuple(out)

    def encode_words(self, words: list[bytes]) -> list[tuple[int, ...]]:
        slots = self.whole.find(words)
        ids = self.id_of_slot[np.maximum(slots, 0)].tolist() if self.whole.n else [0] * len(words)
        return [
            (i,) if s >= 0 else self.merge(w)
            for i, s, w in zip(ids, slots.tolist(), words, strict=True)
        ]

    def encoder(self) -> Callable[[list[str]], list[tuple[int, ...]]]:
        """A function from pieces of texts to their ids."""
        matches = regex.compile(self.pattern).findall

        def encode(pieces: list[str]) -> list[tuple[int, ...]]:
            split = [matches(p) for p in pieces]
            distinct = list({w for words in split for w in words})
            ids = dict(zip(distinct, self.encode_words([w.encode() for w in distinct]), strict=True))
            return [
                ids[words[0]] if len(words) == 1 else tuple(chain.from_iterable(map(ids.__getitem__, words)))
                for words in split
            ]

        return encode

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token_of.__getitem__, ids))


def _texts(df: DataFrame, codec: Codec, one: Callable, schema: str, keep: list[str] | None):
    shared = df.sparkSession.sparkContext.broadcast(codec)

    def make():
        own = shared.value
        known = memory(f"bpe {own.name}", own.encoder, REMEMBERED)

        def work(texts):
            pieces = [cut(t or "") for t in texts]
            known.learn(chain.from_iterable(pieces))
            rows = [one(own, list(chain.from_iterable(map(known.__getitem__, text)))) for text in pieces]
            names = [f.split()[0] for f in schema.split(", ")]
            return dict(zip(names, zip(*rows, strict=True), strict=True))

        return work

    return map_texts(df, "text", make, schema, keep)


def encode(docs: DataFrame, codec: Codec) -> tuple[DataFrame, str]:
    """All columns and an array of ids, whose column name is returned as well."""
    ids = fresh(docs.columns, "ids")
    return _texts(docs, codec, lambda own, x: (x,), f"{ids} array<int>", None), ids


def decode(rows: DataFrame, codec: Codec, ids: str) -> tuple[DataFrame, str]:
    """All columns and the bytes that the array ``ids`` stands for (null ids: none), whose
    column name is returned as well."""
    shared = rows.sparkSession.sparkContext.broadcast(codec)
    decoded = fresh(rows.columns, "decoded")
    schema = StructType([*rows.schema.fields, StructField(decoded, BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]):
        own = shared.value
        for batch in batches:
            data = [own.decode(x or ()) for x in batch[ids].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(data, pa.binary())], [*batch.schema.names, decoded])

    return rows.mapInArrow(run, schema), decoded


def round_trip(docs: DataFrame, codec: Codec, keep: list[str]) -> DataFrame:
    """Encode ``text``, decode the ids, and give the digests of both. A piece's ids are decoded
    and written as decimals once while it is remembered; a text is the run of its pieces."""
    shared = docs.sparkSession.sparkContext.broadcast(codec)

    def make():
        own = shared.value
        encode = own.encoder()

        def both_ways(pieces: list[str]) -> list[tuple[int, str, bytes]]:
            return [(len(ids), ",".join(map(str, ids)), own.decode(ids)) for ids in encode(pieces)]

        known = memory(f"bpe both ways {own.name}", lambda: both_ways, REMEMBERED)

        def work(texts):
            pieces = [cut(t or "") for t in texts]
            known.learn(chain.from_iterable(pieces))
            sizes, ids_sha, decoded_sha = [], [], []
            for text in pieces:
                rows = [row for row in map(known.__getitem__, text) if row[0]]
                n, decimals, decoded = zip(*rows, strict=True) if rows else ((), (), ())
                sizes.append(sum(n))
                ids_sha.append(hashlib.sha256(",".join(decimals).encode()).hexdigest())
                decoded_sha.append(hashlib.sha256(b"".join(decoded)).hexdigest())
            return {"n_tokens": sizes, "ids_sha256": ids_sha, "decoded_sha256": decoded_sha}

        return work

    return map_texts(docs, "text", make, SCHEMA, keep)
