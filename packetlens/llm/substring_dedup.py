"""Word windows that stand more than once, found by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words of one text. Its minimiser is the least hash among
its runs of ``GRAM`` words. Consecutive windows with one minimiser are a super-k-mer: they
travel as one packed string to the bucket of their minimiser, where all equal windows meet.
A bucket sorts its windows, compares the texts of those with equal hashes, and returns for
each packed string which of its words repeated windows cover. Texts find the answers to their
own packed strings by digest, so a string that a third of all texts share travels a few times
per task, not once per text.

Runs of words that are very frequent (``heavy_grams``) order last, so a passage that many texts
share does not draw the differing windows around it into one group. The strings left with a
frequent minimiser are copies, and their answers are spread over ``SALTS`` keys.

* Words are runs of characters other than space and \\t to \\r, taken unchanged; a null text has
  none. A text of fewer than ``WINDOW`` words has no window.
* Windows are judged on the input: a removed word still counts for other windows. Of repeated
  passages every copy goes, the first too. Repeated rows are texts of their own.
* Extra columns are passed through under any name; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from packetlens.llm.common import fresh, gathered, slices, stored
from packetlens.llm.words import rolled, word_table

WINDOW = 35
# Words of a minimiser.
GRAM = 5
# Windows of one packed string at most; a longer run is cut, which loses no window.
LONGEST = 128
# A run of words is heavy from this part of all words on, so at most 2^18 are.
HEAVY_SHARE = 2.0**-18
HEAVY_LEAST = 1000
HEAVY_BIT = np.uint64(1 << 63)
SALTS = 64
# Bytes of text packed at a time, and of packed strings that a bucket is meant to hold.
TOGETHER = 8 << 20
BUCKET_BYTES = 16 << 20
BUCKETS = 128
# Packed strings sent at least twice that a task remembers.
REMEMBERED = 200_000
LEVEL = 6
RESULT = "n_words bigint, n_removed bigint, kept string"


def _minimisers(h: np.ndarray, heavy: np.ndarray) -> np.ndarray:
    """The least of the runs in each window, heavy ones last."""
    g = rolled(h, GRAM) >> np.uint64(1)
    if len(heavy):
        g[_among(g, heavy)] |= HEAVY_BIT
    width, least, size = WINDOW - GRAM + 1, g, 1
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    rest = width - size
    return np.minimum(least[:len(least) - rest], least[rest:]) if rest else least


def _among(g: np.ndarray, known: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(known, g), len(known) - 1)
    return known[at] == g


def super_kmers(
    texts: list, heavy: np.ndarray
) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of all texts as bytes with one space after each, and of each super-k-mer the
    start and end of its bytes, its minimiser, its text's number, and its first word there."""
    h, counts, data, at = word_table(texts)
    none = np.zeros(0, "i8")
    if len(h) < WINDOW:
        return data.tobytes(), none, none, np.zeros(0, "u8"), none, none
    least = _minimisers(h, heavy)
    text = np.repeat(np.arange(len(counts)), counts)
    n = len(h) - WINDOW + 1
    first = np.flatnonzero(text[:n] == text[WINDOW - 1:])
    if not len(first):
        return data.tobytes(), none, none, np.zeros(0, "u8"), none, none
    value, owner = least[first], text[first]
    new = np.ones(len(first), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    begin = np.flatnonzero(new)
    run = np.arange(len(first)) - np.repeat(begin, np.diff(np.append(begin, len(first))))
    begin = np.flatnonzero(run % LONGEST == 0)
    last = np.append(begin[1:], len(first)) - 1
    word = np.cumsum(counts) - counts
    return (data.tobytes(), at[first[begin]], at[first[last] + WINDOW] - 1, value[begin],
            owner[begin], first[begin] - word[owner[begin]])


def heavy_grams(texts: DataFrame) -> tuple[np.ndarray, int]:
    """The sorted hashes of runs of ``GRAM`` words that are a good part of the corpus, and the
    number of all words. Each run of batches gives up its own rare ones, so a run of words
    evenly spread just above the share may be missed; that moves work, not results."""

    def count(batches: Iterator[pa.RecordBatch]):
        for batch in gathered(batches, "text", TOGETHER):
            for part in slices(batch, "text"):
                h, counts, _, _ = word_table(part["text"].to_pylist())
                grams, n = np.zeros(0, "u8"), np.zeros(0, "i8")
                if len(h) >= GRAM:
                    text = np.repeat(np.arange(len(counts)), counts)
                    inside = text[:len(h) - GRAM + 1] == text[GRAM - 1:]
                    grams, n = np.unique((rolled(h, GRAM) >> np.uint64(1))[inside], return_counts=True)
                often = n >= max(4, len(h) >> 14)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.append(grams[often].astype("i8"), -1)),
                     pa.array(np.append(n[often], len(h)).astype("i8"))], ["gram", "n"])

    found = texts.mapInArrow(count, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    found = stored(found, "heavy-grams")
    words = (found.where("gram = -1").agg(F.sum("n")).first()[0]) or 0
    most = found.where("gram >= 0").where(F.col("n") >= max(HEAVY_LEAST, words * HEAVY_SHARE))
    return np.sort(np.asarray(most.select("gram").toArrow()["gram"], "i8").astype("u8")), words


def _packed(texts: DataFrame, shared, buckets: int) -> DataFrame:
    """One row per bucket and run of batches: its distinct packed strings, one a line, and a
    byte for each that tells whether it stood there twice."""

    def pack(batches: Iterator[pa.RecordBatch]):
        heavy, press, sent = shared.value, zstandard.ZstdCompressor(level=LEVEL), set()
        for batch in gathered(batches, "text", TOGETHER):
            for part in slices(batch, "text", TOGETHER):
                data, start, end, least, _, _ = super_kmers(part["text"].to_pylist(), heavy)
                bucket = (least % np.uint64(buckets)).astype("i8")
                order = np.argsort(bucket, kind="stable")
                edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=buckets))
                start, end, out = start[order].tolist(), end[order].tolist(), []
                for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                    times: dict[bytes, int] = {}
                    for i in range(a, b):
                        s = data[start[i]:end[i]]
                        times[s] = times.get(s, 0) + 1
                    for s in [s for s, n in times.items() if n > 1]:
                        key = xxhash.xxh3_128_digest(s)
                        if key in sent:
                            del times[s]
                        else:
                            sent.add(key)
                    if times:
                        twice = bytes(n > 1 for n in times.values())
                        out.append((int(bucket[order[a]]), press.compress(b"\n".join(times)), twice))
                if len(sent) > REMEMBERED:
                    sent.clear()
                for i in range(0, len(out), 64):
                    columns = zip(*out[i:i + 64], strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.binary()), strict=True)],
                        ["bucket", "packed", "twice"])

    return texts.mapInArrow(pack, "bucket bigint, packed binary, twice binary")


def repeated_windows(strings: list[bytes], twice: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of windows inside ``strings``: each one's string, its first word there, and whether its
    words stand in another window too, or its string is marked in ``twice``."""
    hashes, counts = [], []
    start, size = 0, 0
    for i, s in enumerate(strings):
        size += len(s)
        if size >= 1 << 20 or i == len(strings) - 1:
            h, n, _, _ = word_table(strings[start:i + 1])
            hashes.append(h)
            counts.append(n)
            start, size = i + 1, 0
    if not hashes:
        return np.zeros(0, "i8"), np.zeros(0, "i8"), np.zeros(0, bool)
    h, counts = np.concatenate(hashes), np.concatenate(counts)
    del hashes
    windows = np.maximum(counts - WINDOW + 1, 0)
    owner = np.repeat(np.arange(len(strings)), windows)
    word = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    place = np.repeat(np.cumsum(counts) - counts, windows) + word
    keys = rolled(h, WINDOW)[place]
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    head = np.ones(len(order), bool)
    head[1:] = ordered[1:] != ordered[:-1]
    group = np.cumsum(head) - 1
    sizes = np.bincount(group)
    leader = np.empty(len(order), "i8")
    leader[order] = order[np.flatnonzero(head)][group]
    again = np.empty(len(order), bool)
    again[order] = (sizes > 1)[group]
    # Equal hashes must be equal words: runs of windows that follow a run of leaders are
    # compared as one stretch of text.
    own = np.flatnonzero(leader != np.arange(len(order)))
    if len(own):
        lead = leader[own]
        new = np.ones(len(own), bool)
        new[1:] = ((np.diff(own) != 1) | (np.diff(lead) != 1)
                   | (owner[own][1:] != owner[own][:-1]) | (owner[lead][1:] != owner[lead][:-1]))
        at = np.flatnonzero(new)
        length = np.diff(np.append(at, len(own))) + WINDOW - 1
        split: dict[int, list[bytes]] = {}
        last = -1
        for i, j, n in zip(own[at].tolist(), lead[at].tolist(), length.tolist(), strict=True):
            a, b = int(owner[i]), int(owner[j])
            if a != last:
                split, last = {a: strings[a].split(b" ")}, a
            if b not in split:
                split[b] = strings[b].split(b" ")
            p, q = int(word[i]), int(word[j])
            if split[a][p:p + n] != split[b][q:q + n]:
                return owner, word, _by_words(strings, owner, word) | twice[owner]
    return owner, word, again | twice[owner]


def _by_words(strings: list[bytes], owner: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Whether each window's words stand twice, by the words themselves (hashes collided)."""
    split = [s.split(b" ") for s in strings]
    rows = [b" ".join(split[i][p:p + WINDOW]) for i, p in zip(owner.tolist(), word.tolist(), strict=True)]
    times: dict[bytes, int] = {}
    for r in rows:
        times[r] = times.get(r, 0) + 1
    return np.array([times[r] > 1 for r in rows], bool)


def _covered(packed: DataFrame, shared) -> DataFrame:
    """Digest of a packed string, salt, and a stretch of its words that repeated windows cover."""
    schema = "digest binary, salt int, start int, stop int"
    fields = to_arrow_schema(StructType.fromDDL(schema))

    def search(rows: pa.Table) -> pa.Table:
        heavy, unpack = shared.value, zstandard.ZstdDecompressor()
        strings, twice = [], []
        for blob, marks in zip(rows["packed"], rows["twice"], strict=True):
            strings += unpack.decompress(blob.as_py()).split(b"\n")
            twice.append(np.frombuffer(marks.as_py(), bool))
        owner, word, again = repeated_windows(strings, np.concatenate(twice))
        owner, word = owner[again], word[again]
        new = np.ones(len(owner), bool)
        new[1:] = (np.diff(owner) != 0) | (np.diff(word) != 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(owner)) - 1
        stretches: dict[bytes, list] = {}
        held, key, done = -1, b"", set()
        for i, a, b in zip(owner[first].tolist(), word[first].tolist(), word[last].tolist() if len(owner) else [],
                           strict=True):
            if i != held:
                # The same string came from several runs of batches: once is enough.
                held, key = i, xxhash.xxh3_128_digest(strings[i])
                if key not in done:
                    done.add(key)
                    stretches[key] = [i]
            if stretches[key][0] == i:
                stretches[key].append((a, b + WINDOW))
        out = []
        keys = list(stretches)
        least = [_minimisers(word_table([strings[stretches[k][0]]])[0], heavy)[0] for k in keys] if len(heavy) else []
        for n, key in enumerate(keys):
            salts = range(SALTS) if len(heavy) and least[n] & HEAVY_BIT else (0,)
            out += [(key, salt, a, b) for salt in salts for a, b in stretches[key][1:]]
        columns = zip(*out, strict=True) if out else [[]] * 4
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], schema=fields)

    return packed.groupBy("bucket").applyInArrow(search, schema)


def _places(texts: DataFrame, shared) -> DataFrame:
    """Where each packed string stands: its digest and salt, the row, and its first word."""
    schema = "digest binary, salt int, id bigint, row bigint, word int"

    def place(batches: Iterator[pa.RecordBatch]):
        heavy = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                data, start, end, least, owner, first = super_kmers(part["text"].to_pylist(), heavy)
                digests = [xxhash.xxh3_128_digest(data[a:b]) for a, b in zip(start.tolist(), end.tolist(), strict=True)]
                row = np.asarray(part["row"], "i8")[owner]
                salt = np.where(least & HEAVY_BIT != 0, row % SALTS, 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digests, pa.binary()), pa.array(salt, pa.int32()), part["id"].take(pa.array(owner)),
                     pa.array(row), pa.array(first, pa.int32())], ["digest", "salt", "id", "row", "word"])

    return texts.mapInArrow(place, schema)


def _row_key(doc_id: str, text: str):
    """Rows with one key have one doc_id and text, so what holds for one holds for all."""
    return F.xxhash64(F.col(doc_id), F.col(text))


def remove_repeats(docs: DataFrame) -> tuple[DataFrame, str]:
    """All columns and a struct of n_words, n_removed and kept (the words left, with one space
    between them), whose column name is returned as well."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("id"), "text", _row_key("doc_id", "text").alias("row"))
    heavy, words = heavy_grams(texts.select("text"))
    shared = spark.sparkContext.broadcast(heavy)
    # Packed strings take about three times the text.
    buckets = max(BUCKETS, 20 * words // BUCKET_BYTES)
    packed = _packed(texts.select("text"), shared, buckets)
    covered = stored(_covered(packed, shared), "covered")
    held = F.struct((F.col("word") + F.col("start")).alias("a"), (F.col("word") + F.col("stop")).alias("b"))
    hits = _places(texts, shared).join(covered, ["digest", "salt"]).groupBy("id", "row").agg(
        F.collect_set(held).alias("hits"))
    row, id_, cover = (fresh(docs.columns, n) for n in ("row", "id", "cover"))
    keyed = docs.withColumns({row: _row_key("doc_id", "text")})
    hits = hits.select(F.col("id").alias(id_), F.col("row").alias(row), F.col("hits").alias(cover))
    joined = keyed.join(
        hits, (keyed[row] == hits[row]) & keyed["doc_id"].cast("bigint").eqNullSafe(hits[id_]), "left"
    ).select(*[keyed[c] for c in docs.columns],
             F.transform(cover, lambda s: s["a"]).alias(f"{cover}_a"), F.transform(cover, lambda s: s["b"]).alias(f"{cover}_b"))
    return _without(joined, docs, f"{cover}_a", f"{cover}_b")


def _without(rows: DataFrame, docs: DataFrame, starts: str, stops: str) -> tuple[DataFrame, str]:
    name = fresh(docs.columns, "repeats")
    kind = StructType.fromDDL(RESULT)
    fields = list(to_arrow_schema(kind))
    schema = StructType([*docs.schema.fields]).add(name, kind)
    passed = docs.columns

    def cut(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in slices(batch, "text"):
                _, counts, data, at = word_table(part["text"].to_pylist())
                base = np.cumsum(counts) - counts
                change = np.zeros(int(counts.sum()) + 1, "i8")
                for column, step in ((starts, 1), (stops, -1)):
                    size = np.nan_to_num(np.asarray(part[column].value_lengths(), "f8")).astype("i8")
                    where = np.repeat(base, size) + np.asarray(part[column].flatten(), "i8")
                    np.add.at(change, where, step)
                gone = np.cumsum(change[:-1]) > 0
                left = data[np.repeat(~gone, np.diff(at))].tobytes()
                before = np.concatenate([[0], np.cumsum(gone)])
                size = np.concatenate([[0], np.cumsum(np.where(gone, 0, np.diff(at)))])
                ends = np.cumsum(counts)
                kept = [left[a:max(a, b - 1)] for a, b in zip(size[base].tolist(), size[ends].tolist(), strict=True)]
                columns = [pa.array(counts), pa.array(before[ends] - before[base]),
                           pa.array(kept, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(
                    [*[part[c] for c in passed], pa.StructArray.from_arrays(columns, fields=fields)],
                    [*passed, name])

    return rows.mapInArrow(cut, schema), name
