"""Benchmark decontamination by greedy string tiling.

Tokens are runs of letters and digits of any script, lower-cased. Runs of ``LEAST`` tokens that
a text shares with a benchmark item join them into pairs. Each pair is tiled: the longest common
runs of tokens that are not marked yet are found by running Karp-Rabin, longest first, and
marked, down to runs of ``LEAST`` tokens. A text is contaminated by an item if the tiles cover
at least ``COVERAGE`` of the item, in whatever order its passages stand.

No pair is missed: tiles that cover so much hold a known number of the item's runs, so a text
that lacks all but that many holds one of the others. The most frequent runs of each item are
those left out (a prefix filter), which keeps phrases that stand everywhere out of the join.
Runs are counted over all texts first. Filters built from the items' runs keep almost all other
runs inside the scan; what they let pass is joined exactly, so neither table is broadcast.

* Null texts and items, and those without a token, match nothing. An item of fewer than
  ``LEAST`` tokens matches where all its tokens stand in a row.
* Equal texts are tiled once and each row is reported; repeated items are reported by item_id.
* Of common runs of one length those first in the item, then in the text, are marked first.
* Empty tables give an empty result; extra columns do not matter.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetlens.llm.common import fresh, slices, stored
from packetlens.llm.words import runs, word_hashes

LEAST = 3
COVERAGE = 0.6
# Bits of a filter per run that it knows, and the most it may have (16 MB).
BITS_PER_SEED = 32
FILTER_BITS = 1 << 27
# Runs of one kind meet in as many tasks.
SALTS = 16
# Bytes of UTF-8 that are in no token: ASCII other than letters and digits.
BETWEEN = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
# Stands between stretches of a text; no token's hash is so large.
BREAK = 1 << 70
Tile = tuple[int, int, int]


def plain(text: str | None) -> str:
    """``text`` lower-cased, with spaces for characters beyond ASCII that are in no token."""
    text = (text or "").lower()
    if not text.isascii():
        odd = [c for c in set(text) if ord(c) > 127 and not c.isalnum()]
        text = text.translate(dict.fromkeys(map(ord, odd), " ")) if odd else text
    return text


def seed_hashes(texts: list[str | None], lengths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of so many tokens, and the text of each."""
    words, counts = word_hashes([plain(t) for t in texts], BETWEEN)
    found = [runs(words, counts, n)[:2] for n in lengths]
    if len(found) == 1:
        return found[0]
    h, text = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(text, kind="stable")
    return h[order], text[order]


def tokens(text: str | None) -> np.ndarray:
    return word_hashes([plain(text)], BETWEEN)[0].astype("i8")


def common_runs(item: list[int], text: list[int], marked: tuple[bytearray, bytearray], length: int,
                ) -> list[Tile]:
    """Longest extensions of common runs of ``length`` unmarked tokens: (length, place in item,
    place in text), by the rolling hashes of the item's runs and then of the text's."""
    base, bits = 1_000_003, (1 << 61) - 1
    top = pow(base, length - 1, bits)

    def rolling(tokens_: list[int], mark: bytearray) -> Iterator[tuple[int, int]]:
        h, n = 0, 0
        for i, t in enumerate(tokens_):
            if mark[i]:
                h, n = 0, 0
                continue
            if n == length:
                h = (h - tokens_[i - length] * top) % bits
                n -= 1
            h = (h * base + t) % bits
            n += 1
            if n == length:
                yield h, i - length + 1

    at: dict[int, list[int]] = defaultdict(list)
    for h, i in rolling(item, marked[0]):
        at[h].append(i)
    found = []
    for h, j in rolling(text, marked[1]):
        for i in at.get(h, ()):
            # Only the leftmost start of a common run is extended.
            if i and j and item[i - 1] == text[j - 1] and not marked[0][i - 1] and not marked[1][j - 1]:
                continue
            k = 0
            while (i + k < len(item) and j + k < len(text) and item[i + k] == text[j + k]
                   and not marked[0][i + k] and not marked[1][j + k]):
                k += 1
            if k >= length:
                found.append((k, i, j))
    return found


def tiles(item: list[int], text: list[int], least: int = LEAST) -> list[Tile]:
    """Greedy string tiling. The search length starts at the item's length and is halved when
    no common run is left; it goes up again when a run is twice as long. Each pass marks the
    longest runs that do not overlap."""
    marked = (bytearray(len(item)), bytearray(len(text)))
    out: list[Tile] = []
    length = max(least, len(item))
    while True:
        found = common_runs(item, text, marked, length)
        longest = max((k for k, _, _ in found), default=0)
        if not found:
            if length == least:
                return out
            length = max(least, length // 2)
        elif longest >= 2 * length:
            length = longest
        else:
            for k, i, j in sorted(t for t in found if t[0] == longest):
                if not any(marked[0][i:i + k]) and not any(marked[1][j:j + k]):
                    marked[0][i:i + k] = marked[1][j:j + k] = b"\1" * k
                    out.append((k, i, j))


def item_table(benchmark: DataFrame) -> DataFrame:
    """item_id, item (a digest), tokens and, by position, the runs of ``LEAST`` tokens, or of
    all if there are fewer. Items without a token are left out."""

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                own = tokens(batch["text"][row].as_py())
                if len(own):
                    seeds = runs(own.astype("u8"), np.array([len(own)]), min(LEAST, len(own)))[0]
                    yield pa.RecordBatch.from_arrays(
                        [batch["item_id"].slice(row, 1), batch["item"].slice(row, 1),
                         pa.array([own], pa.list_(pa.int64())), pa.array([seeds.astype("i8")], pa.list_(pa.int64()))],
                        ["item_id", "item", "tokens", "seeds"])

    rows = benchmark.select("item_id", F.md5("text").alias("item"), "text")
    kind = dict(rows.dtypes)["item_id"]
    return rows.mapInArrow(run, f"item_id {kind}, item string, tokens array<bigint>, seeds array<bigint>")


def seed_filter(seeds: DataFrame) -> np.ndarray:
    """A bit for each of a number of places that follows the number of seeds up to
    ``FILTER_BITS``, packed; set for every seed. Beyond that it lets more pass."""
    n = max(1, seeds.count())
    bits = min(FILTER_BITS, 1 << max(16, (BITS_PER_SEED * n - 1).bit_length()))
    place = F.shiftrightunsigned("seed", 37).bitwiseAND(F.lit(bits - 1))
    words = seeds.select(place.alias("p")).groupBy(F.shiftright("p", 5).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p & 31 as int))")).alias("mask")).toArrow()
    found = np.zeros(bits // 32, "<u4")
    found[np.asarray(words["word"], "i8")] = np.asarray(words["mask"], "i8").astype("u4")
    return found


def passes(bits: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    place = (seeds.astype("u8") >> np.uint64(37)) & np.uint64(32 * len(bits) - 1)
    word = bits[(place >> np.uint64(5)).astype("i8")]
    return (word >> (place & np.uint64(31)).astype("u4")) & np.uint32(1) != 0


def seed_counts(docs: DataFrame, bits: np.ndarray, lengths: list[int]) -> DataFrame:
    """(seed, n): how often runs that pass the filter stand in all texts."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                h, _ = seed_hashes(part["text"].to_pylist(), lengths)
                seeds, n = np.unique(h[passes(shared.value, h)].astype("i8"), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(seeds), pa.array(n.astype("i8"))], ["seed", "n"])

    rows = docs.where(F.col("text").isNotNull()).select("text")
    return rows.mapInArrow(run, "seed bigint, n bigint").groupBy("seed").agg(F.sum("n").alias("n"))


def chosen_seeds(items: DataFrame, counts: DataFrame, coverage: float) -> DataFrame:
    """(seed, item): of each item the rarest runs, so many that a text with none of them cannot
    reach the coverage. ``items`` has each item once."""
    n, m = F.size("tokens"), F.size("seeds")
    # A tile of k tokens holds k - LEAST + 1 runs, at least k / LEAST.
    needed = F.ceil(F.ceil(n * F.lit(coverage) - 1e-9) / F.least(n, F.lit(LEAST)))
    keep = F.greatest(F.lit(1), m - needed + 1)
    spots = items.select("item", keep.alias("keep"), F.posexplode("seeds").alias("place", "seed"))
    ranked = spots.join(counts, "seed", "left").select(
        "item", "keep", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "place", "seed").alias("spot"))
    # A group is one item's runs.
    firsts = ranked.groupBy("item", "keep").agg(F.array_sort(F.collect_list("spot")).alias("spots"))
    return firsts.select("item", F.explode(F.slice("spots", F.lit(1), F.col("keep").cast("int"))).alias("s")).select(
        F.col("s.seed").alias("seed"), "item").distinct()


def seeded_texts(docs: DataFrame, bits: np.ndarray, lengths: list[int]) -> DataFrame:
    """(digest, text, seeds): texts with runs that pass the filter."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                h, text = seed_hashes(part["text"].to_pylist(), lengths)
                hit = passes(shared.value, h)
                h, text = h[hit].astype("i8"), text[hit]
                rows = np.unique(text)
                if not len(rows):
                    continue
                sets = [np.unique(x) for x in np.split(h, np.searchsorted(text, rows[1:]))]
                yield pa.RecordBatch.from_arrays(
                    [part["text"].take(pa.array(rows)), pa.array(sets, pa.list_(pa.int64()))],
                    ["text", "seeds"])

    found = docs.where(F.col("text").isNotNull()).select("text").mapInArrow(
        run, "text string, seeds array<bigint>")
    return found.select(F.md5("text").alias("digest"), "text", "seeds").dropDuplicates(["digest"])


def covered(item: np.ndarray, text: np.ndarray, shingles: np.ndarray, coverage: float) -> list[Tile]:
    """The tiles of a pair; none if the runs of ``LEAST`` tokens that both have, overlapping or
    not, fall short of the coverage. ``shingles`` are the sorted runs of the text. Only stretches
    of the text that consist of the item's tokens are searched."""
    least = min(LEAST, len(item))
    if least == LEAST:
        own = runs(item.astype("u8"), np.array([len(item)]), LEAST)[0]
        both = np.flatnonzero(np.isin(own, shingles))
        reach = np.zeros(len(item), bool)
        for k in range(LEAST):
            reach[both + k] = True
        if reach.sum() / len(item) < coverage:
            return []
    inside = np.isin(text, item)
    edge = np.diff(inside.astype("i1"), prepend=0, append=0)
    stretch: list[int] = []
    for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
        if b - a >= least:
            stretch += text[a:b].tolist()
            stretch.append(BREAK)
    return tiles(item.tolist(), stretch, least)


def _tile(coverage: float):
    """Rows come sorted by text, each text before its items, so a text is read once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = shingles = np.zeros(0, "i8")
        for batch in batches:
            out = []
            for row in range(batch.num_rows):
                if batch["item"][row].as_py() is None:
                    text = tokens(batch["text"][row].as_py())
                    shingles = np.unique(runs(text.astype("u8"), np.array([len(text)]), LEAST)[0])
                    continue
                item = np.asarray(batch["tokens"][row].values, "i8")
                found = covered(item, text, shingles, coverage)
                matched = sum(t[0] for t in found)
                if matched / len(item) >= coverage:
                    out.append((batch["digest"][row].as_py(), batch["item"][row].as_py(), len(found), matched, len(item)))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in zip(*out, strict=True)],
                    ["digest", "item", "n_tiles", "matched_tokens", "item_tokens"])

    return run


def matches(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """(digest, item_id, n_tiles, matched_tokens, item_tokens, coverage) of every distinct text
    and item whose coverage reaches ``coverage``."""
    named = stored(item_table(benchmark), "items")
    items = stored(named.dropDuplicates(["item"]).drop("item_id"), "distinct-items")
    sizes = items.select(F.least(F.size("tokens"), F.lit(LEAST)).alias("n")).distinct().collect()
    lengths = sorted(r["n"] for r in sizes) or [LEAST]
    every = items.select(F.explode("seeds").alias("seed")).distinct()
    counts = seed_counts(docs, seed_filter(every), lengths)
    chosen = stored(chosen_seeds(items, counts, coverage), "chosen-seeds")
    texts = stored(seeded_texts(docs, seed_filter(chosen.select("seed").distinct()), lengths), "seeded-texts")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    spots = texts.select("digest", F.pmod(F.crc32("digest"), F.lit(SALTS)).cast("int").alias("salt"),
                         F.explode("seeds").alias("seed"))
    pairs = spots.join(chosen.withColumn("salt", salts), ["seed", "salt"]).select("digest", "item").distinct()
    none = F.lit(None)
    met = pairs.select("digest").distinct()
    rows = texts.join(met, "digest", "left_semi").select(
        "digest", none.cast("string").alias("item"), "text", none.cast("array<bigint>").alias("tokens"))
    rows = rows.union(pairs.join(items, "item").select("digest", "item", none.cast("string").alias("text"), "tokens"))
    # A null item sorts first.
    ordered = rows.repartition("digest").sortWithinPartitions("digest", "item")
    tiled = ordered.mapInArrow(
        _tile(coverage), "digest string, item string, n_tiles bigint, matched_tokens bigint, item_tokens bigint")
    found = tiled.join(named.select("item_id", "item"), "item").drop("item")
    return found.withColumn("coverage", F.col("matched_tokens") / F.col("item_tokens")).select(
        "digest", "item_id", "n_tiles", "matched_tokens", "item_tokens", "coverage")


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """doc_id, item_id and how the item is covered, for every contaminated row."""
    found = stored(matches(docs, benchmark, coverage), "contaminated")
    keyed = docs.where(F.col("text").isNotNull()).select("doc_id", F.md5("text").alias("digest"))
    return keyed.join(found, "digest").drop("digest")


def clean(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, with all their columns."""
    found = stored(matches(docs, benchmark, coverage), "contaminated")
    digest = fresh(docs.columns, "digest")
    bad = found.select(F.col("digest").alias(digest)).distinct()
    return docs.withColumn(digest, F.md5("text")).join(bad, digest, "left_anti").drop(digest)
