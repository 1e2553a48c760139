"""Character n-gram language models with Kneser-Ney smoothing.

N-grams are packed into 64-bit integers, 12 bits a character, and models are sorted hash
arrays: keys ordered by a multiplicative hash, found through a directory of its leading bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetlens.llm.common import files_in, slices, stored
from packetlens.session import work_dir

BITS = 12
CLASSES = 1 << BITS
PAD = 0
OTHER = 1
# Distinct n-grams that a task gathers before it merges them.
MERGE_AT = 1_000_000
# N-grams of one part of a model that is held in files; a task holds one part at a time.
PART_NGRAMS = 1 << 22
# Deals n-grams to parts evenly, in Spark and in numpy alike.
DEAL = 1_000_003
MIX = np.uint64(0x9E3779B97F4A7C15)


def class_table(letters_only: bool) -> np.ndarray:
    """The class of each code point below 65536. Classes below 2048 are code points
    themselves, others share 2048 classes. With ``letters_only`` all but letters are OTHER;
    else digits are one class and so is white space."""
    points = np.arange(1 << 16)
    classes = np.where(points < 2048, points, 2048 + points * 40503 % 2048)
    chars = [chr(p) for p in points.tolist()]
    if letters_only:
        classes[~np.array([c.isalpha() for c in chars])] = OTHER
    else:
        classes[[c.isspace() for c in chars]] = ord(" ")
        classes[ord("0"):ord("9") + 1] = ord("0")
    classes[:2] = OTHER
    return classes.astype("u2")


def codes_of(texts: list[str], order: int, table: np.ndarray, letters_only: bool) -> np.ndarray:
    """Classes of all texts, each after ``order - 1`` pads."""
    pad = "\0" * (order - 1)
    joined = pad + pad.join(t.replace("\0", "\1") for t in texts) if texts else ""
    points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
    high = points > 0xFFFF
    if not high.any():
        codes = table[points]
    else:
        codes = table[np.where(high, 1, points)]
        codes[high] = 2048 + points[high] % 2048
        if letters_only:
            plain = [p for p in np.unique(points[high]).tolist() if not chr(p).isalpha()]
            codes[np.isin(points, plain)] = OTHER
    codes[points == 0] = PAD
    return codes


def packed(codes: np.ndarray, order: int) -> np.ndarray:
    """The n-gram that ends at each position from ``order - 1`` on."""
    n = max(0, len(codes) - order + 1)
    wide = codes.astype("i8")
    keys = wide[:n].copy()
    for i in range(1, order):
        keys <<= BITS
        keys |= wide[i:i + n]
    return keys


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    all_keys = np.concatenate(keys)
    found, place = np.unique(all_keys, return_inverse=True)
    return found, np.bincount(place, np.concatenate(counts), len(found)).astype("i8")


def count_ngrams(df: DataFrame, group: str, text: str, order: int, letters_only: bool) -> DataFrame:
    """(group, ngram, n): n-grams of all texts by group, counted in each task and summed."""

    def run(batches: Iterator[pa.RecordBatch]):
        table, found = class_table(letters_only), {}
        size = 0

        def out():
            for name, (keys, counts) in found.items():
                keys, counts = merged(keys, counts)
                for i in range(0, len(keys), 1 << 16):
                    part = keys[i:i + (1 << 16)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(part), pa.string()), pa.array(part),
                         pa.array(counts[i:i + (1 << 16)])], ["grp", "ngram", "n"],
                    )

        for batch in batches:
            for part in slices(batch, "text"):
                by: dict[str, list[str]] = {}
                for name, t in zip(part["grp"].to_pylist(), part["text"].to_pylist(), strict=True):
                    if t:
                        by.setdefault(name, []).append(t.lower() if letters_only else t)
                for name, texts in by.items():
                    codes = codes_of(texts, order, table, letters_only)
                    ends = codes[order - 1:]
                    keys = packed(codes, order)[ends != PAD]
                    keys, counts = np.unique(keys, return_counts=True)
                    held = found.setdefault(name, ([], []))
                    held[0].append(keys)
                    held[1].append(counts)
                    size += len(keys)
                    if len(held[0]) > 1 and sum(map(len, held[0])) > MERGE_AT:
                        size -= sum(map(len, held[0]))
                        whole = merged(*held)
                        held[0][:], held[1][:] = [whole[0]], [whole[1]]
                        size += len(whole[0])
                if size > 3 * MERGE_AT:
                    yield from out()
                    found, size = {}, 0
        yield from out()

    rows = df.select(F.col(group).alias("grp"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "grp string, ngram bigint, n bigint").groupBy("grp", "ngram").agg(
        F.sum("n").alias("n")
    )


class HashArray:
    """Keys in the order of their hashes, with the place of each."""

    def __init__(self, keys: np.ndarray):
        hashes = keys.astype("u8") * MIX
        self.order = np.argsort(hashes)
        self.keys = keys[self.order]
        bits = max(1, int(len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        leading = hashes[self.order] >> self.shift
        self.start = np.searchsorted(leading, np.arange((1 << bits) + 1, dtype="u8")).astype("i4")
        self.longest = int(np.diff(self.start).max(initial=0))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key in this array, or -1."""
        if not len(self.keys):
            return np.full(len(keys), -1, "i4")
        bucket = ((keys.astype("u8") * MIX) >> self.shift).astype("i8")
        at = self.start[bucket]
        last = len(self.keys) - 1
        hit = self.keys[np.minimum(at, last)] == keys
        found = np.where(hit, at, -1)
        left = np.flatnonzero(~hit)
        ends = self.start[bucket[left] + 1]
        at = at[left]
        for _ in range(self.longest - 1):
            at += 1
            open_ = at < ends
            left, at, ends = left[open_], at[open_], ends[open_]
            if not len(left):
                break
            hit = self.keys[at] == keys[left]
            found[left[hit]] = at[hit]
            left, at, ends = left[~hit], at[~hit], ends[~hit]
        return found


def discounts(seen: list[int], modified: bool) -> np.ndarray:
    """The discount for counts 0, 1, 2, and 3 or more, from the numbers of n-grams seen
    one to four times; 0.75 where these say nothing, and never all of a count."""
    n1, n2, n3, n4 = seen
    if not n1 or not n2:
        return np.array([0, 0.75, 0.75, 0.75])
    y = n1 / (n1 + 2 * n2)
    if not modified:
        return np.array([0, y, y, y])
    d = [0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else y]
    return np.array([0] + [min(max(d[k], 0.05), k - 0.05) for k in (1, 2, 3)])


def log_probabilities(counts: DataFrame, order: int) -> DataFrame:
    """(ngram, log_p) of every row of ``counts`` (ngram, n): the modified Kneser-Ney model of
    ``CharModel``, interpolated, by aggregations and joins. Four numbers per order reach the
    driver, and the totals of the lowest order, whose only context is the empty one."""
    ngram, n = F.col("ngram"), F.col("n")
    levels = {order: counts}
    for k in range(order - 1, 0, -1):
        # Lower orders count in how many different n-grams a suffix ends.
        suffix = ngram.bitwiseAND(F.lit((1 << BITS * k) - 1))
        levels[k] = stored(levels[k + 1].groupBy(suffix.alias("ngram")).agg(F.count("*").alias("n")), "ngrams")
    below = None
    for k, level in sorted(levels.items()):
        d = discounts(list(level.agg(*[F.count_if(n == i) for i in (1, 2, 3, 4)]).first()), True).tolist()
        cut = F.when(n == 1, d[1]).when(n == 2, d[2]).otherwise(d[3])
        left = (d[1] * F.count_if(n == 1) + d[2] * F.count_if(n == 2) + d[3] * F.count_if(n > 2)) / F.sum("n")
        if below is None:
            total, share = level.agg(F.sum("n"), left).first()
            rows = level.select("ngram", "n", F.lit(total).alias("total"), F.lit(share).alias("left"),
                                F.lit(1 / CLASSES).alias("below"))
        else:
            context = F.shiftright("ngram", BITS).alias("context")
            suffix = ngram.bitwiseAND(F.lit((1 << BITS * (k - 1)) - 1)).alias("suffix")
            contexts = level.select(context, "n").groupBy("context").agg(F.sum("n").alias("total"), left.alias("left"))
            rows = level.select("ngram", "n", context, suffix).join(contexts, "context").join(
                below.select(ngram.alias("suffix"), F.col("p").alias("below")), "suffix")
        p = (n - cut) / F.col("total") + F.col("left") * F.col("below")
        below = rows.select("ngram", p.alias("p"))
        if k < order:
            below = stored(below, "ngrams")
    return below.select("ngram", F.log("p").cast("float").alias("log_p"))


class StoredScores:
    """Log probabilities of n-grams in sorted arrays, dealt to parts by a hash and kept as files
    of the shared folder. Tasks read them there: a model of one part is held while a task
    runs, otherwise the distinct n-grams of many texts meet one part after the other."""

    def __init__(self, scores: DataFrame, size: int):
        self.parts = max(1, -(-size // PART_NGRAMS))
        self.path = work_dir(scores.sparkSession, "ngram-scores")
        part = F.pmod(F.pmod("ngram", F.lit(DEAL)), F.lit(self.parts))
        scores.withColumn("part", part).repartition(self.parts, "part").sortWithinPartitions(
            "part", "ngram").write.partitionBy("part").parquet(self.path)

    def part(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        found = files_in(f"{self.path}/part={k}", ["ngram", "log_p"])
        if found is None:
            return np.zeros(0, "i8"), np.zeros(0, "f4")
        return found["ngram"].to_numpy(), found["log_p"].to_numpy()

    def reader(self):
        """A function from n-grams to log probabilities. Each must be one of the model's."""
        if self.parts == 1:
            keys, log_p = self.part(0)
            array = HashArray(keys)
            log_p = log_p[array.order]

            def held(wanted: np.ndarray) -> np.ndarray:
                at = array.find(wanted)
                if len(at) and at.min() < 0:
                    raise ValueError("an n-gram of the texts is not in their model")
                return log_p[at] if len(at) else np.zeros(0, "f4")

            return held

        def by_parts(wanted: np.ndarray) -> np.ndarray:
            distinct, place = np.unique(wanted, return_inverse=True)
            out, dealt = np.zeros(len(distinct), "f4"), distinct % DEAL % self.parts
            for k in range(self.parts):
                own = np.flatnonzero(dealt == k)
                if not len(own):
                    continue
                keys, log_p = self.part(k)
                at = np.searchsorted(keys, distinct[own])
                if at.max() == len(keys) or (keys[at] != distinct[own]).any():
                    raise ValueError("an n-gram of the texts is not in their model")
                out[own] = log_p[at]
            return out[place]

        return by_parts


class CharModel:
    """Kneser-Ney model of one text source.

    ``modified`` takes three discounts per order, by count; otherwise one. Log probabilities
    of seen n-grams are stored interpolated, so a hit needs one look-up.
    """

    def __init__(self, ngrams: np.ndarray, counts: np.ndarray, order: int, modified: bool):
        self.order = order
        self.levels = {}
        by_level = {order: (ngrams, counts)}
        for n in range(order - 1, 0, -1):
            # Lower orders count in how many different n-grams a suffix ends.
            suffixes = by_level[n + 1][0] & ((1 << BITS * n) - 1)
            by_level[n] = np.unique(suffixes, return_counts=True)
        lower_keys, lower_p = np.zeros(0, "i8"), np.zeros(0)
        for n in range(1, order + 1):
            keys, c = by_level[n]
            ascending = np.argsort(keys)
            keys, c = keys[ascending], c[ascending].astype("f8")
            cut = self._discounts(c, modified)[np.minimum(c, 3).astype("i8")]
            contexts, first = np.unique(keys >> BITS, return_index=True)
            size = np.diff(np.append(first, len(keys)))
            total = np.add.reduceat(c, first) if len(c) else c
            left = (np.add.reduceat(cut, first) if len(c) else c) / total
            if n == 1:
                below = np.full(len(keys), 1 / CLASSES)
            else:
                below = lower_p[np.searchsorted(lower_keys, keys & ((1 << BITS * (n - 1)) - 1))]
            p = (c - cut) / np.repeat(total, size) + np.repeat(left, size) * below
            found, ctx = HashArray(keys), HashArray(contexts)
            self.levels[n] = (
                found, np.log(p)[found.order].astype("f4"),
                ctx, np.log(left)[ctx.order].astype("f4"),
            )
            lower_keys, lower_p = keys, p
        self.unseen = self._unseen()

    @staticmethod
    def _discounts(c: np.ndarray, modified: bool) -> np.ndarray:
        return discounts([int((c == k).sum()) for k in (1, 2, 3, 4)], modified)

    def _unseen(self) -> float:
        left = self.levels[1][3]
        return float((left[0] if len(left) else 0.0) - np.log(CLASSES))

    def log_p(self, keys: np.ndarray, n: int | None = None) -> np.ndarray:
        """Natural log of the probability of each n-gram's last character after the others."""
        n = self.order if n is None else n
        if n == 0:
            return np.full(len(keys), self.unseen, "f4")
        found, p, ctx, left = self.levels[n]
        at = found.find(keys)
        if not len(p):
            return np.full(len(keys), -np.log(CLASSES), "f4")
        out = p[at]
        miss = np.flatnonzero(at < 0)
        if len(miss):
            rest = keys[miss]
            if n == 1:
                out[miss] = self.unseen
            else:
                place = ctx.find(rest >> BITS)
                weight = np.where(place >= 0, left[place], 0)
                out[miss] = weight + self.log_p(rest & ((1 << BITS * (n - 1)) - 1), n - 1)
        return out


def segment_sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums over consecutive runs of the given lengths (0 for an empty run)."""
    out = np.zeros((len(lengths), *values.shape[1:]))
    filled = lengths > 0
    if filled.any():
        # A run's sum does not depend on the runs around it.
        first = (np.cumsum(lengths) - lengths)[filled]
        out[filled] = np.add.reduceat(values, first, axis=0, dtype="f8")
    return out
