"""Quality rules: plain text statistics, and perplexity bands by language.

A modified Kneser-Ney model over the character n-grams of all texts is counted and smoothed by
Spark. It keeps every n-gram, each with its exact count, in hash-partitioned sorted arrays of
the shared folder, from which every text is scored. For each language and length the centre
of the log perplexity is its median and the spread half the distance of its quartiles; texts
outside the band of ``WIDTH`` spreads around the centre are rejected, below it (boilerplate, loops) as well as above it (noise). A mean over few
characters strays more, so lengths have bands of their own, in bins of half an octave. A bin of
fewer than ``BAND_TEXTS`` texts takes in the bins around it until it has as many.

* Words are runs of characters other than space and \\t to \\r. A null text has none.
* Null languages form a group of their own. A text without words has perplexity null and
  fails the base rules.
* Each row is judged by itself, so repeated rows are judged alike; an empty table gives an
  empty result. Extra columns, also of the same names, are passed through by ``judge``.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packetlens.llm import char_lm
from packetlens.llm.common import SLICE_BYTES, fresh, map_texts, stored

ORDER = 5
# Bytes of texts that are scored together by a model of several parts.
SCORED_BYTES = 8 << 20
# Half the width of a band, in spreads.
WIDTH = 5.0
# Bins of length to a doubling, texts that a bin's quartiles are taken from at least, and by
# how many bins to each side it is widened to get them.
LENGTH_BINS = 2
BAND_TEXTS = 50
REACH = (0, 1, 2, 4, 8, 16, 1000)
# The least spread of log perplexity, in nats: twice the width of its bins.
LEAST_SPREAD = 0.002
# Width, in nats, of the bins in which texts are counted to find quartiles.
BIN = 0.001
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WORD = re.compile(r"[^ \t-\r]+")
SYMBOL = re.compile(r"[#*$%&|<>]")
SCHEMA = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, n_scored bigint, nats double"
)


def repeat_words(words: list[str]) -> int:
    """Words in a window of three words that is found twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    total, end = 0, 0
    for i, w in enumerate(windows):
        if times[w] > 1:
            total += i + 3 - max(i, end)
            end = i + 3
    return total


def dup_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = text.split("\n")
    if len(set(lines)) == len(lines):
        return 0
    lines = [x for x in lines if WORD.search(x)]
    return len(lines) - len(set(lines))


def base_statistics(texts: list[str]) -> dict:
    out: dict[str, list[int]] = {
        n: [] for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
    for t in texts:
        words = WORD.findall(t)
        out["n_words"].append(len(words))
        out["word_chars"].append(sum(map(len, words)))
        out["n_symbols"].append(len(SYMBOL.findall(t)))
        out["n_dup_lines"].append(dup_lines(t))
        out["n_repeat_words"].append(repeat_words(words))
    return out


def fit(docs: DataFrame) -> char_lm.StoredScores:
    """The model of all texts, with all their n-grams. It does not reach the driver."""
    rows = docs.select("text", F.lit("all").alias("grp"))
    counts = stored(char_lm.count_ngrams(rows, "grp", "text", ORDER, False).select("ngram", "n"), "ngrams")
    return char_lm.StoredScores(char_lm.log_probabilities(counts, ORDER), counts.count())


def statistics(docs: DataFrame, model: char_lm.StoredScores, keep: list[str], stats: str) -> DataFrame:
    """Base statistics and nats per character of every text, in a struct named ``stats``.
    ``model`` is fitted on the same texts."""
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    own = {n: fresh([*docs.columns, *names], f"stats_{n}") for n in names}

    def make():
        table, log_p_of = char_lm.class_table(False), model.reader()

        def work(texts):
            texts = [t or "" for t in texts]
            out = base_statistics(texts)
            codes = char_lm.codes_of(texts, ORDER, table, False)
            real = codes[ORDER - 1:] != char_lm.PAD
            log_p = log_p_of(char_lm.packed(codes, ORDER)[real])
            lengths = np.array([len(t) for t in texts])
            nats = -char_lm.segment_sums(log_p, lengths) / np.maximum(lengths, 1)
            out["n_scored"] = lengths
            out["nats"] = [x if n else None for x, n in zip(nats.tolist(), out["n_words"], strict=True)]
            return {own[n]: v for n, v in out.items()}

        return work

    schema = ", ".join(f"{own[n]} {t}" for n, t in (f.split() for f in SCHEMA.split(", ")))
    most = SLICE_BYTES if model.parts == 1 else SCORED_BYTES
    rows = map_texts(docs, "text", make, schema, keep, most)
    return rows.select(*[f"`{c}`" for c in keep], F.struct(*[F.col(own[n]).alias(n) for n in names]).alias(stats))


def base_failed(stats: Column) -> Column:
    return (stats["n_words"] < MIN_WORDS) | (
        100 * stats["n_repeat_words"] > MAX_REPEAT_PERCENT * stats["n_words"]
    )


def length_bin(stats: Column) -> Column:
    return F.floor(LENGTH_BINS * F.log2(F.greatest(stats["n_scored"], F.lit(1))))


def bands(rows: DataFrame, stats: str, width: float = WIDTH) -> DataFrame:
    """(band_lang, band_length, low, high) over all texts that pass the base rules."""
    nats = F.col(stats)["nats"]
    sound = rows.where(~base_failed(F.col(stats))).select(
        F.coalesce("lang", F.lit("")).alias("band_lang"), length_bin(F.col(stats)).alias("length"), nats.alias("nats"))
    # Counts of narrow bins give the same quartiles however rows are dealt to tasks.
    counted = stored(sound.groupBy("band_lang", "length", F.floor(F.col("nats") / BIN).alias("bin")).agg(
        F.count("*").alias("n")), "quality-bins")
    sizes = counted.groupBy("band_lang", "length").agg(F.sum("n").alias("size"))
    away = F.abs(F.col("length") - F.col("band_length"))
    enough = F.coalesce(*[
        F.when(F.sum(F.when(away <= r, F.col("size"))) >= BAND_TEXTS, F.lit(r)) for r in REACH], F.lit(REACH[-1]))
    reach = sizes.select("band_lang", F.col("length").alias("band_length")).join(sizes, "band_lang").groupBy(
        "band_lang", "band_length").agg(enough.alias("reach"))
    bins = counted.join(reach, "band_lang").where(away <= F.col("reach")).groupBy(
        "band_lang", "band_length", "bin").agg(F.sum("n").alias("n"))
    own = Window.partitionBy("band_lang", "band_length")
    ranked = bins.withColumn("below", F.sum("n").over(own.orderBy("bin"))).withColumn("all", F.sum("n").over(own))
    quarters = ranked.groupBy("band_lang", "band_length").agg(F.array(*[
        F.min(F.when(4 * F.col("below") >= k * F.col("all"), F.col("bin"))) * BIN + BIN / 2 for k in (1, 2, 3)
    ]).alias("q"))
    q = F.col("q")
    # Half the distance of the quartiles is the median absolute deviation of an even spread.
    spread = F.greatest((q[2] - q[0]) / 2, F.lit(LEAST_SPREAD)) * width
    return quarters.select("band_lang", "band_length", (q[1] - spread).alias("low"), (q[1] + spread).alias("high"))


def judge(docs: DataFrame, keep: list[str] | None = None, width: float = WIDTH) -> tuple[DataFrame, str]:
    """``keep`` (default: all columns) and a struct column, whose name is returned as well:
    the statistics, ``perplexity``, ``base_failed`` and ``kept``."""
    keep = docs.columns if keep is None else keep
    stats = fresh(docs.columns, "quality")
    rows = stored(statistics(docs, fit(docs), keep, stats), "quality")
    found = bands(rows, stats, width)
    s, nats = F.col(stats), F.col(stats)["nats"]
    key = fresh(docs.columns, "band_key")
    judged = rows.withColumn(key, F.coalesce("lang", F.lit(""))).join(
        found, (F.col(key) == F.col("band_lang")) & (length_bin(s) == F.col("band_length")), "left")
    failed = base_failed(s)
    inside = F.coalesce(nats.between(F.col("low"), F.col("high")), F.lit(False))
    return judged.select(
        *[f"`{c}`" for c in keep],
        s.withField("perplexity", F.exp(nats)).withField("base_failed", failed)
        .withField("kept", ~failed & inside).alias(stats),
    ), stats
