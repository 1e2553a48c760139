"""URL filter: rules by host and path, and naive Bayes on the words of hosts and paths.

Hosts are names run together. Their labels are split into words by a unigram Viterbi search
over word counts, which Spark takes from the pages' own texts and from host labels that are
already split by hyphens. A multinomial naive Bayes model over host and path words, with
add-one smoothing, scores each url; a url is blocked when block is the likelier class. Its
training labels come from seed words: a url one of whose host words is a seed is a block
example, every other an allow example. Rules go before the model.

* A null url or one without ``://`` has an empty host and path, no words, and is allowed unless
  a rule fits; an empty page table gives an empty result.
* Of rules that fit, the longest (host and path) wins, then the first in order.
* A run of more than ``LONGEST_WORD`` letters is no host label: it stays one word.
* Repeated rows are judged alike. Extra columns do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetlens.llm.common import stored

# Words whose presence in a host makes an example of the block class.
SEEDS = ("ads", "adult", "bet", "bets", "casino", "pills", "poker", "porn", "spam", "track", "xxx")
# Count given to a seed beyond those found, so that hosts are split at them.
SEED_COUNT = 100
# Fixed value: letters of the longest host label, and so of the longest word in one.
LONGEST_WORD = 63


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A to Z lower-cased) and path of a url."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The fitting rule (``host/path``) and its verdict, or nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # What comes later goes before: longer rules, and of equally long ones the first.
    for action, rule in sorted(reversed(rules), key=lambda r: len(r[1])):
        own_host, slash, own_path = rule.partition("/")
        fits = ((host == own_host) | host.endswith(f".{own_host}")) & path.startswith(slash + own_path)
        name = F.when(fits, F.lit(rule)).otherwise(name)
        verdict = F.when(fits, F.lit(action)).otherwise(verdict)
    return name, verdict


def words_in(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda w: w != "")


def word_counts(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """(word, n) from page texts without tags, hyphenated host labels and seeds."""
    text = F.regexp_replace("html", r"(?is)<(script|style)\b[^>]*>.*?</\1>|<[^>]*>", " ")
    parts = hosts.select(F.explode(F.split("host", r"\.")).alias("label")).where(
        F.col("label").contains("-")).select(F.explode(F.split("label", "-")).alias("word"))
    seeds = pages.sparkSession.createDataFrame([(s, SEED_COUNT) for s in SEEDS], "word string, n bigint")
    counted = pages.select(F.explode(words_in(text)).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    both = counted.union(parts.groupBy("word").agg((SEED_COUNT * F.count("*")).alias("n"))).union(seeds)
    short = (F.length("word") > 0) & (F.length("word") <= LONGEST_WORD)
    return both.where(short).groupBy("word").agg(F.sum("n").alias("n"))


def best_split(run: str, log_p: dict[str, float], unseen: float) -> list[str]:
    """The likeliest words that make up ``run``. An unseen word of k letters costs k times
    ``unseen``, so unseen letters stay together only where nothing known fits."""
    n = len(run)
    best, begin = [0.0] + [-math.inf] * n, [0] * (n + 1)
    for j in range(1, n + 1):
        for i in range(max(0, j - LONGEST_WORD), j):
            p = log_p.get(run[i:j])
            score = best[i] + (unseen * (j - i + 1) if p is None else p)
            if score > best[j]:
                best[j], begin[j] = score, i
    out, j = [], n
    while j:
        out.append(run[begin[j]:j])
        j = begin[j]
    return out[::-1]


def segmented(runs: DataFrame, counts: DataFrame) -> DataFrame:
    """(run, words): each run of letters split. Only counts of the substrings of a run are
    joined to it, so no table of words is held whole anywhere."""
    total = counts.agg(F.sum("n")).first()[0] or 1
    at = F.explode(F.sequence(F.lit(1), F.length("run")))
    # A longer run is no host label, and is left whole below.
    starts = runs.where(F.length("run").between(1, LONGEST_WORD)).select("run", at.alias("i"))
    size = F.explode(F.sequence(F.lit(1), F.least(F.lit(LONGEST_WORD), F.length("run") - F.col("i") + 1)))
    parts = starts.select("run", "i", size.alias("k")).select(
        "run", F.substring("run", F.col("i"), F.col("k")).alias("word")).distinct()
    known = parts.join(counts, "word").groupBy("run").agg(F.collect_list(F.struct("word", "n")).alias("known"))
    rows = runs.join(known, "run", "left")

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if len(row["run"]) > LONGEST_WORD:
                    out.append([row["run"]])
                    continue
                log_p = {x["word"]: math.log(x["n"] / total) for x in row["known"] or ()}
                out.append(best_split(row["run"], log_p, -math.log(10 * total) / 2))
            yield pa.RecordBatch.from_arrays(
                [batch["run"], pa.array(out, pa.list_(pa.string()))], ["run", "words"])

    return rows.select("run", "known").mapInArrow(run, "run string, words array<string>")


def judge(pages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """page_id, host, path, rule, verdict, the host's words and the log odds of block."""
    host, path = url_parts(F.col("url"))
    name, verdict = rule_for(F.col("host"), F.col("path"), rules)
    parsed = pages.select("page_id", host.alias("host"), path.alias("path")).select(
        "page_id", "host", "path", name.alias("rule"), verdict.alias("by_rule"))
    urls = stored(parsed.groupBy("host", "path").agg(F.count("*").alias("n")), "urls")
    hosts = stored(urls.select("host").distinct(), "hosts")
    runs = hosts.select(F.explode(words_in(F.col("host"))).alias("run")).distinct()
    counts = stored(word_counts(pages, hosts), "words")
    split = stored(segmented(runs, counts), "splits")
    place = F.posexplode(words_in(F.col("host"))).alias("at", "run")
    host_words = stored(hosts.select("host", place).join(split, "run").groupBy("host").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "words"))), lambda x: x["words"])).alias("words")),
        "host-words")
    token = F.concat(
        F.transform(F.coalesce("words", F.array().cast("array<string>")), lambda w: F.concat(F.lit("h:"), w)),
        F.transform(words_in(F.col("path")), lambda w: F.concat(F.lit("p:"), w)))
    seeded = F.coalesce(F.arrays_overlap("words", F.array(*map(F.lit, SEEDS))), F.lit(False))
    known = stored(urls.join(host_words, "host", "left").select(
        "host", "path", "n", "words", token.alias("tokens"), seeded.alias("block")), "url-words")
    weights = bayes(known)
    scored = known.select("host", "path", F.explode("tokens").alias("token")).join(weights, "token").groupBy(
        "host", "path").agg(F.sum("weight").alias("weight"))
    n_block, n_allow = known.agg(*_by_class("n")).first()
    prior = math.log(n_block + 1) - math.log(n_allow + 1)
    judged = stored(known.join(scored, ["host", "path"], "left").select(
        "host", "path", F.coalesce("words", F.array().cast("array<string>")).alias("host_words"),
        (F.lit(prior) + F.coalesce("weight", F.lit(0.0))).alias("log_odds")), "judged")
    by_model = F.when(F.col("log_odds") > 0, "block").otherwise("allow")
    return parsed.join(judged, ["host", "path"]).select(
        "page_id", "host", "path", "rule", F.coalesce("by_rule", by_model).alias("verdict"),
        F.array_join("host_words", " ").alias("host_words"), "log_odds")


def _by_class(n: str) -> list[Column]:
    return [
        F.coalesce(F.sum(F.when(F.col("block") == of, F.col(n))), F.lit(0)).alias(name)
        for of, name in ((True, "n_block"), (False, "n_allow"))
    ]


def bayes(known: DataFrame) -> DataFrame:
    """(token, weight): the log odds of a token under multinomial naive Bayes, add-one."""
    seen = stored(known.select("n", "block", F.explode("tokens").alias("token")).groupBy("token").agg(
        *_by_class("n")), "tokens")
    block, allow, kinds = seen.agg(
        F.coalesce(F.sum("n_block"), F.lit(0)), F.coalesce(F.sum("n_allow"), F.lit(0)), F.count("*")).first()
    weight = F.log((F.col("n_block") + 1) / (F.col("n_allow") + 1)) + math.log(
        max(1, allow + kinds) / max(1, block + kinds))
    return seen.select("token", weight.alias("weight"))
