"""Personal data by regular expressions, and more of it by bootstrapped contexts.

Base spans are e-mail addresses, IPv4 addresses, payment cards and telephone numbers, found
leftmost and without overlap per kind and then validated. They, and strings of hexadecimal
digits as long as keys are, seed a graph of lexical patterns (the words around a mention) and
instances (what stands there). Spark scores it in rounds: a pattern is as good as the mean score
of its instances, an instance is known as far as the best of its patterns is good, and what is
known so far supports patterns like the seeds do. Rounds go on until no pattern is new. The
instances of good patterns are identifiers of the kind ``id``.

A pattern holds a word: the key of a ``key = value`` or ``key: value``, the two words before a
mention, or one on each side. Words are taken from the ``CONTEXT`` characters beside a mention.

Everything is built from Spark's own functions.

* A null text counts as empty and has no span. Repeated rows get the same spans.
* Spans count code points, end exclusive. Discovered spans never touch a base span.
* Of equal starts within a kind there is one span only. Extra columns do not matter; an empty
  table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetlens.llm.common import fresh, stored

# The base kinds in order. Possessive repeats and guards keep the search linear
# and change no match: a run of the class either matches from its first character, or from
# the end of the match before, or nowhere.
KINDS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A text without a match of these has no span of the kind; they are quick to look for.
HINTS = {
    "email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){15}", "phone": r"\+[0-9]",
}
FOUND = "id"
# Identifier-like words: seven characters or more, one of them a digit.
LIKE_ID = (
    r"(?<![A-Za-z0-9_./+=@-])(?=[A-Za-z_./+=@-]*+[0-9])[A-Za-z0-9][A-Za-z0-9_./+=@-]{5,}[A-Za-z0-9=]"
)
# What may stand in a pattern's place: at one character the first of these that matches.
MENTION = "|".join([KINDS["email"], KINDS["phone"], LIKE_ID, KINDS["card"]])
# Fixed value: keys and digests of 128, 160 and 256 bits, of letters and digits both.
SECRET = r"^(?=[0-9]*[a-f])(?=[a-f]*[0-9])(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})$"
# Characters of context on either side.
CONTEXT = 60
# Rounds at most; each adds a pattern, or is the last.
ROUNDS = 20
# A pattern needs known instances with scores of so much together, and such a mean.
SUPPORT = 2.1
GOOD = 0.7
# Lengths summed at a time when places are computed.
BLOCK = 256
SPAN = "array<struct<kind:string,start:int,end:int>>"


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0), lambda x, y: x + y)


def located(text: Column, pattern: str) -> Column:
    """Matches of ``pattern`` with start, end, value, and the text before and after each as
    far as the next matches. Lengths are summed in blocks, so many matches stay cheap."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    both = F.struct(found.alias("v"), between.alias("b"))

    def place(x: Column) -> Column:
        lengths = F.transform(x["v"], lambda v, i: F.length(v) + F.length(F.get(x["b"], i)))
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(x["v"]) - 1) / BLOCK).cast("int")),
            lambda k: _sum(F.slice(lengths, k * BLOCK + 1, F.lit(BLOCK))))
        y = F.struct(x["v"].alias("v"), x["b"].alias("b"), lengths.alias("n"), blocks.alias("k"))

        def one(y: Column) -> Column:
            def row(v: Column, i: Column) -> Column:
                block = F.floor(i / BLOCK).cast("int")
                end = _sum(F.slice(y["k"], F.lit(1), block)) + _sum(
                    F.slice(y["n"], block * BLOCK + 1, i - block * BLOCK + 1))
                return F.struct(
                    (end - F.length(v)).alias("start"), end.alias("end"), v.alias("value"),
                    F.substring(F.get(y["b"], i), -CONTEXT, CONTEXT).alias("before"),
                    F.substring(F.get(y["b"], i + 1), 1, CONTEXT).alias("after"))

            return F.transform(y["v"], row)

        return F.flatten(F.transform(F.array(y), one))

    return F.flatten(F.transform(F.filter(F.array(both), lambda x: F.size(x["v"]) > 0), place))


def valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        short = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        return F.forall(short, lambda p: (F.length(p) <= 3) & (p.cast("bigint") <= 255))
    if kind == "card":
        def weighed(i: Column) -> Column:
            d = F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
            twice = d * 2
            return F.when(i % 2 == 1, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

        luhn = _sum(F.transform(F.sequence(F.lit(1), F.length(digits)), weighed)) % 10 == 0
        return F.when(F.length(digits).between(16, 19), luhn).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Validated spans of all base kinds, by kind and start."""

    def of(kind: str) -> Column:
        found = F.filter(located(text, KINDS[kind]), lambda m: valid(kind, m["value"]))
        own = F.transform(found, lambda m: F.struct(
            F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end")))
        return F.when(text.rlike(HINTS[kind]), own).otherwise(F.array().cast(SPAN))

    return F.concat(*map(of, KINDS))


def seeded(value: Column) -> Column:
    """Whether a mention is, as a whole, a valid span of a base kind."""
    return F.coalesce(
        *[F.when(value.rlike(f"^(?:{p})$") & valid(k, value), F.lit(True)) for k, p in KINDS.items()],
        F.lit(False))


def patterns(before: Column, after: Column) -> Column:
    """The lexical patterns of a mention: a key before it, two words before it, and one word on
    each side; each has a letter. Digits are alike, and so are cases."""
    before, after = (F.regexp_replace(F.lower(x), "[0-9]", "0") for x in (before, after))
    two = F.regexp_extract(before, r"(\S+\s+\S+\s*)$", 1)
    left, right = F.regexp_extract(before, r"(\S+\s*)$", 1), F.regexp_extract(after, r"^(\s*\S+)", 1)
    key = F.regexp_extract(before, r"([\p{L}_][\p{L}0_-]*)\s*[:=]\s*[\"'`]?$", 1)
    made = F.array(
        F.when(key != "", F.concat(F.lit("key "), key)),
        F.when(two != "", F.concat(F.lit("before "), two)),
        F.when((left != "") & (right != ""), F.concat(F.lit("around "), left, F.lit("_"), right)))
    # The name of the form itself has letters; what follows it must have one too.
    return F.filter(made, lambda p: p.isNotNull() & p.rlike(r"(?s)^\w+ .*\p{L}"))


def mentions(docs: DataFrame) -> DataFrame:
    """(digest, start, end, instance, base, seed, patterns) of the different texts with digits or
    @; ``base`` tells a base span, ``seed`` what the rounds start from."""
    texts = docs.where(F.col("text").rlike("[0-9@]")).select(
        F.md5("text").alias("digest"), located(F.col("text"), MENTION).alias("m"))
    # Equal texts have equal mentions: only one copy's are kept.
    return texts.where(F.size("m") > 0).dropDuplicates(["digest"]).select(
        "digest", F.explode("m").alias("m")).select(
        "digest", "m.start", "m.end", "m.before", "m.after", F.lower("m.value").alias("value"),
        seeded(F.col("m.value")).alias("base")).select(
        "digest", "start", "end", F.xxhash64("value").alias("instance"), "base",
        (F.col("base") | F.col("value").rlike(SECRET)).alias("seed"), patterns(F.col("before"), F.col("after")).alias("patterns"))


def good_patterns(found: DataFrame) -> DataFrame:
    """(pattern, score) of high-confidence patterns: rounds over the graph to a fixed point."""
    edges = stored(found.select("instance", "seed", F.explode("patterns").alias("pattern")).groupBy(
        "pattern", "instance").agg(F.max("seed").alias("seed")), "pattern-edges")
    known = edges.groupBy("instance").agg(F.max(F.col("seed").cast("double")).alias("score"))
    size, before = None, None
    for _ in range(ROUNDS):
        good = stored(edges.join(known, "instance").groupBy("pattern").agg(
            F.avg("score").alias("score"), F.sum("score").alias("support")
        ).where((F.col("support") >= SUPPORT) & (F.col("score") >= GOOD)).select("pattern", "score"), "patterns")
        size = good.agg(F.count("*"), F.sum(F.xxhash64("pattern") % F.lit(1 << 32))).first()
        if size == before:
            break
        before = size
        by_pattern = edges.join(good, "pattern", "left").groupBy("instance").agg(
            F.max(F.when(F.col("seed"), 1.0).otherwise(F.coalesce("score", F.lit(0.0)))).alias("score"))
        known = stored(by_pattern, "instances")
    return good


def discovered(docs: DataFrame) -> DataFrame:
    """(digest, found): further spans of each text, which may touch base spans."""
    found = stored(mentions(docs), "mentions")
    good = good_patterns(found)
    new = found.where(~F.col("base")).select("digest", "start", "end", F.explode("patterns").alias("pattern"))
    return new.join(good, "pattern").select("digest", "start", "end").distinct().groupBy("digest").agg(
        F.array_sort(F.collect_list(F.struct(F.lit(FOUND).alias("kind"), "start", "end"))).alias("found"))


def spans(docs: DataFrame, keep: list[str]) -> tuple[DataFrame, str, str]:
    """``keep``, and two columns whose names are returned as well: base spans and all spans."""
    base, every, digest, found = (fresh(docs.columns, c) for c in ("base", "spans", "digest", "found"))
    more = discovered(docs.select("text")).withColumnsRenamed({"digest": digest, "found": found})
    own = docs.select(
        *[f"`{c}`" for c in keep], F.md5("text").alias(digest),
        F.when(F.col("text").rlike("[0-9@]"), base_spans(F.col("text"))).otherwise(
            F.array().cast(SPAN)).alias(base))
    apart = F.filter(found, lambda f: ~F.exists(
        base, lambda b: (b["start"] < f["end"]) & (f["start"] < b["end"])))
    return own.join(more, digest, "left").select(
        *[f"`{c}`" for c in keep], base,
        F.concat(base, F.coalesce(apart, F.array().cast(SPAN))).alias(every)), base, every


def as_text(spans_: Column) -> Column:
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets. Spans that
    overlap are replaced together, by the kind of the first."""
    rows, _, every = spans(docs, docs.columns)
    s = F.sort_array(F.transform(every, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    merged = F.aggregate(
        s, F.array().cast("array<struct<start:int,end:int,kind:string>>"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] > x["start"]),
            F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(
                F.element_at(acc, -1)["start"].alias("start"),
                F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end"),
                F.element_at(acc, -1)["kind"].alias("kind"))))
        ).otherwise(F.concat(acc, F.array(x))))
    gaps = fresh(rows.columns, "gaps")
    text, g = F.col("text"), F.col(gaps)
    parts = F.transform(g, lambda x, i: F.concat(
        F.substr(text, F.coalesce(F.get(g, i - 1)["end"], F.lit(0)) + 1,
                 x["start"] - F.coalesce(F.get(g, i - 1)["end"], F.lit(0))),
        F.lit("["), F.upper(x["kind"]), F.lit("]")))
    whole = F.concat(F.array_join(parts, ""), F.substr(text, F.element_at(g, -1)["end"] + 1))
    safe = rows.withColumn(gaps, merged)
    return safe.select(*[
        F.when(F.size(gaps) > 0, whole).otherwise(text).alias("text") if c == "text" else F.col(f"`{c}`")
        for c in docs.columns])
