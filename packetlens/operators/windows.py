"""Totals per tumbling window, on static tables and on streams alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetlens.functions import info as I
from packetlens.functions.packet import is_dns
from packetlens.functions.text import computed_once, strip, tokens
from packetlens.operators.names import name_records

# Fixed value: window length, with a slide of the same length.
DURATION = "20 seconds"


def windowed(packets: DataFrame, duration: str, watermark: str | None) -> DataFrame:
    """Add the window of ``ts``. A watermark bounds the state a stream keeps and drops
    packets of windows already closed; a static table ignores it."""
    if watermark is not None and packets.isStreaming:
        packets = packets.withWatermark("ts", watermark)
    return packets.withColumn("window", F.window("ts", duration))


def _bounds(df: DataFrame, *rest: str) -> DataFrame:
    return df.select(
        F.col("window.start").alias("start"), F.col("window.end").alias("end"), *rest
    )


def window_bytes_packets(
    packets: DataFrame, duration: str = DURATION, watermark: str | None = None
) -> DataFrame:
    """Bytes and packets of all protocols."""
    rows = windowed(packets, duration, watermark).where(F.col("length").isNotNull())
    sums = rows.groupBy("window").agg(
        F.sum("length").alias("bytes"), F.count("*").alias("packets")
    )
    return _bounds(sums, "bytes", "packets")


def window_exchanged_packets(
    packets: DataFrame, duration: str = DURATION, watermark: str | None = None
) -> DataFrame:
    """DNS packets sent and received per address."""
    rows = windowed(packets, duration, watermark).where(is_dns())
    ends = rows.select(
        "window",
        F.explode(
            F.array(
                F.struct(F.col("src").alias("address"), F.lit(1).alias("s"), F.lit(0).alias("r")),
                F.struct(F.col("dst").alias("address"), F.lit(0).alias("s"), F.lit(1).alias("r")),
            )
        ).alias("e"),
    )
    sums = ends.groupBy("window", F.col("e.address").alias("address")).agg(
        F.sum("e.s").alias("packets_sent"), F.sum("e.r").alias("packets_received")
    )
    return _bounds(sums, "address", "packets_sent", "packets_received")


def _typed(packets: DataFrame) -> DataFrame:
    rows = packets.where(is_dns() & F.col("info").isNotNull())
    return rows.withColumn("type", I.two_words(strip(F.col("info"))))


def window_message_types(
    packets: DataFrame, duration: str = DURATION, watermark: str | None = None
) -> DataFrame:
    """DNS packets per message type."""
    rows = _typed(windowed(packets, duration, watermark))
    return _bounds(
        rows.groupBy("window", "type").agg(F.count("*").alias("count")), "type", "count"
    )


def window_names(
    packets: DataFrame, duration: str = DURATION, watermark: str | None = None
) -> DataFrame:
    """Standard packets of any protocol per queried name or record."""
    rows = windowed(packets, duration, watermark).withColumn("info", strip(F.col("info")))
    counts = name_records(rows, "window").groupBy("window", "type", "request_response").agg(
        F.count("*").alias("requests")
    )
    return _bounds(counts, "type", "request_response", "requests")


# The variants below count a packet line once per window however often it was sent. They
# make lines distinct with one shuffle on (window, line), which partial aggregation
# shields from copies. On a stream that is a state of its own, whose closed windows feed the
# state that adds up; two states in a row need append mode, which gives out a window once.


def _of_lines(lines: DataFrame, duration: str) -> DataFrame:
    """Rows of closed windows under the same window, as event time of the next state."""
    return lines.withColumn("window", F.window(F.window_time("window"), duration))


def window_bytes_packets_distinct(
    packets: DataFrame, duration: str = DURATION, watermark: str | None = None
) -> DataFrame:
    """Bytes of distinct lines, and all packets."""
    rows = windowed(packets, duration, watermark).where(F.col("length").isNotNull())
    lines = rows.groupBy("window", "message", "length").agg(F.count("*").alias("n"))
    sums = _of_lines(lines, duration).groupBy("window").agg(
        F.sum("length").alias("bytes"), F.sum("n").alias("packets")
    )
    return _bounds(sums, "bytes", "packets")


def window_message_types_distinct(
    packets: DataFrame, duration: str = DURATION, watermark: str | None = None
) -> DataFrame:
    rows = _typed(windowed(packets, duration, watermark))
    lines = rows.groupBy("window", "type", "message").agg(F.count("*").alias("n"))
    counts = _of_lines(lines, duration).groupBy("window", "type").agg(F.count("*").alias("count"))
    return _bounds(counts, "type", "count")


def window_names_distinct(
    packets: DataFrame, duration: str = DURATION, watermark: str | None = None
) -> DataFrame:
    rows = windowed(packets, duration, watermark).withColumn("info", strip(F.col("info")))
    lines = rows.where(I.is_standard(F.col("info"))).groupBy("window", "message", "info").agg(
        F.count("*").alias("n"))
    records = name_records(_of_lines(lines, duration), "window")
    counts = records.groupBy("window", "type", "request_response").agg(F.count("*").alias("requests"))
    return _bounds(counts, "type", "request_response", "requests")


# Kinds of the rows that ``window_totals`` adds up, and where their values go.
TOTALS = {
    "window_bytes_packets": {"bytes": "a", "packets": "b"},
    "window_exchanged_packets": {"address": "key", "packets_sent": "a", "packets_received": "b"},
    "window_message_types": {"type": "key", "count": "a"},
    "window_names": {"type": "key", "request_response": "name", "requests": "a"},
}


def window_totals(
    packets: DataFrame, duration: str = DURATION, watermark: str | None = None
) -> DataFrame:
    """The four window results from one pass and one aggregate: start, end, kind, key, name and
    the sums a and b. ``total_of`` has the rows of one kind under their own columns.

    A packet becomes one row per total it counts for: the first four places stand for its bytes,
    its two ends and its type, the others for the tokens of its text.
    """
    bytes_packets, exchanged, types, of_names = TOTALS
    rows = windowed(packets, duration, watermark).select(
        "window", "src", "dst", "length", is_dns().alias("dns"), strip(F.col("info")).alias("info"))
    split = computed_once(rows, words=F.when(I.is_standard(F.col("info")), tokens(F.col("info"))))
    no_words = F.array().cast("array<string>")
    places = F.concat(F.array_repeat(F.lit(""), 4), F.coalesce("words", no_words))
    spots = split.select("*", F.posexplode(places).alias("place", "word"))
    place, at, words = F.col("place"), F.col("place") - 4, F.col("words")
    info = F.col("info")

    def choose(first, sender, receiver, kind, record):
        return (F.when(place == 0, first).when(place == 1, sender).when(place == 2, receiver)
                .when(place == 3, kind).otherwise(record))

    none, one, zero = F.lit(None), F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    lit = F.lit
    tagged = computed_once(
        spots.select("window", "src", "dst", "length", "dns", "info", "words", "place"),
        kind=choose(lit(bytes_packets), lit(exchanged), lit(exchanged), lit(types), lit(of_names)),
        key=choose(none, F.col("src"), F.col("dst"), I.two_words(info), I.record_type(words, at)),
        name=choose(none, none, none, none, I.record_name(words, at)),
        a=choose(F.col("length"), one, zero, one, one),
        b=choose(one, zero, one, zero, zero),
        counts=choose(F.col("length").isNotNull(), F.col("dns"), F.col("dns"),
                      F.col("dns") & info.isNotNull(),
                      I.record_type(words, at).isNotNull() & I.record_name(words, at).isNotNull()),
    )
    sums = tagged.where("counts").groupBy("window", "kind", "key", "name").agg(
        F.sum("a").alias("a"), F.sum("b").alias("b"))
    return _bounds(sums, "kind", "key", "name", "a", "b")


def total_of(totals: DataFrame, kind: str) -> DataFrame:
    columns = [F.col(source).alias(name) for name, source in TOTALS[kind].items()]
    return totals.where(F.col("kind") == kind).select("start", "end", *columns)
