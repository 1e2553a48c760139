"""Queries and responses that belong together."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from packetlens.functions import info as I
from packetlens.functions.text import computed_once, tokens
from packetlens.operators.names import standard
from packetlens.operators.spread import NO_BUCKET, span_of, with_group_size

KEY = ["query_id", "client", "server"]
# Sequence numbers per cut through a hot key.
SPAN = 65536


def messages(packets: DataFrame, *keep: str) -> DataFrame:
    """Each Standard packet under its conversation: a response swaps the endpoints."""
    info, src, dst, words = F.col("info"), F.col("src"), F.col("dst"), F.col("words")
    split = computed_once(
        standard(packets).select(*keep, "src", "dst", "info"), words=tokens(info)
    )
    query = I.is_query(words)
    id_at = F.when(query, 2).when(~query, 3)
    rows = split.select(
        *keep,
        F.get(words, id_at).alias("query_id"),
        F.when(query, src).otherwise(dst).alias("client"),
        F.when(query, dst).otherwise(src).alias("server"),
        F.concat(info, F.lit(" src: "), src, F.lit(" dest: "), dst).alias("message"),
    )
    return rows.where(F.col("query_id").isNotNull())


def conversation_messages(rows: DataFrame, span: int = SPAN) -> DataFrame:
    """The messages (with ``seq`` and ``ts``) of every conversation that has two or more."""
    sized = with_group_size(rows.withColumn("span", span_of(F.col("seq"), span)), KEY, "span")
    return sized.where(F.col("n_group") > 1).select(
        *KEY, F.col("n_group").alias("n_messages"), "span", "ts", "seq", "message"
    )


def conversations(rows: DataFrame, slice_seconds: int | None = None) -> DataFrame:
    """query_id, client, server, n_messages, part and the messages in capture order.

    With ``slice_seconds`` the list of every conversation is cut at multiples of that time,
    ``part`` being the slice's number since 1970; parts read in order are the whole list.
    Without it each list is one row with part 0, so a row is as long as its conversation:
    give a slice, or use ``conversation_messages``, where query ids recur all day.
    """
    ordered = F.array_sort(F.collect_list(F.struct("ts", "seq", "message")))
    if slice_seconds is None:
        grouped = rows.groupBy(*KEY).agg(F.count("*").alias("n_messages"), ordered.alias("m")).where(
            F.col("n_messages") > 1)
        return grouped.select(
            *KEY, "n_messages", F.lit(0).cast("bigint").alias("part"), F.col("m.message").alias("messages"))
    second = F.unix_seconds(F.col("ts").cast("timestamp"))
    whole = [*KEY, "n_messages", "part"]
    return (
        conversation_messages(rows)
        .withColumn("part", F.floor(second / slice_seconds).cast("bigint"))
        # Lists gain nothing from being built before the shuffle as well as after it.
        .repartition(*whole)
        .groupBy(*whole)
        .agg(ordered.alias("m"))
        .select(*whole, F.col("m.message").alias("messages"))
    )


def gap_messages(rows: DataFrame, gap_seconds: int) -> DataFrame:
    """The messages of conversations of two or more, where a pause longer than the gap ends
    a conversation. ``start`` is the time of its first message.

    Times are cut into slices as long as the gap. Messages of one slice belong together, and
    slices follow one another without a pause only if they are neighbours, so counts, first
    and last times per slice decide; a key's slices grow with the time the rows span, not with
    their number. Messages without a time form one conversation per key, with a null start.
    """
    gap = gap_seconds * 1_000_000

    def micros(name: str):
        return F.unix_micros(F.col(name).cast("timestamp"))

    cut = rows.withColumn("slice", F.coalesce(span_of(micros("ts"), gap), F.lit(NO_BUCKET)))
    slices = cut.groupBy(*KEY, "slice").agg(
        F.min("ts").alias("first"), F.max("ts").alias("last"), F.count("*").alias("n"))
    timed = [*KEY, F.col("first").isNull()]
    in_order = Window.partitionBy(*timed).orderBy("slice")
    pause = micros("first") - F.lag(micros("last")).over(in_order)
    runs = slices.withColumn("begins", F.coalesce((pause > gap).cast("int"), F.lit(1)))
    runs = runs.withColumn("run", F.sum("begins").over(in_order))
    run = Window.partitionBy(*timed, "run")
    runs = runs.select(
        *KEY, "slice", F.min("first").over(run).alias("start"), F.sum("n").over(run).alias("n_messages"))
    # Both sides grow with the messages, and sizes guessed before parsing are far too small.
    return cut.join(runs.where(F.col("n_messages") > 1).hint("merge"), [*KEY, "slice"]).select(
        *KEY, "start", "n_messages", "ts", "seq", "message")


def gap_conversations(rows: DataFrame, gap_seconds: int) -> DataFrame:
    """query_id, client, server, start, n_messages and the messages in capture order, one row
    per conversation of ``gap_messages``, which suits conversations too long for a row."""
    ordered = F.array_sort(F.collect_list(F.struct("ts", "seq", "message")))
    grouped = gap_messages(rows, gap_seconds).groupBy(*KEY, "start", "n_messages").agg(ordered.alias("m"))
    return grouped.select(*KEY, "start", "n_messages", F.col("m.message").alias("messages"))


def closed_conversations(packets: DataFrame, gap: str, watermark: str | None = None) -> DataFrame:
    """query_id, client, server, start, n_messages and the messages in capture order, one row
    per conversation of two or more messages, which a pause longer than ``gap`` ends.

    Made for streams: a query waits under its key in the state store until its response
    comes, in whichever micro-batch, and messages that arrive out of order join or bridge what
    is there. Once the watermark has passed the last message by the gap, append mode gives the
    conversation out and its state is freed. Messages later than the watermark are dropped.
    State holds the messages of open conversations; a row is as long as its conversation. On
    static input the rows are those of ``gap_conversations``, but for messages without a time.
    """
    if watermark is not None and packets.isStreaming:
        packets = packets.withWatermark("ts", watermark)
    rows = messages(packets, "seq", "ts")
    ordered = F.array_sort(F.collect_list(F.struct("ts", "seq", "message")))
    grouped = rows.groupBy(*KEY, F.session_window("ts", gap).alias("session")).agg(
        F.count("*").alias("n_messages"), ordered.alias("m")).where(F.col("n_messages") > 1)
    return grouped.select(
        *KEY, F.col("session.start").alias("start"), "n_messages", F.col("m.message").alias("messages"))
