"""Every query by name, over the packets derived from an ``events`` table."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from packetlens.functions import envelope
from packetlens.functions import info as I
from packetlens.functions.packet import FIELDS, parse_packets
from packetlens.functions.text import tokens
from packetlens.operators import (
    chunks, conversations, hosts, messages, names, nameservers, pairs, windows,
)
from packetlens.plans import batch_jobs
from packetlens.plans.hive_views import pair_averages_by_tables, unique_hosts_by_views
from packetlens.session import work_dir
from packetlens.sources import archive, capture, checked, derived, output, topic
from packetlens.streaming import jobs
from packetlens.streaming.serving import SERVING, Serving, upsert_add, upsert_replace

Query = Callable[[SparkSession, str], DataFrame]

# Events are sparse, so most window queries use a window longer than the default.
DAY = "1 day"
# Longer than the events span: no row of a stream is late.
NEVER_LATE = "60 days"


def _plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the test tables have them."""
    times = [n for n, t in df.dtypes if t == "timestamp"]
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in times}) if times else df


def _on_packets(f: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: f(derived.packets(spark, sf_dir))


def _joined(df: DataFrame, column: str, sep: str) -> DataFrame:
    """A list column as one text."""
    return df.withColumn(column, F.array_join(column, sep))


# --- parsing -------------------------------------------------------------------------


def parse_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.packets(spark, sf_dir).select("seq", *FIELDS)


def parse_stream_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = derived.topic_records(spark, sf_dir)
    return records.select(
        "partition", "offset", envelope.stream_message(F.col("value")).alias("message")
    )


def parse_slice_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = derived.archive_lines(spark, sf_dir)
    return lines.select("seq", envelope.sliced_message(F.col("value")).alias("message"))


def query_direction(packets: DataFrame) -> DataFrame:
    query = I.is_query(tokens(F.col("info")))
    return packets.where(query.isNotNull()).select(
        "seq", F.when(query, "query").otherwise("response").alias("direction")
    )


def chunk_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.chunk_ids(derived.packet_lines(spark, sf_dir)).select("seq", "chunk_id")


def damaged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packet lines, some of them cut short, with no whole length, without text, or empty."""
    rows = derived.typed_packets(spark, sf_dir)
    seq, whole = F.col("seq"), F.concat_ws(",", *FIELDS)
    line = (
        F.when(seq % 17 == 0, "").when(seq % 11 == 0, F.concat_ws(",", *FIELDS[:3]))
        .when(seq % 13 == 0, F.concat_ws(",", *FIELDS[:3], F.lit("6 0"), "info"))
        .when(seq % 19 == 0, F.concat_ws(",", *FIELDS[:4], F.lit(" "))).otherwise(whole)
    )
    return rows.select("seq", "ts", line.alias("message"))


def parse_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line once, parsed or quarantined, beside the counts of the pass that told."""
    path = work_dir(spark, "checked")
    counts = checked.write_checked(damaged_lines(spark, sf_dir), path)
    return checked.read_checked(spark, path).select(
        "seq", "state", "reason", *[F.lit(n).cast("bigint").alias(f"n_{k}") for k, n in counts.items()])


def stream_parse_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a topic in which every 23rd record is none, with the counts that three
    runs reported."""
    root = work_dir(spark, "checked")
    lines = damaged_lines(spark, sf_dir).withColumns({
        "partition": (F.col("seq") % derived.TOPIC_PARTITIONS).cast("int"),
        "offset": F.floor(F.col("seq") / derived.TOPIC_PARTITIONS), "timestamp": F.col("ts").cast("timestamp")})
    record = F.when(F.col("seq") % 23 == 0, F.lit("{")).otherwise(envelope.to_stream(F.col("message")))
    records = lines.select(record.cast("binary").alias("value"), "timestamp", "partition", "offset")
    counts: dict[str, int] = {}
    for k in SLICES:
        records.where(day_slice() == k).write.mode("append").parquet(f"{root}/topic")
        source = topic.read_topic(spark, "parquet", path=f"{root}/topic")
        query = jobs.run_available(checked.checked_writer(source, f"{root}/out", f"{root}/checkpoint"))
        for progress in query.recentProgress:
            for name, n in progress.observedMetrics.get("lines", {}).asDict().items() if progress.observedMetrics else ():
                counts[name] = counts.get(name, 0) + n
    seq = F.col("offset") * derived.TOPIC_PARTITIONS + F.col("partition")
    return checked.read_checked(spark, f"{root}/out").select(
        seq.alias("seq"), "state", "reason", *[F.lit(n).cast("bigint").alias(f"n_{k}") for k, n in counts.items()])


# --- batch results that need more than the packets -----------------------------------


def find_hosts_by_join(packets: DataFrame) -> DataFrame:
    return hosts.find_hosts(packets, nameservers.nameserver_activity(packets))


def conversation_rows(packets: DataFrame) -> DataFrame:
    return conversations.messages(packets, "seq", "ts")


def conversation_list(packets: DataFrame) -> DataFrame:
    return _joined(conversations.conversations(conversation_rows(packets)), "messages", "\n")


def conversation_parts(packets: DataFrame) -> DataFrame:
    """Lists cut by days, and the place of every message in its part."""
    found = conversations.conversations(conversation_rows(packets), 86_400)
    return found.select(
        *conversations.KEY, "n_messages", "part", F.posexplode("messages").alias("place", "message"))


# Shorter than the events span, so that it divides conversations.
GAP = 86_400


def conversations_gap(packets: DataFrame) -> DataFrame:
    return _joined(conversations.gap_conversations(conversation_rows(packets), GAP), "messages", "\n")


def conversation_long(packets: DataFrame) -> DataFrame:
    found = conversations.conversation_messages(conversation_rows(packets))
    return found.select(*conversations.KEY, "n_messages", "seq", "message")


def hive_style_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = derived.archive_lines(spark, sf_dir)
    return unique_hosts_by_views(lines.select(F.col("value").alias("fields")))


def hive_pair_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{work_dir(spark, 'archive')}/archive"
    derived.archive_lines(spark, sf_dir).select("value").write.text(path)
    return pair_averages_by_tables(spark, path)


# --- streams -------------------------------------------------------------------------


def day_slice() -> Column:
    """Thirds of a month: 0, 1, 2."""
    return F.least(F.expr("(dayofmonth(timestamp) - 1) div 10"), F.lit(2))


SLICES = range(3)


def run_in_slices(
    spark: SparkSession,
    sf_dir: str,
    name: str,
    duration: str = DAY,
    watermark: str = NEVER_LATE,
    arrival: Column | None = None,
) -> Serving:
    """Fill a topic slice by slice; after each one start the job on its checkpoint, let it
    take what is new, and stop it. The serving tables then hold the work of three runs."""
    def start(packets: DataFrame, serving: Serving, checkpoint: str) -> DataStreamWriter:
        return jobs.writer(jobs.JOBS[name], packets, serving, checkpoint, duration, watermark)

    return fill_and_run(spark, sf_dir, start, day_slice() if arrival is None else arrival)


def fill_and_run(
    spark: SparkSession,
    sf_dir: str,
    start: Callable[[DataFrame, Serving, str], DataStreamWriter],
    slice_of: Column,
) -> Serving:
    root = work_dir(spark, "stream")
    feed, checkpoint = f"{root}/topic", f"{root}/checkpoint"
    serving = Serving(spark, f"{root}/serving")
    records = derived.topic_records(spark, sf_dir)
    for k in SLICES:
        records.where(slice_of == k).write.mode("append").parquet(feed)
        packets = topic.topic_packets(topic.read_topic(spark, "parquet", path=feed))
        jobs.run_available(start(packets, serving, checkpoint))
    return serving


SHARED = {
    "message_types": ("type", "packets"),
    "errors": ("address", "errors"),
    "categories": ("category", "requests"),
}


def stream_shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three counting jobs on one stream, their tables one below the other."""
    chosen = [jobs.JOBS[name] for name in SHARED]

    def start(packets: DataFrame, serving: Serving, checkpoint: str) -> DataStreamWriter:
        return jobs.shared_writer(chosen, packets, serving, checkpoint)

    serving = fill_and_run(spark, sf_dir, start, day_slice())
    parts = [
        jobs.read_result(name, serving).select(
            F.lit(name).alias("served"), F.col(key).alias("item"), F.col(value).alias("n")
        )
        for name, (key, value) in SHARED.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# A packet so much later than all others that it closes what they opened.
CLOSING = "2100-01-01 00:00:00"
# Every so manieth record is sent once more, one slice later.
AGAIN = 5


def closing_record(spark: SparkSession) -> DataFrame:
    """One query without a response: it moves the watermark and is given out nowhere."""
    line = "192.0.2.1,192.0.2.2,DNS,60,Standard query 0xffffff A closing.invalid"
    return spark.range(1).select(
        envelope.to_stream(F.lit(line)).cast("binary").alias("value"),
        F.lit(CLOSING).cast("timestamp").alias("timestamp"),
        F.lit(0).alias("partition"), F.lit(topic.OFFSET_RANGE - 1).alias("offset"))


def run_and_close(
    spark: SparkSession, sf_dir: str, name: str, duration: str = DAY, again: bool = False
) -> Serving:
    """Three runs over slices with late records, some of them sent twice if ``again``, and a
    run in which the last windows close."""
    root = work_dir(spark, "stream")
    feed, checkpoint = f"{root}/topic", f"{root}/checkpoint"
    serving = Serving(spark, f"{root}/serving")
    records, arrival = derived.topic_records(spark, sf_dir), late_arrival()
    seq = F.col("partition") + F.col("offset") * derived.TOPIC_PARTITIONS
    for k in [*SLICES, None]:
        if k is None:
            new = closing_record(spark)
        else:
            new = records.where(arrival == k)
            if again:
                new = new.unionByName(records.where((F.least(arrival + 1, F.lit(2)) == k) & (seq % AGAIN == 0)))
        new.write.mode("append").parquet(feed)
        packets = topic.topic_packets(topic.read_topic(spark, "parquet", path=feed))
        jobs.run_available(
            jobs.writer(jobs.JOBS[name], packets, serving, checkpoint, duration, NEVER_LATE))
    return serving


def _closed(name: str, duration: str, again: bool = False) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        served = jobs.read_result(name, run_and_close(spark, sf_dir, name, duration, again))
        lists = [c for c, t in served.dtypes if t == "array<string>"]
        return _plain_times(_joined(served, lists[0], "\n") if lists else served)

    return query


def stream_window_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four window tables filled by one stream, one below the other."""
    def start(packets: DataFrame, serving: Serving, checkpoint: str) -> DataStreamWriter:
        return jobs.totals_writer(packets, serving, checkpoint, DAY, NEVER_LATE)

    serving = fill_and_run(spark, sf_dir, start, late_arrival())
    parts = []
    for kind, columns in windows.TOTALS.items():
        source = {v: k for k, v in columns.items()}
        rows = jobs.read_result(kind, serving)
        parts.append(rows.select(
            F.lit(kind).alias("kind"), "start", "end",
            *[F.col(source[c]).cast(t).alias(c) if c in source else F.lit(None).cast(t).alias(c)
              for c, t in (("key", "string"), ("name", "string"), ("a", "bigint"), ("b", "bigint"))]))
    return _plain_times(reduce(DataFrame.unionByName, parts))


def _stream(name: str, shape: Callable[[DataFrame], DataFrame] = _plain_times) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return shape(jobs.read_result(name, run_in_slices(spark, sf_dir, name)))

    return query


def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One slice, a stop, the other two at once, a stop, and a start that finds nothing new."""
    arrival = F.least(day_slice(), F.lit(1))
    serving = run_in_slices(spark, sf_dir, "window_names", arrival=arrival)
    return _plain_times(jobs.read_result("window_names", serving))


def late_arrival() -> Column:
    """Every seventh packet comes one slice late."""
    late = (F.col("partition") + F.col("offset") * derived.TOPIC_PARTITIONS) % 7 == 0
    return F.least(day_slice() + F.when(late, 1).otherwise(0), F.lit(2))


def late_rows_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    serving = run_in_slices(
        spark, sf_dir, "window_message_types", watermark="0 seconds", arrival=late_arrival()
    )
    return _plain_times(jobs.read_result("window_message_types", serving))


def archive_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(spark, "archive")
    feed = f"{root}/topic"
    derived.topic_records(spark, sf_dir).write.parquet(feed)
    source = topic.read_topic(spark, "parquet", path=feed)
    jobs.run_available(archive.archive_writer(source, f"{root}/archive", f"{root}/checkpoint"))
    return parse_packets(archive.read_archive(spark, f"{root}/archive")).select(*FIELDS)


def capture_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures by the hour, with an empty one between, to chunks of 4,000 rows and back."""
    root = work_dir(spark, "chunks")
    rows = derived.typed_packets(spark, sf_dir)
    hourly = rows.select("seq", "ts", *FIELDS, F.hour("ts").alias("h")).repartition("h")
    form = {"header": True, "encoding": capture.CAPTURE_ENCODING, "escape": '"'}
    hourly.sortWithinPartitions("h", "seq").write.partitionBy("h").csv(f"{root}/captures", **form)
    hourly.drop("h").where("false").coalesce(1).write.csv(f"{root}/captures/h=3-none", **form)
    numbered = capture.numbered_captures(spark, f"{root}/captures/*")
    capture.write_exact_chunks(numbered, f"{root}/chunks")
    return capture.read_chunks(spark, f"{root}/chunks")


def _ingested(spark: SparkSession, sf_dir: str) -> str:
    """Captures -> chunk files -> watched folder -> topic records, below one root."""
    root = work_dir(spark, "ingest")
    rows = derived.typed_packets(spark, sf_dir)
    rows.select(
        "seq", "ts", *FIELDS, F.hour("ts").alias("hour")
    ).write.partitionBy("hour").csv(
        f"{root}/captures", header=True, encoding=capture.CAPTURE_ENCODING, escape='"'
    )
    capture.write_chunks(capture.read_captures(spark, f"{root}/captures/*"), f"{root}/chunks")
    lines = capture.watch_lines(spark, f"{root}/chunks")
    jobs.run_available(
        topic.topic_writer(lines, f"{root}/checkpoint", "parquet", path=f"{root}/topic")
    )
    return root


def csv_to_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From capture files over the topic to the messages of served conversations."""
    root = _ingested(spark, sf_dir)
    serving = Serving(spark, f"{root}/serving")
    packets = topic.topic_packets(topic.read_topic(spark, "parquet", path=f"{root}/topic"))
    jobs.run_available(jobs.writer(jobs.JOBS["conversations"], packets, serving, f"{root}/talk"))
    return jobs.read_conversations(serving).select(
        *conversations.KEY, "n_messages", F.explode("messages").alias("message"))


def csv_ingest_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = spark.read.parquet(f"{_ingested(spark, sf_dir)}/topic")
    return parse_packets(
        records.select(envelope.stream_message(F.col("value")).alias("message"))
    ).select(*FIELDS)


# --- serving tables and files --------------------------------------------------------


def _halves(packets: DataFrame) -> tuple[DataFrame, DataFrame]:
    # Packets without a time are in the second half.
    first = F.coalesce(F.dayofmonth("ts") <= 15, F.lit(False))
    return (
        names.name_counts(packets.where(first)),
        names.name_counts(packets.where(~first)),
    )


NAME_KEYS = ["request_response", "type"]


def replaced(packets: DataFrame) -> DataFrame:
    old, new = _halves(packets)
    return upsert_replace(old, new, NAME_KEYS)


def added(packets: DataFrame) -> DataFrame:
    old, new = _halves(packets)
    return upsert_add(old, new, NAME_KEYS)


def _served_names(spark: SparkSession, sf_dir: str) -> Serving:
    """Both halves as epochs 0 and 1, and epoch 1 once more."""
    serving = Serving(spark, work_dir(spark, "serving"))
    table = SERVING["domain_requests_and_responses"]
    old, new = _halves(derived.packets(spark, sf_dir))
    serving.create(table)
    serving.apply(table, old, 0)
    serving.apply(table, new, 1)
    serving.apply(table, new, 1)
    return serving


def upsert_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _served_names(spark, sf_dir).read(SERVING["domain_requests_and_responses"])


def serving_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    serving = _served_names(spark, sf_dir)
    table = SERVING["domain_requests_and_responses"]
    serving.compact(table)
    return serving.read(table)


def upsert_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream's epoch, a compaction, and a stream without its checkpoint at epoch 0 again."""
    serving = Serving(spark, work_dir(spark, "serving"))
    table = SERVING["domain_requests_and_responses"]
    old, new = _halves(derived.packets(spark, sf_dir))
    serving.apply(table, old, 0, "first")
    serving.compact(table)
    serving.apply(table, new, 0, "second")
    serving.apply(table, new, 0, "second")
    return serving.read(table)


def _served_nameservers(spark: SparkSession, sf_dir: str) -> tuple[str, Serving]:
    """An archive, and the table that the batch job fills from it."""
    root = work_dir(spark, "nameservers")
    derived.archive_lines(spark, sf_dir).select("value").write.text(f"{root}/archive")
    serving = Serving(spark, f"{root}/serving")
    batch_jobs.run(spark, "nameservers", f"{root}/archive", serving=serving)
    return f"{root}/archive", serving


def serving_nameservers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _served_nameservers(spark, sf_dir)[1].read(SERVING["nameservers"])


def find_hosts_served(spark: SparkSession, sf_dir: str) -> DataFrame:
    archived, serving = _served_nameservers(spark, sf_dir)
    return batch_jobs.result(spark, "find_host", archived, serving, "json")


def serving_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    serving = _served_names(spark, sf_dir)
    table = SERVING["domain_requests_and_responses"]
    return serving.lookup(table, request_response="google.com", type="A")


PAIR_SCHEMA = "address_a string, address_b string, total bigint, avg double, count bigint"


def tsv_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "tsv")
    output.write_tsv(pairs.pair_traffic_rounded(derived.packets(spark, sf_dir)), path)
    return output.read_tsv(spark, path, PAIR_SCHEMA)


def tsv_single_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "tsv")
    found = pairs.pair_traffic_rounded(derived.packets(spark, sf_dir))
    output.write_tsv(found, path, single_file=True)
    return output.read_tsv(spark, path, PAIR_SCHEMA)


def pair_traffic_from_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "packets")
    archive.write_packet_table(derived.packets(spark, sf_dir), path)
    return pairs.pair_traffic(archive.read_packet_table(spark, path))


# --- the registry --------------------------------------------------------------------


def _window(f: Callable[..., DataFrame], duration: str) -> Query:
    return lambda spark, sf_dir: _plain_times(f(derived.packets(spark, sf_dir), duration))


STATIC: dict[str, Query] = {
    "parse_packets": parse_all,
    "parse_stream_envelope": parse_stream_envelope,
    "parse_slice_envelope": parse_slice_envelope,
    "query_domains": _on_packets(lambda p: names.query_domains(p, "seq")),
    "response_records": _on_packets(lambda p: names.response_records(p, "seq")),
    "query_direction": _on_packets(query_direction),
    "chunk_assign": chunk_assign,
    "parse_checked": parse_checked,
    "directed_traffic": _on_packets(pairs.directed_traffic),
    "pair_traffic": _on_packets(pairs.pair_traffic),
    "pair_traffic_join": _on_packets(pairs.pair_traffic_by_join),
    "pair_traffic_no_self": _on_packets(lambda p: pairs.pair_traffic(p, self_pairs="drop")),
    "pair_traffic_rounded": _on_packets(pairs.pair_traffic_rounded),
    "pair_average_ranked": _on_packets(pairs.pair_average_ranked),
    "unique_hosts": _on_packets(names.unique_hosts),
    "unique_hosts_dns": _on_packets(lambda p: names.unique_hosts_ranked(p, dns_only=True)),
    "unique_hosts_ranked": _on_packets(names.unique_hosts_ranked),
    "host_pairs": _on_packets(names.host_pairs),
    "host_lists": _on_packets(lambda p: _joined(names.host_lists(p), "hosts", ",")),
    "host_list_parts": _on_packets(
        lambda p: names.host_lists(p, parts=4).select(
            "type", "request_response", "count", F.explode("hosts").alias("host"))),
    "find_hosts": _on_packets(nameservers.unproven),
    "find_hosts_join": _on_packets(find_hosts_by_join),
    "message_types": _on_packets(messages.message_types),
    "error_sources": _on_packets(messages.error_sources),
    "nameserver_activity": _on_packets(nameservers.nameserver_activity),
    "nameserver_queries_only": _on_packets(
        lambda p: nameservers.nameserver_activity(p, ("queries",))),
    "nameserver_updates_only": _on_packets(
        lambda p: nameservers.nameserver_activity(p, ("updates",))),
    "nameserver_status_only": _on_packets(
        lambda p: nameservers.nameserver_activity(p, ("status",))),
    "name_counts": _on_packets(names.name_counts),
    "category_counts": _on_packets(names.category_counts),
    "conversations": _on_packets(conversation_list),
    "conversation_parts": _on_packets(conversation_parts),
    "conversation_messages": _on_packets(conversation_long),
    "conversations_gap": lambda spark, sf_dir: _plain_times(
        conversations_gap(derived.packets(spark, sf_dir))),
    "window_bytes_packets": _window(windows.window_bytes_packets, DAY),
    "window_exchanged_packets": _window(windows.window_exchanged_packets, DAY),
    "window_message_types": _window(windows.window_message_types, DAY),
    "window_names": _window(windows.window_names, DAY),
    "window_bytes_packets_20s": _window(windows.window_bytes_packets, windows.DURATION),
    "window_exchanged_packets_20s": _window(windows.window_exchanged_packets, windows.DURATION),
    "window_message_types_20s": _window(windows.window_message_types, windows.DURATION),
    "window_names_20s": _window(windows.window_names, windows.DURATION),
    "window_bytes_packets_distinct": _window(windows.window_bytes_packets_distinct, DAY),
    "window_message_types_distinct": _window(windows.window_message_types_distinct, DAY),
    "window_names_distinct": _window(windows.window_names_distinct, DAY),
    "upsert_replace": _on_packets(replaced),
    "upsert_add": _on_packets(added),
    "upsert_replay": upsert_replay,
    "upsert_restart": upsert_restart,
    "serving_compact": serving_compact,
    "serving_nameservers": serving_nameservers,
    "find_hosts_served": find_hosts_served,
    "serving_lookup": serving_lookup,
    "tsv_output": tsv_output,
    "tsv_single_file": tsv_single_file,
    "pair_traffic_from_table": pair_traffic_from_table,
    "hive_style_views": hive_style_views,
    "hive_pair_views": hive_pair_views,
    "capture_chunks": capture_chunks,
}

STREAMS: dict[str, Query] = {
    "stream_message_types": _stream("message_types"),
    "stream_errors": _stream("errors"),
    "stream_nameservers": _stream("nameservers"),
    "stream_nameservers_from_evidence": _stream("nameservers_from_evidence"),
    "stream_parse_checked": stream_parse_checked,
    "stream_name_counts": _stream("names"),
    "stream_categories": _stream("categories"),
    "stream_shared": stream_shared,
    "stream_conversations": _stream(
        "conversations", lambda df: _joined(df, "messages", "\n")),
    "stream_conversations_gap": lambda spark, sf_dir: _plain_times(_joined(
        jobs.read_conversations(run_in_slices(spark, sf_dir, "conversations"), GAP),
        "messages", "\n")),
    "stream_conversations_per_batch": _stream(
        "conversations_per_batch", lambda df: _joined(df, "messages", "\n")),
    "stream_window_bytes_packets": _stream("window_bytes_packets"),
    "stream_window_exchanged_packets": _stream("window_exchanged_packets"),
    "stream_window_message_types": _stream("window_message_types"),
    "stream_window_names": _stream("window_names"),
    "stream_conversations_closed": _closed("closed_conversations", f"{GAP} seconds"),
    "stream_window_bytes_packets_distinct": _closed("window_bytes_packets_distinct", DAY, True),
    "stream_window_message_types_distinct": _closed("window_message_types_distinct", DAY, True),
    "stream_window_names_distinct": _closed("window_names_distinct", DAY, True),
    "stream_window_totals": stream_window_totals,
    "stream_resume": stream_resume,
    "late_rows_dropped": late_rows_dropped,
    "archive_roundtrip": archive_roundtrip,
    "csv_ingest_roundtrip": csv_ingest_roundtrip,
    "csv_to_conversations": csv_to_conversations,
}

QUERIES: dict[str, Query] = {**STATIC, **STREAMS}
