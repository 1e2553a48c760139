"""Streams: restarts, replays, late rows, cross-batch pairing, compaction."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from checks import DATA
from packetlens.functions.envelope import to_stream
from packetlens.operators import conversations, messages, windows
from packetlens.plans.registry import late_rows_dropped
from packetlens.sources import derived, topic
from packetlens.streaming import jobs
from packetlens.streaming.serving import SERVING, Serving, upsert_add, upsert_replace

SF = f"{DATA}/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def publish(spark, path, lines, first=0, second="2024-01-01 00:00:00"):
    """Append packet lines, one offset each, all at one time."""
    data = [(i + first, line, second) for i, line in enumerate(lines)]
    spark.createDataFrame(data, "offset bigint, m string, at string").select(
        to_stream(F.col("m")).cast("binary").alias("value"),
        F.to_timestamp("at").alias("timestamp"),
        F.lit(0).alias("partition"),
        "offset",
    ).coalesce(1).write.mode("append").parquet(path)


def run(spark, name, root, **args):
    serving = Serving(spark, f"{root}/serving")
    packets = topic.topic_packets(topic.read_topic(spark, "parquet", path=f"{root}/topic"))
    jobs.run_available(
        jobs.writer(jobs.JOBS[name], packets, serving, f"{root}/checkpoint", **args)
    )
    return serving


QUERY = "1.1.1.1,2.2.2.2,DNS,60,Standard query 0x1 A a.b"
REPLY = "2.2.2.2,1.1.1.1,DNS,80,Standard query response 0x1 A a.b CNAME c.d"


def test_conversation_across_batches(spark, tmp_path):
    root = str(tmp_path)
    publish(spark, f"{root}/topic", [QUERY])
    assert jobs.read_conversations(run(spark, "conversations", root)).count() == 0
    publish(spark, f"{root}/topic", [REPLY], first=1)
    found = jobs.read_conversations(run(spark, "conversations", root)).collect()
    assert [(r.query_id, r.client, r.server, r.n_messages) for r in found] == [
        ("0x1", "1.1.1.1", "2.2.2.2", 2)]
    assert [m.split(" src: ")[1] for m in found[0].messages] == [
        "1.1.1.1 dest: 2.2.2.2", "2.2.2.2 dest: 1.1.1.1"]


def test_conversation_within_a_batch_only(spark, tmp_path):
    root = str(tmp_path)
    publish(spark, f"{root}/topic", [QUERY])
    run(spark, "conversations_per_batch", root)
    publish(spark, f"{root}/topic", [REPLY], first=1)
    serving = run(spark, "conversations_per_batch", root)
    assert jobs.read_result("conversations_per_batch", serving).count() == 0


def test_evidence_from_a_later_batch_counts_back(spark, tmp_path):
    root = str(tmp_path)
    publish(spark, f"{root}/topic", ["2.2.2.2,3.3.3.3,DNS,60,Standard query 0x9 A a.b"])
    run(spark, "nameservers", root)
    publish(spark, f"{root}/topic", [QUERY], first=1)
    served = jobs.read_nameservers(run(spark, "nameservers", root))
    assert rows(served) == [("2.2.2.2", 1, 1), ("3.3.3.3", 0, 1)]


@pytest.mark.parametrize("name", ["message_types", "window_bytes_packets"])
def test_restart_without_new_data_changes_nothing(spark, tmp_path, name):
    root = str(tmp_path)
    publish(spark, f"{root}/topic", [QUERY, REPLY])
    first = rows(jobs.read_result(name, run(spark, name, root)))
    assert first
    assert rows(jobs.read_result(name, run(spark, name, root))) == first
    publish(spark, f"{root}/topic", [QUERY], first=2)
    assert rows(jobs.read_result(name, run(spark, name, root))) != first


def test_running_totals_replace_instead_of_adding(spark, tmp_path):
    root = str(tmp_path)
    for first in range(0, 6, 2):
        publish(spark, f"{root}/topic", [QUERY, REPLY], first)
        serving = run(spark, "window_bytes_packets", root)
    assert [r[2:] for r in rows(serving.read(SERVING["window_bytes_packets"]))] == [(420, 6)]


def test_many_small_batches_equal_the_static_result(spark, tmp_path):
    root = str(tmp_path)
    derived.topic_records(spark, SF).repartition(6).write.parquet(f"{root}/topic")
    source = topic.read_topic(spark, "parquet", path=f"{root}/topic", maxFilesPerTrigger="1")
    serving = Serving(spark, f"{root}/serving")
    packets = topic.topic_packets(source)
    static = derived.packets(spark, SF).withColumn("ts", F.col("ts").cast("timestamp"))
    for name, want in (
        ("window_exchanged_packets", windows.window_exchanged_packets(static, "1 day")),
        ("message_types", messages.message_types(static)),
    ):
        query = jobs.run_available(
            jobs.writer(jobs.JOBS[name], packets, serving, f"{root}/cp-{name}", "1 day", "60 days")
        )
        assert query.lastProgress["batchId"] >= 5
        assert rows(jobs.read_result(name, serving)) == rows(want)


def test_late_rows_are_really_dropped(spark):
    kept = late_rows_dropped(spark, SF).agg(F.sum("count")).first()[0]
    total = derived.packets(spark, SF).where("protocol = 'DNS'").count()
    assert 0 < kept < total


def test_state_is_dropped_once_a_window_has_closed(spark, tmp_path):
    root = str(tmp_path)
    for k in range(4):
        publish(spark, f"{root}/topic", [QUERY], k, f"2024-01-0{k + 1} 00:00:00")
        packets = topic.topic_packets(topic.read_topic(spark, "parquet", path=f"{root}/topic"))
        query = jobs.run_available(
            jobs.writer(jobs.JOBS["window_message_types"], packets,
                        Serving(spark, f"{root}/serving"), f"{root}/checkpoint",
                        "1 hour", "0 seconds")
        )
    state = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress
             if p["stateOperators"]]
    assert state[-1] <= 1


NAMES = SERVING["domain_requests_and_responses"]


def counts(spark, **n):
    return spark.createDataFrame([(k, "A", v) for k, v in n.items()], NAMES.schema)


def test_replayed_epoch_counts_once(spark, tmp_path):
    serving = Serving(spark, str(tmp_path))
    serving.apply(NAMES, counts(spark, a=1, b=2), 0)
    serving.apply(NAMES, counts(spark, a=10), 1)
    serving.apply(NAMES, counts(spark, a=10), 1)
    assert rows(serving.read(NAMES)) == [("a", "A", 11), ("b", "A", 2)]
    # A replay may also write less or more than the attempt that was cut short.
    serving.apply(NAMES, counts(spark, c=5), 1)
    assert rows(serving.read(NAMES)) == [("a", "A", 1), ("b", "A", 2), ("c", "A", 5)]


def test_unfinished_epoch_is_not_read(spark, tmp_path):
    serving = Serving(spark, str(tmp_path))
    serving.apply(NAMES, counts(spark, a=1), 0)
    serving.apply(NAMES, counts(spark, a=7), 1)
    (tmp_path / NAMES.name / "changes" / "epoch=1" / "_SUCCESS").unlink()
    assert rows(serving.read(NAMES)) == [("a", "A", 1)]


def test_compaction_keeps_the_rows(spark, tmp_path):
    serving = Serving(spark, str(tmp_path))
    for epoch in range(3):
        serving.apply(NAMES, counts(spark, a=1, **{f"n{epoch}": 1}), epoch)
    before = rows(serving.read(NAMES))
    serving.compact(NAMES)
    serving.compact(NAMES)
    assert rows(serving.read(NAMES)) == before
    assert serving.next_epoch(NAMES) == 3
    # A replay of an epoch the snapshot holds changes nothing.
    serving.apply(NAMES, counts(spark, a=1, n2=1), 2)
    assert rows(serving.read(NAMES)) == before
    serving.apply(NAMES, counts(spark, a=1), 3)
    assert ("a", "A", 4) in rows(serving.read(NAMES))
    serving.create(NAMES)
    assert rows(serving.read(NAMES)) == []
    serving.apply(NAMES, counts(spark, z=1), 0)
    assert rows(serving.read(NAMES)) == [("z", "A", 1)]


def test_newest_row_wins_and_pieces_go_together(spark, tmp_path):
    serving = Serving(spark, str(tmp_path))
    table = SERVING["conversations"]
    new = lambda *r: spark.createDataFrame(list(r), table.schema)
    serving.apply(table, new(("i", "c", "s", 0, 3, ["x"]), ("i", "c", "s", 9, 3, ["y", "z"]),
                             ("j", "c", "s", 0, 2, ["p", "q"])), 0)
    serving.apply(table, new(("i", "c", "s", 0, 2, ["u", "v"])), 1)
    assert rows(serving.read(table)) == [
        ("i", "c", "s", 0, 2, ["u", "v"]), ("j", "c", "s", 0, 2, ["p", "q"])]
    hosts = SERVING["hosts"]
    for epoch in (0, 1):
        serving.apply(hosts, spark.createDataFrame([("a",), ("b",)], "host string"), epoch)
    assert rows(serving.read(hosts)) == [("a",), ("b",)]


def test_every_table_can_be_created_and_read(spark, tmp_path):
    serving = Serving(spark, str(tmp_path))
    for table in SERVING.values():
        assert serving.read(table).count() == 0
        serving.create(table)
        got = serving.read(table)
        assert got.columns == list(table.columns) and got.count() == 0


def test_lookup_reaches_the_scan(spark, tmp_path):
    serving = Serving(spark, str(tmp_path))
    serving.apply(NAMES, counts(spark, a=1, b=2), 0)
    found = serving.lookup(NAMES, request_response="b", type="A")
    assert rows(found) == [("b", "A", 2)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(request_response,b)" in plan


def test_window_jobs_do_not_share_a_stream(spark, tmp_path):
    with pytest.raises(ValueError):
        jobs.shared_writer([jobs.JOBS["window_names"]], spark.range(1), Serving(spark, "x"), "y")


def test_upserts(spark):
    old, new = counts(spark, a=1, b=2), counts(spark, b=5, c=7)
    keys = ["request_response", "type"]
    assert rows(upsert_replace(old, new, keys)) == [("a", "A", 1), ("b", "A", 5), ("c", "A", 7)]
    assert rows(upsert_add(old, new, keys)) == [("a", "A", 1), ("b", "A", 7), ("c", "A", 7)]


def test_sequence_numbers_are_unique_over_partitions(spark):
    p = topic.topic_packets(derived.topic_records(spark, SF))
    assert p.select("seq").distinct().count() == p.count()
    talk = conversations.messages(p, "seq", "ts")
    static = conversations.messages(derived.packets(spark, SF), "seq", "ts")
    sizes = lambda t: Counter(
        r.n_messages for r in conversations.conversations(t).collect())
    assert sizes(talk) == sizes(static)


def test_a_stream_without_its_checkpoint_adds_to_the_table(spark, tmp_path):
    root = str(tmp_path)
    publish(spark, f"{root}/topic", [QUERY, REPLY])
    serving = Serving(spark, f"{root}/serving")
    packets = topic.topic_packets(topic.read_topic(spark, "parquet", path=f"{root}/topic"))
    for attempt, want in (("one", 2), ("two", 4), ("two", 4)):
        jobs.run_available(
            jobs.writer(jobs.JOBS["message_types"], packets, serving, f"{root}/{attempt}"))
        serving.compact(SERVING["message_types"])
        served = jobs.read_result("message_types", serving)
        assert served.agg(F.sum("packets")).first()[0] == want


def test_a_store_without_marks_is_an_error(spark, tmp_path):
    serving = Serving(spark, str(tmp_path))
    for epoch in (0, 1):
        serving.apply(NAMES, counts(spark, a=1), epoch)
    (tmp_path / NAMES.name / "changes" / "epoch=0" / "_SUCCESS").unlink()
    with pytest.raises(RuntimeError):
        serving.read(NAMES)


def test_file_topic_offsets_are_unique_over_batches(spark):
    lines = spark.range(40, numPartitions=3).select(F.lit("x").alias("value"))
    both = topic.numbered(lines, 0).union(topic.numbered(lines, 1))
    assert both.select("partition", "offset").distinct().count() == 80
    with pytest.raises(ValueError):
        topic.numbered(lines, topic.OFFSET_RANGE // topic.BATCH_OFFSETS)


def test_gap_divides_conversations(spark):
    talk = spark.sql("""
        SELECT '1' AS query_id, 'c' AS client, 's' AS server, id AS seq, CAST(id AS STRING) AS message,
               timestamp_micros(array(5000000, 14999999, 25000000, 35000000, 34999999, -3)[id]) AS ts
        FROM range(6)
        UNION ALL SELECT '2', 'c', 's', id, 'm', CAST(null AS TIMESTAMP) FROM range(2)
        UNION ALL SELECT '3', 'c', 's', 0, 'm', timestamp_micros(0)""")
    found = conversations.gap_conversations(talk, 10).collect()
    # 14.999999 s to 25 s is a pause; 25 s to 35 s is not.
    assert sorted(tuple(r.messages) for r in found) == [("2", "4", "3"), ("5", "0", "1"), ("m", "m")]


def start(spark, name, root, **args):
    packets = topic.topic_packets(topic.read_topic(spark, "parquet", path=f"{root}/topic"))
    return jobs.run_available(jobs.writer(
        jobs.JOBS[name], packets, Serving(spark, f"{root}/serving"), f"{root}/checkpoint", **args))


def closed(spark, root):
    served = Serving(spark, f"{root}/serving").read(SERVING["closed_conversations"])
    return sorted((r.query_id, r.n_messages, tuple(m.split(" src: ")[1] for m in r.messages)) for r in served.collect())


OTHER = "9.9.9.9,8.8.8.8,DNS,60,Standard query 0xf A a.b"
THERE, BACK = "1.1.1.1 dest: 2.2.2.2", "2.2.2.2 dest: 1.1.1.1"


def test_a_conversation_is_given_out_once_when_its_gap_has_passed(spark, tmp_path):
    root, talk = str(tmp_path), {"duration": "10 seconds", "watermark": "5 seconds"}
    publish(spark, f"{root}/topic", [QUERY], 0, "2024-01-01 00:00:00")
    start(spark, "closed_conversations", root, **talk)
    # The second half comes in another run, exactly one gap later.
    publish(spark, f"{root}/topic", [REPLY], 1, "2024-01-01 00:00:10")
    start(spark, "closed_conversations", root, **talk)
    assert closed(spark, root) == []
    publish(spark, f"{root}/topic", [OTHER], 2, "2024-01-01 00:00:30")
    start(spark, "closed_conversations", root, **talk)
    assert closed(spark, root) == [("0x1", 2, (THERE, BACK))]
    # Later than the watermark: dropped, and the pair is not opened again.
    publish(spark, f"{root}/topic", [REPLY], 3, "2024-01-01 00:00:12")
    publish(spark, f"{root}/topic", [OTHER], 4, "2024-01-01 00:02:00")
    start(spark, "closed_conversations", root, **talk)
    assert closed(spark, root) == [("0x1", 2, (THERE, BACK))]
    # The same id again after the gap is a conversation of its own.
    publish(spark, f"{root}/topic", [QUERY, REPLY], 5, "2024-01-01 00:02:01")
    publish(spark, f"{root}/topic", [OTHER], 7, "2024-01-01 00:09:00")
    for _ in range(2):
        start(spark, "closed_conversations", root, **talk)
        assert closed(spark, root) == [("0x1", 2, (THERE, BACK))] * 2


def test_messages_out_of_order_bridge_a_conversation(spark, tmp_path):
    root, talk = str(tmp_path), {"duration": "10 seconds", "watermark": "60 seconds"}
    for k, (line, second) in enumerate([(QUERY, "00"), (QUERY, "18"), (REPLY, "09")]):
        publish(spark, f"{root}/topic", [line], k, f"2024-01-01 00:00:{second}")
        start(spark, "closed_conversations", root, **talk)
    publish(spark, f"{root}/topic", [OTHER], 3, "2024-01-01 01:00:00")
    start(spark, "closed_conversations", root, **talk)
    assert closed(spark, root) == [("0x1", 3, (THERE, BACK, THERE))]


def test_state_of_closed_conversations_is_freed(spark, tmp_path):
    root, kept = str(tmp_path), []
    for k in range(5):
        lines = [f"1.1.1.{i},2.2.2.2,DNS,60,Standard query 0x{k:x}{i:x} A a.b" for i in range(20)]
        publish(spark, f"{root}/topic", lines, 100 * k, f"2024-01-01 0{k}:00:00")
        query = start(spark, "closed_conversations", root, duration="10 seconds", watermark="5 seconds")
        kept.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert max(kept) <= 40 and kept[-1] <= 20


def test_closed_conversations_of_a_table_are_those_of_the_gap(spark):
    static = derived.packets(spark, SF).withColumn("ts", F.col("ts").cast("timestamp"))
    talk = conversations.messages(static, "seq", "ts")
    for gap in (86_400, 3_600, 1):
        got = rows(conversations.closed_conversations(static, f"{gap} seconds"))
        assert got == rows(conversations.gap_conversations(talk, gap))


@pytest.mark.parametrize("name", ["window_bytes_packets_distinct", "window_message_types_distinct", "window_names_distinct"])
def test_a_line_counts_once_per_window_over_micro_batches(spark, tmp_path, name):
    root, args = str(tmp_path), {"duration": "1 hour", "watermark": "10 minutes"}
    for k in range(3):
        publish(spark, f"{root}/topic", [QUERY, REPLY], 2 * k, "2024-01-01 00:10:00")
        start(spark, name, root, **args)
    publish(spark, f"{root}/topic", [QUERY], 6, "2024-01-01 01:10:00")
    publish(spark, f"{root}/topic", [QUERY], 7, "2024-01-01 09:00:00")
    query = start(spark, name, root, **args)
    served = rows(Serving(spark, f"{root}/serving").read(jobs.JOBS[name].target).drop("start", "end"))
    want = {
        "window_bytes_packets_distinct": [(140, 6), (60, 1)],
        "window_message_types_distinct": [("Standard query", 1), ("Standard query", 2)],
        "window_names_distinct": [("A", "a.b", 1), ("A", "a.b", 1), ("CNAME", "c.d", 1)],
    }[name]
    assert served == want
    # Both states of closed windows are empty but for the window still open.
    assert all(s["numRowsTotal"] <= 2 for s in query.lastProgress["stateOperators"])


def test_four_window_tables_come_from_one_read(spark, tmp_path):
    root = str(tmp_path)
    derived.topic_records(spark, SF).repartition(3).write.parquet(f"{root}/topic")
    source = topic.read_topic(spark, "parquet", path=f"{root}/topic", maxFilesPerTrigger="1")
    packets, serving = topic.topic_packets(source), Serving(spark, f"{root}/serving")
    query = jobs.run_available(jobs.totals_writer(packets, serving, f"{root}/cp", "1 day", "60 days"))
    reports = [p for p in query.recentProgress if p["numInputRows"]]
    total = derived.packets(spark, SF).count()
    assert sum(p["numInputRows"] for p in reports) == total and len(reports) == 3
    assert all(len(p["sources"]) == 1 and len(p["stateOperators"]) == 1 for p in reports)
    static = derived.packets(spark, SF).withColumn("ts", F.col("ts").cast("timestamp"))
    for kind in windows.TOTALS:
        want = getattr(windows, kind)(static, "1 day")
        assert rows(jobs.read_result(kind, serving)) == rows(want)
        assert rows(windows.total_of(windows.window_totals(static, "1 day"), kind)) == rows(want)


def test_nameserver_state_is_read_by_address_only(spark, tmp_path):
    root = str(tmp_path)
    lines = [f"1.1.{i // 250}.{i % 250},7.7.{i // 250}.{i % 250},DNS,60,Standard query 0x1 A a.b" for i in range(1000)]
    publish(spark, f"{root}/topic", lines)
    start(spark, "nameservers", root)
    publish(spark, f"{root}/topic", [QUERY], 1000)
    query = start(spark, "nameservers", root)
    state = [p["stateOperators"][0] for p in query.recentProgress if p["numInputRows"]]
    assert state[-1]["numRowsTotal"] >= 2000 and state[-1]["numRowsUpdated"] <= 2
    last = Serving(spark, f"{root}/serving").written(SERVING["nameservers"], 1)
    assert rows(last) == [("2.2.2.2", 0, 1)]


def test_a_lookup_opens_one_bucket(spark, tmp_path):
    serving = Serving(spark, str(tmp_path))
    for epoch in range(6):
        serving.apply(NAMES, counts(spark, **{f"n{i}": 1 for i in range(50)}, a=1), epoch)
    found = serving.lookup(NAMES, request_response="a", type="A")
    assert rows(found) == [("a", "A", 6)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan
    serving.compact(NAMES)
    assert rows(serving.lookup(NAMES, request_response="a", type="A")) == [("a", "A", 6)]
    assert rows(serving.lookup(NAMES, request_response="n7")) == [("n7", "A", 6)]
    assert serving.read(NAMES).count() == 51
    assert rows(serving.lookup(NAMES, request_response="none", type="A")) == []
    # A lookup still works when no file of another bucket can be opened.
    own = spark.range(1).select(NAMES.bucket_of(F.lit("a"), F.lit("A"))).first()[0]
    spoilt = [f for f in tmp_path.glob("**/bucket=*/*.parquet") if f.parent.name != f"bucket={own}"]
    assert len({f.parent.name for f in spoilt}) == NAMES.buckets - 1
    for f in spoilt:
        f.write_bytes(b"spoilt")
        f.with_name(f".{f.name}.crc").unlink(missing_ok=True)
    assert rows(serving.lookup(NAMES, request_response="a", type="A")) == [("a", "A", 6)]
    with pytest.raises(Exception, match="Parquet|parquet"):
        serving.read(NAMES).collect()
