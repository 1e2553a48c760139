"""Operators against plain Python on hand-made and random packets, with small spans."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from packetlens.functions.packet import parse_packets
from packetlens.operators import (
    chunks, conversations, hosts, messages, names, nameservers, pairs, windows,
)
from packetlens.operators.spread import with_group_size


def packets(spark, lines, partitions=3):
    rows = [(i, f"2024-01-01 00:00:{i % 60:02d}", line) for i, line in enumerate(lines)]
    df = spark.createDataFrame(rows, "seq bigint, ts string, message string")
    return parse_packets(df.withColumn("ts", F.to_timestamp("ts")).repartition(partitions))


def rows(df):
    return sorted(tuple(r) for r in df.collect())


EDGE = [
    "10.0.0.1,10.0.0.1,DNS,80,Standard query 0x0001 A a.b.com",
    "fe80::1,fe80::2,DNS,90,Standard query 0x0002 A a.b",
    "fe80::2,fe80::1,DNS,110,Standard query response 0x0002 A a.b CNAME",
    "1.1.1.1,2.2.2.2,DNS,60,Malformed",
    "1.1.1.1,2.2.2.2,DNS,60,Standard query",
    "1.1.1.1,2.2.2.2,DNS,abc,Standard query 0x0003 A a.b",
    "1.1.1.1,2.2.2.2",
    "",
    "9.9.9.9,10.0.0.1,DNS,50,Standard query 0x0004 A <Root>",
    "10.0.0.1,9.9.9.9,DNS,70,Standard query response 0x0004 A x CNAME CNAME y",
    "2.2.2.2,3.3.3.3,DNS,10,Standard query 0x0005 A com.  ",
    "2.2.2.2,3.3.3.3,TCP,10,53 > 400 [SYN]",
]


def test_pairs_on_edges(spark):
    p = packets(spark, EDGE)
    want = [
        ("1.1.1.1", "2.2.2.2", 120, 60.0, 2),
        ("10.0.0.1", "10.0.0.1", 80, 80.0, 1),
        ("2.2.2.2", "3.3.3.3", 10, 10.0, 1),
        ("9.9.9.9", "10.0.0.1", 120, 60.0, 2),
        ("fe80::1", "fe80::2", 200, 100.0, 2),
    ]
    assert rows(pairs.pair_traffic(p)) == want
    no_self = [w for w in want if w[0] != w[1]]
    assert rows(pairs.pair_traffic(p, self_pairs="drop")) == no_self
    assert rows(pairs.pair_traffic_by_join(p)) == no_self
    doubled = pairs.pair_traffic(p, self_pairs="double").where("address_a = address_b")
    assert rows(doubled) == [("10.0.0.1", "10.0.0.1", 160, 80.0, 2)]
    smaller = [r[:2] for r in rows(pairs.pair_traffic(p, leader="smaller"))]
    assert ("10.0.0.1", "9.9.9.9") in smaller
    with pytest.raises(ValueError):
        pairs.pair_traffic(p, leader="first")


def test_names_on_edges(spark):
    p = packets(spark, EDGE)
    want = [("A", "<Root>"), ("A", "a.b"), ("A", "a.b"), ("A", "b.com"), ("A", "com."),
            ("CNAME", "CNAME"), ("CNAME", "y")]
    assert rows(names.name_records(p)) == want
    assert rows(names.response_records(p)) == [("CNAME", "CNAME"), ("CNAME", "y")]
    assert sorted(r[0] for r in names.query_domains(p).collect()) == [n for t, n in want if t == "A"]


def test_messages_on_edges(spark):
    p = packets(spark, EDGE)
    assert rows(messages.message_types(p)) == [
        ("Error/Unknown operation", 1), ("Standard query", 8)]
    assert rows(messages.error_sources(p)) == [("1.1.1.1", 1)]


def test_hosts_are_addresses_that_are_no_nameserver(spark):
    p = packets(spark, EDGE)
    found = hosts.find_hosts(p, nameservers.nameserver_activity(p))
    everyone = {a for line in EDGE for a in line.split(",")[:2] if line}
    known = {"10.0.0.1", "fe80::2", "2.2.2.2", "3.3.3.3"}
    assert {r[0] for r in found.collect()} == (everyone | {""}) - known


def traffic(n, seed, hot=True):
    """Random packets; with ``hot`` a third of them are one conversation asking one name."""
    rng = random.Random(seed)
    ips = [f"10.0.{i % 3}.{i}" for i in range(1, 30)]
    out = []
    for i in range(n):
        if hot and i % 3 == 0:
            out.append("10.0.0.1,10.0.0.2,DNS,77,Standard query 0x0000 A hot.example.com")
            continue
        a, b, qid = rng.choice(ips), rng.choice(ips), f"0x{rng.randrange(6):04x}"
        name = rng.choice(["www.google.com", "x.y.z", "localhost"])
        text = rng.choice([
            f"Standard query {qid} A {name}",
            f"Standard query response {qid} A {name} CNAME c.{name} NS ns.{name}",
            f"Inverse query {qid} PTR {name}", f"Inverse query response {qid} PTR {name}",
            f"Dynamic update {qid}", f"Zone change {qid}",
            f"Server status request {qid}", f"Server status request response {qid}",
            "DNS Stateful operations (DSO) response", f"DNS Stateful operations (DSO) {qid}",
            "Odd operation",
        ])
        out.append(f"{a},{b},{rng.choice(['DNS', 'DNS', 'MDNS'])},{rng.randrange(40, 400)},{text}")
    return out


def fields(line):
    src, dst, protocol, length, text = line.split(",")
    return src, dst, protocol, int(length), text.split(" "), text


def test_nameservers_by_brute_force(spark):
    lines = traffic(400, 1)
    certain, possible, total = Counter(), Counter(), Counter()
    for line in lines:
        src, dst, _, _, w, text = fields(line)
        if w[0] in ("Standard", "Inverse", "DNS"):
            query = (w[4] if w[0] == "DNS" else w[2]) != "response"
            proven, other = (dst, src) if query else (src, dst)
            certain[proven, "r" if query else "s"] += 1
            possible[other, "s" if query else "r"] += 1
        elif w[0] in ("Dynamic", "Zone"):
            total[src, "s"] += 1
            total[dst, "r"] += 1
        elif text.startswith("Server status request response"):
            total[src, "s"] += 1
        elif text.startswith("Server status"):
            total[dst, "r"] += 1
    total.update(certain)
    sure = {a for a, _ in certain}
    total.update({k: n for k, n in possible.items() if k[0] in sure})
    want = sorted((a, total[a, "s"], total[a, "r"]) for a in {a for a, _ in total})
    assert rows(nameservers.nameserver_activity(packets(spark, lines))) == want


def talks(lines):
    groups = defaultdict(list)
    for seq, line in enumerate(lines):
        src, dst, _, _, w, text = fields(line)
        if w[0] == "Standard":
            key = (w[2], src, dst) if w[2] != "response" else (w[3], dst, src)
            groups[key].append((seq, f"{text} src: {src} dest: {dst}"))
    return {k: v for k, v in groups.items() if len(v) > 1}


@pytest.mark.parametrize("seconds", [None, 1, 7, 10_000])
def test_conversations_in_order_for_any_slice(spark, seconds):
    """Parts read in order hold every message by time, then number."""
    lines = traffic(600, 2)
    # The times repeat every minute, so numbers and times are in different orders.
    found = conversations.messages(packets(spark, lines), "seq", "ts")
    times = {r.seq: r.ts for r in found.select("seq", "ts").collect()}
    got, sizes = defaultdict(list), {}
    for r in conversations.conversations(found, seconds).collect():
        got[r.query_id, r.client, r.server].append((r.part, r.messages))
        sizes[r.query_id, r.client, r.server] = r.n_messages
    want = talks(lines)
    whole = {k: [m for _, ms in sorted(parts) for m in ms] for k, parts in got.items()}
    assert whole == {k: [m for _, _, m in sorted((times[s], s, m) for s, m in v)] for k, v in want.items()}
    assert sizes == {k: len(v) for k, v in want.items()}


@pytest.mark.parametrize("span", [1, 64, 10_000])
def test_conversation_messages_for_any_span(spark, span):
    lines = traffic(600, 2)
    want = talks(lines)
    found = conversations.messages(packets(spark, lines), "seq", "ts")
    long = conversations.conversation_messages(found, span)
    assert Counter((r.query_id, r.client, r.server, r.seq, r.message) for r in long.collect()) == \
        Counter((*k, s, m) for k, v in want.items() for s, m in v)


def test_conversation_messages_without_numbers(spark):
    lines = traffic(600, 2)
    found = conversations.messages(packets(spark, lines), "seq", "ts")
    unnumbered = found.withColumn("seq", F.lit(None).cast("bigint"))
    want = Counter(m for v in talks(lines).values() for _, m in v)
    for rows_ in (conversations.conversation_messages(unnumbered).select("message"),
                  conversations.conversations(unnumbered).select(F.explode("messages").alias("message"))):
        assert Counter(r.message for r in rows_.collect()) == want


@pytest.mark.parametrize("parts", [1, 4, 64])
def test_host_lists_whole_for_any_parts(spark, parts):
    lines = traffic(500, 3)
    want = defaultdict(set)
    for line in lines:
        src, _, _, _, w, _ = fields(line)
        if w[0] != "Standard":
            continue
        if w[2] != "response":
            want["A", ".".join(w[-1].split(".")[-2:])].add(src)
        else:
            for t, n in zip(w, w[1:]):
                if t in ("CNAME", "NS"):
                    want[t, n].add(src)
    got = defaultdict(list)
    for r in names.host_lists(packets(spark, lines), parts=parts).collect():
        assert r.hosts == sorted(r.hosts)
        assert r["count"] == len(want[r.type, r.request_response])
        got[r.type, r.request_response] += r.hosts
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    counts = {(r.type, r.request_response): r["count"]
              for r in names.unique_hosts(packets(spark, lines)).collect()}
    assert counts == {k: len(v) for k, v in want.items()}


def test_group_size(spark):
    df = spark.range(1000).selectExpr("IF(id % 3 = 0, 0, id % 50) AS k", "id AS seq", "id div 7 AS b")
    got = {(r.seq, r.n_group) for r in with_group_size(df, ["k"], "b").collect()}
    sizes = Counter(0 if i % 3 == 0 else i % 50 for i in range(1000))
    assert got == {(i, sizes[0 if i % 3 == 0 else i % 50]) for i in range(1000)}


def sent_whole(df, capsys):
    """Whether a side of a join went to the driver and from there to every task, in the plan
    before the run or in the one that adaptive execution ended with."""
    capsys.readouterr()
    df.explain()
    df.collect()
    df.explain()
    plans = capsys.readouterr().out
    assert plans.count("== Physical Plan ==") == 2 and "SortMergeJoin" in plans
    return "Broadcast" in plans


def test_conversation_messages_send_no_side_whole(spark, capsys):
    """The inputs are small, so without the operator's word they would be."""
    found = conversations.messages(packets(spark, traffic(200, 4)), "seq", "ts")
    assert not sent_whole(conversations.conversation_messages(found), capsys)


def test_conversation_parts_send_no_side_whole(spark, capsys):
    found = conversations.messages(packets(spark, traffic(200, 4)), "seq", "ts")
    assert not sent_whole(conversations.conversations(found, 20), capsys)


def test_gap_conversations_send_no_side_whole(spark, capsys):
    found = conversations.messages(packets(spark, traffic(200, 4)), "seq", "ts")
    assert not sent_whole(conversations.gap_conversations(found, 5), capsys)


@pytest.mark.parametrize("span", [1, 7, 1000])
def test_chunks_follow_sequence_order(spark, span):
    ids = sorted(random.Random(5).sample(range(-500, 5000), 700))
    df = spark.createDataFrame([(i,) for i in ids], "seq bigint").repartition(5)
    got = {r.seq: r.chunk_id for r in chunks.chunk_ids(df, chunk_rows=40, span=span).collect()}
    assert got == {seq: i // 40 for i, seq in enumerate(ids)}


def test_partitioning_does_not_change_results(spark):
    lines = traffic(300, 6)
    for f in (pairs.pair_traffic, names.unique_hosts, nameservers.nameserver_activity,
              messages.message_types, windows.window_exchanged_packets, windows.window_names):
        assert rows(f(packets(spark, lines, 1))) == rows(f(packets(spark, lines, 9)))


def test_distinct_windows_count_copies_once(spark):
    line = "1.1.1.1,2.2.2.2,DNS,60,Standard query 0x1 A a.b"
    other = "1.1.1.1,2.2.2.2,DNS,60,Standard query 0x2 A a.b"
    p = packets(spark, [line, line, line, other])
    assert [r[2:] for r in rows(windows.window_bytes_packets(p))] == [(240, 4)]
    assert [r[2:] for r in rows(windows.window_bytes_packets_distinct(p))] == [(120, 4)]
    assert [r[2:] for r in rows(windows.window_message_types(p))] == [("Standard query", 4)]
    assert [r[2:] for r in rows(windows.window_message_types_distinct(p))] == [("Standard query", 2)]
    assert [r[2:] for r in rows(windows.window_names_distinct(p))] == [("A", "a.b", 2)]
