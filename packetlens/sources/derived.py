"""Packets derived from an ``events`` table.

Every value follows from ``event_id`` by whole-number arithmetic, so the same text gives
the same rows in Spark and in the checking database, at any scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetlens.functions.envelope import archive_message, to_archive, to_stream
from packetlens.functions.packet import parse_packets
from packetlens.functions.text import computed_once

# Columns in the order they build on each other. ``{half}`` is event_id halved, ``{hex4}``
# p's low bits in hexadecimal, ``{text}`` the type name for strings.
STAGES = [
    {"p": "{half}"},
    {
        "c": "CAST(p % 23 AS INT)",
        "n": "CAST(p % 5 AS INT)",
        "d": "CAST(p % 9 AS INT)",
        "kind": """CASE WHEN p % 20 IN (11, 12) AND p % 23 >= 12 THEN 0
            ELSE CAST(p % 20 AS INT) END""",
        "is_resp": """CASE WHEN p % 23 >= 20 THEN 0 WHEN p % 23 = 19 THEN 1
            WHEN p % 13 = 0 THEN 0 ELSE CAST(event_id % 2 AS INT) END""",
        "x": "CASE WHEN p % 13 = 0 OR p % 23 >= 19 THEN p ELSE event_id END",
        "qid": "concat('0x', {hex4})",
    },
    {
        "client": """CASE WHEN p % 11 = 0 THEN '10.0.53.2'
            ELSE concat(CASE WHEN c % 2 = 0 THEN '9.9.' ELSE '192.168.' END,
                        CAST(c % 3 AS {text}), '.', CAST(c + 2 AS {text})) END""",
        "server": """CASE WHEN p % 77 = 0 THEN '10.0.53.2'
            ELSE concat('10.0.53.', CAST(n + 1 AS {text})) END""",
        "qname": """CASE d WHEN 0 THEN 'www.google.com' WHEN 1 THEN 'graph.facebook.com'
            WHEN 2 THEN 's3.amazonaws.com' WHEN 3 THEN 'www.amazon.com'
            WHEN 4 THEN 'e1.akamai.net' WHEN 5 THEN 'localhost' WHEN 6 THEN '<Root>'
            WHEN 7 THEN 'cdn.example.org' ELSE 'mail.yahoo.com' END""",
        "marker": "CASE WHEN is_resp = 1 THEN 'response ' ELSE '' END",
    },
]
PACKET = {
    "seq": "event_id",
    "ts": "ts",
    "src": "CASE WHEN is_resp = 1 THEN server ELSE client END",
    "dst": "CASE WHEN is_resp = 1 THEN client ELSE server END",
    "protocol": """CASE WHEN kind < 17 THEN 'DNS' WHEN kind = 17 THEN 'TCP'
        WHEN kind = 18 THEN 'ICMPv6' ELSE 'MDNS' END""",
    "length": "CAST(60 + (x * 37) % 400 AS BIGINT)",
    "info": """CASE
        WHEN kind < 10 THEN concat('Standard query ', marker, qid, ' A ', qname,
            CASE WHEN is_resp = 0 THEN ''
                 WHEN kind < 6 THEN concat(' CNAME alias', CAST(d AS {text}), '.cdn.net A 1.2.3.4')
                 ELSE concat(' NS ns1.', qname, ' NS ns2.', qname) END)
        WHEN kind = 10 THEN concat('Inverse query ', marker, qid, ' PTR ', qname)
        WHEN kind = 11 THEN concat('Dynamic update ', marker, qid, ' SOA ', qname)
        WHEN kind = 12 THEN concat('Zone change notification ', qid, ' SOA ', qname)
        WHEN kind = 13 THEN concat('Server status request ', marker, qid)
        WHEN kind = 14 THEN CASE WHEN is_resp = 0
            THEN concat('DNS Stateful operations (DSO) ', qid)
            ELSE 'DNS Stateful operations (DSO) response' END
        WHEN kind = 15 THEN concat('Unknown operation (9) ', qid)
        WHEN kind = 16 THEN 'Malformed'
        WHEN kind = 17 THEN '53 > 40000 [SYN]'
        WHEN kind = 18 THEN 'Neighbor Solicitation'
        ELSE concat('Standard query 0x0000 PTR _ipp._tcp.local, ', '"QM" question') END""",
}
SPARK = {"half": "event_id div 2", "hex4": "lpad(lower(hex(p % 4096)), 4, '0')", "text": "STRING"}
DUCKDB = {"half": "event_id // 2", "hex4": "lpad(lower(to_hex(p % 4096)), 4, '0')",
          "text": "VARCHAR"}


def _sql(dialect: dict[str, str]) -> str:
    """The stages as nested selects over ``events``."""
    source = "SELECT event_id, ts FROM events"
    for i, stage in enumerate(STAGES):
        made = ", ".join(f"{e.format(**dialect)} AS {c}" for c, e in stage.items())
        source = f"SELECT *, {made} FROM ({source}) s{i}"
    made = ", ".join(f"{e.format(**dialect)} AS {c}" for c, e in PACKET.items())
    return f"SELECT {made} FROM ({source}) s"


DUCKDB_TEXT = _sql(DUCKDB)

# Derived topic: capture order is dealt out over this many partitions.
TOPIC_PARTITIONS = 4


def from_events(events: DataFrame) -> DataFrame:
    """Packets for any table with a unique ``event_id`` and a ``ts``."""
    rows = events.select("event_id", "ts")
    for stage in STAGES:
        made = {c: F.expr(e.format(**SPARK)) for c, e in stage.items()}
        rows = computed_once(rows, **made)
    return rows.select(*[F.expr(e.format(**SPARK)).alias(c) for c, e in PACKET.items()])


def typed_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


def joined(typed: DataFrame) -> DataFrame:
    """seq, ts and the comma-joined packet line."""
    return typed.select(
        "seq", "ts", F.concat_ws(",", "src", "dst", "protocol", "length", "info").alias("message")
    )


def packet_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined(typed_packets(spark, sf_dir))


def archive_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq, ts and the archive record as text."""
    lines = packet_lines(spark, sf_dir)
    return lines.select("seq", "ts", to_archive(F.col("message")).alias("value"))


def topic_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns a topic read gives: value, timestamp, partition, offset."""
    lines = packet_lines(spark, sf_dir)
    return lines.select(
        to_stream(F.col("message")).cast("binary").alias("value"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        (F.col("seq") % TOPIC_PARTITIONS).cast("int").alias("partition"),
        F.floor(F.col("seq") / TOPIC_PARTITIONS).alias("offset"),
    )


def packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive records parsed back into packets."""
    lines = archive_lines(spark, sf_dir)
    return parse_packets(
        lines.select("seq", "ts", archive_message(F.col("value")).alias("message"))
    )
