"""Batch jobs by name: archive in, result files or a serving table out."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetlens.functions.packet import parse_packets
from packetlens.operators import conversations, hosts, messages, names, nameservers, pairs
from packetlens.plans.hive_views import unique_hosts_by_views
from packetlens.sources import archive, output
from packetlens.streaming.jobs import read_nameservers
from packetlens.streaming.serving import SERVING, Serving


@dataclass(frozen=True)
class BatchJob:
    """``run`` maps packets to a result; ``table`` is where it is served, if anywhere."""

    run: Callable[[DataFrame], DataFrame]
    table: str | None = None


def all_conversations(packets: DataFrame) -> DataFrame:
    """Conversations of an archive, whose packets have a position but no time."""
    if "seq" not in packets.columns:
        # The archive is read once, so a number need not be the same in another read.
        packets = packets.withColumn("seq", F.monotonically_increasing_id())
    if "ts" not in packets.columns:
        packets = packets.withColumn("ts", F.lit(None).cast("timestamp"))
    return conversations.conversations(conversations.messages(packets, "seq", "ts"))


JOBS = {
    "packets_total_avg_len": BatchJob(pairs.pair_traffic, "total_avg_bytes"),
    "requests_and_responses_uniquehosts": BatchJob(
        names.host_lists, "requests_responses_uniquehosts"
    ),
    "packets_total_avg_len_rounded": BatchJob(pairs.pair_traffic_rounded),
    "packets_average_ranked": BatchJob(pairs.pair_average_ranked),
    "uniquehosts_dns": BatchJob(lambda p: names.unique_hosts_ranked(p, dns_only=True)),
    "uniquehosts_ranked": BatchJob(names.unique_hosts_ranked),
    # What the counting streams maintain, over a whole archive at once.
    "message_types": BatchJob(messages.message_types),
    "errors": BatchJob(messages.error_sources),
    "nameservers": BatchJob(nameservers.nameserver_activity, "nameservers"),
    "names": BatchJob(names.name_counts),
    "categories": BatchJob(names.category_counts),
    "conversations": BatchJob(all_conversations),
}
# Jobs that need something other than packets alone.
NAMES = (*JOBS, "find_host", "uniquehosts_views")


def read_packets(spark: SparkSession, path: str, input_format: str) -> DataFrame:
    if input_format == "table":
        return archive.read_packet_table(spark, path)
    return parse_packets(archive.read_archive(spark, path))


def result(
    spark: SparkSession, name: str, input_path: str, serving: Serving | None, input_format: str
) -> DataFrame:
    if name == "uniquehosts_views":
        return unique_hosts_by_views(archive.read_archive_text(spark, input_path))
    packets = read_packets(spark, input_path, input_format)
    if name == "find_host":
        if serving is None:
            raise ValueError("find_host reads the nameservers from a serving root")
        return hosts.find_hosts(packets, read_nameservers(serving))
    return JOBS[name].run(packets)


def table_of(name: str) -> str | None:
    if name == "find_host":
        return "hosts"
    return JOBS[name].table if name in JOBS else None


def run(
    spark: SparkSession,
    name: str,
    input_path: str,
    output_path: str | None = None,
    serving: Serving | None = None,
    input_format: str = "json",
) -> None:
    """Serve the result where the job has a table and a root is given, else write it
    tab-separated to ``output_path``."""
    rows = result(spark, name, input_path, serving, input_format)
    table = table_of(name)
    if table and serving is not None:
        serving.apply(SERVING[table], rows, serving.next_epoch(SERVING[table]))
    elif output_path:
        output.write_tsv(_flat(rows), output_path)
    else:
        raise ValueError(f"{name} needs an output path")


LIST_SEPARATOR = ","


def _flat(rows: DataFrame) -> DataFrame:
    """Lists as joined text, which a text file can hold."""
    return rows.selectExpr(
        *[f"array_join(`{c}`, '{LIST_SEPARATOR}') AS `{c}`" if t.startswith("array") else f"`{c}`"
          for c, t in rows.dtypes]
    )
