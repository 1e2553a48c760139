"""Queried names, CNAME and NS records, and the hosts that asked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetlens.functions import info as I
from packetlens.functions.packet import is_dns
from packetlens.functions.text import computed_once, strip, tokens
from packetlens.operators.spread import with_group_size

# Hosts of one name are cut into this many hash buckets, a power of two, when lists are
# asked for.
HOST_BUCKETS = 65536


def standard(packets: DataFrame) -> DataFrame:
    """Packets of any protocol whose verb is Standard."""
    return packets.where(I.is_standard(F.col("info")))


def _tokenised(packets: DataFrame, *keep: str) -> DataFrame:
    rows = standard(packets).select(*keep, "info")
    return computed_once(rows, words=tokens(strip(F.col("info"))))


def name_records(packets: DataFrame, *keep: str) -> DataFrame:
    """One (type, request_response) row per Standard query and per record of a Standard
    response, with the columns in ``keep``. Walking the tokens as rows stays in generated
    code, which array functions with lambdas would leave."""
    words, at = F.col("words"), F.col("at")
    spots = _tokenised(packets, *keep).select(
        *keep, "words", F.posexplode("words").alias("at", "word")
    )
    found = spots.select(
        *keep,
        I.record_type(words, at).alias("type"),
        I.record_name(words, at).alias("request_response"),
    )
    return found.where(F.col("type").isNotNull() & F.col("request_response").isNotNull())


def query_domains(packets: DataFrame, *keep: str) -> DataFrame:
    """The registered domain of every Standard query."""
    queries = _tokenised(packets, *keep).where(I.word(F.col("words"), 2) != "response")
    return queries.select(*keep, I.query_domain(F.col("words")).alias("domain"))


def response_records(packets: DataFrame, *keep: str) -> DataFrame:
    """The CNAME and NS records of every Standard response."""
    return name_records(packets, *keep).where(F.col("type").isin(*I.RECORD_TYPES))


def name_counts(packets: DataFrame) -> DataFrame:
    return name_records(packets).groupBy("request_response", "type").agg(
        F.count("*").alias("requests")
    )


def category_counts(packets: DataFrame) -> DataFrame:
    """Queries per category of their domain. The category is taken per packet, so the only
    shuffle carries one row per category and task."""
    return query_domains(packets).groupBy(I.category(F.col("domain")).alias("category")).agg(
        F.count("*").alias("requests")
    )


def host_pairs(packets: DataFrame, dns_only: bool = False) -> DataFrame:
    """Distinct (type, request_response, host)."""
    rows = packets.where(is_dns()) if dns_only else packets
    return name_records(rows, "src").withColumnRenamed("src", "host").distinct()


def unique_hosts(packets: DataFrame, dns_only: bool = False) -> DataFrame:
    """Distinct hosts per (type, name). Pairs are made distinct on all three columns first,
    which spreads a popular name, and what is left is a count with a map-side part."""
    return host_pairs(packets, dns_only).groupBy("type", "request_response").agg(
        F.count("*").alias("count")
    )


def unique_hosts_ranked(packets: DataFrame, dns_only: bool = False) -> DataFrame:
    return unique_hosts(packets, dns_only).orderBy(F.desc("count"), "type", "request_response")


def host_lists(
    packets: DataFrame, dns_only: bool = False, parts: int = 1
) -> DataFrame:
    """type, request_response, count, part and the sorted hosts.

    The hosts of every name are dealt by hash over ``parts`` rows, a power of two up to
    ``HOST_BUCKETS``; together its parts hold every host once. ``host_pairs`` has one row per host.
    """
    keys = ["type", "request_response"]
    pairs = host_pairs(packets, dns_only).withColumn(
        "bucket", F.xxhash64("host").bitwiseAND(F.lit(HOST_BUCKETS - 1))
    )
    sized = with_group_size(pairs, keys, "bucket")
    whole = [*keys, "count", "part"]
    return (
        sized.withColumn("part", F.pmod(F.col("bucket"), F.lit(parts)).cast("bigint"))
        .withColumnRenamed("n_group", "count")
        # Lists gain nothing from being built before the shuffle as well as after it.
        .repartition(*whole)
        .groupBy(*whole)
        .agg(F.array_sort(F.collect_list("host")).alias("hosts"))
    )
