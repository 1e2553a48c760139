"""Packets sent and received by nameservers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetlens.functions import info as I
from packetlens.functions.text import computed_once, tokens

# What a packet says about an address, as counts that add up over any split of the data.
EVIDENCE = ("known_sent", "known_received", "possible_sent", "possible_received", "certain")
BRANCHES = ("queries", "updates", "status")


def _says(address: str, **counts: int) -> Column:
    return F.struct(
        F.col(address).alias("address"),
        *[F.lit(counts.get(name, 0)).cast("bigint").alias(name) for name in EVIDENCE],
    )


def evidence(
    packets: DataFrame, branches: tuple[str, ...] = BRANCHES, endpoints: bool = False
) -> DataFrame:
    """Summed evidence per address, for any protocol. With ``endpoints`` every source and
    destination has a row, also one without evidence.

    queries: a Standard, Inverse or DNS query proves its destination a nameserver and a
    response its source; the other endpoint is possible evidence. updates: both ends of a
    Dynamic or Zone packet are nameservers. status: the source of a Server status response
    is one, else the destination.
    """
    info, words = F.col("info"), F.col("words")
    verb, query = I.word(words, 0), I.is_query(words)
    cases = {
        "queries": [
            (query, F.array(_says("dst", known_received=1, certain=1),
                            _says("src", possible_sent=1))),
            (~query, F.array(_says("src", known_sent=1, certain=1),
                             _says("dst", possible_received=1))),
        ],
        "updates": [
            (verb.isin("Dynamic", "Zone"),
             F.array(_says("src", known_sent=1), _says("dst", known_received=1))),
        ],
        "status": [
            (info.startswith(I.STATUS_RESPONSE), F.array(_says("src", known_sent=1))),
            (info.startswith(I.STATUS), F.array(_says("dst", known_received=1))),
        ],
    }
    chosen = [case for branch in branches for case in cases[branch]]
    said = F.when(*chosen[0])
    for condition, value in chosen[1:]:
        said = said.when(condition, value)
    split = computed_once(packets.select("src", "dst", "info"), words=tokens(info))
    if endpoints:
        seen = F.array(_says("src"), _says("dst"))
        said = F.concat(seen, F.coalesce(said, F.slice(seen, 1, 0)))
    rows = split.select(F.inline(said))
    return rows.groupBy("address").agg(*[F.sum(name).alias(name) for name in EVIDENCE])


def activity(evidence_rows: DataFrame) -> DataFrame:
    """packets_sent and packets_received of the proven nameservers. Possible evidence counts
    only for an address some query or response has proven."""
    proven = F.col("certain") > 0
    return evidence_rows.where(F.col("known_sent") + F.col("known_received") > 0).select(
        "address",
        (F.col("known_sent") + F.when(proven, F.col("possible_sent")).otherwise(0)).alias(
            "packets_sent"
        ),
        (F.col("known_received") + F.when(proven, F.col("possible_received")).otherwise(0)).alias(
            "packets_received"
        ),
    )


def unproven(packets: DataFrame) -> DataFrame:
    """Addresses that no packet proves to be nameservers, from one pass over the packets."""
    rows = evidence(packets, endpoints=True)
    proven = F.col("known_sent") + F.col("known_received") > 0
    return rows.where(~proven & F.col("address").isNotNull()).select(F.col("address").alias("host"))


def nameserver_activity(packets: DataFrame, branches: tuple[str, ...] = BRANCHES) -> DataFrame:
    return activity(evidence(packets, branches))
