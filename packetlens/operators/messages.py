"""Message types and senders of unknown operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packetlens.functions import info as I
from packetlens.functions.text import strip


def candidates(packets: DataFrame) -> DataFrame:
    """Packets with an info text whose protocol names neither TCP nor IP."""
    protocol = F.col("protocol")
    return packets.where(
        ~protocol.contains("TCP") & ~protocol.contains("IP") & F.col("info").isNotNull()
    )


def message_types(packets: DataFrame) -> DataFrame:
    return candidates(packets).groupBy(I.message_type(F.col("info")).alias("type")).agg(
        F.count("*").alias("packets")
    )


def error_sources(packets: DataFrame) -> DataFrame:
    errors = candidates(packets).where(~I.verb(strip(F.col("info"))).isin(*I.VERBS))
    return errors.groupBy(F.col("src").alias("address")).agg(F.count("*").alias("errors"))
