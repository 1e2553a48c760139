"""Addresses that never act as nameservers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def addresses(packets: DataFrame) -> DataFrame:
    """Every source and destination, once."""
    both = packets.select(F.explode(F.array("src", "dst")).alias("address"))
    return both.where(F.col("address").isNotNull()).distinct()


def find_hosts(packets: DataFrame, nameservers: DataFrame) -> DataFrame:
    """Addresses absent from ``nameservers``. Neither side has a size bound, so the join
    carries no hint: both are keyed by address, and adaptive execution broadcasts the
    nameservers only when it has measured them to be small."""
    known = nameservers.select("address")
    return addresses(packets).join(known, "address", "left_anti").select(
        F.col("address").alias("host")
    )
