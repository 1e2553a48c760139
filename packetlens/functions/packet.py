"""Packet lines to typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetlens.functions.text import computed_once, strip

FIELDS = ("src", "dst", "protocol", "length", "info")


def parse_packets(lines: DataFrame) -> DataFrame:
    """``message`` text plus any other columns -> the same columns and the five fields.

    Fields are positional and a field the line lacks is null, so a malformed line costs
    only itself. An info text that holds a comma ends at that comma. A length that is not
    a whole number is null.
    """
    lines = lines.withColumn("f", F.split(strip(F.col("message")), ","))
    fields = {name: F.get("f", F.lit(i)) for i, name in enumerate(FIELDS)}
    fields["length"] = fields["length"].try_cast("bigint")
    return computed_once(lines, **fields).drop("f")


def is_dns() -> Column:
    return F.col("protocol") == "DNS"
