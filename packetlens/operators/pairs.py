"""Bytes and packets between two addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetlens.functions.address import precedes
from packetlens.functions.numbers import average, two_decimals
from packetlens.functions.packet import is_dns


def measured(packets: DataFrame) -> DataFrame:
    """DNS packets with a usable length."""
    return packets.where(is_dns() & F.col("length").isNotNull())


def directed_traffic(packets: DataFrame) -> DataFrame:
    """total and count per (src, dst)."""
    return measured(packets).groupBy("src", "dst").agg(
        F.sum("length").alias("total"), F.count("*").alias("count")
    )


def _numeric(a: Column, b: Column) -> Column:
    return F.when(precedes(a, b), a).otherwise(b)


# Which address leads a pair seen in both directions.
LEADERS = {"numeric": _numeric, "smaller": F.least, "larger": F.greatest}


def pair_traffic(
    packets: DataFrame, leader: str = "numeric", self_pairs: str = "once"
) -> DataFrame:
    """total, avg and count per unordered pair, in one shuffle.

    Both directions fall into one group because the key is the sorted pair; counting the
    packets sent by its first address tells afterwards which directions occurred. A pair
    seen one way keeps that way round. ``self_pairs``: "once", "drop" or "double".
    """
    if leader not in LEADERS or self_pairs not in ("once", "drop", "double"):
        raise ValueError(f"unknown leader or self_pairs: {leader}, {self_pairs}")
    rows = measured(packets)
    if self_pairs == "drop":
        rows = rows.where(F.col("src") != F.col("dst"))
    sums = rows.groupBy(F.least("src", "dst").alias("lo"), F.greatest("src", "dst").alias("hi")).agg(
        F.sum("length").alias("total"),
        F.count("*").alias("count"),
        F.count_if(F.col("src") <= F.col("dst")).alias("from_lo"),
    )
    lo, hi = F.col("lo"), F.col("hi")
    first = (
        F.when(F.col("from_lo") == F.col("count"), lo)
        .when(F.col("from_lo") == 0, hi)
        .otherwise(LEADERS[leader](lo, hi))
    )
    weight = F.when(lo == hi, 2).otherwise(1) if self_pairs == "double" else F.lit(1)
    return sums.select(
        first.alias("address_a"),
        F.when(first == lo, hi).otherwise(lo).alias("address_b"),
        (F.col("total") * weight).alias("total"),
        average(F.col("total"), F.col("count")).alias("avg"),
        (F.col("count") * weight).alias("count"),
    )


def pair_traffic_by_join(packets: DataFrame) -> DataFrame:
    """The same totals from a mirror join of the directed ones; pairs of one address with
    itself are left out. Kept to check and time ``pair_traffic`` against."""
    there = directed_traffic(packets)
    back = there.select(
        F.col("dst").alias("src"),
        F.col("src").alias("dst"),
        F.col("total").alias("back_total"),
        F.col("count").alias("back_count"),
    )
    one_way = F.col("back_count").isNull()
    total = F.col("total") + F.coalesce("back_total", F.lit(0))
    count = F.col("count") + F.coalesce("back_count", F.lit(0))
    return (
        there.join(back, ["src", "dst"], "left")
        .where(one_way | ((F.col("src") != F.col("dst")) & precedes(F.col("src"), F.col("dst"))))
        .select(
            F.col("src").alias("address_a"),
            F.col("dst").alias("address_b"),
            total.alias("total"),
            average(total, count).alias("avg"),
            count.alias("count"),
        )
    )


def pair_traffic_rounded(packets: DataFrame) -> DataFrame:
    """Pairs led by the smaller string, averages to two decimals, largest total first."""
    pairs = pair_traffic(packets, leader="smaller")
    return pairs.withColumn("avg", two_decimals(F.col("avg"))).orderBy(
        F.desc("total"), "address_a", "address_b"
    )


def pair_average_ranked(packets: DataFrame) -> DataFrame:
    """Pairs led by the larger string, self pairs counted twice, largest average first.
    The packet count is a double."""
    pairs = pair_traffic(packets, leader="larger", self_pairs="double")
    return pairs.select(
        F.col("address_a").alias("src"),
        F.col("address_b").alias("dst"),
        F.col("avg").alias("average"),
        F.col("count").cast("double").alias("tot"),
    ).orderBy(F.desc("average"), "src", "dst")
