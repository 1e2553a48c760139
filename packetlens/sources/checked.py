"""Packets and the lines that are none, accounted for in one pass.

Every line that is read ends up in one of two folders: with its fields in ``state=parsed``, or
with a reason in ``state=quarantined``. The pass counts both as it goes, so what was read is
known to be parsed plus quarantined, for a batch and for every micro-batch of a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from packetlens.functions.envelope import stream_message
from packetlens.functions.packet import FIELDS, parse_packets
from packetlens.functions.text import strip

PARSED, QUARANTINED = "parsed", "quarantined"
# Why a line is no packet, in the order they are tried.
NO_RECORD, NO_FIELDS, NO_LENGTH, NO_TEXT = "no record", "too few fields", "length", "no text"


def _reason() -> Column:
    fields = F.size(F.split(strip(F.col("message")), ","))
    return (
        F.when(F.col("message").isNull(), NO_RECORD)
        .when(fields < len(FIELDS), NO_FIELDS)
        .when(F.col("length").isNull(), NO_LENGTH)
        .when(strip(F.col("info")) == "", NO_TEXT)
    )


def checked(lines: DataFrame) -> DataFrame:
    """``parse_packets`` with the columns ``reason`` (null for a packet) and ``state``."""
    rows = parse_packets(lines).withColumn("reason", _reason())
    return rows.withColumn("state", F.when(F.col("reason").isNull(), PARSED).otherwise(QUARANTINED))


def _counts() -> list[Column]:
    sound = F.col("state") == PARSED
    return [F.count("*").alias("read"), F.count_if(sound).alias(PARSED), F.count_if(~sound).alias(QUARANTINED)]


def write_checked(lines: DataFrame, path: str) -> dict[str, int]:
    """Write both folders below ``path`` and return how many lines were read, parsed and
    quarantined. Columns beside ``message``, such as an offset, are kept."""
    seen = Observation()
    checked(lines).observe(seen, *_counts()).write.partitionBy("state").parquet(path)
    return seen.get


def checked_writer(records: DataFrame, path: str, checkpoint: str, name: str = "lines") -> DataStreamWriter:
    """The same for a topic stream; the counts of each micro-batch are in its progress report
    under ``name``. A record that holds no message is quarantined with its text."""
    lines = records.select(
        "partition", "offset", "timestamp", F.col("value").cast("string").alias("record"),
        stream_message(F.col("value")).alias("message"))
    rows = checked(lines).withColumn("record", F.when(F.col("reason").isNotNull(), F.col("record")))
    return (
        rows.observe(name, *_counts()).writeStream.format("parquet").partitionBy("state")
        .option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    )


def read_checked(spark: SparkSession, path: str, state: str | None = None) -> DataFrame:
    """Both folders, or one of them."""
    rows = spark.read.parquet(path)
    return rows if state is None else rows.where(F.col("state") == state)
