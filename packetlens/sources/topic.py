"""Topic reads and writes.

The message broker's connector is a separate package; ``fmt="kafka"`` needs it on the class
path. ``fmt="parquet"`` reads files with the same columns and shares everything after that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from packetlens.functions.envelope import stream_message, to_stream
from packetlens.functions.packet import parse_packets

TOPIC = "network-data"
TOPIC_SCHEMA = "value binary, timestamp timestamp, partition int, offset bigint"
# Offsets per partition that fit beside the partition number in one sequence number.
OFFSET_RANGE = 1 << 43
# Offsets that a task of one micro-batch may use in the file form of the topic.
BATCH_OFFSETS = 1 << 24


def read_topic(spark: SparkSession, fmt: str = "kafka", **options: str) -> DataFrame:
    """The stream of value, timestamp, partition and offset. Options go to the source:
    for kafka at least ``kafka.bootstrap.servers``, for files ``path``."""
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        options = {"subscribe": TOPIC, "startingOffsets": "latest", **options}
    else:
        reader = reader.schema(TOPIC_SCHEMA)
    return reader.options(**options).load().select("value", "timestamp", "partition", "offset")


def publish_columns(lines: DataFrame) -> DataFrame:
    """Packet lines as the ``value`` column a topic write expects; other columns are kept."""
    return lines.select(
        to_stream(F.col("message")).alias("value"), *[c for c in lines.columns if c != "message"]
    )


def topic_writer(
    lines: DataFrame, checkpoint: str, fmt: str = "kafka", **options: str
) -> DataStreamWriter:
    """Publish a stream of packet lines. Options go to the sink: for kafka at least
    ``kafka.bootstrap.servers``, for files ``path``; files get a folder per micro-batch, and
    the partitions and offsets that a broker would give."""
    if fmt == "kafka":
        records = publish_columns(lines.select("message")).writeStream.format(fmt)
        records = records.options(**{"topic": TOPIC, **options})
    else:
        path = options.pop("path")

        def publish(batch: DataFrame, epoch: int) -> None:
            rows = numbered(publish_columns(batch), epoch)
            rows.write.format(fmt).options(**options).mode("overwrite").save(f"{path}/epoch={epoch}")

        records = lines.writeStream.foreachBatch(publish)
    return records.option("checkpointLocation", checkpoint).outputMode("append")


def numbered(records: DataFrame, epoch: int) -> DataFrame:
    """Records of one micro-batch under partition and offset: the task, and the row's place
    in it after all places of earlier micro-batches. More rows in a task than places, or more
    micro-batches than fit, are an error."""
    if epoch >= OFFSET_RANGE // BATCH_OFFSETS:
        raise ValueError("the file form of the topic is full; start a new path and checkpoint")
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    fits = F.when(place < BATCH_OFFSETS, place).otherwise(
        F.raise_error(F.lit("too many rows in a task; take fewer files per trigger")).cast("bigint"))
    return records.withColumns(
        {"partition": F.spark_partition_id(), "offset": fits + F.lit(epoch * BATCH_OFFSETS)})


def topic_packets(topic: DataFrame) -> DataFrame:
    """Packets with ``ts`` and a unique ``seq`` made from partition and offset."""
    lines = topic.select(
        (F.col("partition") * F.lit(OFFSET_RANGE) + F.col("offset")).alias("seq"),
        F.col("timestamp").alias("ts"),
        stream_message(F.col("value")).alias("message"),
    )
    return parse_packets(lines.where(F.col("message").isNotNull()))
