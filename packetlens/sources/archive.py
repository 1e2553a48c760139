"""The JSON-lines archive of a topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from packetlens.functions.envelope import ARCHIVE_SCHEMA, stream_message

# Fixed value: records per archive file.
RECORDS_PER_FILE = 10_000


def read_archive(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``message`` of every record below ``path``; lines that are no record are left out."""
    records = spark.read.schema(ARCHIVE_SCHEMA).option("recursiveFileLookup", "true").json(path)
    return records.where(F.col("message").isNotNull())


def read_archive_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The archive as one text column, ``fields``, the shape of an external table over it."""
    return spark.read.option("recursiveFileLookup", "true").text(path).toDF("fields")


def archive_writer(
    topic: DataFrame, path: str, checkpoint: str, records_per_file: int = RECORDS_PER_FILE
) -> DataStreamWriter:
    """Append a topic stream to ``path`` as ``partition=N`` folders of JSON lines."""
    return (
        topic.select(stream_message(F.col("value")).alias("message"), "partition")
        .writeStream.format("json")
        .partitionBy("partition")
        .option("maxRecordsPerFile", records_per_file)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )


def write_packet_table(packets: DataFrame, path: str) -> None:
    """Parsed packets in columns, so that several jobs share one parse and read only what
    they use. Sorting within each task lets a filter on protocol skip row groups."""
    packets.drop("message").sortWithinPartitions("protocol").write.parquet(path)


def read_packet_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
