"""The JSON wrappers a packet line travels in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The archive record and the stream record.
ARCHIVE_SCHEMA = "message string"
STREAM_SCHEMA = "schema string, payload struct<message: string>"
# Characters around the packet line in an archive record.
PREFIX = '{"message":"'
SUFFIX = '"}'


def archive_message(value: Column) -> Column:
    return F.from_json(value, ARCHIVE_SCHEMA)["message"]


def stream_message(value: Column) -> Column:
    return F.from_json(value.cast("string"), STREAM_SCHEMA)["payload"]["message"]


def sliced_message(value: Column) -> Column:
    """Cut the packet line out by position, leaving JSON escapes as they are."""
    return F.substring(
        value, F.lit(len(PREFIX) + 1), F.length(value) - F.lit(len(PREFIX) + len(SUFFIX))
    )


def to_archive(message: Column) -> Column:
    return F.to_json(F.struct(message.alias("message")))


def to_stream(message: Column) -> Column:
    return F.to_json(
        F.struct(
            F.lit("packet").alias("schema"),
            F.struct(message.alias("message")).alias("payload"),
        )
    )
