"""Capture files in, chunk files out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from packetlens.functions.packet import FIELDS
from packetlens.operators.chunks import CHUNK_ROWS
from packetlens.session import work_dir

# Encoding and column order of a capture. The first two columns are dropped.
CAPTURE_ENCODING = "ISO-8859-1"
CAPTURE_SCHEMA = (
    "number string, time string, "
    "src string, dst string, protocol string, length string, info string"
)


def _raw_captures(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.csv(
        paths, schema=CAPTURE_SCHEMA, header=True, encoding=CAPTURE_ENCODING, escape='"'
    )


def read_captures(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The five packet fields of all capture files, which have a header line each."""
    return _raw_captures(spark, paths).drop("number", "time")


def natural(path: Column) -> Column:
    """A text that sorts as ``path`` with numbers by their value: h2 before h10."""
    runs = F.regexp_extract_all(path, F.lit("([0-9]+|[^0-9]+)"))
    return F.array_join(F.transform(runs, lambda r: F.when(r.rlike("^[0-9]"), F.lpad(r, 20, "0")).otherwise(r)), "")


def numbered_captures(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The five packet fields and ``seq``, the row's place over all files: files in natural
    order of their paths, rows in file order, numbered from 0 without a gap.

    A scan reads each split of a file in order in one task, so a row's number within its split
    is at hand, and only the rows before a split are missing: a running sum over one count per
    split. Rows are written to the working folder between, so that both come from one scan.
    """
    split = ["file", "block"]
    placed = _raw_captures(spark, paths).select(
        *FIELDS, F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"))
    path = work_dir(spark, "captures")
    placed.write.parquet(path)
    placed = spark.read.schema(placed.schema).parquet(path)
    before = Window.orderBy(natural(F.col("file")), "file", "block").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy(*split).agg(F.count("*").alias("n"), F.min("id").alias("first")).select(
        *split, (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return placed.join(starts, split).select(*FIELDS, (F.col("id") + F.col("shift")).alias("seq"))


def write_exact_chunks(rows: DataFrame, path: str, rows_per_chunk: int = CHUNK_ROWS) -> None:
    """Folders ``chunk=N`` with one file each, UTF-8 CSV without header: the rows whose ``seq``,
    numbered without a gap, divided by the size gives N, in that order. Every chunk but the last
    is full. One shuffle by chunk; a task holds no more of a chunk than its rows."""
    chunk = F.expr(f"seq div {rows_per_chunk}")
    ordered = rows.withColumn("chunk", chunk).repartition("chunk").sortWithinPartitions("chunk", "seq")
    ordered.select(*FIELDS, "chunk").write.partitionBy("chunk").csv(
        path, header=False, encoding="UTF-8", escape='"')


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The packet fields of exact chunks and their ``chunk``."""
    fields = ", ".join(f"{c} string" for c in FIELDS)
    return spark.read.schema(f"{fields}, chunk bigint").csv(path, header=False, encoding="UTF-8", escape='"')


def write_chunks(capture: DataFrame, path: str, rows_per_file: int = CHUNK_ROWS) -> None:
    """UTF-8 CSV without header, at most ``rows_per_file`` rows per file, no row lost and
    no shuffle. Fields that hold a comma or a quote are quoted."""
    (
        capture.select(*FIELDS)
        .write.option("maxRecordsPerFile", rows_per_file)
        .csv(path, header=False, encoding="UTF-8", escape='"')
    )


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Chunk files as packet lines."""
    return spark.read.text(paths, pathGlobFilter="*.csv").select(F.col("value").alias("message"))


def watch_lines(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """A stream of the lines of ``*.csv`` files appearing in ``path``.

    Each file is read once (the checkpoint remembers it). The line's time is the file's
    arrival, which a replay finds unchanged.
    """
    reader = spark.readStream.option("pathGlobFilter", "*.csv")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path).select(
        F.col("value").alias("message"),
        F.col("_metadata.file_modification_time").alias("timestamp"),
    )
