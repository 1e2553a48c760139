"""Unique hosts and pair averages written as SQL over staged tables and views."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetlens.functions.envelope import archive_message
from packetlens.functions.packet import parse_packets
from packetlens.operators.names import name_records
from packetlens.operators.pairs import measured
from packetlens.session import work_dir


def unique_hosts_by_views(archive: DataFrame) -> DataFrame:
    """``archive`` has one text column, ``fields``. Views get names of their own and are
    dropped once the plan that reads them is resolved."""
    spark = archive.sparkSession
    tag = uuid.uuid4().hex
    source, records = f"input_{tag}", f"records_{tag}"
    archive.createOrReplaceTempView(source)
    lines = spark.table(source).select(archive_message(F.col("fields")).alias("message"))
    name_records(parse_packets(lines), "src").createOrReplaceTempView(records)
    ranked = spark.sql(f"""
        SELECT type, request_response AS name, count(*) AS n
        FROM (SELECT DISTINCT type, request_response, src FROM {records})
        GROUP BY type, request_response
        ORDER BY n DESC, type, name
    """)
    spark.catalog.dropTempView(source)
    spark.catalog.dropTempView(records)
    return ranked


# The chain from one measured packet per row to averages per pair, in the order it is run. The
# braces stand for the database and the folders of its external tables.
PAIR_CHAIN = (
    # A pair that was met from both sides counts from its larger address.
    """CREATE VIEW {db}.v1 AS
    SELECT src, dst, CAST(sum(len) AS DOUBLE) AS bytes, CAST(sum(num) AS DOUBLE) AS tot
    FROM {db}.new_input GROUP BY src, dst""",
    """CREATE VIEW {db}.v2 AS SELECT dst AS src, src AS dst, bytes AS bytes_i, tot AS tot_i FROM {db}.v1""",
    """CREATE VIEW {db}.v3 AS
    SELECT v1.src, v1.dst, v1.bytes, v1.tot, v2.bytes_i, v2.tot_i, v2.tot_i IS NOT NULL AS mutual
    FROM {db}.v1 LEFT JOIN {db}.v2 ON v1.src = v2.src AND v1.dst = v2.dst""",
    """CREATE VIEW {db}.v4 AS
    SELECT DISTINCT greatest(src, dst) AS src, least(src, dst) AS dst FROM {db}.v3 WHERE mutual""",
    """CREATE TABLE {db}.v5 USING parquet AS
    SELECT v4.src, v4.dst, v3.bytes + v3.bytes_i AS tot_bytes, v3.tot + v3.tot_i AS tot
    FROM {db}.v4 JOIN {db}.v3 ON v4.src = v3.src AND v4.dst = v3.dst""",
    """INSERT INTO {db}.v5 (src, dst, tot_bytes, tot)
    SELECT src, dst, bytes, tot FROM {db}.v3 WHERE NOT mutual""",
    """CREATE VIEW {db}.output AS
    SELECT src, dst, tot_bytes / tot AS average, tot FROM {db}.v5 ORDER BY average DESC, src, dst""",
)


def load_archive(spark: SparkSession, table: str, archive: str, location: str) -> None:
    """``table`` over the folder ``location``, holding the text lines found below ``archive``;
    loading again replaces them. Dropping the table leaves the folder."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} (fields STRING) USING text LOCATION '{location}'")
    lines = spark.read.option("recursiveFileLookup", "true").text(archive)
    lines.select(F.col("value").alias("fields")).write.insertInto(table, overwrite=True)


def pair_averages_by_tables(spark: SparkSession, archive: str) -> DataFrame:
    """src, dst, average and tot per pair of DNS packets, from an archive folder through an
    external input table, a packet table made from a query, and a chain of views and a table
    that is filled twice. All live in a database of their own, which is dropped with them; the
    result is kept in the working folder."""
    root = work_dir(spark, "pair-tables")
    db = f"pairs_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{root}/managed'")
    try:
        load_archive(spark, f"{db}.input", archive, f"{root}/input")
        lines = spark.table(f"{db}.input").select(archive_message(F.col("fields")).alias("message"))
        packets = measured(parse_packets(lines.where(F.col("message").isNotNull())))
        packets.select("src", "dst", F.col("length").alias("len"), F.lit(1).cast("bigint").alias("num")) \
            .writeTo(f"{db}.new_input").using("parquet").create()
        for statement in PAIR_CHAIN:
            spark.sql(statement.format(db=db))
        result = spark.table(f"{db}.output")
        result.write.parquet(f"{root}/result")
        return spark.read.schema(result.schema).parquet(f"{root}/result")
    finally:
        spark.sql(f"DROP DATABASE {db} CASCADE")
