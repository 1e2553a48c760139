"""Fixed-size chunks of a capture."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from packetlens.operators.spread import span_of

# Fixed value: rows per chunk.
CHUNK_ROWS = 4000
# Sequence numbers numbered by one task.
SPAN = 250_000


def chunk_ids(
    rows: DataFrame, seq: str = "seq", chunk_rows: int = CHUNK_ROWS, span: int = SPAN
) -> DataFrame:
    """Add ``chunk_id``: rows 0..chunk_rows-1 in ``seq`` order are chunk 0, and so on.

    Numbering all rows in one window would run in one task. Here each span of sequence
    numbers is numbered by itself and shifted by the rows before it; the running sum that
    gives the shift sees one count per span. ``seq`` must be whole and unique.
    """
    spans = rows.withColumn("span", span_of(F.col(seq), span))
    before = Window.orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    starts = spans.groupBy("span").agg(F.count("*").alias("n")).select(
        "span", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    place = F.row_number().over(Window.partitionBy("span").orderBy(seq)) - 1
    numbered = spans.withColumn("place", place).join(starts, "span")
    chunk = F.expr(f"(start + place) div {chunk_rows}")
    return numbered.withColumn("chunk_id", chunk).drop("span", "place", "start")
