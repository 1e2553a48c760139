"""Facts about a group without bringing the group to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The bucket of rows without one; spans are never negative.
NO_BUCKET = -1


def span_of(seq: Column, width: int) -> Column:
    """The range of ``width`` sequence numbers a row falls in. Numbers are whole and
    unique, so a range holds at most ``width`` rows."""
    return (seq - F.pmod(seq, F.lit(width))).cast("bigint")


def with_group_size(rows: DataFrame, keys: list[str], bucket: str) -> DataFrame:
    """Add ``n_group``, the number of rows sharing ``keys``.

    A hot key is cut along ``bucket``. Rows are counted per (keys, bucket), the counts are
    summed per key with a map-side part, and rows meet their sum on (keys, bucket), so a
    task never holds more of a key than one bucket of rows; the join that brings sums back to
    buckets is one that adaptive execution can split. Keys must not be null. Rows whose
    bucket is null form a bucket of their own.

    Rows and counts grow with the data, and the size guessed from the files before they are
    parsed can be far too small, so both joins are merges and neither side goes to the driver.
    """
    rows = rows.withColumn(bucket, F.coalesce(bucket, F.lit(NO_BUCKET)))
    counts = rows.groupBy(*keys, bucket).agg(F.count("*").alias("n_bucket"))
    sums = counts.groupBy(*keys).agg(F.sum("n_bucket").alias("n_group"))
    totals = counts.drop("n_bucket").join(sums.hint("merge"), keys)
    return rows.join(totals.hint("merge"), [*keys, bucket])
