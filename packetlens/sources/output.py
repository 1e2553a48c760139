"""Tab-separated result files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_tsv(result: DataFrame, path: str, single_file: bool = False) -> None:
    """``single_file`` is for results known to be small; it runs the write in one task."""
    out = result.coalesce(1) if single_file else result
    out.write.csv(path, sep="\t", header=False)


def read_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema=schema)
