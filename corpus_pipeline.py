"""Documents to token ids in five stages, each written as Parquet and read again.

Quality rules, near duplicates, benchmark passages and personal data leave the columns of
``documents`` as they are; the last stage encodes what is left. ``ORACLE_SQL`` is None: the
stages' models have no SQL form, so tests hold the rows against a plain version of each stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetlens.llm import byte_bpe, decontaminate, ngram_join, pii, quality
from packetlens.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged, q = quality.judge(docs)
    return judged.where(F.col(q)["kept"]).drop(q)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source and the ids of the text; an id array is what the decoder takes."""
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    coded, ids = byte_bpe.encode(docs, byte_bpe.Codec(ranks, public_tokenizers.PATTERN))
    return coded.select("doc_id", "lang", "source", F.size(ids).alias("n_tokens"), F.col(ids).alias("ids"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", keep_quality),
    ("ngram_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark),
    ("pii", redact_personal_data),
    ("byte_bpe", encode_tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
