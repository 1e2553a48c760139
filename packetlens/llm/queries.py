"""The queries of this package over the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetlens.llm import (
    alignment, byte_bpe, chat, decontaminate, hard_negatives, language_id, ngram_join, pii, quality,
    substring_dedup, token_counts, token_files, url_filter,
)
from packetlens.llm.common import stored, table
from packetlens.llm.oracles import ORACLES as ORACLES
from packetlens.session import work_dir

# The rules given for pages, by host and path.
URL_RULES = [
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
    ("block", "net/es/"), ("block", "net/fr/"),
]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    eligible = F.crc32(F.col("doc_id").cast("string")) % 5 != 0
    found = language_id.fit(docs, eligible)
    return language_id.predict(docs.select("doc_id", "text"), found, ["doc_id"]).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "nats", "rejected"
    )


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    judged, q = quality.judge(docs, ["doc_id", "lang"])
    return judged.select("doc_id", f"{q}.*").drop("nats", "n_scored")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url", "html"), URL_RULES)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "token-files")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    token_files.write_token_files(docs, path, public_tokenizers.path("byte_bpe_50k.json"), 0)
    return token_files.read_token_files(spark, path)


def _codec() -> byte_bpe.Codec:
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return byte_bpe.Codec(ranks, public_tokenizers.PATTERN)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return byte_bpe.round_trip(docs, _codec(), ["doc_id"])


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.sql(
        "SELECT * FROM VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), "
        "(-7, 1, 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)")
    back = chat.read_back(chat.formatted(rows.union(extra)))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"), "valid")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows, base, every = pii.spans(docs, ["doc_id"])

    def n(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return rows.select(
        "doc_id", *[n(k) for k in pii.KINDS],
        F.sha2(pii.as_text(F.col(base)), 256).alias("base_sha256"), pii.as_text(F.col(every)).alias("spans"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_join.classes(docs).select("doc_id", "class_id", "n_links", "n_copies")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs, public_tokenizers.path("word_bpe_49k.json"), ["doc_id"])


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows, name = alignment.align(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    groups = F.col(f"{name}.groups")
    rows = stored(rows.select(
        "doc_id", F.when(groups == "", "").otherwise(F.sha2(groups, 256)).alias("groups_sha256"),
        F.col(name).dropFields("groups").alias(name)), "aligned")
    counts = stored(alignment.link_counts(rows, name), "link-counts")
    rows, linked = alignment.with_counts(rows, name, counts)
    return rows.select(
        "doc_id", *[f"{name}.{c}" for c in ("n_a", "n_b", "n_groups", "n_links")], f"{linked}.*", "groups_sha256")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows, name = substring_dedup.remove_repeats(docs)
    return rows.select(
        "doc_id", f"{name}.n_words", f"{name}.n_removed", F.sha2(f"{name}.kept", 256).alias("kept_sha256"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_url_filter": op2_url_filter,
    "op3_quality": op3_quality,
    "op4_token_files": op4_token_files,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_chat": op6_chat,
    "op7_pii": op7_pii,
    "op8_ngram_join": op8_ngram_join,
    "op9_decontaminate": op9_decontaminate,
    "op10_token_counts": op10_token_counts,
    "op11_alignment": op11_alignment,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_substring_dedup": op13_substring_dedup,
}
