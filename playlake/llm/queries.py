"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlake.llm import (
    byte_bpe,
    byte_dedup,
    chat,
    fingerprint,
    hard_negatives,
    lang_filter,
    mixing,
    near_dup,
    packing,
    pii_boost,
    quality_llr,
    whitening,
    word_dedup,
)
from playlake.llm._columns import read_table


def op1_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.classes(read_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op2_pii_boost(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = pii_boost.fit(docs)
    found = docs.select("doc_id", pii_boost.find(F.col("text"), model).alias("f"))
    kinds = [
        F.size(F.filter("f.base", lambda s: s["rank"] == rank)).cast("long").alias(f"n_{kind}")  # noqa: B023
        for rank, kind in enumerate(pii_boost.KINDS)
    ]
    return found.select(
        "doc_id",
        *kinds,
        F.sha2(pii_boost.spans_string(F.col("f.base")), 256).alias("base_sha256"),
        pii_boost.spans_string(F.col("f.all")).alias("spans"),
    )


def op3_byte_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = byte_dedup.dedup(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("removed_starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op5_quality_llr(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = quality_llr.fit(docs, read_table(spark, sf_dir, "labels"))
    return quality_llr.assess(docs, model)


def op6_lang_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return lang_filter.predict(docs, lang_filter.fit(docs))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = mixing.quality_weights(read_table(spark, sf_dir, "labels"))
    return mixing.mix(read_table(spark, sf_dir, "documents"), weights)


def op8_rotate_speakers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(read_table(spark, sf_dir, "conversations"))


def op9_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_with_next(read_table(spark, sf_dir, "documents"))


def op10_word_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = word_dedup.dedup(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = byte_bpe.decode(byte_bpe.encode(read_table(spark, sf_dir, "documents")))
    return found.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return whitening.whiten(vectors, whitening.fit(vectors))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(read_table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_near_dup": op1_near_dup,
        "op2_pii_boost": op2_pii_boost,
        "op3_byte_dedup": op3_byte_dedup,
        "op4_packing": op4_packing,
        "op5_quality_llr": op5_quality_llr,
        "op6_lang_filter": op6_lang_filter,
        "op7_mix_sources": op7_mix_sources,
        "op8_rotate_speakers": op8_rotate_speakers,
        "op9_fingerprint": op9_fingerprint,
        "op10_word_dedup": op10_word_dedup,
        "op11_byte_bpe": op11_byte_bpe,
        "op12_whitening": op12_whitening,
        "op13_hard_negatives": op13_hard_negatives,
    }


def oracle_sql() -> dict[str, str]:
    """SQL where it can express an operator; the others are tested against brute force."""
    return {
        "op3_byte_dedup": byte_dedup.SQL,
        "op7_mix_sources": mixing.SQL,
        "op8_rotate_speakers": chat.SQL,
        "op10_word_dedup": word_dedup.SQL,
    }
