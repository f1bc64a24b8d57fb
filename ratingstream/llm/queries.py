"""The registered queries of the corpus operators: each applies its operator to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, conversations, decontaminate, embedding_dedup, hilbert_ann, katz, langid, packing, quality, simhash_dedup, spelling, toxicity, url_filter
from .common import held_out, table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(spark, docs, table(spark, sf_dir, "labels"))
    scored = quality.score(spark, docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", "predicted")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(spark, pages, url_filter.labelled_hosts(pages)).drop("url")


def op3_hilbert_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_ann.nearest(spark, table(spark, sf_dir, "embeddings"), k=20, every=20)


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(spark, table(spark, sf_dir, "embeddings"), threshold=0.95)


def op5_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = katz.score(spark, table(spark, sf_dir, "documents"), katz.trained_on("doc_id", 7, 2))
    return scored.withColumn("held_out", held_out("doc_id", 7, 2)).drop("train_types")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(spark, docs)
    found = langid.predict(spark, docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "lang_pred", "score")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(spark, table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(spark, docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(spark, docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", "predicted")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", packing.ids_crc32().alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spark, table(spark, sf_dir, "documents"))


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.scan(spark, docs, table(spark, sf_dir, "benchmark"), window=10)
    digest = F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversations.repair(spark, conversations.damage(rows), ids=rows)


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality": op1_quality,
        "op2_url_filter": op2_url_filter,
        "op3_hilbert_ann": op3_hilbert_ann,
        "op4_embedding_dedup": op4_embedding_dedup,
        "op5_katz": op5_katz,
        "op6_language_id": op6_language_id,
        "op7_byte_bpe": op7_byte_bpe,
        "op8_simhash_dedup": op8_simhash_dedup,
        "op9_toxicity": op9_toxicity,
        "op10_packing": op10_packing,
        "op11_spelling_variants": op11_spelling_variants,
        "op12_decontaminate": op12_decontaminate,
        "op13_conversation_repair": op13_conversation_repair,
    }


def sql() -> dict[str, str]:
    return {"op2_url_filter": url_filter.sql(), "op12_decontaminate": decontaminate.sql()}
