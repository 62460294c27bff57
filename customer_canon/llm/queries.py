"""The registered queries of this subpackage, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from customer_canon.llm import exact, licenses, mixing, near, packing, phrases, pii, quality, rules, search, sharding, stats, urls, vectors
from customer_canon.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    return urls.judge_urls(pages, spark.sql(urls.RULES_SQL)).select("page_id", "host", "path", "rule", "verdict")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return sharding.shard_rows(docs, 40).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return licenses.scan_licenses(docs).drop("spans")


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.duplicate_classes(table(spark, sf_dir, "documents", "doc_id", "text"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents", "doc_id", "text", "source"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality.score_quality(docs, model).select(
        "doc_id",
        stats.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return packing.pack_documents(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    learned = rules.learn_rules(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    failed = rules.base_failed()
    return stats.with_counts(docs).select(
        "doc_id",
        *[f"counts.{c}" for c in counts],
        failed.alias("base_failed"),
        (~failed & rules.rule_verdict(learned)).alias("kept"),
    )


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select(
        "doc_id",
        *[pii.count_of(F.col("base"), kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(pii.as_text(F.col("base")), 256).alias("base_sha256"),
        pii.as_text(F.col("spans")).alias("spans"),
    )


def op10_embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.link_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


def op11_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.duplicate_rows(table(spark, sf_dir, "documents", "doc_id", "text"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return search.ranked_search(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents", "lang", "text"))


QUERIES: dict[str, Query] = {
    "op1_url_filters": op1_url_filters,
    "op2_sharding": op2_sharding,
    "op3_licenses": op3_licenses,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_mixing": op5_mixing,
    "op6_quality": op6_quality,
    "op7_packing": op7_packing,
    "op8_quality_rules": op8_quality_rules,
    "op9_personal_data": op9_personal_data,
    "op10_embedding_duplicates": op10_embedding_duplicates,
    "op11_exact_duplicates": op11_exact_duplicates,
    "op12_ranked_search": op12_ranked_search,
    "op13_collocations": op13_collocations,
}

ORACLES: dict[str, str] = {
    "op1_url_filters": urls.URLS_SQL,
    "op5_mixing": mixing.MIX_SQL,
    "op11_exact_duplicates": exact.EXACT_SQL,
    "op12_ranked_search": search.SEARCH_SQL,
    "op13_collocations": phrases.PHRASES_SQL,
}
