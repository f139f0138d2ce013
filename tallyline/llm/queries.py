"""The registered queries of this subpackage: each applies one operator to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyline.llm import alignment, chat, decontaminate, extract, language, licenses, merkle, mixing, neardup, suffixdedup, urlfilter, vptree, warc
from tallyline.llm.store import package_for_workers


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    package_for_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_probminhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"))[0].select("doc_id", "class_id", "n_links")


def op2_rare_token_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents")).drop("matches")


def op3_positional_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = (_table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return decontaminate.contamination(documents, benchmark).drop("text_key")


def op4_vantage_point_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.filter_urls(_table(spark, sf_dir, "pages"))


def op6_deep_shallow_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.removal_report(_table(spark, sf_dir, "documents")).drop("runs")


def op7_site_style_tree_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract_main_text(_table(spark, sf_dir, "pages"))


def op8_warc_zstd_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents"))


def op10_kneser_ney_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(merkle.build(_table(spark, sf_dir, "documents"), merkle.without_line_ends(merkle.chosen())))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(_table(spark, sf_dir, "documents"))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.read_back(chat.format_conversations(chat.planted(_table(spark, sf_dir, "conversations"))))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op")}


def oracle_sql() -> dict[str, str]:
    return {
        "op3_positional_decontamination": decontaminate.oracle(),
        "op8_warc_zstd_round_trip": warc.oracle(),
        "op9_source_mixing": mixing.oracle(),
        "op11_merkle_manifest": merkle.oracle(),
    }
