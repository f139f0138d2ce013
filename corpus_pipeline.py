"""Training corpus from raw documents: five stages, each an operator of tallyline.llm, each over all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next one's docs. All
but the last return the columns of documents. What the stages do with nulls, ties, repeated rows and empty tables is what their
operators say; here only the following is added. Documents that the language stage rejects go. Of near duplicates one document stays.
Repeated passages are cut out of the texts, and n_chars follows the text; a document all of whose text was cut stays as an empty one.
Documents with a benchmark passage go. The mix returns the documents it takes words of, with size, source_size, target and taken;
columns of these names in the input are left out of the last stage's result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyline.llm import decontaminate, language, mixing, neardup, suffixdedup
from tallyline.llm.store import package_for_workers, written

#: No SQL: language models and sketches have none; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    package_for_workers(spark)
    return language.known_language(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    package_for_workers(spark)
    return neardup.one_of_each(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    package_for_workers(spark)
    cut = suffixdedup.without_repeats(docs)
    if "n_chars" not in docs.columns:
        return cut
    n_chars = F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), "n_chars")
    return cut.select(*[n_chars.alias(c) if c == "n_chars" else c for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    package_for_workers(spark)
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    package_for_workers(spark)
    told = {"size", "source_size", "target", "taken"}
    return mixing.mix_sources(docs, keep=[c for c in docs.columns if c not in told]).where("taken > 0")


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    package_for_workers(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
