"""Corpus pipeline: STAGES in order, each on what the one before has kept.

Language identification drops documents without a sure language, the similarity
join keeps one document of each group, decontamination drops documents that
contain a benchmark item, the secret scan replaces secrets by a mark, and the
encoder returns the token ids of what is left.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedplan.llm import bpe, chosen_path, decontaminate, langid, secret_scan, words
from feedplan.sources.staging import staged

#: Probability of its language under which a document is dropped.
LEAST_SCORE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters whose language is told with some certainty."""
    found = langid.with_languages(docs, "__language")
    sure = (F.col("__language.lang_pred") != langid.UNKNOWN) & (F.col("__language.score") >= LEAST_SCORE)
    return found.where(sure).drop("__language")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of similar ones; rows without an id go by their text."""
    hashed = F.lit(1 << 61) + F.shiftrightunsigned(F.xxhash64("text"), 3)
    named = docs.withColumn("__id", F.coalesce("doc_id", hashed))
    groups = chosen_path.joined(named, "__id")
    stays = groups.where(F.col("__id") == F.col("class_id")).select("__id").distinct()
    return named.join(stays, "__id", "left_semi").dropDuplicates(["__id", "text"]).drop("__id")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.with_leaks(docs, items, column="__leaks").where(F.size("__leaks") == 0).drop("__leaks")


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced; the number of characters is that of the new text."""
    out = secret_scan.redacted(docs.withColumn("__before", F.length("text")))
    return out.withColumn("n_chars", F.when(F.length("text") != F.col("__before"), F.length("text").cast("bigint")).otherwise(F.col("n_chars"))).drop("__before")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document."""
    words.small_batches(spark)
    ids = bpe.encoded(F.col("text"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    out = docs.select("doc_id", "lang", "source", ids.alias("ids"))
    return out.withColumn("n_tokens", F.size("ids").cast("bigint"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminated", decontaminated),
    ("without_secrets", without_secrets),
    ("tokens", tokens),
]

#: No SQL trains a network or merges byte pairs; tests hold the result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to `documents`, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
