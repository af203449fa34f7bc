"""A training corpus from documents: five stages, each written and read again."""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from palimpsest.llm import byte_bpe, language_id, minhash_dedup, mixing, substring_dedup  # noqa: E402
from palimpsest.llm.components import staged  # noqa: E402


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts of no learned language; where ``lang`` is null, the prediction fills it.

    Texts of several languages stay. Null texts, texts without a letter and long texts
    whose words are of no language the labelled documents have (gibberish, other scripts)
    go. Repeated rows are judged alike. Without a labelled document everything goes.
    """
    found = language_id.predict(docs, language_id.train(docs)).where(F.col("fits"))
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays.

    Documents without words (null, empty, blank) stay, each alone; of repeated rows one stays.
    """
    return minhash_dedup.keep_one(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occur more than once go; texts without any stay as they were."""
    cut = substring_dedup.remove_repeats(docs)
    changed = F.col("n_removed") > 0
    text = F.when(changed, F.col("kept_text")).otherwise(F.col("text"))
    chars = F.when(changed, F.length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return cut.withColumns({"text": text, "n_chars": chars}).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time the mix takes a document, or a part of it.

    Documents without words are not taken; repeated rows are documents of their own.
    """
    mixed = mixing.materialize(docs)
    chars = F.length("text").cast(docs.schema["n_chars"].dataType)
    return mixed.withColumn("n_chars", chars).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and the digest of what they decode to; null texts have none."""
    return byte_bpe.encode_and_decode(docs.select("doc_id", "source", "text")).select(
        "doc_id", "source", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES = [
    ("language_id", identify_language),
    ("minhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("mixing", mix_sources),
    ("byte_bpe", tokenize),
]

#: SQL can express none of the models and digests; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
