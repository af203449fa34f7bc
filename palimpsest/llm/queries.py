"""The queries of this package and, where it can express them, their DuckDB SQL."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm import (
    byte_bpe,
    embedding_neardup,
    language_id,
    minhash_dedup,
    mixing,
    personal_data,
    run_detection,
    sharding,
    substring_dedup,
    token_output,
    topk_search,
    toxicity,
    whitening,
)
from palimpsest.workspace import ship_library


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_library(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_neardup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tagger = language_id.train(docs)
    return language_id.predict(docs.select("doc_id", "text"), tagger).select(
        "doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score"
    )


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk_search.top_k(vectors, vectors.where("vec_id % 20 = 0"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash_dedup.near_duplicates(docs).select("doc_id", "component_id", "kept")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scorer = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, scorer).select(
        "doc_id", language_id.held_out().alias("held_out"), "score", "predicted"
    )


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.round_trip(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return personal_data.digests(personal_data.find(docs, personal_data.train(docs)))


def op12_run_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_detection.digests(table(spark, sf_dir, "documents"), loop=True)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.components(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_library(spark)
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_embedding_neardup,
        op2_language_id,
        op3_substring_dedup,
        op4_topk_search,
        op5_byte_bpe,
        op6_sharding,
        op7_minhash_dedup,
        op8_toxicity,
        op9_token_output,
        op10_mixing,
        op11_personal_data,
        op12_run_detection,
        op13_whitening,
        pipeline,
    )
}

ORACLE: dict[str, str] = {
    "op3_substring_dedup": r"""
WITH docs AS (
    SELECT doc_id, row_number() OVER () AS row,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), places AS (
    SELECT row, words, unnest(range(1, len(words) - 33)) AS start FROM docs WHERE len(words) >= 35
), windows AS (
    SELECT row, start, sha256(array_to_string(words[start:start + 34], ' ')) AS passage FROM places
), repeated AS (
    SELECT row, start FROM windows
    WHERE passage IN (SELECT passage FROM windows GROUP BY passage HAVING count(*) > 1)
), gone AS (
    SELECT DISTINCT row, unnest(range(start, start + 35)) AS place FROM repeated
), lost AS (
    SELECT row, list(place) AS places FROM gone GROUP BY row
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(len(places), 0)::BIGINT AS n_removed,
       sha256(array_to_string(
           CASE WHEN places IS NULL THEN words
                ELSE list_filter(words, lambda w, i: NOT list_contains(places, i)) END, ' ')) AS kept_sha256
FROM docs LEFT JOIN lost USING (row)
""",
    "op1_embedding_neardup": """
WITH RECURSIVE usable AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND NOT list_contains(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)), true)
      AND list_contains(list_transform(embedding, lambda x: x <> 0), true)
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), reach AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings
    UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = vec_id)::BIGINT AS n_links,
       component_id, vec_id = component_id AS kept
FROM embeddings JOIN least ON a = vec_id
""",
    "op4_topk_search": """
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL
      AND NOT list_contains(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)), true)
), scores AS (
    SELECT q.vec_id AS query_id, r.vec_id, list_dot_product(q.v, r.v)::BIGINT AS score
    FROM usable q JOIN usable r ON q.vec_id <> r.vec_id AND len(q.v) = len(r.v) WHERE q.vec_id % 20 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scores
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
""",
}
