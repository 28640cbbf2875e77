"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.llm import backoff, decontaminate, exact_dedup, language, mixing, ngram_join, oracles, quality, rolling, simhash, tokens, toxicity, warc, whiten
from inkwell.llm.tables import table


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op2_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("spans")


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_components(table(spark, sf_dir, "documents"))


def fold(modulus: int, rest: int) -> Column:
    """Held-out rows: crc32 of the id as text. A row without id is in no fold."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus == rest, F.lit(False))


def op3_toxicity_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), "crc32(CAST(doc_id AS string)) % 5 <> 0")
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", fold(5, 0).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "offending")


def op7_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.materialise(spark, table(spark, sf_dir, "documents"))


def op8_quality_fourier(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = "crc32(CAST(doc_id AS string)) % 5"
    scored = quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), f"{left} NOT IN (0, 1)", f"{left} = 1")
    return scored.select("doc_id", fold(5, 0).alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op9_language_svm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.predict(docs, language.fit(docs, "crc32(CAST(doc_id AS string)) % 4 <> 2"))
    return found.select("doc_id", fold(4, 2).alias("held_out"), "lang_pred", "score")


def op10_lm_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = backoff.score_texts(table(spark, sf_dir, "documents"), "crc32(CAST(doc_id AS string)) % 7 <> 2")
    return scored.select("doc_id", fold(7, 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_rolling_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolling.rolling_mad(table(spark, sf_dir, "clicks"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten.whiten(table(spark, sf_dir, "embeddings"))


def op13_simhash_bktree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_components(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_mix_sources, op2_warc_salvage, op3_toxicity_mil, op4_exact_dedup, op5_decontaminate, op6_ngram_jaccard, op7_training_order, op8_quality_fourier, op9_language_svm, op10_lm_backoff,
        op11_rolling_median, op12_embedding_whitening, op13_simhash_bktree,
    )
}
ORACLES = {
    "op1_mix_sources": oracles.OP1, "op2_warc_salvage": oracles.OP2, "op4_exact_dedup": oracles.OP4, "op5_decontaminate": oracles.OP5, "op6_ngram_jaccard": oracles.OP6, "op11_rolling_median": oracles.OP11,
}
