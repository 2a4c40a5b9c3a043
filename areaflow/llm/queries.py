"""Registered queries of the text operators, with the SQL that must agree where SQL can express them."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areaflow.llm import (
    check_sql, decontaminate, hmm, html_text, language, mixing, packing, quality, simhash, spelling, toxicity, vectors, warc, whitening,
)
from areaflow.llm.common import bucket_of, saved, table
from areaflow.runtime import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECK_SQL: dict[str, str] = {
    "op1_mixing": check_sql.mixing_sql(),
    "op7_quality": check_sql.quality_sql(),
    "op9_vectors": check_sql.VECTORS_SQL,
    "op11_spelling": check_sql.spelling_sql(),
    "op12_decontaminate": check_sql.leaks_sql(),
}


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def piece_columns(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "sequence_tokens"
    )


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_columns(packing.pack(table(spark, sf_dir, "documents"), tokenizer_path()))


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_copies(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_print(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = saved(quality.with_counts(table(spark, sf_dir, "documents")).drop("text", "n_chars"), "quality-counts")
    return quality.verdicts(counted, quality.thresholds(counted)).select("doc_id", *quality.BASE, "base_failed", "kept")


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), bucket_of(F.col("doc_id"), 3) == 1
    rows = toxicity.sample(docs, table(spark, sf_dir, "labels"), ~held, "doc_id", "text", "toxic", toxicity.SAMPLE_ROWS)
    found = toxicity.scored(docs.select("doc_id", "text"), toxicity.fit(rows))
    return found.select("doc_id", held.alias("held_out"), "toxicity.score", "toxicity.predicted")


@query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = mixing.mixed(table(spark, sf_dir, "documents"))
    return chosen.select("doc_id", "mix_domain", "lang", "source", "mix_tokens", "mix_copies", "mix_budget")


@query
def op9_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_copies(table(spark, sf_dir, "embeddings"))


@query
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "llm-warc")
    folder = re.sub(r"^(file:)?/(?!/)", "file:///", folder)  # a local path as the URI that Arrow takes
    saved(warc.write_archives(table(spark, sf_dir, "pages"), folder), "warc-archives")
    found = warc.read_archives(spark, folder)
    page = lambda c: F.try_element_at(F.split(F.col(c), ":"), F.lit(-1)).try_cast("long")
    sound = F.when(F.col("error").isNotNull(), F.raise_error(F.concat(F.lit("archive: "), F.col("error")))).otherwise(page("record_id"))
    return found.select(
        sound.alias("page_id"), F.coalesce(F.octet_length("payload").cast("long"), F.col("payload_length")).alias("payload_bytes"),
        "payload_digest", F.col("type").alias("record_type"), page("refers_to").alias("refers_to"),
    )


@query
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), bucket_of(F.col("doc_id"), 4) == 2
    model = language.fit(language.sample(docs, ~held, "doc_id", "text", "lang"))
    found = language.identified(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held.alias("held_out"), "language.lang_pred", "language.score")


@query
def op8_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents").select("doc_id", "text"), bucket_of(F.col("doc_id"), 7) == 2
    found = hmm.scored(docs.withColumn("held_out", held), ~held)
    return found.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "visible_text")


@query
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


@query
def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.sha2(F.concat_ws(",", "items"), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), names.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.components(whitening.whitened(table(spark, sf_dir, "embeddings")))
    return rows.select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")
