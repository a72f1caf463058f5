"""The registered queries: each operator over its whole table."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldgauge.llm.alignment import align
from fieldgauge.llm.collocations import collocations
from fieldgauge.llm.decontamination import contamination
from fieldgauge.llm.html_text import extract_text
from fieldgauge.llm.language_model import held_out_scores
from fieldgauge.llm.licences import scan
from fieldgauge.llm.merkle import fingerprints
from fieldgauge.llm.mixing import mix
from fieldgauge.llm.simhash import near_duplicates
from fieldgauge.llm.substrings import remove_repeats
from fieldgauge.llm.token_counts import encoded_lengths, length_histogram
from fieldgauge.llm.toxicity import score, train
from fieldgauge.llm.warc import build_derivatives, responses_of_pages


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_histogram(encoded_lengths(_table(spark, sf_dir, "documents")))


def simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs, one_space=True).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents"))


def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(_table(spark, sf_dir, "pages"))


def warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_derivatives(responses_of_pages(_table(spark, sf_dir, "pages")))


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return score(docs, train(docs, _table(spark, sf_dir, "labels")))


def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(_table(spark, sf_dir, "documents"))


def licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(_table(spark, sf_dir, "documents"))


def language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return held_out_scores(_table(spark, sf_dir, "documents"))


def tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(_table(spark, sf_dir, "documents"))


def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_token_counts": token_counts,
    "op2_simhash_dedup": simhash_dedup,
    "op3_benchmark_decontamination": benchmark_decontamination,
    "op4_substring_dedup": substring_dedup,
    "op5_source_mixing": source_mixing,
    "op6_merkle_fingerprints": merkle_fingerprints,
    "op7_html_extraction": html_extraction,
    "op8_warc_derivatives": warc_derivatives,
    "op9_toxicity": toxicity,
    "op10_licence_scan": licence_scan,
    "op11_language_model": language_model,
    "op12_tokenizer_alignment": tokenizer_alignment,
    "op13_phrase_collocations": phrase_collocations,
    "pipeline": corpus_pipeline.run,
}
