"""The corpus pipeline: from documents to a mix of clean ones, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldgauge.llm.decontamination import without_contamination
from fieldgauge.llm.mixing import mixed
from fieldgauge.llm.simhash import one_of_each
from fieldgauge.llm.substrings import remove_repeats
from fieldgauge.llm.tables import written
from fieldgauge.llm.toxicity import train, without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; the grammar's weights come from the labels beside the documents."""
    return without_toxic(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose SimHash fingerprints link, the one with the smallest id stays; see ``one_of_each``."""
    return one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that also occur earlier go; a document of which nothing is left goes."""
    left = remove_repeats(docs).where("n_removed = 0 or n_removed < n_words")
    return left.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return without_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with what the mix takes of each, in words, repeats included."""
    return mixed(docs)


STAGES = [
    ("toxicity", toxicity),
    ("simhash_dedup", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("benchmark_decontamination", decontamination),
    ("source_mixing", mixing),
]

# No stage but the last can be written in SQL: the learned grammar, the hashes and the walks have no counterpart.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
