"""Exact token counts: one histogram of encoded lengths answers every context limit."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldgauge.llm.running import running_sums

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how texts are cut before pairs are merged; it belongs to the vocabulary file.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
BUCKET = 1024


@lru_cache(maxsize=2)
def _encoding(path: str, pattern: str) -> tiktoken.Encoding:
    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _lengths(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(path, pattern).encode_to_numpy
        for batch in batches:
            lengths = (len(encode(text.as_py(), disallowed_special=())) if text.is_valid else 0 for text in batch.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(np.fromiter(lengths, np.int64, batch.num_rows))], names=["length"])

    return run


def encoded_lengths(docs: DataFrame, text: str = "text", path: str = RANKS, pattern: str = PATTERN) -> DataFrame:
    """One row (length) for each document: its number of tokens; 0 for null and empty texts.

    ``path`` names the vocabulary's ranks and must be readable on every executor.
    """
    schema = T.StructType([T.StructField("length", T.LongType())])
    return docs.select(F.col(f"`{text}`")).mapInArrow(_lengths(path, pattern), schema)


def length_histogram(lengths: DataFrame) -> DataFrame:
    """Documents by length, with sums over all documents at least as long.

    ``documents`` have exactly ``length`` tokens; ``documents_from`` and ``tokens_from``
    count the documents of that length or more and their tokens; ``truncated_total`` is
    what remains of all tokens if every document is cut at ``length``. Null lengths are
    ignored; an empty table gives an empty histogram. The histogram has a row for each
    length that occurs, however many documents there are.
    """
    counted = lengths.where("length is not null").groupBy("length").agg(F.count("*").alias("documents"))
    counted = counted.withColumn("tokens", F.col("length") * F.col("documents"))
    counted = counted.withColumn("bucket", -F.floor(F.col("length") / BUCKET)).withColumn("one", F.lit(1))
    sums = {"documents_from": "documents", "tokens_from": "tokens"}
    longest_first = running_sums(counted, ["one"], "bucket", [F.desc("length")], sums)
    total = counted.agg(F.sum("tokens").alias("total"))
    return longest_first.join(F.broadcast(total)).select(
        "length",
        "documents",
        "documents_from",
        "tokens_from",
        (F.col("total") - F.col("tokens_from") + F.col("length") * F.col("documents_from")).alias("truncated_total"),
    )


def truncated_total(histogram: DataFrame, limit: int) -> DataFrame:
    """One row (tokens): what remains if every document is cut at ``limit`` tokens."""
    cut = F.least("length", F.lit(limit)) * F.col("documents")
    return histogram.agg(F.coalesce(F.sum(cut), F.lit(0)).alias("tokens"))


def length_quantile(histogram: DataFrame, share: float) -> DataFrame:
    """One row (length): the least length that at least ``share`` of the documents don't exceed."""
    total = histogram.agg(F.sum("documents").alias("all_documents"))
    up_to = F.col("all_documents") - F.col("documents_from") + F.col("documents")
    return (
        histogram.join(F.broadcast(total)).where(up_to >= F.col("all_documents") * share).agg(F.min("length").alias("length"))
    )
