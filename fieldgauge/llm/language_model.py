"""Scoring texts with a language model held in a log-frequency Bloom filter.

Counts of word sequences are quantised to levels, of which each stands for a range of
counts that widens in proportion. A sequence of level q is put into a Bloom filter q
times, as (sequence, 1) to (sequence, q); to read a level back, (sequence, 1), (sequence,
2), ... are probed until one is absent. A filter never loses a level and rarely adds one.

Spark counts: tasks add up their sequences, as 48-bit hashes, and send them packed by hash
ranges; each range becomes a filter of its own, as large as its entries need, so the model
grows with the corpus. Ranges are broadcast in segments of bounded size, and a task reads
its texts once and probes one segment after the other.

From the levels, the probability of a word after one and after two words is smoothed with
the shorter context's. A numerator takes the least count of its level and a denominator
the greatest, so probabilities of all words sum to one at most but for falsely added
levels. The score of a text is that of an even mixture of the three orders, whole text by
whole text: no order can pull it below another by more than the logarithm of three.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldgauge.llm.grouped import whole_groups
from fieldgauge.llm.tables import written
from fieldgauge.llm.words import chunks, lower_ascii, mix, span_hashes, split_words

HELD_OUT = 10  # one document in so many is not learned from
ADDED = 0.1  # to every count of the base model
PRIOR = (64.0, 2.0)  # words that the shorter context's probability counts for, after one word and after two
FREQUENT = 1 << 20  # words of at least this share of all tokens, of which there can't be more, are kept exactly
BITS_PER_ENTRY = 8
SEGMENT_WORDS = 1 << 22  # of 64 bits: 32 MiB are broadcast at a time
KEPT_SEGMENTS = 1  # of so many all stay loaded in a Python worker; of more each is loaded when it is probed

# Fixed values that no word's hash is likely to have: two marks before a text, one behind it.
FIRST, SECOND, END = (np.uint64(v) for v in (0x5851F42D4C957F2D, 0x14057B7EF767814F, 0x2545F4914F6CDD1D))

_RANGES = 1 << 16
_COUNTED, _SCORED_TOGETHER = 1 << 20, 1 << 19  # tokens
_GROUP_BYTES = 32 << 20


def _level_values() -> np.ndarray:
    values = [1]
    while values[-1] < 1 << 60:
        values.append(max(values[-1] + 1, values[-1] * 7 // 5))
    return np.array(values, np.int64)


LEVELS = _level_values()
_AT_LEAST = np.append(0, LEVELS).astype(np.float64)
_AT_MOST = np.append(0, np.append(LEVELS[1:] - 1, 1 << 62)).astype(np.float64)

_COUNTS = T.StructType([T.StructField("key", T.LongType()), T.StructField("times", T.LongType())])
_PACKED = T.StructType(
    [T.StructField("range", T.IntegerType()), T.StructField("keys", T.BinaryType()), T.StructField("times", T.BinaryType())]
)
_FILTERS = T.StructType([T.StructField("range", T.IntegerType()), T.StructField("words", T.BinaryType())])
_SCORED = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("row", "doc_id", "n_tokens", "n_known")]
    + [T.StructField(c, T.DoubleType()) for c in ("base", "after_one", "after_two")]
    + [T.StructField(c, T.ArrayType(T.LongType())) for c in ("rare", "rare_times")]
)


@dataclass
class _Tokens:
    """Hashes of consecutive texts' words between marks: FIRST, SECOND, words, END for each text."""

    all: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray

    def behind(self, marks: int) -> np.ndarray:
        """Places of everything but each text's first ``marks`` tokens."""
        use = np.ones(len(self.all), bool)
        for mark in range(marks):
            use[self.starts + mark] = False
        return np.flatnonzero(use)


def _tokens(texts: pa.Array) -> _Tokens:
    words = split_words(texts)
    words.data = lower_ascii(words.data)
    lengths = words.counts + 3
    starts = np.cumsum(lengths) - lengths
    found = np.empty(int(lengths.sum()), np.uint64)
    found[starts], found[starts + 1], found[starts + lengths - 1] = FIRST, SECOND, END
    row = words.row_of_word()
    found[starts[row] + 2 + np.arange(len(row)) - words.rows[row]] = words.hashes()
    return _Tokens(found, starts, lengths)


def _several(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[pa.RecordBatch, _Tokens]]:
    """Rows and their tokens, about ``most`` at a time; words are hashed in smaller chunks, of the size of caches."""
    waiting: list[tuple[pa.RecordBatch, _Tokens]] = []
    many = 0

    def together() -> tuple[pa.RecordBatch, _Tokens]:
        rows, tokens = zip(*waiting, strict=True)
        shifts = np.cumsum([0] + [len(t.all) for t in tokens])
        starts = [t.starts + shift for t, shift in zip(tokens, shifts, strict=False)]
        parts = [t.all for t in tokens], starts, [t.lengths for t in tokens]
        return pa.concat_batches(rows), _Tokens(*map(np.concatenate, parts))

    for whole in batches:
        for batch in chunks(whole, "text"):
            tokens = _tokens(batch.column("text"))
            waiting.append((batch, tokens))
            many += len(tokens.all)
            if many >= most:
                yield together()
                waiting, many = [], 0
    if waiting:
        yield together()


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, tokens in _several(batches, _COUNTED):
        keys, times = np.unique(tokens.all[tokens.behind(2)], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(times)], names=_COUNTS.names)


def _sequence_keys(tokens: _Tokens, at: np.ndarray, size: int) -> np.ndarray:
    """48-bit keys of the sequences that end at these places; the upper 16 bits are the range."""
    return span_hashes(tokens.all, at - (size - 1), at + 1) >> np.uint64(16)


def _sequence_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts and sequences with their counts, a row for each range of keys."""
    for _, tokens in _several(batches, _COUNTED):
        one = np.setdiff1d(tokens.behind(1), tokens.starts + tokens.lengths - 1, assume_unique=True)
        found = [_sequence_keys(tokens, one, 1)]
        found += [_sequence_keys(tokens, tokens.behind(size - 1), size) for size in (2, 3)]
        keys, times = np.unique(np.concatenate(found), return_counts=True)
        ranges = (keys >> np.uint64(32)).astype(np.int32)
        starts = np.flatnonzero(np.append(True, ranges[1:] != ranges[:-1]))
        ends = pa.array((np.append(starts, len(keys)) * 4).astype(np.int32)).buffers()[1]
        columns = [pa.array(ranges[starts])]
        for values in (keys, times):
            data = pa.py_buffer(values.astype(np.uint32).tobytes())
            columns.append(pa.Array.from_buffers(pa.binary(), len(starts), [None, ends, data]))
        yield pa.RecordBatch.from_arrays(columns, names=_PACKED.names)


def _places(keys: np.ndarray, level: int, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For (key, level) in filters of so many words: the word and the four bits of it."""
    hashes = mix(keys + np.uint64(level * 0x9E3779B97F4A7C15 % 2**64))
    bits = np.zeros(len(keys), np.uint64)
    for shift in (0, 6, 12, 18):
        bits |= np.uint64(1) << (hashes >> np.uint64(shift) & np.uint64(63))
    return (hashes >> np.uint64(32)) * sizes >> np.uint64(32), bits


def _fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The filter of each range, from all its counts."""
    for rows in whole_groups(batches, ["range"], _GROUP_BYTES):
        parts = [np.frombuffer(b"".join(rows.column(c).to_pylist()), np.uint32) for c in ("keys", "times")]
        many = np.array([len(x) // 4 for x in rows.column("keys").to_pylist()])
        ranges = rows.column("range").to_numpy().astype(np.uint64)
        keys = np.repeat(ranges << np.uint64(32), many) | parts[0]
        order = np.argsort(keys)
        keys = keys[order]
        new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        keys, times = keys[new], np.add.reduceat(parts[1][order].astype(np.int64), new)
        levels = np.searchsorted(LEVELS, times, side="right")
        held, of = np.unique(keys >> np.uint64(32), return_inverse=True)
        entries = np.bincount(of, weights=levels).astype(np.int64)
        sizes = np.minimum(-(-entries * BITS_PER_ENTRY // 64), SEGMENT_WORDS)
        starts = np.cumsum(sizes) - sizes
        filters = np.zeros(int(sizes.sum()), np.uint64)
        alive = np.arange(len(keys))
        for level in range(1, int(levels.max()) + 1):
            alive = alive[levels[alive] >= level]
            word, bits = _places(keys[alive], level, sizes[of[alive]].astype(np.uint64))
            np.bitwise_or.at(filters, starts[of[alive]] + word.astype(np.int64), bits)
        found = [filters[a : a + n].tobytes() for a, n in zip(starts.tolist(), sizes.tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(found, pa.binary())], names=_FILTERS.names)


@dataclass
class Model:
    """What scoring needs: totals, the frequent words' counts, and the filter in segments."""

    tokens: int
    distinct: int
    words: Broadcast  # sorted keys and their counts
    sizes: Broadcast  # words of each range's filter
    segments: list[tuple[int, int, Broadcast]]  # ranges from, to, and their filters end to end
    vocabulary: DataFrame

    @property
    def total(self) -> float:
        return self.tokens + ADDED * (self.distinct + 1)


def train(docs: DataFrame, text: str = "text") -> Model:
    """Counts all whole texts and builds the filter; a null text counts as empty."""
    spark = docs.sparkSession
    texts = docs.select(F.col(f"`{text}`").alias("text"))
    counted = texts.mapInArrow(_word_counts, _COUNTS).groupBy("key").agg(F.sum("times").alias("times"))
    vocabulary = written(counted, "vocabulary")
    totals = vocabulary.agg(F.coalesce(F.sum("times"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    frequent = vocabulary.where(F.col("times") * F.lit(FREQUENT).cast("decimal(20,0)") >= totals.n).toArrow()
    keys = frequent["key"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    words = spark.sparkContext.broadcast((keys[order], frequent["times"].to_numpy()[order]))

    packed = texts.mapInArrow(_sequence_counts, _PACKED)
    filled = packed.repartition("range").sortWithinPartitions("range").mapInArrow(_fill, _FILTERS)
    filters = written(filled, "filters")
    held = filters.select("range", (F.length("words") / 8).cast("long").alias("size")).toArrow()
    sizes = np.zeros(_RANGES, np.int64)
    sizes[held["range"].to_numpy()] = held["size"].to_numpy()
    segments, first = [], 0
    ends = np.cumsum(sizes)
    while first < _RANGES and ends[-1]:
        done = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + SEGMENT_WORDS, side="right")))
        rows = filters.where(F.col("range").between(first, last - 1)).toArrow().sort_by("range")
        joined = np.frombuffer(b"".join(x.as_py() for x in rows["words"]), np.uint64)
        segments.append((first, last, spark.sparkContext.broadcast(joined)))
        first = last
    return Model(totals.n, totals.v, words, spark.sparkContext.broadcast(sizes), segments, vocabulary)


def _levels(keys: np.ndarray, sizes: np.ndarray, segments: list[tuple[int, int, Broadcast]]) -> np.ndarray:
    """The level of each key, by probing one level after the other until one is absent."""
    levels = np.zeros(len(keys), np.int64)
    ranges = (keys >> np.uint64(32)).astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    for first, last, shared in segments:
        alive = np.flatnonzero((ranges >= first) & (ranges < last) & (sizes[ranges] > 0))
        if not len(alive):
            continue
        filters = shared.value
        for level in range(1, len(LEVELS) + 1):
            there = ranges[alive]
            word, bits = _places(keys[alive], level, sizes[there].astype(np.uint64))
            found = filters[starts[there] - starts[first] + word.astype(np.int64)]
            alive = alive[found & bits == bits]
            if not len(alive):
                break
            levels[alive] = level
        if len(segments) > KEPT_SEGMENTS:
            shared.__dict__.pop("_value", None)  # the file stays, so it can be loaded again
    return levels


def _scoring(total: float, words: Broadcast, sizes: Broadcast, segments: list[tuple[int, int, Broadcast]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = words.value
        row = TaskContext.get().partitionId() << 40
        for rows, tokens in _several(batches, _SCORED_TOGETHER):
            yield _scored(rows, tokens, row, known, counts.astype(np.float64), total, sizes.value, segments)
            row += rows.num_rows

    return run


@dataclass
class _Probabilities:
    """Of the predicted tokens, in order: their places, distinct words, and probabilities after one and two words."""

    at: np.ndarray
    words: np.ndarray
    of: np.ndarray  # which of the distinct words each token is
    frequent: np.ndarray  # of the distinct words
    counts: np.ndarray  # exact ones of those
    after_one: np.ndarray
    after_two: np.ndarray


def _probabilities(tokens, known, counts, total, sizes, segments) -> _Probabilities:
    words, of = np.unique(tokens.all, return_inverse=True)
    place = np.minimum(np.searchsorted(known, words), max(0, len(known) - 1))
    frequent = known[place] == words if len(known) else np.zeros(len(words), bool)
    exact = np.where(frequent, counts[place] if len(known) else 0.0, 0.0)
    # One lookup for everything: contexts of one word, then the sequences of two and three that end at each place.
    pairs, at = tokens.behind(1), tokens.behind(2)
    single = np.arange(len(words))
    keys = [span_hashes(words, single, single + 1) >> np.uint64(16)]
    keys += [_sequence_keys(tokens, pairs, 2), _sequence_keys(tokens, at, 3)]
    levels = _levels(np.concatenate(keys), sizes, segments)
    one, two, three = np.split(levels, np.cumsum([len(k) for k in keys])[:2])
    two_at = np.zeros(len(tokens.all), np.int64)
    two_at[pairs] = two

    share = (np.where(frequent, exact, _AT_LEAST[one]) + ADDED) / total
    context = np.where(frequent, exact, _AT_MOST[one])
    prior_one, prior_two = PRIOR
    seen = context[of[at - 1]]
    after_one = (np.minimum(_AT_LEAST[two_at[at]], seen) + prior_one * share[of[at]]) / (seen + prior_one)
    seen = _AT_MOST[two_at[at - 1]]
    after_two = (np.minimum(_AT_LEAST[three], seen) + prior_two * after_one) / (seen + prior_two)
    return _Probabilities(at, words, of[at], frequent, exact, after_one, after_two)


def _scored(rows, tokens, row, known, counts, total, sizes, segments) -> pa.RecordBatch:
    """A row for each text: sums over its tokens, and its rare words with how often it has them."""
    docs = rows.num_rows
    p = _probabilities(tokens, known, counts, total, sizes, segments)
    doc = np.repeat(np.arange(docs), tokens.lengths)[p.at]
    frequent = p.frequent[p.of]
    logs = np.where(frequent, np.log10(p.counts + ADDED)[p.of], 0.0)
    sums = [np.bincount(doc, weights=w, minlength=docs) for w in (frequent, logs, np.log10(p.after_one), np.log10(p.after_two))]
    lone = np.flatnonzero(~frequent)
    pair, times = np.unique(doc[lone] * len(p.words) + p.of[lone], return_counts=True)
    of_doc, word = np.divmod(pair, len(p.words))
    ends = pa.array(np.searchsorted(of_doc, np.arange(docs + 1)).astype(np.int32))
    columns = [pa.array(row + np.arange(docs)), rows.column("doc_id"), pa.array(tokens.lengths - 2)]
    columns += [pa.array(sums[0].astype(np.int64)), *map(pa.array, sums[1:])]
    columns += [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (p.words[word].view(np.int64), times)]
    return pa.RecordBatch.from_arrays(columns, names=_SCORED.names)


def _mixed(*scores: str) -> Column:
    best = F.greatest(*scores)
    total = sum((F.pow(F.lit(10.0), F.col(s) - best) for s in scores), F.lit(0.0))
    return best + F.log10(total / len(scores))


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs``.

    Tokens are the words of a text, lower-cased in A to Z, and one end. ``base_score`` sums
    the logarithms to base 10 of the exact, additively smoothed word shares, ``score`` is the
    model's logarithm of the text's probability. Null and empty texts have the end alone.
    Rows that repeat an id or a whole row are scored each; null ids stay null; an empty
    table gives an empty table, a model of no texts gives every token the same share; other
    columns are not read.
    """
    plain = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    scored = written(plain.mapInArrow(_scoring(model.total, model.words, model.sizes, model.segments), _SCORED), "scored")
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "rare_times")).alias("of"))
    rare = rare.select("row", F.col("of.rare").alias("key"), F.col("of.rare_times").alias("n"))
    rare = rare.join(model.vocabulary, "key", "left").withColumn("times", F.coalesce("times", F.lit(0)))
    rare = rare.groupBy("row").agg(
        F.sum(F.col("n") * F.log10(F.col("times") + ADDED)).alias("rare_base"),
        F.sum(F.when(F.col("times") > 0, F.col("n")).otherwise(0)).alias("rare_known"),
    )
    base = F.col("base") + F.coalesce("rare_base", F.lit(0.0)) - F.col("n_tokens") * F.log10(F.lit(float(model.total)))
    joined = scored.drop("rare", "rare_times").join(rare, "row", "left").withColumn("base_score", base)
    return joined.select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(int(model.tokens)).cast("long").alias("train_tokens"),
        "base_score",
        _mixed("base_score", "after_one", "after_two").alias("score"),
    )


def held_out(id_column: str = "doc_id") -> Column:
    """Whether a document is kept from learning; one without an id is learned from."""
    return F.coalesce(F.crc32(F.col(f"`{id_column}`").cast("string")) % HELD_OUT == 0, F.lit(False))


def held_out_scores(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``score`` with ``held_out`` for all documents, learned from those that are not held out."""
    model = train(docs.where(~held_out(id_column)), text)
    found = score(docs, model, id_column, text)
    return found.select("doc_id", held_out().alias("held_out"), *[c for c in found.columns if c != "doc_id"])
