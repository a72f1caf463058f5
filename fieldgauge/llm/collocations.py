"""Phrase collocations by prefix-free parsing.

Texts are parsed into overlapping chunks. A chunk begins at the first word of a piece of
text and wherever a window of words is a trigger (its hash is a multiple of PERIOD), and
goes on to the end of the next trigger. So chunks depend on content alone, equal passages
give equal chunks, and chunks share exactly the words of a trigger. Spark counts the
distinct chunks, and phrases are counted inside those only, weighted by how often a chunk
occurs. A phrase belongs to the chunk that holds its first word before the closing
trigger, so what lies in two chunks is counted once.

Frequent phrases have frequent parts. Words and pairs are counted first, as 64-bit hashes;
the hashes that reach the threshold go into a filter of fixed size, which keeps phrases
with a rare part out of the next count. The filter holds every frequent hash and may let
others through, so the last count, of the phrases themselves, is exact. Only phrases of
one batch are told apart by 64-bit hashes when they are added up there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldgauge.llm.tables import written
from fieldgauge.llm.words import byte_table, chunks, lower_ascii, mix, span_hashes, split_words, text_bytes

LONGEST = 4
LEAST = 30
KEPT = 2000
ABSORBED = (80, 100)  # a phrase goes if a longer one has this share of its occurrences
SCALE = 2_000_000
NO_LANG = "und"

PERIOD = 16
CHUNK_WORDS = 128  # a chunk without a trigger ends here
FILTER_WORDS = 1 << 21  # of 64 bits: 16 MiB, whatever the input
_BATCH_WORDS = 1 << 20  # counted together in a task
_CHUNK_BYTES = 4 << 20

_STOPS = byte_table(b".,;:!?\x0a\x0b\x0c\x0d")
_SEPARATORS = _STOPS | byte_table(b" \t")
_SPACE = byte_table(b" ")

_CHUNKS = T.StructType(
    [T.StructField("lang", T.StringType()), T.StructField("chunk", T.StringType()), T.StructField("own", T.IntegerType())]
)
_HASHES = T.StructType([T.StructField("key", T.LongType()), T.StructField("times", T.LongType())])
_PHRASES = T.StructType(
    [T.StructField("lang", T.StringType()), T.StructField("size", T.IntegerType())]
    + [T.StructField("phrase", T.StringType()), T.StructField("times", T.LongType())]
)


def _first_words(new: np.ndarray, hashes: np.ndarray, piece_end: np.ndarray, shared: int) -> np.ndarray:
    """The words at which chunks begin: at new pieces, at triggers, and after CHUNK_WORDS words without one."""
    at = np.flatnonzero(np.arange(len(new)) + shared <= piece_end)
    trigger = np.zeros(len(new), bool)
    trigger[at] = span_hashes(hashes, at, at + shared) % np.uint64(PERIOD) == 0
    begins = np.flatnonzero(new | trigger)
    gaps = np.diff(np.append(begins, len(new)))
    long = np.flatnonzero(gaps > CHUNK_WORDS)
    more = [np.arange(begins[i] + CHUNK_WORDS, begins[i] + gaps[i], CHUNK_WORDS) for i in long]
    return np.sort(np.concatenate([begins, *more])) if more else begins


def _parsed(batch: pa.RecordBatch, shared: int) -> pa.RecordBatch:
    """The chunks of a batch of (lang, text): their words joined by spaces, and how many are before the next chunk's."""
    words = split_words(batch.column("text"), _SEPARATORS)
    n = len(words.starts)
    if not n:
        return pa.RecordBatch.from_pylist([], schema=pa.schema([("lang", pa.string()), ("chunk", pa.string()), ("own", pa.int32())]))
    raw = words.data
    words.data = lower_ascii(raw)
    stops = np.append(0, np.cumsum(_STOPS[raw]))[words.starts]
    row = words.row_of_word()
    new = np.append(True, (stops[1:] != stops[:-1]) | (row[1:] != row[:-1]))
    firsts = np.flatnonzero(new)
    piece_end = np.repeat(np.append(firsts[1:], n), np.diff(np.append(firsts, n)))
    begins = _first_words(new, words.hashes(), piece_end, shared)
    own = np.diff(np.append(begins, n))
    behind = np.minimum(begins + own + shared, piece_end[begins])

    lengths = words.ends - words.starts
    ends = np.cumsum(lengths + 1) - 1
    joined = np.full(ends[-1] + 1, ord(" "), np.uint8)
    inside = np.ones(len(joined), bool)
    inside[ends] = False
    joined[inside] = words.data[~_SEPARATORS[raw]]
    text = joined.tobytes()
    spans = zip((ends - lengths)[begins].tolist(), ends[behind - 1].tolist(), strict=True)
    found = pa.array([text[a:b] for a, b in spans], pa.binary()).cast(pa.string())
    langs = batch.column("lang").take(pa.array(row[begins]))
    return pa.RecordBatch.from_arrays([langs, found, pa.array(own.astype(np.int32))], names=_CHUNKS.names)


def _parsing(shared: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole, "text", _CHUNK_BYTES):
                yield _parsed(batch, shared)

    return run


def dictionary(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST) -> DataFrame:
    """(lang, chunk, own, times): the distinct chunks of the parse and how often each occurs.

    ``own`` is the number of words before those shared with the next chunk; phrases that
    begin there are this chunk's. Null texts count as empty, null languages as NO_LANG.
    """
    plain = docs.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(NO_LANG)).alias("lang"), F.col(f"`{text}`").alias("text")
    )
    parsed = plain.mapInArrow(_parsing(max(1, longest - 1)), _CHUNKS)
    return parsed.groupBy("lang", "chunk", "own").agg(F.count("*").alias("times"))


class _Chunks:
    """The words of some dictionary rows, with hashes, weights and languages."""

    def __init__(self, batch: pa.RecordBatch):
        self.words = split_words(batch.column("chunk"), _SPACE)
        self.hashes = self.words.hashes()
        self.row = self.words.row_of_word()
        place = np.arange(len(self.row)) - self.words.rows[self.row]
        self.owned = place < batch.column("own").to_numpy()[self.row]
        self.left = self.words.counts[self.row] - place  # words from here to the chunk's end
        self.times = batch.column("times").to_numpy()
        self.langs = batch.column("lang")
        coded = self.langs.dictionary_encode()
        data, offsets = text_bytes(coded.dictionary)
        self.salts = span_hashes(data.astype(np.uint64) + np.uint64(1), offsets[:-1], offsets[1:])[coded.indices.to_numpy()]

    def keys(self, at: np.ndarray, size: int) -> np.ndarray:
        return mix(span_hashes(self.hashes, at, at + size) ^ self.salts[self.row[at]])

    def phrases(self, size: int, filters: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of the chunks' own phrases whose parts, and themselves, pass the filters."""
        at = np.flatnonzero(self.owned & (self.left >= size))
        if size - 1 in filters:
            for step in (0, 1):
                at = at[_passes(filters[size - 1], self.keys(at + step, size - 1))]
        keys = self.keys(at, size)
        if size in filters:
            passed = _passes(filters[size], keys)
            at, keys = at[passed], keys[passed]
        return at, keys


def _bits(keys: np.ndarray) -> np.ndarray:
    one, bits = np.uint64(1), np.zeros(len(keys), np.uint64)
    for shift in (0, 6, 12, 18):
        bits |= one << (keys >> np.uint64(shift) & np.uint64(63))
    return bits


def _passes(filter_words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    bits = _bits(keys)
    return filter_words[keys >> np.uint64(65 - FILTER_WORDS.bit_length())] & bits == bits


def _filter(frequent: DataFrame) -> Broadcast:
    """A filter of FILTER_WORDS words that passes every ``key``; a key sets four bits of one word."""
    key = F.col("key")
    bits = F.expr(" | ".join(f"shiftleft(1L, cast(shiftrightunsigned(key, {s}) & 63 as int))" for s in (0, 6, 12, 18)))
    rows = (
        frequent.select(F.shiftrightunsigned(key, 65 - FILTER_WORDS.bit_length()).alias("word"), bits.alias("bits"))
        .groupBy("word")
        .agg(F.bit_or("bits").alias("bits"))
        .toArrow()
    )
    found = np.zeros(FILTER_WORDS, np.uint64)
    found[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return frequent.sparkSession.sparkContext.broadcast(found)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches, several at a time."""
    waiting: list[pa.RecordBatch] = []
    words = 0
    for batch in batches:
        if batch.num_rows:
            waiting.append(batch)
            words += int(batch.column("own").to_numpy().sum())
        if words >= _BATCH_WORDS:
            yield pa.concat_batches(waiting)
            waiting, words = [], 0
    if waiting:
        yield pa.concat_batches(waiting)


def _summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct key is first, in the order of the keys, and its sum."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return order[new], np.add.reduceat(times[order], new)


def _hash_counts(sizes: tuple[int, ...], filters: dict[int, Broadcast]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {size: shared.value for size, shared in filters.items()}
        for batch in _gathered(batches):
            rows = _Chunks(batch)
            for size in sizes:
                at, keys = rows.phrases(size, known)
                if len(at):
                    first, sums = _summed(keys, rows.times[rows.row[at]])
                    yield pa.RecordBatch.from_arrays([pa.array(keys[first].view(np.int64)), pa.array(sums)], names=_HASHES.names)

    return run


def _phrase_counts(longest: int, filters: dict[int, Broadcast]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {size: shared.value for size, shared in filters.items()}
        for batch in _gathered(batches):
            rows = _Chunks(batch)
            text, starts, ends = rows.words.data.tobytes(), rows.words.starts, rows.words.ends
            for size in range(1, longest + 1):
                at, keys = rows.phrases(size, known)
                if not len(at):
                    continue
                first, sums = _summed(keys, rows.times[rows.row[at]])
                at = at[first]
                spans = zip(starts[at].tolist(), ends[at + size - 1].tolist(), strict=True)
                found = pa.array([text[a:b] for a, b in spans], pa.binary()).cast(pa.string())
                langs = rows.langs.take(pa.array(rows.row[at]))
                sizes = pa.array(np.full(len(at), size, np.int32))
                yield pa.RecordBatch.from_arrays([langs, sizes, found, pa.array(sums)], names=_PHRASES.names)

    return run


def frequent_phrases(chunked: DataFrame, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """(lang, size, phrase, f): all phrases of up to ``longest`` words that occur ``least`` times, from a dictionary."""
    filters: dict[int, Broadcast] = {}
    for sizes in ((1, 2), *((size,) for size in range(3, longest))):
        counted = chunked.mapInArrow(_hash_counts(sizes, dict(filters)), _HASHES).groupBy("key").agg(F.sum("times").alias("f"))
        found = _filter(counted.where(F.col("f") >= least))
        filters.update({size: found for size in sizes if size < longest})
    counted = chunked.mapInArrow(_phrase_counts(longest, filters), _PHRASES)
    return counted.groupBy("lang", "size", "phrase").agg(F.sum("times").alias("f")).where(F.col("f") >= least)


def _part(words: str, first: Column | int, size: Column) -> Column:
    return F.array_join(F.slice(words, first, size), " ")


def _scored(phrases: DataFrame) -> DataFrame:
    """(lang, size, phrase, words, a, score, l, r): candidates by their lowest-scoring cut."""
    words = F.split("phrase", " ")
    cuts = F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    cut = phrases.where("size > 1").select("lang", "size", "phrase", F.col("f").alias("a"), words.alias("words"), cuts)
    k = F.col("k")
    cut = cut.withColumn("first", _part("words", 1, k)).withColumn("rest", _part("words", k + 1, F.col("size") - k))
    one = phrases.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    two = phrases.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    both = cut.join(one, ["lang", "first"]).join(two, ["lang", "rest"])
    # Decimals of 38 digits, as the product may pass 64 bits.
    score = F.expr(f"cast(a as decimal(20,0)) * cast({SCALE} as decimal(7,0)) div cast(l + r as decimal(20,0))")
    lowest = both.withColumn("score", score).groupBy("lang", "size", "phrase", "words", "a")
    return lowest.agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select(
        "lang", "size", "phrase", "words", "a", "cut.score", "cut.l", "cut.r"
    )


def _inside(candidates: DataFrame) -> DataFrame:
    """(lang, phrase, longer): for each phrase inside a longer candidate, the greatest count of one that holds it."""
    size = F.col("size")
    spans = F.explode(
        F.expr("flatten(transform(sequence(2, size - 1), n -> transform(sequence(1, size - n + 1), i -> struct(i, n))))")
    )
    parts = candidates.where(size > 2).select("lang", "words", "a", spans.alias("span"))
    parts = parts.select("lang", _part("words", F.col("span.i"), F.col("span.n")).alias("phrase"), "a")
    return parts.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST, kept: int = KEPT
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the strongest phrases of each language.

    Texts are lower-cased in A to Z and split at stops into pieces, these into words.
    Phrases of 2 to ``longest`` words with ``least`` occurrences ``a`` or more are
    candidates; a cut after k words has ``l`` and ``r`` occurrences of its two parts and
    the score floor(SCALE * a / (l + r)), the lowest of all cuts counts. Candidates inside a
    longer one that has the share ABSORBED of their occurrences are left out. ``n`` is the
    language's number of words. Each language's first ``kept`` are returned by score, count
    and phrase, so ties are never open. Null texts are empty; null languages are NO_LANG;
    repeated rows count each time; without candidates, as in an empty table, there are no
    rows; other columns are not read.
    """
    chunked = written(dictionary(docs, text, lang, longest), "dictionary")
    phrases = written(frequent_phrases(chunked, longest, least), "phrases")
    totals = chunked.groupBy("lang").agg(F.sum(F.col("own") * F.col("times")).alias("n"))
    candidates = _scored(phrases)
    share, whole = ABSORBED
    as_decimal = "cast({} as decimal(20,0)) * cast({} as decimal(3,0))"
    absorbed = F.expr(f"{as_decimal.format('longer', whole)} >= {as_decimal.format('a', share)}")
    alone = candidates.join(_inside(candidates), ["lang", "phrase"], "left").where(F.coalesce(~absorbed, F.lit(True)))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = alone.withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= kept)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
