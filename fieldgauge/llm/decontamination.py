"""Benchmark decontamination under edit distance.

The CGK embedding turns edit distance into Hamming distance: a random walk reads a word
sequence, gives out what stands at its place at each time, and moves on or waits by a
random bit of the word there. Walks over two nearly equal sequences fall back in step
after most edits. Locality-sensitive hashing samples a few times of a walk; where a walk
from a place in a document gives out the same words as one from a place in an item, the
item-sized window around it is compared exactly. Every place of every document starts a
walk, and every third place of an item does, for several walks, which gives the recall.

Documents never move: the items are a stated query set, taken in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldgauge.llm.words import Words, chunks, mix, span_hashes, split_words

EDITS = 0.2  # of an item's words
WALKS = 4
STEPS = 12
SAMPLES = 3
STRIDE = 3
SHORT = 8  # items of fewer words match only as they are
ITEM_BLOCK = 20_000

_SEED = 0x5851F42D4C957F2D
_TABLE_BITS = 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_MATCHES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("distance", T.LongType()),
    ]
)


def sample_times(walk: int) -> list[int]:
    """The times of a walk at which its output is sampled: one in each equal part of its steps."""
    part = STEPS // SAMPLES
    return [i * part + (walk * 7 + i * 5) % part for i in range(SAMPLES)]


class _Walk:
    """A walk over all places of word sequences at once; behind each sequence lies nothing, so no walk goes on into the next."""

    def __init__(self, symbols: np.ndarray, rows: np.ndarray, number: int):
        gap = STEPS + 2
        self.shift = np.repeat(np.arange(len(rows) - 1), np.diff(rows)) * gap
        spread = np.zeros(len(symbols) + gap * (len(rows) - 1), np.uint64)
        there = np.arange(len(symbols)) + self.shift
        spread[there] = symbols
        # What a walk gives out is a word with its successor, which is rarer than a word.
        self.output, self.bits = np.zeros_like(spread), np.zeros_like(spread)
        self.output[there] = mix(symbols + mix(spread[there + 1] + np.uint64(1)))
        self.bits[there] = mix(symbols ^ np.uint64(_SEED * (number + 1) & (2**64 - 1)))
        self.times = sample_times(number)

    def keys(self, starts: np.ndarray, known: list[np.ndarray] | None = None):
        """Starts and their keys; with ``known`` tables, starts whose samples can't be an item's fall out early."""
        at = starts + self.shift[starts]
        key = np.zeros(len(starts), np.uint64)
        for time in range(self.times[-1] + 1):
            if time in self.times:
                output = self.output[at]
                if known is not None:
                    likely = known[self.times.index(time)][output & np.uint64((1 << _TABLE_BITS) - 1)]
                    starts, at, key, output = starts[likely], at[likely], key[likely], output[likely]
                key = mix(key * np.uint64(3) + output)
            at = at + ((self.bits[at] >> np.uint64(time)) & np.uint64(1)).astype(np.int64)
        return starts, key

    def outputs(self, starts: np.ndarray) -> list[np.ndarray]:
        at, found = starts + self.shift[starts], []
        for time in range(self.times[-1] + 1):
            if time in self.times:
                found.append(self.output[at])
            at = at + ((self.bits[at] >> np.uint64(time)) & np.uint64(1)).astype(np.int64)
        return found


class Items:
    """The index of a block of items: walk keys of their places, and hashes of short items."""

    def __init__(self, items: list[tuple[int, str | None]]):
        words = _lowered(pa.array([text for _, text in items], pa.string()))
        self.ids = [i for i, _ in items]
        self.symbols = words.hashes()
        self.rows = words.rows
        counts = words.counts
        place = np.arange(len(self.symbols))
        row = words.row_of_word()
        offset = place - words.rows[row]
        starts = place[(counts[row] >= SHORT) & (offset % STRIDE == 0) & (offset + SHORT <= counts[row])]
        self.walks = []
        for number in range(WALKS):
            walk = _Walk(self.symbols, self.rows, number)
            _, keys = walk.keys(starts)
            tables = []
            for output in walk.outputs(starts):
                table = np.zeros(1 << _TABLE_BITS, bool)
                table[output & np.uint64((1 << _TABLE_BITS) - 1)] = True
                tables.append(table)
            order = np.argsort(keys, kind="stable")
            self.walks.append((keys[order], row[starts[order]], offset[starts[order]], tables))
        self.short = {}
        for size in np.unique(counts[(counts > 0) & (counts < SHORT)]).tolist():
            rows = np.flatnonzero(counts == size)
            hashes = span_hashes(self.symbols, words.rows[rows], words.rows[rows] + size)
            order = np.argsort(hashes, kind="stable")
            self.short[size] = hashes[order], rows[order]

    def of(self, item: int) -> np.ndarray:
        return self.symbols[self.rows[item] : self.rows[item + 1]]


def _lowered(column: pa.Array) -> Words:
    words = split_words(column)
    words.data = _LOWER[words.data]
    return words


def _pairs(keys: np.ndarray, wanted: np.ndarray):
    """(index in keys, index in wanted) of all equal values; ``wanted`` is sorted."""
    low, high = np.searchsorted(wanted, keys, "left"), np.searchsorted(wanted, keys, "right")
    hit = np.flatnonzero(high > low)
    sizes = (high - low)[hit]
    inner = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return np.repeat(hit, sizes), np.repeat(low[hit], sizes) + inner


def best_window(item: np.ndarray, region: np.ndarray) -> tuple[int, int]:
    """Least edit distance between the item and any window of the region, and where that window ends."""
    row = np.zeros(len(region) + 1, np.int64)
    steps = np.arange(len(region) + 1)
    for i, word in enumerate(item, 1):
        changed = np.minimum(row[1:] + 1, row[:-1] + (region != word))
        row = np.append(i, changed)
        row = np.minimum.accumulate(row - steps) + steps
    end = int(np.argmin(row))
    return int(row[end]), end


def _regions(tried: np.ndarray, rows: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(row, item, first, last): the words around candidates (row, item, begin), in order; what overlaps is one region."""
    if not len(tried):
        return
    row, item, begin = tried.T
    most = (sizes[item] * EDITS).astype(np.int64)
    first = np.maximum(rows[row], begin - most)
    last = np.minimum(rows[row + 1], begin + sizes[item] + most)
    new = np.ones(len(tried), bool)
    # Begins ascend within a row and item, and so do the ends of their regions.
    new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (first[1:] > last[:-1])
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(tried)) - 1
    yield from zip(row[heads].tolist(), item[heads].tolist(), first[heads].tolist(), last[tails].tolist(), strict=True)


def _found(words: Words, items: Items) -> dict[tuple[int, int], tuple[int, int]]:
    """(row, item) to (distance, start) of the best match of every item in every row."""
    symbols = words.hashes()
    found: dict[tuple[int, int], tuple[int, int]] = {}
    if not len(symbols):
        return found
    ends = words.rows[1:]
    candidates = []
    for number, (wanted, item, offset, tables) in enumerate(items.walks):
        if not len(wanted):
            continue
        starts, keys = _Walk(symbols, words.rows, number).keys(np.arange(len(symbols)), tables)
        mine, theirs = _pairs(keys, wanted)
        row = np.searchsorted(words.rows, starts[mine], "right") - 1
        candidates.append(np.stack([row, item[theirs], starts[mine] - offset[theirs]], 1))
    tried = np.unique(np.concatenate(candidates), axis=0) if candidates else np.zeros((0, 3), np.int64)
    for row, item, first, last in _regions(tried, words.rows, np.diff(items.rows)):
        wanted = items.of(item)
        distance, end = best_window(wanted, symbols[first:last])
        if distance <= int(len(wanted) * EDITS):
            start = max(0, first + end - len(wanted) - int(words.rows[row]))
            found[row, item] = min(found.get((row, item), (distance, start)), (distance, start))
    for size, (wanted, item) in items.short.items():
        at = np.flatnonzero(np.repeat(ends, words.counts) - np.arange(len(symbols)) >= size)
        mine, theirs = _pairs(span_hashes(symbols, at, at + size), wanted)
        rows = np.searchsorted(words.rows, at[mine], "right") - 1
        for place, row, which in zip(at[mine].tolist(), rows.tolist(), item[theirs].tolist(), strict=True):
            start = place - int(words.rows[row])
            found[row, which] = min(found.get((row, which), (0, start)), (0, start))
    return found


def _blocks(items: DataFrame, id_column: str, text: str) -> Iterator[Items]:
    items = items.select(F.col(f"`{id_column}`").cast("long").alias("item"), F.col(f"`{text}`").alias("text"))
    items = items.where("text is not null")
    blocks = -(-items.count() // (ITEM_BLOCK // 2))
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).collect()
        for begin in range(0, len(rows), ITEM_BLOCK):
            yield Items([tuple(r) for r in rows[begin : begin + ITEM_BLOCK]])


def _match_rows(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        for whole in batches:
            for batch in chunks(whole, "text"):
                found = sorted(_found(_lowered(batch.column("text")), items).items())
                ids = batch.column("doc_id")
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array([row for (row, _), _ in found], pa.int64())),
                        pa.array([items.ids[item] for (_, item), _ in found], pa.int64()),
                        pa.array([start for _, (_, start) in found], pa.int64()),
                        pa.array([distance for _, (distance, _) in found], pa.int64()),
                    ],
                    names=_MATCHES.names,
                )

    return run


def _clean_rows(shared, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        for whole in batches:
            for batch in chunks(whole, text):
                marked = {row for row, _ in _found(_lowered(batch.column(text)), items)}
                yield batch.take(pa.array([i for i in range(batch.num_rows) if i not in marked], pa.int64()))

    return run


def contamination(
    docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text: str = "text", item_id: str = "item_id"
) -> DataFrame:
    """(doc_id, item_id, start, distance): the best match of each item in each document.

    Words are compared without regard to case in A to Z. An item matches where a window
    of the document is within a fifth of the item's words in edit distance (insertions,
    deletions and changes of words); ``start`` is about where it begins, in words. Items
    of fewer than eight words match only as a whole; null and blank items match nothing,
    and so do null and empty texts. Repeated items and documents match one by one; an
    empty table on either side gives no rows; other columns are not read.
    """
    plain = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    found = None
    for block in _blocks(items, item_id, "text"):
        part = plain.mapInArrow(_match_rows(docs.sparkSession.sparkContext.broadcast(block)), _MATCHES)
        found = part if found is None else found.unionByName(part)
    return docs.sparkSession.createDataFrame([], _MATCHES) if found is None else found


def without_contamination(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id") -> DataFrame:
    """The documents in which no item matches, with all their columns."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    inner = names[docs.columns.index(text)]
    rest = docs.toDF(*names)
    for block in _blocks(items, item_id, "text"):
        rest = rest.mapInArrow(_clean_rows(docs.sparkSession.sparkContext.broadcast(block), inner), rest.schema)
    return rest.toDF(*docs.columns)
