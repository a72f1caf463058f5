"""Removing repeated passages, found by recompression.

Recompression shrinks a text in rounds: runs of one symbol get a name, then the
alphabet is split in two and every pair of a left and a right symbol gets a name.
Names and sides are functions of the content (64-bit hashes), so they agree over the
whole corpus without a dictionary to shuffle, and each round runs where the text lies.
Equal passages get equal symbols inside; only symbols at their edges can differ. For a
window of words, the symbols that its own words decide are known exactly. The highest
such symbols give the window's anchor: equal windows have equal anchors. One shuffle by
anchor brings together every window that may be equal, in the order of their places,
and the windows' own hashes verify them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldgauge.llm.tables import written
from fieldgauge.llm.words import chunks, mix, span_hashes, split_words

WINDOW = 20

_LEFT = np.uint64(0xD6E8FEB86659FD93)
_RIGHT = np.uint64(0xA0761D6478BD642F)
_ROUND = 0xE7037ED1A0B428DB
_LEVEL_BITS = 40
# A place holds the first window's start and the windows less one.
_COUNT_BITS = 12
# Windows are compared by their own 56 bits, within an anchor of 48: unrelated ones by 104 bits.
_HASH_BYTES = 7
_ANCHOR_MASK = np.uint64(2**64 - 2**16)

_ANCHORS = T.StructType(
    [
        T.StructField("anchor", T.LongType()),
        T.StructField("doc", T.LongType()),
        T.StructField("place", T.LongType()),
        T.StructField("windows", T.BinaryType()),
    ]
)
_REPEATS = T.StructType([T.StructField("doc", T.LongType()), T.StructField("repeat", T.LongType())])


def _name_runs(symbols, first, low, high):
    """One round that names runs; low and high bound the symbols that each window decides."""
    begins = np.ones(len(symbols), bool)
    begins[1:] = (symbols[1:] != symbols[:-1]) | first[1:]
    run = np.cumsum(begins) - 1
    at = np.flatnonzero(begins)
    length = np.diff(np.append(at, len(symbols))).astype(np.uint64)
    named = np.where(length > 1, mix(symbols[at] ^ mix(length * _LEFT)), symbols[at])
    # The first and the last run of a window may go on outside it.
    return named, first[at], run[low] + 1, run[high - 1]


def _name_pairs(symbols, first, low, high, number):
    """One round that names pairs of a left and a right symbol."""
    salt = np.uint64(number * _ROUND & (2**64 - 1))
    left = (mix(symbols + salt) & np.uint64(1)).astype(bool)
    pair = np.zeros(len(symbols), bool)
    pair[:-1] = left[:-1] & ~left[1:] & ~first[1:]
    kept = np.ones(len(symbols), bool)
    kept[1:] = ~pair[:-1]
    index = np.cumsum(kept) - 1
    after = np.append(symbols[1:], np.uint64(0))
    named = np.where(pair, mix(symbols * _LEFT + mix(after * _RIGHT + salt)), symbols)[kept]
    # A right symbol at the start, or a left one at the end, may pair with a symbol outside.
    low = low + ~left[low]
    high = high - left[high - 1]
    inside = high > low
    low = index[np.minimum(low, len(index) - 1)]
    high = np.where(inside, index[high - 1] + 1, low)
    return named, first[kept], low, high


def rounds_for(width: int) -> int:
    """Rounds of pair naming after which a window still decides some eight symbols."""
    left, rounds = width - 2.0, 0
    while (left - 1) * 0.75 >= 8:
        left, rounds = (left - 1) * 0.75, rounds + 1
    return rounds


def _least(pairs: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Where pairs[low:high] is least, for every window; the leftmost of equal ones."""
    size = np.frexp(high - low)[1] - 1  # of the largest power of two that fits
    best = np.arange(len(pairs))
    at = np.empty(len(low), np.int64)
    for power in range(int(size.max()) + 1):
        these = np.flatnonzero(size == power)
        one, two = best[low[these]], best[high[these] - (1 << power)]
        at[these] = np.where(pairs[two] < pairs[one], two, one)
        ahead = best[np.minimum(np.arange(len(pairs)) + (1 << power), len(pairs) - 1)]
        best = np.where(pairs[ahead] < pairs[best], ahead, best)
    return at


def window_anchors(symbols: np.ndarray, rows: np.ndarray, width: int):
    """For every window: where it starts, its anchor's name, and an id of the anchor's place.

    The anchor is the least pair of neighbours among the symbols that the window decides,
    after the last round that leaves it two of them. So it depends on nothing else, and
    windows that start close together mostly share it.
    """
    counts = np.diff(rows)
    ends = np.repeat(rows[1:], counts)
    place = np.arange(len(symbols))
    at = place[ends - place >= width]
    if width < 2:
        return at, symbols[at], at
    first = np.zeros(len(symbols) + 1, bool)
    first[rows[:-1]] = True
    first = first[:-1]
    anchor, where = np.empty(len(at), np.uint64), np.empty(len(at), np.int64)
    live, low, high = np.arange(len(at)), at, at + width
    rounds = rounds_for(width)
    for number in range(rounds + 2):
        if not len(live):
            break
        if number > rounds:
            after, going = None, np.zeros(len(live), bool)
        else:
            if number == 0:
                after = _name_runs(symbols, first, low, high)
            else:
                after = _name_pairs(symbols, first, low, high, number)
            going = after[3] - after[2] >= 2
        if not going.all():
            pairs = mix(symbols[:-1] * _LEFT + mix(symbols[1:] + _RIGHT))
            least = _least(pairs, low[~going], high[~going] - 1)
            anchor[live[~going]] = pairs[least]
            where[live[~going]] = least + (number << _LEVEL_BITS)
        if after:
            symbols, first = after[:2]
            live, low, high = live[going], after[2][going], after[3][going]
    return at, anchor, where


def _anchor_rows(width: int):
    """Rows of an anchor's place with the hashes of its windows.

    Of rows with the same windows in one batch, the earliest goes on in full. The others
    repeat it for certain and go on without hashes, under a key that spreads them; so a
    passage that very many documents share arrives about once per batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            parts = [found for batch in chunks(whole, "text") if (found := _anchors_of(batch, width))]
            if not parts:
                continue
            anchor, doc, place, windows, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
            anchor = anchor & _ANCHOR_MASK
            ends = np.cumsum(counts)
            content = mix(anchor ^ span_hashes(windows, ends - counts, ends))
            order = np.lexsort((place, doc, content))
            head = np.ones(len(order), bool)
            head[1:] = content[order[1:]] != content[order[:-1]]
            earliest = order[head][np.cumsum(head) - 1]
            again = np.zeros(len(order), bool)
            again[order] = (doc[order] != doc[earliest]) | (place[order] != place[earliest])
            windows = windows[np.repeat(~again, counts)].view(np.uint8).reshape(-1, 8)[:, :_HASH_BYTES].ravel()
            anchor = np.where(again, mix(content + mix(doc.view(np.uint64)) + place.view(np.uint64)), anchor)
            offsets = np.append(0, np.cumsum(np.where(again, 0, counts * _HASH_BYTES))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(anchor.view(np.int64)),
                    pa.array(doc),
                    pa.array(place),
                    pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(offsets), pa.py_buffer(windows)]),
                ],
                names=_ANCHORS.names,
            )

    return run


def _anchors_of(batch: pa.RecordBatch, width: int):
    words = split_words(batch.column("text"))
    symbols = words.hashes()
    at, anchor, where = window_anchors(symbols.copy(), words.rows, width) if len(symbols) else ([], [], [])
    if not len(at):
        return None
    row = words.row_of_word()[at]
    new = np.ones(len(at), bool)
    new[1:] = (where[1:] != where[:-1]) | (row[1:] != row[:-1])
    begins = np.flatnonzero(new)
    counts = np.diff(np.append(begins, len(at)))
    row = row[begins]
    doc = batch.column("doc").to_numpy(zero_copy_only=False)[row]
    place = ((at[begins] - words.rows[row]) << _COUNT_BITS) + counts - 1
    return anchor[begins], doc, place, span_hashes(symbols, at, at + width), counts


def _binary_values(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The window hashes in a column of byte strings, end to end, and how many each row has."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    packed = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].reshape(-1, _HASH_BYTES)
    values = np.zeros((len(packed), 8), np.uint8)
    values[:, :_HASH_BYTES] = packed
    return values.view(np.uint64).ravel(), np.diff(offsets) // _HASH_BYTES


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows equal to an earlier one. Rows come sorted by anchor, document and place.

    What is kept between batches is one anchor's distinct windows.
    """
    kept = None
    for batch in batches:
        anchor = batch.column("anchor").to_numpy(zero_copy_only=False)
        if not len(anchor):
            continue
        doc = batch.column("doc").to_numpy(zero_copy_only=False)
        place = batch.column("place").to_numpy(zero_copy_only=False)
        windows, counts = _binary_values(batch.column("windows"))
        known = counts == 0
        yield _repeat_rows(doc[known], place[known])
        anchor, doc, place, counts = anchor[~known], doc[~known], place[~known], counts[~known]
        if not len(anchor):
            continue
        new = np.ones(len(anchor), bool)
        new[1:] = anchor[1:] != anchor[:-1]
        goes_on = kept is not None and kept[0] == anchor[0]
        alone = new.copy()
        alone[:-1] &= new[1:]
        alone[0] &= not goes_on
        alone[-1] = False
        windows = windows[np.repeat(~alone, counts)]
        use = np.flatnonzero(~alone)
        counts, group = counts[use], (np.cumsum(new) - 1)[use]
        row = np.repeat(np.arange(len(use)), counts)
        offset = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        group, doc, place = group[row], doc[use][row], (place[use][row] >> _COUNT_BITS) + offset
        before = 0
        if goes_on:
            before = len(kept[1])
            windows = np.concatenate([kept[1], windows])
            doc, place = np.concatenate([kept[2], doc]), np.concatenate([kept[3], place])
            group = np.concatenate([np.zeros(before, group.dtype), group])
            row = np.concatenate([np.full(before, -1), row])
        order = np.lexsort((windows, group))
        head = np.ones(len(order), bool)
        head[1:] = (windows[order][1:] != windows[order][:-1]) | (group[order][1:] != group[order][:-1])
        earliest = order[head][np.cumsum(head) - 1]
        repeated = np.zeros(len(order), bool)
        repeated[order] = (doc[order] != doc[earliest]) | (place[order] != place[earliest])
        heads = order[head]
        heads = np.sort(heads[group[heads] == group[-1]])
        kept = (anchor[-1], windows[heads], doc[heads], place[heads])
        repeated[:before] = False
        begins = repeated.copy()
        begins[1:] &= ~repeated[:-1] | (row[1:] != row[:-1])
        ends = repeated.copy()
        ends[:-1] &= ~repeated[1:] | (row[1:] != row[:-1])
        begins, ends = np.flatnonzero(begins), np.flatnonzero(ends)
        yield _repeat_rows(doc[begins], (place[begins] << _COUNT_BITS) + ends - begins)


def _repeat_rows(doc, repeat) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(repeat)], names=_REPEATS.names)


def repeated_windows(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """Windows of (doc, text) whose words also start earlier, as (doc, repeat): start * 2**12 + windows - 1.

    Different texts must have different numbers ``doc``.
    """
    if not 1 <= width <= 1 << _COUNT_BITS:
        raise ValueError(f"width must be between 1 and {1 << _COUNT_BITS}")
    anchors = docs.select("doc", "text").mapInArrow(_anchor_rows(width), _ANCHORS)
    return (
        anchors.repartition("anchor")
        .sortWithinPartitions("anchor", "doc", "place")
        .mapInArrow(_repeats, _REPEATS)
    )


def _numbered(docs: DataFrame, text: str) -> DataFrame:
    """The rows with a ``doc`` that tells different texts apart and keeps their order.

    That is the id itself where every text has its own. Otherwise (null ids, or several
    texts under one) texts are numbered in the order of their ids, null last, and of their
    64-bit hashes; equal texts under one id have one number.
    """
    content = F.xxhash64(F.col(f"`{text}`"))
    keys = docs.select("doc", content.alias("content"))
    mixed = keys.groupBy("doc").agg(F.min("content").alias("one"), F.max("content").alias("two"))
    if mixed.where("doc is null or one <> two").isEmpty():
        return docs
    ordered = keys.distinct().orderBy(F.asc_nulls_last("doc"), "content")
    numbers = written(ordered.withColumn("number", F.monotonically_increasing_id()), "numbers")
    left = docs.withColumn("content", content)
    same = left["doc"].eqNullSafe(numbers["doc"]) & (left["content"] == numbers["content"])
    kept = [left[c] for c in docs.columns if c != "doc"]
    return left.join(numbers, same).select(numbers["number"].alias("doc"), *kept)


def _cut(width: int, one_space: bool, position: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole, whole.schema.names[position]):
                text = batch.column(position)
                words = split_words(text)
                removed = np.zeros(len(words.starts) + 1, np.int64)
                repeats = batch.column("repeats")
                packed = repeats.flatten().to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(len(repeats)), np.diff(repeats.offsets.to_numpy()))
                start = words.rows[row] + (packed >> _COUNT_BITS)
                behind = start + (packed & ((1 << _COUNT_BITS) - 1)) + width
                if (behind > words.rows[row + 1]).any():
                    raise ValueError("a repeat goes beyond its text")
                np.add.at(removed, start, 1)
                np.add.at(removed, behind, -1)
                gone = np.cumsum(removed[:-1]) > 0
                kept = np.flatnonzero(~gone)
                n_gone = np.diff(np.concatenate([[0], np.cumsum(gone)])[words.rows])
                # Each kept word with the white space behind it, or with one space.
                row_of_word = words.row_of_word()
                follows = np.append(words.starts[1:], len(words.data))
                last = np.zeros(len(words.starts), bool)
                last[(words.rows[1:] - 1)[words.counts > 0]] = True
                stop = np.where(last, words.ends, np.minimum(words.ends + 1, follows) if one_space else follows)
                mark = np.zeros(len(words.data) + 1, np.int8)
                np.add.at(mark, words.starts[kept], 1)
                np.add.at(mark, stop[kept], -1)
                data = words.data.copy()
                if one_space:
                    data[(words.ends[~last])] = 0x20
                covered = np.cumsum(mark[:-1], dtype=np.int32) > 0
                data = data[covered]
                sizes = np.bincount(row_of_word[kept], (stop - words.starts)[kept], len(text)).astype(np.int64)
                offsets = np.concatenate([[0], np.cumsum(sizes)])
                out = [bytes(data[a:b]).rstrip(b" \t\n\v\f\r").decode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                if not one_space:
                    same = n_gone == 0
                    out = [v if s else o for v, s, o in zip(text.to_pylist(), same, out, strict=True)]
                columns = [batch.column(i) for i in range(len(names))]
                columns[position] = pa.array(out, pa.string())
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(words.counts), pa.array(n_gone)], names=[*names, "n_words", "n_removed"]
                )

    return run


def remove_repeats(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", width: int = WINDOW, one_space: bool = False
) -> DataFrame:
    """The documents without the words of any window that also starts earlier.

    Earlier means a smaller id, or the same document and an earlier start; windows are
    judged on the input. All columns stay; ``text`` has the kept words, and ``n_words``
    and ``n_removed`` (replacing columns of that name) count the words before and those
    removed. With ``one_space`` kept words are joined by one space; otherwise they keep
    the white space behind them, and a text without removals stays as it is (null stays
    null). A null or empty text, or one of fewer words than a window, has no window. A
    null id counts as the last. Rows equal in id and text don't repeat each other;
    different texts under one id come in the order of their hashes. An empty table
    gives an empty table.
    """
    names = [c for c in docs.columns if c not in ("n_words", "n_removed")]
    inner = [f"c{i}" for i in range(len(names))]
    position = names.index(text)
    given = docs.select(F.col(f"`{id_column}`").cast("long"), *[F.col(f"`{c}`") for c in names]).toDF("doc", *inner)
    left = _numbered(given, inner[position])
    repeats = (
        repeated_windows(left.select("doc", F.col(inner[position]).alias("text")), width)
        .groupBy("doc")
        .agg(F.collect_list("repeat").alias("repeats"))
    )
    joined = left.join(repeats, "doc", "left").select(
        *inner, F.coalesce("repeats", F.array().cast("array<long>")).alias("repeats")
    )
    schema = T.StructType([T.StructField(i, left.schema[i].dataType) for i in inner])
    schema = schema.add("n_words", T.LongType()).add("n_removed", T.LongType())
    cut = joined.mapInArrow(_cut(width, one_space, position, inner), schema)
    return cut.toDF(*names, "n_words", "n_removed")
