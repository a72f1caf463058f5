"""Near duplicates by SimHash fingerprints and a hierarchical index in Gray order.

The index finds all pairs of fingerprints that differ in at most ``distance`` bits. Its
upper nodes are masked bit patterns: the bits are cut into distance + 1 blocks, of which
a pair within the distance shares at least one, and the remaining bits once more. Spark
shuffles each fingerprint to its nodes and sorts a node by Gray rank. Below a node,
consecutive fingerprints form groups of groups that hold the bits their members agree
on; two groups are skipped as a whole once the differences in bits that both have fixed
exceed the distance.

A node with very many fingerprints is no work for one task: its members go on to nodes
below it, where some of the remaining bits are masked as well, in a further round. Each
round leaves fewer bits open, so a node's size is bounded whatever the documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldgauge.llm.components import components
from fieldgauge.llm.tables import written
from fieldgauge.llm.words import chunks, split_words

SHINGLE = 3
DISTANCE = 3
SEED = 42

NODE = 1 << 16  # fingerprints of a node that one task links
_FAN = 32  # members of a group, at every level
_PAIRS = 2048  # group pairs compared at a time
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_FINGERPRINTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("fingerprint", T.LongType())])
_LINKS = T.StructType([T.StructField(c, T.LongType()) for c in ("a", "b", "mask")])


def _shingle_words(words, size: int):
    """The first word of each row's shingles, the word behind the last, and the number of shingles of each row."""
    counts = words.counts
    shingles = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    first = np.repeat(words.rows[:-1], shingles)
    first = first + np.arange(len(first)) - np.repeat(np.cumsum(shingles) - shingles, shingles)
    return first, first + np.repeat(np.minimum(counts, size), shingles), shingles


def _shingle_spans(words, size: int):
    """Byte spans, in a text of words with one space between them, of each row's shingles."""
    lengths = words.ends - words.starts
    ends = np.cumsum(lengths + 1) - 1
    first, behind, shingles = _shingle_words(words, size)
    return (ends - lengths)[first], ends[behind - 1], shingles


def _majority(hashes: np.ndarray, shingles: np.ndarray) -> np.ndarray:
    """For each row with shingles, the bits set in over half of its shingles' hashes."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    filled = np.flatnonzero(shingles)
    sums = np.add.reduceat(bits, (np.cumsum(shingles) - shingles)[filled], axis=0, dtype=np.int64)
    return np.packbits(sums * 2 > shingles[filled, None], axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprint_values(column: pa.Array, size: int = SHINGLE) -> np.ndarray:
    """The fingerprint of each text: bit i is set if it is in over half of the shingles' hashes."""
    words = split_words(column)
    found = np.zeros(len(words.rows) - 1, np.uint64)
    if not len(words.starts):
        return found
    starts, ends, shingles = _shingle_spans(words, size)
    lowered = _LOWER[words.data].tobytes()
    text = b" ".join([lowered[a:b] for a, b in zip(words.starts.tolist(), words.ends.tolist(), strict=True)])
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(text[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)), np.uint64, len(starts)
    )
    found[np.flatnonzero(shingles)] = _majority(hashes, shingles)
    return found


def _fingerprint_rows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole, "text"):
                values = fingerprint_values(batch.column("text"), size).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values)], names=_FINGERPRINTS.names)

    return run


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text", size: int = SHINGLE) -> DataFrame:
    """(doc_id, fingerprint) for every row; a null text counts as empty and has fingerprint 0."""
    plain = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return plain.mapInArrow(_fingerprint_rows(size), _FINGERPRINTS)


def finer(mask: int, distance: int = DISTANCE, bits: int = 64) -> list[int]:
    """Masks of more bits: two words that agree under ``mask`` and are within the distance agree under one at least."""
    left, parts = [p for p in range(bits) if not mask >> p & 1], distance + 1
    blocks = [left[len(left) * i // parts : len(left) * (i + 1) // parts] for i in range(parts)]
    return [mask | sum(1 << p for p in block) for block in blocks]


def masks(distance: int = DISTANCE, bits: int = 64) -> list[int]:
    """Masks of the index's upper nodes: two words within the distance agree under one at least."""
    return [fine for block in finer(0, distance, bits) for fine in finer(block, distance, bits)]


def gray_rank(value: Column) -> Column:
    """Where a word stands in the reflected Gray code."""
    for shift in (1, 2, 4, 8, 16, 32):
        value = value.bitwiseXOR(F.shiftrightunsigned(value, shift))
    return value


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


class _Labels:
    """Which of n members are connected so far, and the pairs that connected them."""

    def __init__(self, n: int):
        self.of = np.arange(n)
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            one, two = self.of[a], self.of[b]
            apart = one != two
            if not apart.any():
                return
            a, b, one, two = a[apart], b[apart], one[apart], two[apart]
            high, low = np.maximum(one, two), np.minimum(one, two)
            order = np.lexsort((low, high))
            used = order[np.append(True, high[order[1:]] != high[order[:-1]])]
            self.of[high[used]] = low[used]
            self.pairs.append((a[used], b[used]))
            while (self.of != self.of[self.of]).any():
                self.of = self.of[self.of]


def _small_groups(values: np.ndarray, group: np.ndarray, labels: _Labels, distance: int) -> None:
    """Compares all members of groups of up to _FAN, all groups at a time."""
    at = np.arange(len(values))
    for step in range(1, _FAN):
        at = at[at + step < len(values)]
        at = at[group[at] == group[at + step]]
        if not len(at):
            return
        close = at[np.bitwise_count(values[at] ^ values[at + step]) <= distance]
        labels.join(close, close + step)


def _levels(values: np.ndarray):
    """From the leaves up: each group's first member, the bits its members agree on, and its size bounds."""
    levels = []
    first, agreed = values, np.full_like(values, 2**64 - 1)
    while len(first) > _FAN:
        starts = np.arange(0, len(first), _FAN)
        lead = np.repeat(first[starts], np.diff(np.append(starts, len(first))))
        differ = np.bitwise_or.reduceat((first ^ lead) | ~agreed, starts)
        first, agreed = first[starts], ~differ
        levels.append((first, agreed))
    return levels


def _large_group(values: np.ndarray, labels: _Labels, base: int, distance: int) -> None:
    """Compares members in Gray order through the tree of groups, skipping pairs of groups that are
    too far apart or already connected as a whole."""
    levels = _levels(values)
    top = len(levels) - 1
    n = len(levels[top][0])
    one, two = np.triu_indices(n)
    stack = [(top, one, two)]
    full = np.concatenate([values, np.zeros(-len(values) % _FAN, np.uint64)])
    while stack:
        level, one, two = stack.pop()
        if len(one) > _PAIRS:
            near = np.argsort(two - one, kind="stable")  # close groups first: they connect most
            one, two = one[near], two[near]
            for start in reversed(range(0, len(one), _PAIRS)):
                stack.append((level, one[start : start + _PAIRS], two[start : start + _PAIRS]))
            continue
        first, agreed = levels[level]
        apart = np.bitwise_count((first[one] ^ first[two]) & agreed[one] & agreed[two]) > distance
        one, two = one[~apart], two[~apart]
        span = _FAN ** (level + 1)
        starts = np.arange(0, len(values), span)
        own = labels.of[base : base + len(values)]
        low, high = np.minimum.reduceat(own, starts), np.maximum.reduceat(own, starts)
        done = (low[one] == high[one]) & (low[two] == high[two]) & (low[one] == low[two])
        one, two = one[~done], two[~done]
        if not len(one):
            continue
        a = (one[:, None, None] * _FAN + np.arange(_FAN)[None, :, None])
        b = (two[:, None, None] * _FAN + np.arange(_FAN)[None, None, :])
        a, b = np.broadcast_arrays(a, b)
        if level == 0:
            close = (np.bitwise_count(full[a] ^ full[b]) <= distance) & (a < b) & (b < len(values))
            labels.join(base + a[close], base + b[close])
        else:
            use = (a <= b) & (b < len(levels[level - 1][0]))
            stack.append((level - 1, a[use], b[use]))


def _links(distance: int, most: int):
    """Links that connect the fingerprints of a node as their pairs within the distance do.

    A node gives fewer links than it has members. One of more than about ``most`` members
    gives its members with its mask, and no links.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list = []  # of a node that may go on
        open_key, number, too_many = None, 0, False

        def found() -> pa.RecordBatch:
            return _link_rows(*(np.concatenate(x) for x in zip(*waiting, strict=True)), distance)

        def passed_on(values: np.ndarray) -> pa.RecordBatch:
            rows = [pa.array(values), pa.nulls(len(values), pa.int64()), pa.array(np.full(len(values), open_key[0]))]
            return pa.RecordBatch.from_arrays(rows, names=_LINKS.names)

        for batch in batches:
            if not batch.num_rows:
                continue
            *key, values = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("mask", "pattern", "fingerprint"))
            new = np.zeros(batch.num_rows, bool)
            new[0] = open_key != [k[0] for k in key]
            for k in key:
                new[1:] |= k[1:] != k[:-1]
            rest = [np.cumsum(new) + number, values]
            number = rest[0][-1]
            ends = np.flatnonzero(new)
            begin = 0
            if too_many:  # the open node's further members
                begin = int(ends[0]) if len(ends) else len(values)
                if begin:
                    yield passed_on(values[:begin])
                too_many = not len(ends)
            open_key = [k[-1] for k in key]
            if len(ends):
                if ends[-1] > begin:
                    waiting.append([x[begin : ends[-1]] for x in rest])
                if waiting:
                    yield found()
                waiting, begin = [], ends[-1]
            if begin < len(values):
                waiting.append([x[begin:] for x in rest])
            if sum(len(x) for x, _ in waiting) > most:
                yield passed_on(np.concatenate([x for _, x in waiting]))
                waiting, too_many = [], True
        if waiting:
            yield found()

    return run


def _link_rows(node: np.ndarray, names: np.ndarray, distance: int) -> pa.RecordBatch:
    sizes = np.diff(np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1], [True]])))
    shared = np.repeat(sizes > 1, sizes)
    names, group = names[shared], node[shared]
    values = names.view(np.uint64)
    labels = _Labels(len(values))
    size = np.repeat(sizes, sizes)[shared]
    small = np.flatnonzero(size <= _FAN)
    inner = _Labels(len(small))
    large = np.flatnonzero(size > _FAN)
    starts = large[np.append(True, np.diff(group[large]) != 0)] if len(large) else []
    _small_groups(values[small], group[small], inner, distance)
    for begin in starts:
        _large_group(values[begin : begin + size[begin]], labels, begin, distance)
    pairs = [*labels.pairs, *((small[a], small[b]) for a, b in inner.pairs)]
    a, b = (np.concatenate(x) for x in zip(*pairs, strict=True)) if pairs else (np.zeros(0, int), np.zeros(0, int))
    columns = [pa.array(names[a]), pa.array(names[b]), pa.nulls(len(a), pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=_LINKS.names)


def links(distinct: DataFrame, distance: int = DISTANCE, most: int = NODE) -> DataFrame:
    """Edges (a, b) that connect the fingerprints within the distance, directly or over others.

    Nodes of over ``most`` fingerprints go on to finer masks, round by round. The last have
    so few bits open that they can't hold as many.
    """
    level, found = masks(distance), []
    mask = F.explode(F.array(*[F.lit(_signed(m)) for m in level])).alias("mask")
    placed = distinct.select("fingerprint", mask)
    while True:
        placed = placed.withColumn("pattern", F.col("fingerprint").bitwiseAND(F.col("mask")))
        linked = (
            placed.repartition("mask", "pattern")
            .sortWithinPartitions("mask", "pattern", gray_rank(F.col("fingerprint")))
            .mapInArrow(_links(distance, most), _LINKS)
        )
        linked = written(linked, "links")
        found.append(linked.where("b is not null").select("a", "b"))
        going_on = linked.where("b is null").select(F.col("a").alias("fingerprint"), "mask")
        if going_on.isEmpty():
            return reduce(DataFrame.unionAll, found)
        below = [(_signed(m), _signed(f)) for m in level for f in finer(m, distance)]
        level = list({f for m in level for f in finer(m, distance)})
        table = distinct.sparkSession.createDataFrame(below, "mask long, finer long")
        # Different masks may have a finer one in common.
        placed = going_on.join(F.broadcast(table), "mask").select("fingerprint", F.col("finer").alias("mask")).distinct()


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", size: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    Texts are lower-cased in A to Z and cut into words; fingerprints come from all
    shingles of ``size`` words, repeats included, or from the whole sequence where it is
    shorter. Documents whose fingerprints differ in ``distance`` bits or fewer are linked;
    component_id is the smallest doc_id reachable. Null, empty and blank texts have
    fingerprint 0 and link like any other. Null ids take their component's id, which is
    null only if no member has one. Rows that repeat an id are kept; an empty table gives
    an empty table; other columns are not read.
    """
    prints = written(fingerprints(docs, id_column, text, size), "fingerprints")
    distinct = written(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "distinct")
    linked = components(links(distinct, distance)).withColumnRenamed("node", "fingerprint")
    rooted = distinct.join(linked, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(named, "root").select("fingerprint", "component_id")
    return prints.join(classes, "fingerprint").select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The documents without near duplicates: of each component, the one with the smallest id stays.

    All columns stay as they are, whatever their names. Rows that share an id are one
    document. Null, empty and blank texts are near duplicates of each other. Rows without
    an id stay only where no member of their component has one. An empty table stays empty.
    """
    found = near_duplicates(docs, id_column, text, **settings)
    kept = found.where("doc_id <=> component_id").select(F.col("doc_id").alias("_kept_id")).distinct()
    return docs.join(kept, docs[f"`{id_column}`"].eqNullSafe(kept["_kept_id"]), "left_semi")
