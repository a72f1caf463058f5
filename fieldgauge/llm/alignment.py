"""Aligning the tokens of two tokenizers by external spill counting.

A task encodes its texts with both tokenizers and finds where a token of either ends at
the same byte; the two tokens that end there are linked. Of each chunk of texts, the
records (pair, document, links) are sorted side-major, by the second side's token and then
the first's, partitioned by the last bits of the second side's id, and written to the
shared folder as runs compressed by zstd. Spark sends the runs' pairs to their partitions,
where a heap merges them k at a time and counts each pair; as all pairs of one second-side
token follow each other, its highest count is known when they end. Then the runs' records
meet their partition's counts, in groups of chunks so that no partition is one task, and
what each pair contributes streams back to the documents of its chunk.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldgauge.llm.grouped import group_starts, whole_groups
from fieldgauge.llm.tables import written
from fieldgauge.llm.token_counts import PATTERN
from fieldgauge.llm.words import chunks

FIRST_SIDE = "/opt/tokenizers/byte_bpe_50k.json"
SECOND_SIDE = "/opt/tokenizers/piece_bpe_32k.model"

PARTITIONS = 64  # by the last bits of the second side's ids
FAN_IN = 256  # runs merged at a time
TOGETHER = 32  # chunks whose runs meet the counts of a partition in one group

_SIDE_BITS, _DOC_BITS = 17, 20  # room for an id of either side, and for a document in its chunk
_LOW = PARTITIONS.bit_length() - 1
_CHUNK_BYTES = 4 << 20
_GROUP_BYTES = 32 << 20

_ENCODED = T.StructType(
    [T.StructField("chunk", T.LongType()), T.StructField("part", T.IntegerType()), T.StructField("place", T.IntegerType())]
    + [T.StructField(c, T.LongType()) for c in ("doc_id", "n_a", "n_b", "n_links")]
    + [T.StructField("groups_sha256", T.StringType()), T.StructField("pairs", T.BinaryType()), T.StructField("docs", T.BinaryType())]
)
_RUNS = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("part", T.IntegerType()), T.StructField("pairs", T.BinaryType())])
_SUMS = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("pairs", T.BinaryType())])
_SHARES = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("best", T.BinaryType()), T.StructField("total", T.BinaryType())])
_PER_DOC = T.StructType(
    [T.StructField("chunk", T.LongType()), T.StructField("place", T.IntegerType())]
    + [T.StructField(c, T.LongType()) for c in ("n_best", "count_sum")]
)


def _byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others as characters from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class FirstSide:
    """A byte-level BPE vocabulary file; its special tokens' strings are ordinary text."""

    def __init__(self, path: str, pattern: str = PATTERN):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        special = {t["content"] for t in described["added_tokens"]}
        byte = _byte_of_character()
        ranks = {bytes(byte[c] for c in t): i for t, i in described["model"]["vocab"].items() if t not in special}
        self.encoding = tiktoken.Encoding("first", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self.lengths[i] = len(token)

    def encode(self, text: str) -> tuple[np.ndarray, bytes]:
        ids = self.encoding.encode_to_numpy(text, disallowed_special=())
        return ids.astype(np.int64), self.encoding.decode_bytes(ids.tolist())


class SecondSide:
    """A sentence-piece model, which puts a space before the text itself."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(self.model.get_piece_size())
        self.pieces = [self._bytes(self.model.id_to_piece(i), self.model.is_byte(i)) for i in ids]
        self.lengths = np.array([len(p) for p in self.pieces])

    @staticmethod
    def _bytes(piece: str, is_byte: bool) -> bytes:
        return bytes([int(piece[3:5], 16)]) if is_byte else piece.replace("▁", " ").encode()

    def encode(self, text: str) -> tuple[np.ndarray, bytes]:
        ids = self.model.encode(text, num_threads=1)
        return np.array(ids, np.int64), b"".join(map(self.pieces.__getitem__, ids))


@lru_cache(maxsize=2)
def _sides(first: str, second: str) -> tuple[FirstSide, SecondSide]:
    return FirstSide(first), SecondSide(second)


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers, each in the least width that holds it, as a zstd frame."""
    parts = []
    for column in columns:
        column = column.astype(np.min_scalar_type(int(column.max()) if len(column) else 0))
        parts += [np.array([column.itemsize, len(column)], np.int64).tobytes(), column.tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def _unpacked(frame: bytes) -> list[np.ndarray]:
    data, at, columns = zstandard.ZstdDecompressor().decompress(frame), 0, []
    while at < len(data):
        width, many = np.frombuffer(data, np.int64, 2, at).tolist()
        columns.append(np.frombuffer(data, f"u{width}", many, at + 16).astype(np.int64))
        at += 16 + width * many
    return columns


def _side_major(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A pair as one number: the second side's partition, the rest of its id, then the first side's id."""
    rest = b >> _LOW
    return ((b & (PARTITIONS - 1)) << (_SIDE_BITS - _LOW) | rest) << _SIDE_BITS | a


class _Decimals:
    """Numbers below a limit as digits, for writing many at once."""

    def __init__(self, limit: int):
        text = [str(i).encode() for i in range(limit)]
        self.lengths = np.array([len(t) for t in text])
        width = int(self.lengths.max())
        self.digits = np.frombuffer(b"".join(t.ljust(width) for t in text), np.uint8).reshape(limit, width)

    def joined(self, numbers: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all numbers, each followed by its separator, and where each ends."""
        lengths = self.lengths[numbers]
        ends = np.cumsum(lengths + 1)
        found = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
        begins = ends - lengths - 1
        for place in range(self.digits.shape[1]):
            longer = np.flatnonzero(lengths > place)
            found[begins[longer] + place] = self.digits[numbers[longer], place]
        found[ends - 1] = separators
        return found, ends


@lru_cache(maxsize=2)
def _decimals(limit: int) -> _Decimals:
    return _Decimals(limit)


def _written_groups(a, b, ends_a, ends_b, shared, limit) -> tuple[np.ndarray, np.ndarray]:
    """The groups of a chunk as bytes, and where each group's last separator stands."""
    group_a, group_b = np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b)
    upto_a, upto_b = np.searchsorted(ends_a, shared, side="right"), np.searchsorted(ends_b, shared, side="right")
    at_a = np.arange(len(a)) + np.append(0, upto_b)[group_a]
    at_b = np.arange(len(b)) + upto_a[group_b]
    numbers, separators = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
    numbers[at_a], numbers[at_b] = a, b
    separators[at_a[upto_a - 1]] = ord("|")
    separators[at_b[upto_b - 1]] = ord(";")
    text, ends = _decimals(limit).joined(numbers, separators)
    return text, ends[at_b[upto_b - 1]]


def _align(batch: pa.RecordBatch, chunk: int, first: FirstSide, second: SecondSide) -> Iterator[pa.RecordBatch]:
    """A row for each document of a chunk, and one for each run."""
    n = batch.num_rows
    tokens, sizes = ([], []), np.zeros((2, n), np.int64)
    for place, text in enumerate(batch.column("text").to_pylist()):
        if text:
            whole = (" " + text).encode()
            found = first.encode(" " + text), second.encode(text)
            if all(joined == whole for _, joined in found):
                for side, (ids, _) in enumerate(found):
                    tokens[side].append(ids)
                    sizes[side, place] = len(ids)
    a, b = (np.concatenate(ids) if ids else np.zeros(0, np.int64) for ids in tokens)
    # Both sides spell the same bytes, so places can be counted through the whole chunk.
    ends_a, ends_b = np.cumsum(first.lengths[a]), np.cumsum(second.lengths[b])
    shared, at_a, at_b = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
    doc = np.repeat(np.arange(n), sizes[0])[at_a]
    links = np.bincount(doc, minlength=n)

    digests = [""] * n
    if len(shared):
        text, group_ends = _written_groups(a, b, ends_a, ends_b, shared, max(len(first.lengths), len(second.lengths)))
        upto = np.cumsum(links)
        data = text.tobytes()
        for place in np.flatnonzero(links).tolist():
            begin = int(group_ends[upto[place] - links[place] - 1]) if upto[place] > links[place] else 0
            digests[place] = hashlib.sha256(data[begin : int(group_ends[upto[place] - 1]) - 1]).hexdigest()

    def rows(many: int, **given) -> pa.RecordBatch:
        types = {"chunk": pa.int64(), "part": pa.int32(), "place": pa.int32(), "groups_sha256": pa.string()}
        types |= {"pairs": pa.binary(), "docs": pa.binary()}
        columns = [pa.array(given[c], types.get(c, pa.int64())) if c in given else pa.nulls(many, types.get(c, pa.int64())) for c in _ENCODED.names]
        return pa.RecordBatch.from_arrays(columns, names=_ENCODED.names)

    yield rows(
        n, chunk=np.full(n, chunk), place=np.arange(n), doc_id=batch.column("doc_id"), n_a=sizes[0], n_b=sizes[1],
        n_links=links, groups_sha256=digests,
    )
    records, times = np.unique(_side_major(a[at_a], b[at_b]) << _DOC_BITS | doc, return_counts=True)
    if not len(records):
        return
    pair = records >> _DOC_BITS
    part = pair >> (2 * _SIDE_BITS - _LOW)
    cuts = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(part))
    runs = [_run(pair[x:y], records[x:y] & ((1 << _DOC_BITS) - 1), times[x:y]) for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
    pairs, docs = zip(*runs, strict=True)
    yield rows(len(runs), chunk=np.full(len(runs), chunk), part=part[cuts[:-1]], pairs=list(pairs), docs=list(docs))


def _run(pair: np.ndarray, doc: np.ndarray, times: np.ndarray) -> tuple[bytes, bytes]:
    """A sorted run: its pairs with their links and documents, and the records' documents and links."""
    new = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
    many = np.diff(np.append(new, len(pair)))
    pairs = np.diff(pair[new], prepend=0)
    return _packed(pairs, np.add.reduceat(times, new), many), _packed(doc, times)


def _encoding(first: str, second: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = _sides(first, second)
        chunk = TaskContext.get().partitionId() << 32
        for whole in batches:
            for batch in chunks(whole, "text", _CHUNK_BYTES):
                yield from _align(batch, chunk, *sides)
                chunk += 1

    return run


def _merged(frames: list[bytes]) -> Iterator[tuple[int, int]]:
    """(pair, links) of sorted runs, by a heap of their heads; each pair once."""
    heads = []
    for frame in frames:
        pairs, links, *_ = _unpacked(frame)
        heads.append(zip(np.cumsum(pairs).tolist(), links.tolist(), strict=True))
    last, total = -1, 0
    for pair, links in heapq.merge(*heads):
        if pair != last:
            if last >= 0:
                yield last, total
            last, total = pair, 0
        total += links
    if last >= 0:
        yield last, total


def _by_group(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    for rows in whole_groups(batches, keys, _GROUP_BYTES):
        starts = group_starts(rows, keys)
        for begin, end in zip(starts.tolist(), [*starts[1:].tolist(), rows.num_rows], strict=True):
            yield rows.slice(begin, end - begin)


def _merge_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs of a group of chunks as one run."""
    for rows in _by_group(batches, ["part", "chunk"]):
        merged = np.array(list(_merged(rows.column("pairs").to_pylist())), np.int64)
        run = {"chunk": rows["chunk"][0].as_py(), "part": rows["part"][0].as_py()}
        run["pairs"] = _packed(np.diff(merged[:, 0], prepend=0), merged[:, 1])
        yield pa.RecordBatch.from_pylist([run], schema=_arrow(_RUNS))


def _sum_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts of a partition's pairs, and whether each is its second-side token's highest."""
    for rows in _by_group(batches, ["part"]):
        merged = np.array(list(_merged(rows.column("pairs").to_pylist())), np.int64)
        pairs, counts = merged[:, 0], merged[:, 1]
        token = pairs >> _SIDE_BITS
        new = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
        highest = np.repeat(np.maximum.reduceat(counts, new), np.diff(np.append(new, len(token))))
        sums = _packed(np.diff(pairs, prepend=0), counts, counts == highest)
        yield pa.RecordBatch.from_pylist([{"part": rows["part"][0].as_py(), "pairs": sums}], schema=_arrow(_SUMS))


def _arrow(schema: T.StructType) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(f.name, kinds[f.dataType.simpleString()]) for f in schema.fields])


def _contribute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each run's pairs give its documents; a group's counts come before its runs, which have records."""
    known = counts = best = None
    for batch in batches:
        found = []
        for chunk, pairs, docs in zip(*(batch.column(c).to_pylist() for c in ("chunk", "pairs", "docs")), strict=True):
            if docs is None:
                known, counts, best = _unpacked(pairs)
                known = np.cumsum(known)
                continue
            pairs, _, many = _unpacked(pairs)
            doc, times = _unpacked(docs)
            at = np.repeat(np.searchsorted(known, np.cumsum(pairs)), many)
            sums = np.zeros((2, int(doc.max()) + 1), np.int64)
            np.add.at(sums[0], doc, times * best[at])
            np.add.at(sums[1], doc, times * counts[at])
            found.append({"chunk": chunk, "best": sums[0].tobytes(), "total": sums[1].tobytes()})
        if found:
            yield pa.RecordBatch.from_pylist(found, schema=_arrow(_SHARES))


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of each chunk's documents over all their runs."""
    for rows in _by_group(batches, ["chunk"]):
        sums = []
        for column in ("best", "total"):
            parts = [np.frombuffer(x, np.int64) for x in rows.column(column).to_pylist()]
            whole = np.zeros(max(map(len, parts)), np.int64)
            for part in parts:
                whole[: len(part)] += part
            sums.append(pa.array(whole))
        places = np.arange(len(sums[0]), dtype=np.int32)
        chunk = pa.array(repeat(rows["chunk"][0].as_py(), len(places)), pa.int64())
        yield pa.RecordBatch.from_arrays([chunk, pa.array(places), *sums], names=_PER_DOC.names)


def _pair_sums(runs: DataFrame, many: int, fan_in: int) -> DataFrame:
    """(part, pairs): the counts of each partition, merged from at most ``fan_in`` runs at a time."""
    while many > fan_in:
        many = -(-many // fan_in)
        group = F.pmod(F.xxhash64("chunk"), F.lit(many)).alias("chunk")
        grouped = runs.select(group, "part", "pairs").repartition("part", "chunk").sortWithinPartitions("part", "chunk")
        runs = written(grouped.mapInArrow(_merge_runs, _RUNS), "runs")
    together = runs.select("part", "pairs").repartition("part").sortWithinPartitions("part")
    return written(together.mapInArrow(_sum_runs, _SUMS), "sums")


def align(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    first: str = FIRST_SIDE,
    second: str = SECOND_SIDE,
    fan_in: int = FAN_IN,
    together: int = TOGETHER,
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row of ``docs``.

    ``n_a`` and ``n_b`` count the tokens of both vocabularies, files that every executor can
    read. Texts are cut into groups wherever tokens of both end at the same byte; there the two
    that end are linked. ``n_best`` counts the links of pairs that occur as often as any of
    their second-side token, ties included, and ``count_sum`` adds the counts of all links'
    pairs. ``groups_sha256`` is the digest of the groups, written as ids. Texts that are
    null, empty or not spelt alike by both sides have no tokens: zeros and an empty digest.
    Repeated rows count each time; null ids stay null; an empty table gives an empty table;
    other columns are not read.
    """
    plain = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    encoded = written(plain.mapInArrow(_encoding(first, second), _ENCODED), "encoded")
    runs = encoded.where("part is not null")
    many = runs.select("chunk").distinct().count()
    sums = _pair_sums(runs, many, fan_in)
    groups = max(1, -(-many // together))
    salted = runs.select("part", F.pmod(F.xxhash64("chunk"), F.lit(groups)).alias("salt"), "chunk", "pairs", "docs")
    salts = F.explode(F.sequence(*(F.lit(n).cast("long") for n in (0, groups - 1)))).alias("salt")
    spread = sums.select("part", "pairs", salts).select(
        "part", "salt", F.lit(None).cast("long").alias("chunk"), "pairs", F.lit(None).cast("binary").alias("docs")
    )
    met = salted.unionByName(spread).repartition("part", "salt").sortWithinPartitions("part", "salt", F.asc_nulls_first("chunk"))
    shares = met.mapInArrow(_contribute, _SHARES).repartition("chunk").sortWithinPartitions("chunk")
    per_doc = shares.mapInArrow(_gather, _PER_DOC)
    found = encoded.where("part is null").join(per_doc, ["chunk", "place"], "left")
    return found.select(
        "doc_id",
        "n_a",
        "n_b",
        F.col("n_links").alias("n_groups"),
        "n_links",
        F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"),
        "groups_sha256",
    )
