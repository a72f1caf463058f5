"""Main text of web pages by differencing pages with near URLs.

Pages are sorted by host and path over the cluster, so that each stands next to the
pages of its host with the nearest paths, however many pages a host has. Its lines are
aligned with those of the page before and the page after by longest common subsequence;
lines they share are the site's, not the page's, and are deleted.

Differencing alone can't give right results where furniture is unlike from page to page
(menus that name the article's topics) or where a site carries two copies of an article.
So every page is differenced and its own marks have the last word on single lines: marked
furniture goes, also if no neighbour has it, and lines of an article or main element stay,
also if a neighbour has them. Lines with neither mark go if a neighbour shares them that
is no copy of the page, and stay otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator
from bisect import bisect_left
from functools import lru_cache
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldgauge.llm.html_blocks import Block, blocks

COPY = 0.5  # pages that share more of their text are copies, and their sharing says nothing

_OFTEN = 16


def shared_lines(one: list[str], two: list[str]) -> set[int]:
    """Indexes in ``one`` of a longest common subsequence with ``two``.

    Works on positions of equal lines, in time of matches times the logarithm of the
    length; texts whose lines occur so often that these are many go to ``_dense_lines``.
    """
    places: dict[str, list[int]] = {}
    for j, line in enumerate(two):
        places.setdefault(line, []).append(j)
    if sum(len(places.get(line, ())) for line in one) > _OFTEN * len(one):
        return _dense_lines(one, two)
    ends: list[int] = []  # least end of a common subsequence of each length
    nodes: list[tuple[int, tuple | None]] = []
    for i, line in enumerate(one):
        for j in reversed(places.get(line, ())):
            k = bisect_left(ends, j)
            node = (i, nodes[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                nodes.append(node)
            else:
                ends[k], nodes[k] = j, node
    kept: set[int] = set()
    node = nodes[-1] if nodes else None
    while node:
        kept.add(node[0])
        node = node[1]
    return kept


def _dense_lines(one: list[str], two: list[str]) -> set[int]:
    """``shared_lines`` by bit vectors: a row of the table of lengths is one integer, whatever the matches.

    Bit j of row i is 0 where the length grows from the first j lines of ``two`` to the
    first j + 1. Equal starts and ends, and lines that one side lacks, need no row. One row
    in ``step`` is held, and the rows between two of them while the way back passes them.
    """
    start, size = 0, min(len(one), len(two))
    while start < size and one[start] == two[start]:
        start += 1
    end = 0
    while end < size - start and one[-1 - end] == two[-1 - end]:
        end += 1
    kept = {*range(start), *range(len(one) - end, len(one))}
    both = {*one[start : len(one) - end]} & {*two[start : len(two) - end]}
    rows = [i for i in range(start, len(one) - end) if one[i] in both]
    columns = [line for line in two[start : len(two) - end] if line in both]
    places: dict[str, list[int]] = {}
    for j, line in enumerate(columns):
        places.setdefault(line, []).append(j)
    full = (1 << len(columns)) - 1

    @lru_cache(maxsize=256)  # not one for each line: their number times that of the columns may be large
    def found(line: str) -> int:
        bits = bytearray(len(columns) // 8 + 1)
        for j in places[line]:
            bits[j >> 3] |= 1 << (j & 7)
        return int.from_bytes(bits, "little")

    def after(row: int, i: int) -> int:
        grown = row & found(one[rows[i]])
        return ((row + grown) | (row - grown)) & full

    step = isqrt(len(rows)) + 1
    held, row = [], full
    for i in range(len(rows)):
        if i % step == 0:
            held.append(row)
        row = after(row, i)
    j = len(columns)
    for first in range((len(held) - 1) * step, -1, -step):
        table = [held[first // step]]
        for i in range(first, min(first + step, len(rows))):
            table.append(after(table[-1], i))
        for i in range(first + len(table) - 2, first - 1, -1):
            upto = (1 << j) - 1
            j = (~table[i + 1 - first] & upto).bit_length()  # the last line of two that adds to the length
            if not j:
                return kept
            if table[i - first] >> (j - 1) & 1:  # without this line of one it would not
                kept.add(rows[i])
                j -= 1
    return kept


def _is_copy(lines: list[str], shared: list[str]) -> bool:
    """Whether more than ``COPY`` of the text is shared, and more than that of its long lines.

    Menus are many short lines and stories few long ones, so squares tell pages with short
    stories under one long menu from copies of one story.
    """
    return all(sum(len(s) ** n for s in shared) > COPY * sum(len(line) ** n for line in lines) for n in (1, 2))


def main_text(page: list[Block], neighbours: list[list[Block]]) -> str:
    """The page's main text, given its blocks and those of the pages next to it."""
    lines = [b for b in page if not b.furniture]
    own = [b.text for b in lines]
    inside = [i for i, b in enumerate(lines) if b.content]
    gone: set[int] = set()
    for other in neighbours:
        shared = shared_lines(own, [b.text for b in other if not b.furniture])
        # A copy has most of the page, and most of its article if it has one.
        for part in filter(None, (inside, range(len(own)))):
            if not _is_copy([own[i] for i in part], [own[i] for i in part if i in shared]):
                gone |= shared
    gone.difference_update(inside)
    return "\n".join(line for i, line in enumerate(own) if i not in gone)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages come sorted by host and path; three are held at a time, besides the batches.

    Pages in a row with the same unmarked lines say nothing of each other and have one
    text, by the pages before and after all of them; only their ids and URLs wait for it.
    """
    before, waiting, rows, found, columns = None, None, 0, [], None

    def done(after) -> None:
        near = [page for host, page in filter(None, (before, after)) if host == waiting[0]]
        found.extend([main_text(waiting[1], near)] * rows)

    for batch in batches:
        hosts, pages = batch.column("host").to_pylist(), batch.column("html")
        for i, host in enumerate(hosts):
            now = (host, [b for b in blocks(pages[i].as_py() or "") if not b.furniture])
            if now == waiting:
                rows += 1
                continue
            if waiting:
                done(now)
            before, waiting, rows = waiting, now, 1
        # The last pages wait for their successor.
        ready = pa.concat_tables([columns, pa.table(batch.select(["page_id", "url"]))]) if columns else pa.table(batch.select(["page_id", "url"]))
        columns = ready.slice(len(found))
        yield from _with_text(ready.slice(0, len(found)), found)
        found = []
    if waiting:
        done(None)
        yield from _with_text(columns, found)


def _with_text(columns: pa.Table, text: list[str]) -> Iterator[pa.RecordBatch]:
    """In batches no longer than those read, as equal pages in a row may be more than these."""
    at = 0
    for batch in columns.to_batches():
        yield batch.append_column("text", pa.array(text[at : at + len(batch)], pa.string()))
        at += len(batch)


def extract_text(pages: DataFrame, id_column: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for every row: the main text, its blocks joined by a line feed.

    Character references are decoded, white space inside a block is one space, and text
    has ``n_chars`` code points. Null and empty pages have an empty text. A page without
    neighbours on its host is judged by its own marks. Repeated rows are pages of their
    own and have the same text, by the pages around them. Null ids and URLs are kept;
    other columns are not read. An empty table gives an empty table.
    """
    near = pages.select(
        F.col(f"`{id_column}`").alias("page_id"),
        F.col(f"`{url}`").alias("url"),
        F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("html"),
    )
    pattern = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://)?(?:www\.)?([^/?#]*)([^?#]*)"
    address = F.coalesce(F.trim("url"), F.lit(""))
    near = near.withColumn("host", F.lower(F.regexp_extract(address, pattern, 1)))
    near = near.withColumn("path", F.rtrim(F.regexp_extract(address, pattern, 2), F.lit("/")))
    order = ["host", "path", "url", "page_id"]
    out = T.StructType([near.schema["page_id"], near.schema["url"], T.StructField("text", T.StringType())])
    text = near.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_extract, out)
    return text.withColumn("n_chars", F.char_length("text").cast("long"))
