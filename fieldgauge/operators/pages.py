"""Audit of landed result pages."""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path


def page_chain_audit(
    df: DataFrame,
    chain: str = "chain_id",
    page: str = "page",
    next_cursor: str = "next_cursor",
    has_more: str = "has_more",
    max_pages: int | None = None,
) -> DataFrame:
    """Completeness of each chain of pages, one row per chain.

    A chain is done when its last page has no next cursor and no more results, or
    when ``max_pages`` pages were read. Pages are reduced to one row per number
    first and chains are then summarised by aggregation, so no chain has to be
    sorted, or held, in one task.
    """
    has_next = (F.coalesce(F.col(next_cursor), F.lit("")) != "") | F.coalesce(F.col(has_more), F.lit(False))
    numbered = df.groupBy(chain, page).agg(F.count("*").alias("_copies"), F.max(has_next).alias("_has_next"))
    first, last = F.min(page), F.max(page)
    count = F.count("*")
    ended = ~F.max_by("_has_next", page)
    capped = count >= max_pages if max_pages else F.lit(False)
    return numbered.groupBy(chain).agg(
        count.alias("pages"),
        first.alias("first_page"),
        last.alias("last_page"),
        (last - first + 1 - count).alias("missing_pages"),
        (F.sum("_copies") - count).alias("duplicate_pages"),
        F.min(F.when(~F.col("_has_next"), F.col(page))).alias("first_end_page"),
        ended.alias("is_ended"),
        (~ended & capped).alias("is_capped"),
        (ended | capped).alias("is_terminated"),
    )


def cursor_chain_audit(
    df: DataFrame, chain: str = "chain_id", cursor: str = "cursor", next_cursor: str = "next_cursor"
) -> DataFrame:
    """Where each landed page stands in its chain, by the cursors alone; page numbers are not needed.

    ``cursor`` is what a page was asked with, null or empty for a chain's first, and
    ``next_cursor`` what it said to ask next, null or empty at the end. One row for each
    (chain, cursor): ``copies`` landed; ``position`` counts pages from ``head``, the cursor
    of the first page that can be reached backwards, and is null on a cycle.

    ``state`` is ``cycle`` if going back never ends, ``lost`` if the head is no first page
    (a page before it has not landed), else ``reached``. ``is_fork`` marks pages that were
    named by several or whose copies name different next pages; of several the one with
    the least cursor counts. ``is_open`` marks pages whose next one has not landed.

    Pointers are doubled: in each round a page takes over the pointer of the page it points
    to, so a chain of n pages takes log2(n) rounds of one join, each written to the
    scratch folder, and no chain is sorted or held in one task.
    """
    none = F.lit("")
    pages = (
        df.select(
            F.col(chain).alias("chain"), F.coalesce(cursor, none).alias("page"), F.coalesce(next_cursor, none).alias("next")
        )
        .groupBy("chain", "page", "next")
        .agg(F.count("*").alias("copies"))
    )
    named = pages.where("next <> ''").groupBy("chain", F.col("next").alias("page"))
    before = named.agg(F.min("page").alias("before"), F.count("*").alias("named_by"))
    landed = pages.select("chain", F.col("page").alias("next")).distinct().withColumn("landed", F.lit(True))
    own = (
        pages.join(landed, ["chain", "next"], "left")
        .groupBy("chain", "page")
        .agg(
            F.sum("copies").alias("copies"),
            F.count("*").alias("nexts"),
            F.bool_or((F.col("next") != "") & F.col("landed").isNull()).alias("is_open"),
        )
    )
    # A chain's first page is one even if a page names it again.
    linked = own.join(before, ["chain", "page"], "left").withColumn("before", F.when(F.col("page") != "", F.col("before")))
    nodes = _scratch(linked, "pages")
    ranked = _positions(nodes.select("chain", "page", "before"))
    head = F.when(F.col("ended"), F.col("to"))
    return nodes.join(ranked, ["chain", "page"]).select(
        F.col("chain").alias(chain),
        F.col("page").alias(cursor),
        "copies",
        head.alias("head"),
        F.when(F.col("ended"), F.col("steps")).alias("position"),
        F.when(~F.col("ended"), "cycle").when(F.col("to") == "", "reached").otherwise("lost").alias("state"),
        ((F.col("nexts") > 1) | (F.coalesce("named_by", F.lit(0)) > 1)).alias("is_fork"),
        "is_open",
    )


def _scratch(df: DataFrame, label: str) -> DataFrame:
    path = f"{scratch_path(df.sparkSession, label)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _positions(nodes: DataFrame) -> DataFrame:
    """(chain, page, to, steps, ended): how many steps back the last reachable page is, by doubling pointers."""
    ended = F.col("before").isNull()
    at = nodes.select(
        "chain", "page", F.coalesce("before", "page").alias("to"), F.when(ended, 0).otherwise(1).cast("long").alias("steps"), ended.alias("ended")
    )
    # A page whose predecessor is a chain's end is at it; others go on.
    at = _scratch(at, "pointers")
    rounds = ceil(log2(max(2, at.count()))) + 1
    for _ in range(rounds):
        if at.where("not ended").isEmpty():
            break
        waiting = at.where("not ended")
        target = at.select(F.col("chain"), F.col("page").alias("to"), F.col("to").alias("further"), F.col("steps").alias("more"), F.col("ended").alias("over"))
        moved = waiting.join(target, ["chain", "to"]).select(
            "chain", "page", F.col("further").alias("to"), (F.col("steps") + F.col("more")).alias("steps"), F.col("over").alias("ended")
        )
        at = _scratch(at.where("ended").unionByName(moved), "pointers")
    return at
