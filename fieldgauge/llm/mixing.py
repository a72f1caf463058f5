"""Mixing sources to target weights by a low-discrepancy schedule, in SQL operations only.

The mix is a row of equal slots. The golden-ratio point of each slot, mapped through the
sources' cumulative targets, says which source fills it, so any stretch of the mix holds
the sources nearly in proportion. A source's documents are shuffled and laid end to end,
again and again; its target is cut into as many equal blocks of that row as it has slots,
at least one, and its slots, by rank, take these blocks in turn. So every source meets its
target to the word, whatever its size beside the others'.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldgauge.llm.running import running_sums
from fieldgauge.llm.tables import written
from fieldgauge.llm.words import WORD

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
REPEATS = 2
SLOTS = 1 << 20

_GOLDEN = 2654435769  # 2**32 over the golden ratio
_CELL_BITS = 12
# Where a turn's block begins in a source's row, and whose turn a word of it is; exact, as products may pass 64 bits.
_BEGIN = "(cast({} as decimal(20,0)) * cast(words as decimal(18,0)) div cast(turns as decimal(20,0)))"
_TURN_OF = "(((cast({} + 1 as decimal(20,0)) * cast(turns as decimal(18,0)) - 1) div cast(words as decimal(20,0))))"


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """(source, rank, source_size, target) for every source of (source, size).

    Sources by code point, null last, get ``weights`` in turn and divide ``share`` of all
    sizes by them. No target exceeds ``repeats`` times its source; the excess goes to the
    others by weight. In order of cap over weight the capped sources come first, so
    running sums over the sources (one row each) find them.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    totals = totals.withColumn("rank", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    totals = totals.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(repeats)))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = (
        totals.withColumn("total", F.sum("source_size").over(every) * F.lit(float(share)))
        .withColumn("below", F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("open_weight", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("total") - F.col("below")) / F.col("open_weight"))
        .withColumn("capped", F.col("cap") <= F.col("level") * F.col("weight"))
    )
    first_open = F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), F.col("rank"), F.col("level"))))
    totals = totals.withColumn("final_level", first_open.over(every)["level"])
    target = F.when(F.col("capped"), F.col("cap")).otherwise(F.col("final_level") * F.col("weight"))
    return totals.select("source", "rank", "source_size", target.alias("target"))


def schedule(targets: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(rank, slot, turn): the sources' turns in the mix, numbered within each source.

    A slot's golden-ratio point falls into the part of one source; a source whose part is
    so narrow that no point falls into it has one turn, at the slot where its part begins.
    """
    # Summed as decimals: the same in any order of the sources, so reruns have the same slots.
    all_targets = float(targets.agg(F.sum(F.col("target").cast("decimal(38,6)"))).first()[0] or 0)
    block = max(1, -int(-all_targets // slots))
    n_slots = -int(-all_targets // block)
    order = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    points = 1 << 32
    parts = targets.withColumn("until", F.round(F.sum("target").over(order) / F.lit(all_targets or 1.0) * points).cast("long"))
    parts = parts.withColumn("since", F.coalesce(F.lag("until").over(Window.orderBy("rank")), F.lit(0)))
    wide = parts.where("until > since")
    cells = F.sequence(F.shiftright("since", 32 - _CELL_BITS), F.shiftright(F.col("until") - 1, 32 - _CELL_BITS))
    slot = targets.sparkSession.range(n_slots).withColumn("point", (F.col("id") * _GOLDEN) % points)
    slot = slot.withColumn("cell", F.shiftright("point", 32 - _CELL_BITS))
    placed = slot.join(wide.withColumn("cell", F.explode(cells)), "cell").where("point >= since and point < until")
    placed = placed.select("rank", F.col("id").alias("slot"))
    own = parts.where("target > 0").select("rank", F.floor(F.col("since") / points * n_slots).alias("slot"))
    placed = placed.unionByName(own.join(placed.select("rank").distinct(), "rank", "left_anti"))
    turn = F.row_number().over(Window.partitionBy("rank").orderBy("slot")) - 1
    return placed.select("rank", "slot", turn.cast("long").alias("turn"))


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights=WEIGHTS,
    share: float = SHARE,
    slots: int = SLOTS,
) -> DataFrame:
    """(doc_id, size, source, source_size, target, taken) for every row of ``docs``.

    ``taken`` counts the words the mix takes of a document, repeats included: at most
    twice its size. A document on a block's edge may be taken in part. The order within
    a source follows a hash of the id, so reruns agree. A null text has size 0, and a
    document of size 0 has taken 0; null sources are one source, the last. Rows that
    repeat an id are mixed as documents of their own. An empty table gives an empty
    table; other columns are not read. The schedule has ``slots`` slots and a turn for each
    source at most, which bounds its table. Of a source as many words are taken as its
    target says, rounded to whole words, whatever the number of slots.
    """
    sizes = docs.select(
        F.col(f"`{id_column}`").alias("doc_id"),
        F.col(f"`{source}`").alias("source"),
        F.regexp_count(F.coalesce(F.col(f"`{text}`"), F.lit("")), F.lit(WORD)).cast("long").alias("size"),
    )
    sizes = written(sizes, "sizes")
    targets = written(source_targets(sizes, weights, share, REPEATS), "targets")
    turns = written(schedule(targets, slots), "schedule")
    counted = turns.groupBy("rank").agg(F.count("*").alias("turns"))
    targets = targets.join(counted, "rank", "left").withColumn("words", F.round("target").cast("long"))
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    keyed = sizes.join(targets, sizes["source"].eqNullSafe(targets["source"])).select(
        "doc_id", "size", sizes["source"], "rank", "source_size", "target", "words", "turns", digest.alias("digest")
    )
    keyed = keyed.withColumn("bucket", F.substring("digest", 1, 3))
    laid = running_sums(keyed, ["rank"], "bucket", ["digest", "size"], {"until": "size"})
    out = ["doc_id", "size", "source", "source_size", "target"]
    laid = written(laid.select(*out, "rank", "until", "words", "turns"), "laid")
    # A document's place in each repetition of its source's row, as far as the mix takes it.
    passes = F.explode(F.sequence(F.lit(0), F.lit(REPEATS - 1))).alias("pass")
    places = laid.where("size > 0").select("*", passes).withColumn("shift", F.col("pass") * F.col("source_size"))
    places = places.withColumn("first", F.col("until") - F.col("size") + F.col("shift"))
    places = places.withColumn("last", F.least(F.col("until") + F.col("shift"), "words"))
    pieces = places.where("first < last").withColumn(
        "turn", F.explode(F.sequence(F.expr(_TURN_OF.format("first")), F.expr(_TURN_OF.format("last - 1"))))
    )
    overlap = F.expr(f"least(last, {_BEGIN.format('turn + 1')}) - greatest(first, {_BEGIN.format('turn')})")
    # Added up as whole numbers, so the order of rows does not matter.
    taken = (
        pieces.withColumn("overlap", overlap)
        .join(turns.select("rank", "turn"), ["rank", "turn"])
        .groupBy(*out, "rank", "until")
        .agg(F.sum("overlap").alias("taken"))
        .select(*out, "rank", "until", "taken")
    )
    kept = ["rank", "until", "size"]
    same = F.col("l.doc_id").eqNullSafe(F.col("t.doc_id"))
    for name in kept:
        same = same & (F.col(f"l.{name}") == F.col(f"t.{name}"))
    joined = laid.alias("l").join(taken.alias("t"), same, "left")
    return joined.select(*[F.col(f"l.{c}").alias(c) for c in out], F.coalesce("t.taken", F.lit(0)).alias("taken"))


def mixed(docs: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source", **settings) -> DataFrame:
    """The documents with all their columns, and size, source_size, target and taken of ``mix``.

    Columns of those names are replaced. Rows equal in id, source and size are alike in
    what is taken of them together; each gets its share, rounded down, and the first ones
    the rest.
    """
    parts = ["size", "source_size", "target", "taken"]
    names = [c for c in docs.columns if c not in parts]
    inner = {c: f"c{i}" for i, c in enumerate(names)}
    found = mix(docs, id_column, text, source, **settings).groupBy("doc_id", "source", "size", "source_size", "target")
    found = found.agg(F.sum("taken").alias("together"), F.count("*").alias("rows")).alias("f")
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    keyed = docs.select(
        *[F.col(f"`{c}`").alias(inner[c]) for c in names],
        F.regexp_count(content, F.lit(WORD)).cast("long").alias("size"),
        F.sha2(content, 256).alias("content"),
    ).alias("d")
    doc, of = F.col(f"d.{inner[id_column]}"), F.col(f"d.{inner[source]}")
    same = doc.eqNullSafe(F.col("f.doc_id")) & of.eqNullSafe(F.col("f.source")) & (F.col("d.size") == F.col("f.size"))
    # Rows equal in their text as well are alike, so whichever comes first changes nothing.
    number = F.row_number().over(Window.partitionBy(doc, of, F.col("d.size")).orderBy("d.content"))
    share = F.floor(F.col("f.together") / F.col("f.rows"))
    taken = share + F.when(number <= F.col("f.together") - share * F.col("f.rows"), 1).otherwise(0)
    joined = keyed.join(found, same).select(
        *[F.col(f"d.{inner[c]}").alias(c) for c in names], F.col("d.size").alias("size"), "f.source_size", "f.target",
        taken.cast("long").alias("taken"),
    )
    return joined
