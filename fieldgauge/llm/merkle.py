"""Document fingerprints as Merkle trees over sections, paragraphs and pieces, in SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIECE = 32  # code points of a leaf
SECTION = 8  # paragraphs of a section
_LAST = 2**63 - 1


def paragraphs(text: Column, piece: int = PIECE) -> Column:
    """The leaves of each paragraph (line): MD5 digests of its pieces of ``piece`` code points."""
    pieces = F.lit(f"(?s).{{1,{piece}}}")
    return F.transform(
        F.split(text, "\n"),
        lambda line: F.transform(F.regexp_extract_all(line, pieces, F.lit(0)), lambda p: F.md5(p)),
    )


def paragraph_nodes(leaves: Column) -> Column:
    return F.transform(leaves, lambda part: F.sha2(F.concat_ws(",", part), 256))


def section_nodes(nodes: Column, size: int = SECTION) -> Column:
    sections = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / size).cast("int"))
    return F.transform(sections, lambda i: F.sha2(F.concat_ws(",", F.slice(nodes, i * size + 1, F.lit(size))), 256))


def root(sections: Column) -> Column:
    return F.sha2(F.concat_ws(",", sections), 256)


def with_tree(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds the levels of the tree of a text column: <name>_leaves (by paragraph), _paragraphs, _sections, _root.

    Null counts as the empty text, which has one paragraph without leaves. Equal texts
    have equal roots.
    """
    df = df.withColumn(f"{name}_leaves", paragraphs(F.coalesce(F.col(f"`{text}`"), F.lit(""))))
    df = df.withColumn(f"{name}_paragraphs", paragraph_nodes(F.col(f"{name}_leaves")))
    df = df.withColumn(f"{name}_sections", section_nodes(F.col(f"{name}_paragraphs")))
    return df.withColumn(f"{name}_root", root(F.col(f"{name}_sections")))


def differing(one: Column, two: Column) -> Column:
    """Positions, from 0, at which two levels of trees differ; where one is longer, its rest differs."""
    both = F.greatest(F.size(one), F.size(two))
    positions = F.when(both > 0, F.sequence(F.lit(0), both - 1)).otherwise(F.array().cast("array<int>"))
    return F.filter(positions, lambda i: ~F.get(one, i).eqNullSafe(F.get(two, i)))


def edits(df: DataFrame, one: str, two: str) -> DataFrame:
    """Adds what differs between trees ``one`` and ``two``: sections, and paragraphs inside those sections."""
    df = df.withColumn("differing_sections", differing(F.col(f"{one}_sections"), F.col(f"{two}_sections")))
    inside = F.filter(
        differing(F.col(f"{one}_paragraphs"), F.col(f"{two}_paragraphs")),
        lambda i: F.array_contains("differing_sections", F.floor(i / SECTION).cast("int")),
    )
    return df.withColumn("differing_paragraphs", inside)


def likeness(one: Column, two: Column) -> Column:
    """Share of equal leaves of two trees, from 0 to 1, counting each distinct leaf once; 1 without leaves."""
    one, two = F.array_distinct(F.flatten(one)), F.array_distinct(F.flatten(two))
    size = F.size(one) + F.size(two)
    return F.when(size == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(one, two)) * 2.0 / size)


def with_next(docs: DataFrame, id_column: str, text: str, buckets: int | None = None) -> DataFrame:
    """(id, text, next_text) by ascending id, after the last the first; null texts are empty, null ids last.

    Ranges of ids, cut at approximate quantiles, are sorted one by one; the last document
    of a range finds the first of the next in a join of two small tables.
    """
    spark = docs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    plain = docs.select(
        F.col(f"`{id_column}`").alias("id"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
        F.coalesce(F.col(f"`{id_column}`").cast("long"), F.lit(_LAST)).alias("key"),
    )
    shares = [i / buckets for i in range(1, buckets)] or [0.5]
    cuts = plain.agg(F.percentile_approx("key", shares, max(10_000, 10 * buckets)).alias("cuts")).first()["cuts"] or []
    cut_at = F.array(*[F.lit(c) for c in sorted(set(cuts))]).cast("array<long>")
    placed = plain.withColumn("bucket", F.size(F.filter(cut_at, lambda c: c < F.col("key"))))
    order = Window.partitionBy("bucket").orderBy("key", F.xxhash64("text"))
    placed = placed.withColumn("next_text", F.lead("text").over(order)).withColumn("at", F.row_number().over(order))
    inner = placed.where("next_text is not null").select("id", "text", "next_text")
    firsts = placed.where("at = 1").select("bucket", F.col("text").alias("first_text"))
    by_bucket = Window.orderBy("bucket")
    links = placed.where("at = 1").select("bucket").withColumn(
        "after", F.coalesce(F.lead("bucket").over(by_bucket), F.min("bucket").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    )
    lasts = placed.where("next_text is null").select("id", "text", "bucket").join(links, "bucket")
    closing = lasts.join(firsts.withColumnRenamed("bucket", "after"), "after").select("id", "text", F.col("first_text").alias("next_text"))
    return inner.unionByName(closing)


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text, of an edited text, and how alike they are to each other and the next one's.

    The edited text has its last half, floor(n_chars / 2) code points, replaced by as many
    from the start of the next document (or all it has) by ascending id; the last one's
    next is the first. Returns (doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next). Null texts count as empty, null ids come
    last; rows that repeat an id follow each other by a hash of their texts; one document
    alone is its own next; an empty table gives an empty table; other columns are not read.
    """
    near = with_next(docs, id_column, text).withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    near = near.withColumn(
        "edited",
        F.concat(
            F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next_text", F.lit(1), half)
        ),
    )
    near = near.select(
        "id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        paragraphs(F.col("text")).alias("own_leaves"),
        paragraphs(F.col("edited")).alias("edited_leaves"),
        paragraphs(F.col("next_text")).alias("next_leaves"),
    )
    return near.select(
        F.col("id").alias("doc_id"),
        "n_chars",
        "edited_sha256",
        root(section_nodes(paragraph_nodes(F.col("own_leaves")))).alias("fingerprint"),
        root(section_nodes(paragraph_nodes(F.col("edited_leaves")))).alias("edited_fingerprint"),
        likeness(F.col("own_leaves"), F.col("edited_leaves")).alias("near_edited"),
        likeness(F.col("own_leaves"), F.col("next_leaves")).alias("near_next"),
    )
