"""Licence scans: a trained paragraph classifier, with templates confirming what it predicts.

Paragraphs become sparse counts of word n-grams; logistic regression gives each licence
family a probability, and "unknown" is a class of its own. It learns from templates of
the families, cut and shortened in many ways, and from paragraphs of the corpus that no
template resembles. A prediction counts as confirmed if a template of the family, too,
shares enough of its word pairs with the paragraph.
"""

from __future__ import annotations

import re

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldgauge.llm.tables import written

UNKNOWN = "unknown"
SAMPLE = 2_000
BUCKETS = 1 << 14
CONFIRMED = 0.5
RESEMBLES = 0.3

# Notices by which licences are named in texts.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT license. See the LICENSE file for details."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "Distributed under the terms of the Apache License, Version 2.0."),
    ("GPL", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("GPL", "Released under the GPL version 2 or later."),
    ("LGPL", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    ("AGPL", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD", "Licensed under the BSD 3-Clause License."),
    ("MPL", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL", "Licensed under the Mozilla Public License, version 2.0."),
    ("CC-BY", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY", "Licensed under CC BY 4.0."),
    ("CC-BY-SA", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC", "Licensed under CC BY-NC 4.0."),
    ("CC0", "Dedicated to the public domain under the CC0 1.0 Universal dedication."),
    ("CC0", "Released under CC0 1.0 Universal."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("Proprietary", "Copyright. All rights reserved. No part of this work may be reproduced without written permission."),
)
# Words of licences: a paragraph that holds one is reported even if it is unknown.
ANCHORS = r"(?i)licen[cs]e|copyright|permission|permitted|public domain|\bgpl\b|\bcc0\b"


def words(text: Column) -> Column:
    """Words in lower case, numbers as they are, without punctuation."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _followed(starts: str, size: int) -> Column:
    """n-grams of ``size`` words, from those of one word less and the words."""
    but_last = F.slice(starts, F.lit(1), F.greatest(F.size(starts) - 1, F.lit(0)))
    later = F.slice("tokens", F.lit(size), F.greatest(F.size("tokens") - size + 1, F.lit(0)))
    return F.zip_with(but_last, later, lambda start, word: F.concat_ws(" ", start, word))


def with_grams(rows: DataFrame) -> DataFrame:
    """Adds word pairs, and grams: words, pairs and triples, all with repeats."""
    rows = rows.withColumn("pairs", _followed("tokens", 2))
    return rows.withColumn("grams", F.concat("tokens", "pairs", _followed("pairs", 3)))


def _literal_words(text: str) -> list[str]:
    """``words`` of a template, on the driver."""
    return re.findall(r"[^\W_]+", text.lower())


def _literal_pairs(text: str) -> Column:
    tokens = _literal_words(text)
    pairs = dict.fromkeys(f"{a} {b}" for a, b in zip(tokens, tokens[1:], strict=False))
    return F.array(*[F.lit(p) for p in pairs]).cast("array<string>")


def template_table(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """(family, tokens) of the templates."""
    rows = F.array(
        *[
            F.struct(F.lit(f).alias("family"), F.array(*[F.lit(w) for w in _literal_words(t)]).alias("tokens"))
            for f, t in templates
        ]
    )
    return spark.range(1).select(F.inline(rows))


def _similarity(pairs: Column, template: Column) -> Column:
    """Share of the template's word pairs that the paragraph has."""
    return F.size(F.array_intersect(pairs, template)) / F.greatest(F.size(template), F.lit(1))


def paragraphs(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """(doc_id, paragraph, text, tokens) of all paragraphs (lines) that hold a word."""
    lines = F.split(F.col(f"`{text}`"), "\n")
    found = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.posexplode(lines).alias("paragraph", "text"))
    return found.where(F.col("text").rlike(r"[\p{L}\p{N}]")).withColumn("tokens", words(F.col("text")))


def training_rows(docs: DataFrame, text: str = "text", templates=TEMPLATES, sample: int = SAMPLE) -> DataFrame:
    """(family, tokens): templates whole, without each of their words, and their starts and ends; and corpus paragraphs.

    Of the corpus, at most ``sample`` paragraphs from anywhere in its texts, chosen by a
    hash, that share less than RESEMBLES of any template's word pairs stand for the unknown
    class, with their first 200 words.
    """
    known = template_table(docs.sparkSession, templates)
    size = F.size("tokens")
    cuts = F.flatten(
        F.array(
            F.transform(
                F.sequence(F.lit(1), size),
                lambda i: F.concat(F.slice("tokens", F.lit(1), i - 1), F.slice("tokens", i + 1, F.greatest(size - i, F.lit(0)))),
            ),
            F.transform(F.sequence(F.floor(size * 0.6).cast("int"), size), lambda i: F.slice("tokens", F.lit(1), i)),
            F.transform(F.sequence(F.lit(1), F.ceil(size * 0.4).cast("int")), lambda i: F.slice("tokens", i, size)),
        )
    )
    positive = known.select("family", F.explode(cuts).alias("tokens"))
    all_pairs = F.array(*[_literal_pairs(t) for _, t in templates])
    other = paragraphs(docs.withColumn("_chosen", F.xxhash64(F.col(f"`{text}`"))), "_chosen", text)
    other = other.select(F.xxhash64("doc_id", "paragraph").alias("chosen"), F.col("text").alias("line"))
    other = other.orderBy("chosen", "line").limit(sample).withColumn("tokens", F.slice(words(F.col("line")), 1, 200))
    other = with_grams(other).withColumn("templates", all_pairs)
    unlike = F.forall("templates", lambda t: _similarity(F.col("pairs"), t) < RESEMBLES)
    return positive.unionByName(other.where(unlike).select(F.lit(UNKNOWN).alias("family"), "tokens"))


def train(docs: DataFrame, text: str = "text", templates=TEMPLATES, sample: int = SAMPLE) -> tuple[PipelineModel, list[str]]:
    """The fitted model and its classes. Rows are weighted so that every class counts alike."""
    families = [*dict.fromkeys(f for f, _ in templates), UNKNOWN]
    rows = training_rows(docs, text, templates, sample)
    # A paragraph of no words at all is unknown; it also keeps the class from being empty.
    rows = rows.unionByName(rows.sparkSession.range(1).select(F.lit(UNKNOWN).alias("family"), F.array().cast("array<string>").alias("tokens")))
    label = F.array_position(F.array(*[F.lit(f) for f in families]), F.col("family")).cast("double") - 1
    rows = written(with_grams(rows.withColumn("label", label)), "training")
    sizes = rows.groupBy("label").agg((1 / F.count("*")).alias("weight"))
    rows = rows.join(F.broadcast(sizes), "label")
    hashing = HashingTF(inputCol="grams", outputCol="vector", numFeatures=BUCKETS, binary=True)
    model = LogisticRegression(
        featuresCol="vector", labelCol="label", weightCol="weight", regParam=1e-4, maxIter=30, probabilityCol="probabilities"
    ).fit(hashing.transform(rows))
    return PipelineModel([hashing, model]), families


def scan(docs: DataFrame, id_column: str = "doc_id", text: str = "text", templates=TEMPLATES, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, paragraph, family, probability, similarity, confirmed) of paragraphs of a licence family or licence words.

    Paragraphs are lines, numbered from 0, and each is classified. Those that the classifier
    gives a family are returned, and unknown ones that hold one of ANCHORS. ``similarity``
    is the largest share of word pairs that a template of the predicted family has in common
    with the paragraph; ``confirmed`` tells whether it reaches CONFIRMED. An unknown
    paragraph has similarity 0 and isn't confirmed. Null and empty texts have no paragraph.
    Repeated rows are scanned one by one; other columns are not read; an empty table gives
    an empty table.
    """
    model, families = train(docs, text, templates, sample)
    scored = model.transform(with_grams(paragraphs(docs, id_column, text)))
    scored = scored.withColumn("shares", vector_to_array("probabilities"))
    best = F.array_max("shares")
    family = F.element_at(F.array(*[F.lit(f) for f in families]), F.array_position("shares", best).cast("int"))
    # Through an array of one row, so that no filter reaches below and runs the model once more.
    row = F.struct(best.alias("probability"), family.alias("family"))
    scored = scored.select("doc_id", "paragraph", "text", "pairs", F.inline(F.array(row)))
    scored = scored.where((F.col("family") != UNKNOWN) | F.col("text").rlike(ANCHORS))
    likeness = F.lit(0.0)
    for family in dict.fromkeys(f for f, _ in templates):
        own = [_literal_pairs(t) for f, t in templates if f == family]
        most = F.greatest(*[_similarity(F.col("pairs"), t) for t in own], F.lit(0.0))
        likeness = F.when(F.col("family") == family, most).otherwise(likeness)
    return scored.select("doc_id", "paragraph", "family", "probability", likeness.alias("similarity")).withColumn(
        "confirmed", F.col("similarity") >= CONFIRMED
    )
