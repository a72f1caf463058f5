"""Phrase collocations against brute force."""

import random
import re
import sys
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from fieldgauge.llm import collocations as c  # noqa: E402

DOCS = "doc_id long, text string, lang string"


def lowered(text):
    return "".join(x.lower() if "A" <= x <= "Z" else x for x in text or "")


def pieces(text):
    found = (re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)))
    return [words for words in found if words]


def brute_force(rows, least, kept, longest=4):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            totals[lang] += len(words)
            for n in range(1, longest + 1):
                for i in range(len(words) - n + 1):
                    counts[lang][tuple(words[i : i + n])] += 1
    found = []
    for lang, count in counts.items():
        candidates = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        best = []
        for phrase, a in candidates.items():
            cuts = [(2_000_000 * a // (count[phrase[:k]] + count[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            n = len(phrase)
            holders = [
                x for p, x in candidates.items() if len(p) > n and any(p[i : i + n] == phrase for i in range(len(p) - n + 1))
            ]
            if not any(100 * x >= 80 * a for x in holders):
                text = " ".join(phrase)
                best.append((-score, -a, text.encode(), text, a, count[phrase[:k]], count[phrase[k:]], score))
        for rank, (_, _, _, text, a, left, right, score) in enumerate(sorted(best)[:kept], 1):
            found.append((lang, rank, text, a, left, right, totals[lang], score))
    return sorted(found)


def some_rows(seed, n=300):
    rng = random.Random(seed)
    words = [rng.choice(["ab", "Cd", "é", "ß", "x\u0085y"]) + str(i) for i in range(60)] + ["A", "a", "B", "Éa"]
    lines = [" ".join(rng.choice(words) for _ in range(rng.randint(3, 12))) for _ in range(8)]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 12)):
            parts.append(rng.choice(lines) if rng.random() < 0.4 else " ".join(rng.choices(words, k=rng.randint(1, 30))))
        rows.append((rng.choice([" ", ". ", "\n", ",", "\t"]).join(parts), rng.choice(["en", "en", "en", "de", "", None])))
    return rows + [(None, "en"), ("", None), (" .,; \t", "de"), ("a " * 5000, "fr"), ("q" * 40_000, "fr")]


@pytest.mark.parametrize("least, kept", [(5, 2000), (30, 15)])
def test_equal_brute_force(spark, least, kept):
    rows = some_rows(least)
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], DOCS).repartition(5)
    docs = docs.withColumnsRenamed({"doc_id": "phrase"}).selectExpr("*", "1 as rank", "2 as words", "3 as n")
    got = sorted(tuple(r) for r in c.collocations(docs, least=least, kept=kept).collect())
    assert got == brute_force(rows, least, kept) and len(got) > 12


def test_shorter_and_longer_phrases(spark):
    rows = some_rows(7, n=120)
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], DOCS)
    for longest in (2, 3, 5):
        got = sorted(tuple(r) for r in c.collocations(docs, longest=longest, least=8).collect())
        assert got == brute_force(rows, 8, 2000, longest)


def test_chunks_cover_every_word_once_and_repeat_with_their_content(spark):
    rows = some_rows(3)
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], DOCS)
    found = c.dictionary(docs).collect()
    assert sum(r.own * r.times for r in found) == sum(len(p) for t, _ in rows for p in pieces(t))
    assert len(found) == len({(r.lang, r.chunk, r.own) for r in found})
    assert all(1 <= r.own <= len(r.chunk.split(" ")) <= r.own + 3 and r.own <= c.CHUNK_WORDS for r in found)
    text = " ".join(f"w{i}" for i in np.random.default_rng(2).integers(0, 10**6, 3000))
    both = spark.createDataFrame([(1, text, "en"), (2, "other words before " + text, "en")], DOCS)
    twice = [r for r in c.dictionary(both).collect() if r.times == 2]
    assert sum(r.own for r in twice) > 2800  # the parse finds its way back after a different start


def test_empty_table(spark):
    assert c.collocations(spark.createDataFrame([], DOCS)).count() == 0
    assert c.collocations(spark.createDataFrame([(1, None, None)], DOCS)).columns == [
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    ]
