"""Language-model scores against exact counts."""

import math
import random
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from fieldgauge.llm import language_model as lm  # noqa: E402

DOCS = "doc_id long, text string"


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(space, " ")
    return [w for w in lowered.split(" ") if w]


def is_held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 10 == 0


def some_rows(seed=3, n=400):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["The", "é", "x" * 90]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    texts = [" ".join(rng.choices(vocabulary, weights, k=rng.randrange(120))) for _ in range(n)]
    for i in range(0, n, 5):  # near copies
        copy = texts[rng.randrange(n)].split()
        if copy:
            copy[rng.randrange(len(copy))] = "changed"
        texts[i] = "\n".join(copy).upper()
    rows = list(enumerate(texts + [None, "", " \t\r\n", "never seen anywhere", "é\u0085é"]))
    return rows + [rows[7], (None, texts[3]), (None, None)]


def exact(rows):
    """The model without a filter: exact counts, in levels."""
    marks = ("<1>", "<2>")
    counts = Counter()
    for doc_id, text in rows:
        if doc_id is None or not is_held_out(doc_id):
            tokens = [*marks, *words(text), "</>"]
            for size in (1, 2, 3):
                counts.update(tuple(tokens[i : i + size]) for i in range(len(tokens) - size + 1))
    seen = {t[0]: c for t, c in counts.items() if len(t) == 1 and t[0] not in marks}
    total, distinct = sum(seen.values()), len(seen)
    levels = [0, *lm.LEVELS.tolist()]

    def least(c):
        return max(x for x in levels if x <= c)

    def most(c):
        return 0 if not c else min(x for x in levels if x > c) - 1

    found = []
    for doc_id, text in rows:
        tokens = [*marks, *words(text), "</>"]
        base = one = two = 0.0
        for i in range(2, len(tokens)):
            share = (seen.get(tokens[i], 0) + 0.1) / (total + 0.1 * (distinct + 1))
            before = tokens[i - 1]
            c = seen.get(before, 0) if before in seen else most(counts[(before,)])
            pair, triple = counts[tuple(tokens[i - 1 : i + 1])], counts[tuple(tokens[i - 2 : i + 1])]
            p_one = (min(least(pair), c) + lm.PRIOR[0] * share) / (c + lm.PRIOR[0])
            d = most(counts[tuple(tokens[i - 2 : i])])
            p_two = (min(least(triple), d) + lm.PRIOR[1] * p_one) / (d + lm.PRIOR[1])
            base, one, two = base + math.log10(share), one + math.log10(p_one), two + math.log10(p_two)
        best = max(base, one, two)
        score = best + math.log10(sum(10 ** (x - best) for x in (base, one, two)) / 3)
        held = doc_id is not None and is_held_out(doc_id)
        known = sum(t in seen for t in tokens[2:])
        found.append((-1 if doc_id is None else doc_id, held, len(tokens) - 2, known, total, base, score))
    return sorted(found)


@pytest.mark.parametrize("frequent", [lm.FREQUENT, 40])
def test_scores_equal_exact_counts(spark, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT", frequent)  # 40: most words count as rare
    rows = some_rows()
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as row", "2 as base", "'x' as score").repartition(5)
    got = lm.held_out_scores(docs).collect()
    got = sorted((-1 if r.doc_id is None else r.doc_id, *r[1:]) for r in got)
    wanted = exact(rows)
    assert [r[:5] for r in got] == [r[:5] for r in wanted]
    assert np.allclose([r[5] for r in got], [r[5] for r in wanted], rtol=1e-9)
    # Falsely added levels and, for rare words, counts by level move a score a little.
    apart = np.abs(np.array([r[6] - w[6] for r, w in zip(got, wanted, strict=True)]))
    size = np.array([r[2] for r in got])
    assert apart.sum() / size.sum() < (0.02 if frequent == lm.FREQUENT else 0.1)
    held = [r for r in got if r[1]]
    assert sum(r[6] for r in held) > sum(r[5] for r in held)
    assert all(r[6] > r[5] - math.log10(3) - 1e-9 for r in got)


def test_filter_loses_no_level_and_adds_few(spark):
    model = lm.train(spark.createDataFrame(some_rows(8), DOCS))
    rng = np.random.default_rng(1)
    counts = Counter()
    for _, text in some_rows(8):
        tokens = words(text)
        counts.update(zip(tokens, tokens[1:]))
    hashes = {w: lm._tokens(pa.array([w])).all[2] for w in {w for p in counts for w in p}}
    keys = np.array([lm.span_hashes(np.array([hashes[a], hashes[b]]), np.array([0]), np.array([2]))[0] for a, b in counts])
    sizes = model.sizes.value
    got = lm._levels(keys >> np.uint64(16), sizes, model.segments)
    true = np.searchsorted(lm.LEVELS, list(counts.values()), side="right")
    assert (got >= true).all() and (got > true).mean() < 0.05
    others = lm._levels(rng.integers(0, 2**48, 20_000, dtype=np.uint64), sizes, model.segments)
    assert (others > 0).mean() < 0.05


def test_segments_change_nothing(spark, monkeypatch):
    docs = spark.createDataFrame(some_rows(4), DOCS)
    whole = sorted(map(str, lm.held_out_scores(docs).collect()))
    monkeypatch.setattr(lm, "SEGMENT_WORDS", 500)
    monkeypatch.setattr(lm, "KEPT_SEGMENTS", 0)
    assert len(lm.train(docs).segments) > 5
    assert sorted(map(str, lm.held_out_scores(docs).collect())) == whole


def test_probabilities_of_all_words_sum_to_one_at_most(spark):
    rows = some_rows(6, 200)
    vocabulary = sorted({w for _, t in rows for w in words(t)})
    pairs = Counter(p for _, t in rows for p in zip(words(t), words(t)[1:]))
    model = lm.train(spark.createDataFrame(rows, DOCS))
    known, counts = model.words.value
    for context, _ in pairs.most_common(40)[::8]:
        texts = [f"{' '.join(context)} {w}" for w in [*vocabulary, "unknown"]] + [" ".join(context)]
        tokens = lm._tokens(pa.array(texts))
        p = lm._probabilities(tokens, known, counts.astype(float), model.total, model.sizes.value, model.segments)
        third = np.flatnonzero(np.isin(p.at, tokens.starts + 4))  # what follows the two words: each word, and the end
        assert len(third) == len(texts)
        for found in (p.after_one, p.after_two):
            assert (found > 0).all() and found[third].sum() < 1.02  # falsely added levels
            assert found[third].sum() > 0.5


def test_nothing_to_learn_from_or_to_score(spark):
    empty = spark.createDataFrame([], DOCS)
    assert lm.held_out_scores(empty).count() == 0
    rows = lm.score(spark.createDataFrame([(1, "a b"), (2, None)], DOCS), lm.train(empty)).collect()
    assert {(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows} == {(1, 3, 0, 0, 0.0), (2, 1, 0, 0, 0.0)}
