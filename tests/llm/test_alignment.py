"""Alignment of two tokenizers against brute force with the tokenizers' own libraries."""

import hashlib
import random
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from fieldgauge.llm import alignment as al  # noqa: E402

DOCS = "doc_id long, text string"


def some_texts(seed=1, n=60):
    rng = random.Random(seed)
    words = ["the", "of", "Überaus", "naïve", "x" * 40, "1234567", "don't", "we'll", "C++", "日本語", "🎈", "é", " "]
    texts = [rng.choice([" ", "  ", "\n", "\t ", ", "]).join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(n)]
    odd = [None, "", " ", "\n\n ", "<|endoftext|> end", "<s> a </s> <unk> <0x41>", "a▁b", "\x00\x01 nul", "ﬁ ½ Å", "z" * 20_000]
    return texts + odd + ["the of " * 4000, "é ö", " leading and trailing "] + texts[:4]


@pytest.fixture(scope="module")
def sides():
    first = Tokenizer.from_file(al.FIRST_SIDE)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=al.SECOND_SIDE)


def brute_force(texts, sides):
    first, second = sides
    byte = al._byte_of_character()
    aligned = []
    for text in texts:
        groups = []
        if text:
            a = first.encode(" " + text, add_special_tokens=False)
            spelt_a = [bytes(byte[c] for c in t) for t in a.tokens]
            ids_b = second.encode(text)
            pieces = [second.id_to_piece(i) for i in ids_b]
            spelt_b = [bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, pieces, strict=True)]
            if b"".join(spelt_a) == b"".join(spelt_b) == (" " + text).encode():
                ends_a, ends_b = (list(np.cumsum([len(x) for x in s])) for s in (spelt_a, spelt_b))
                begin_a = begin_b = 0
                for end in sorted(set(ends_a) & set(ends_b)):
                    i, j = ends_a.index(end, begin_a) + 1, ends_b.index(end, begin_b) + 1
                    groups.append((a.ids[begin_a:i], ids_b[begin_b:j]))
                    begin_a, begin_b = i, j
        aligned.append(groups)
    counts = Counter((a[-1], b[-1]) for groups in aligned for a, b in groups)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    rows = []
    for i, groups in enumerate(aligned):
        links = [(a[-1], b[-1]) for a, b in groups]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        n_best = sum(counts[x] == best[x[1]] for x in links)
        n_a, n_b = (sum(len(g[side]) for g in groups) for side in (0, 1))
        rows.append((i, n_a, n_b, len(links), len(links), n_best, sum(counts[x] for x in links), digest))
    return rows


@pytest.mark.parametrize("fan_in, together", [(al.FAN_IN, al.TOGETHER), (2, 1)])
def test_equal_brute_force(spark, sides, fan_in, together):
    texts = some_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS).selectExpr("*", "1L as chunk", "2 as part", "'x' as pairs")
    got = al.align(docs.repartition(7), fan_in=fan_in, together=together)
    assert sorted(map(tuple, got.collect())) == brute_force(texts, sides)


def test_first_side_equals_its_own_library(sides):
    engine = al.FirstSide(al.FIRST_SIDE)
    rng = random.Random(5)
    plain = [c for c in range(1, 0x11000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(map(chr, plain[i : i + 64])) for i in range(0, len(plain), 64)]
    texts += ["".join(chr(rng.choice(plain)) if rng.random() < 0.3 else rng.choice(" \n\tab'1.") for _ in range(200)) for _ in range(300)]
    for text in [*texts, *filter(None, some_texts(9))]:
        assert engine.encode(" " + text)[0].tolist() == sides[0].encode(" " + text, add_special_tokens=False).ids


def test_no_token_is_empty():
    assert al.FirstSide(al.FIRST_SIDE).lengths.min() > 0 and al.SecondSide(al.SECOND_SIDE).lengths.min() > 0


def test_repeated_null_and_no_rows(spark):
    rows = [(3, "the same text"), (3, "the same text"), (None, "the same text"), (None, None)]
    got = al.align(spark.createDataFrame(rows, DOCS)).collect()
    assert Counter((r.doc_id, r.n_links > 0) for r in got) == {(3, True): 2, (None, True): 1, (None, False): 1}
    assert {r.count_sum for r in got if r.n_links} == {3 * next(r.n_links for r in got if r.n_links)}
    assert al.align(spark.createDataFrame([], DOCS)).count() == 0


def test_runs_of_one_pair_and_merges():
    frames = [al._packed(np.array([5, 2, 9]), np.array([1, 1, 7])), al._packed(np.array([7]), np.array([2**40]))]
    assert list(al._merged(frames)) == [(5, 1), (7, 1 + 2**40), (16, 7)]
    assert [x.tolist() for x in al._unpacked(al._packed(np.array([], int), np.array([3, 2**33])))] == [[], [3, 2**33]]
