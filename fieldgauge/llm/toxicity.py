"""Toxicity by a weighted finite-state pattern grammar.

A clause runs through a chain of small transducers: a lexer turns its words into symbols
(insult with a weight, threat, target, negation, reported speech), and each further one
rewrites an insult or a threat by what stands near it: negated, reported, aimed at
someone. The weights come from labels: a lexicon of word stems whose presence separates
toxic from other documents, and one factor for each kind of match.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE = 20_000
_STEM = range(4, 11)
_STRONGER = 0.7  # log odds by which a longer form must exceed a shorter one
_LEAST_DOCS = 3
_REACH = 3  # words over which negation, and a target behind its insult, act
_RIDGE = 0.05
_STEPS = 30

# Function words of the grammar.
_TARGETS = frozenset(
    "you your yours yourself u ur he she him her his they them their this that these those "
    "du dich dir dein deine ihr euch sie er tu te toi ton ta tes vous votre vos il elle ils elles "
    "tú ti tus usted ustedes él ella ellos vosotros".split()
)
_NEGATIONS = frozenset(
    "not no never neither nor without isn't aren't wasn't don't doesn't cannot can't "
    "nicht kein keine keinen nie niemals ohne pas jamais aucun aucune sans nunca jamás ningún ninguna sin".split()
)
_REPORTS = frozenset(
    "said says say called calls wrote writes quoted quote claimed claims reported allegedly "
    "sagte sagt nannte schrieb angeblich dit disait appelé écrit dijo dice llamó escribió".split()
)
_THREATS = frozenset(
    "kill murder stab shoot strangle hurt destroy töten umbringen erschießen tuer assassiner frapper "
    "matar asesinar golpear".split()
)

_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
_CLAUSE = re.compile(r"[.!?;:\n]+")
_QUOTES = re.compile("[\"“”«»„]")

KINDS = ("plain", "aimed", "negated", "reported", "threat", "aimed_threat")


@dataclass(frozen=True)
class Symbol:
    kind: str
    weight: float = 0.0


@dataclass(frozen=True)
class Model:
    """stems: weight by stem; a stem ending in $ is a whole word. factors: one for each kind, and the last for all."""

    stems: dict[str, float]
    factors: tuple[float, ...]


def lexer(clause: str, stems: dict[str, float]) -> Iterator[Symbol]:
    """The first transducer: words to symbols."""
    for quote_or_word in re.finditer(rf"{_QUOTES.pattern}|{_WORD.pattern}", clause):
        word = quote_or_word[0]
        if _QUOTES.fullmatch(word):
            yield Symbol("quote")
            continue
        weight = max(
            [stems.get(word[:n], 0.0) for n in _STEM if len(word) >= n] + [stems.get(f"{word}$", 0.0)], default=0.0
        )
        if weight:
            yield Symbol("insult", weight)
        elif word in _THREATS:
            yield Symbol("threat", 1.0)
        elif word in _NEGATIONS:
            yield Symbol("negation")
        elif word in _REPORTS:
            yield Symbol("report")
        elif word in _TARGETS:
            yield Symbol("target")
        else:
            yield Symbol("other")


def negation(symbols: Iterable[Symbol]) -> Iterator[Symbol]:
    """An insult or threat at most _REACH words behind a negation is negated. States: words left."""
    left = 0
    for symbol in symbols:
        if symbol.kind == "negation":
            left = _REACH + 1
        elif left and symbol.kind in ("insult", "threat"):
            symbol = Symbol("negated", symbol.weight)
        left = max(0, left - 1)
        yield symbol


def reported_speech(symbols: Iterable[Symbol]) -> Iterator[Symbol]:
    """Behind a verb of saying, and inside quotation marks, matches are reported."""
    said = quoted = False
    for symbol in symbols:
        if symbol.kind == "report":
            said = True
        elif symbol.kind == "quote":
            quoted = not quoted
        elif (said or quoted) and symbol.kind in ("insult", "threat", "negated"):
            symbol = Symbol("reported", symbol.weight)
        yield symbol


def aim(symbols: Iterable[Symbol]) -> Iterator[Symbol]:
    """An insult or threat with a target before it in its clause, or right behind it, is aimed."""
    symbols = list(symbols)
    targets = [i for i, s in enumerate(symbols) if s.kind == "target"]
    for i, symbol in enumerate(symbols):
        if symbol.kind in ("insult", "threat"):
            near = any(t - i <= _REACH for t in targets)
            kind = {"insult": ("plain", "aimed"), "threat": ("threat", "aimed_threat")}[symbol.kind][near]
            symbol = Symbol(kind, symbol.weight)
        yield symbol


def clause_matches(clause: str, stems: dict[str, float]) -> Iterator[Symbol]:
    """The composed transducers over one clause; only matches come out."""
    return (s for s in aim(reported_speech(negation(lexer(clause, stems)))) if s.kind in KINDS)


class Grammar:
    """Scores texts with a lexicon; clauses without any of its stems are not looked into."""

    def __init__(self, stems: dict[str, float]):
        self.stems = stems
        self.finder = ahocorasick.Automaton()
        for word in [*(s.rstrip("$") for s in stems), *_THREATS]:
            self.finder.add_word(word, len(word))
        self.finder.make_automaton()

    def evidence(self, text: str | None) -> np.ndarray:
        """The weights of all matches, by kind."""
        total = np.zeros(len(KINDS))
        if not text:
            return total
        lowered = text.lower()
        done = 0  # where the last clause looked into ends
        for end, size in self.finder.iter(lowered):
            start = end - size + 1
            if start < done or (start and lowered[start - 1].isalpha()):
                continue
            before = max(done, 1 + max(lowered.rfind(mark, done, start) for mark in ".!?;:\n"))
            behind = _CLAUSE.search(lowered, end)
            done = behind.end() if behind else len(lowered)
            for match in clause_matches(lowered[before:done], self.stems):
                total[KINDS.index(match.kind)] += match.weight
        return total


def held_out(doc_id: Column) -> Column:
    """Whether a document's label may not be learned from; a null id is held out."""
    digest = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(digest % 5 == 0, F.lit(True))


def _stem_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(stem, toxic, clean): how many documents of each label in a batch have a stem."""
    for whole in batches:
        for begin in range(0, whole.num_rows, 1000):
            batch = whole.slice(begin, 1000)
            counts = (Counter(), Counter())
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                words = set(_WORD.findall((text or "").lower()))
                found = {w[:n] for w in words for n in _STEM if len(w) >= n}
                found.update(f"{w}$" for w in words if len(w) > 1)
                counts[label == 0].update(found)
            stems = list(counts[0] | counts[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(stems, pa.string()), *(pa.array([c[s] for s in stems], pa.int64()) for c in counts)],
                names=["stem", "toxic", "clean"],
            )


def _chosen(counts: DataFrame, toxic: int, clean: int) -> dict[str, float]:
    """Stems that separate the labels beyond chance, with their log odds; a longer form only if it says more."""
    counts = counts.groupBy("stem").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    counts = counts.where(F.col("t") + F.col("c") >= _LEAST_DOCS)
    tested = max(2, counts.count())
    n, share = F.col("t") + F.col("c"), toxic / (toxic + clean)

    def part(k: Column, expected: float) -> Column:
        return F.when(k > 0, k * F.log(k / (n * F.lit(expected)))).otherwise(0.0)

    gain = 2 * (part(F.col("t"), share) + part(F.col("c"), 1 - share))
    odds = F.log((F.col("t") + 0.5) / (toxic + 1.0)) - F.log((F.col("c") + 0.5) / (clean + 1.0))
    strong = counts.withColumn("gain", gain).withColumn("odds", odds)
    strong = strong.where((F.col("odds") > 1.5) & (F.col("gain") > 2 * math.log(tested)))
    chosen: dict[str, float] = {}
    for row in sorted(strong.collect(), key=lambda r: (-r["gain"], len(r["stem"]), r["stem"])):
        forms = [row["stem"][:n] for n in _STEM if n < len(row["stem"])]
        if not any(chosen.get(f, -math.inf) > row["odds"] - _STRONGER for f in forms):
            chosen[row["stem"]] = row["odds"]
    return chosen


def _fit(features: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Logistic regression with a ridge on all factors but the last, by Newton's method."""
    x = np.hstack([features, np.ones((len(features), 1))])
    weights = np.zeros(x.shape[1])
    ridge = np.append(np.full(features.shape[1], _RIDGE), 1e-6)
    for _ in range(_STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (p - labels) + ridge * weights
        curve = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge)
        weights = weights - np.linalg.solve(curve, gradient)
    return weights


def _evidence_rows(stems: dict[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(stems)
        for batch in batches:
            rows = np.array([grammar.evidence(t.as_py()) for t in batch.column("text")]).reshape(-1, len(KINDS))
            rest = [batch.column(c) for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*rest, *(pa.array(rows[:, i]) for i in range(len(KINDS)))],
                names=[*(c for c in batch.schema.names if c != "text"), *KINDS],
            )

    return run


def _evidence(docs: DataFrame, stems: dict[str, float]) -> DataFrame:
    """Each row's columns but ``text``, and its evidence by kind."""
    schema = T.StructType([f for f in docs.schema if f.name != "text"])
    for kind in KINDS:
        schema = schema.add(kind, T.DoubleType())
    return docs.mapInArrow(_evidence_rows(stems), schema)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fits the grammar's weights to labels (doc_id, toxic) of documents (doc_id, text).

    At most ``sample`` labelled documents are used, chosen by a hash of their ids; those
    held out are not among them. Null labels are ignored. Without documents of both
    labels the lexicon is empty and every text gets the share of toxic labels, smoothed.
    """
    usable = labels.where(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", "toxic")
    usable = usable.groupBy("doc_id").agg(F.max("toxic").cast("long").alias("toxic"))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic")
    by_label = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    clean = by_label.get(0, 0)
    toxic = sum(by_label.values()) - clean
    if not toxic or not clean:
        return Model({}, (*[0.0] * len(KINDS), math.log((toxic + 0.5) / (clean + 1.5))))
    schema = T.StructType([T.StructField("stem", T.StringType())]).add("toxic", T.LongType()).add("clean", T.LongType())
    stems = _chosen(rows.mapInArrow(_stem_counts, schema), toxic, clean)
    evidence = _evidence(rows, stems).toPandas()
    factors = _fit(evidence[list(KINDS)].to_numpy(), (evidence["toxic"] != 0).to_numpy(float))
    return Model(stems, tuple(float(f) for f in factors))


def _log_odds(model: Model) -> Column:
    *factors, base = model.factors
    total = F.lit(base)
    for kind, factor in zip(KINDS, factors, strict=True):
        total = total + F.col(kind) * F.lit(factor)
    return total


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of (doc_id, text).

    The score is between 0 and 1. Null, empty and unmatched texts get the score of no
    evidence. Rows that repeat an id are scored one by one; an empty table gives an
    empty table; other columns are not read.
    """
    found = _evidence(docs.select("doc_id", "text"), model.stems)
    found = found.withColumn("score", 1 / (1 + F.exp(-_log_odds(model))))
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    text = docs.columns.index("text")
    plain = docs.toDF(*names).withColumn("text", F.col(names[text]))
    found = _evidence(plain, model.stems)
    return found.where(_log_odds(model) < 0).select(*names).toDF(*docs.columns)
