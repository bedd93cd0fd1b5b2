"""Toxicity by a weighted finite-state pattern grammar.

Four small transducers read the token classes of a clause from left to right:
negation, reported speech, target and the insult / threat scorer. They are
composed into one deterministic transducer, and a clause scores the sum of the
weights of its matched patterns: an insult alone, an insult near a target, a
threat near a target; negated and reported matches weigh less. A document's
features are its best clause, the sum of its clauses and the number of matched
clauses; a logistic function turns them into a score between 0 and 1.

Insults and their weights are learned from labelled rows outside the held-out
fold: words, and stems of 4 to 7 letters, with the log-odds of the number of
*distinct contexts* (previous and next word) in toxic and other texts, so that
copies of one toxic text count once. Threats, targets, negations and reporting
words are fixed lists. The model is fitted on at most ``MAX_TRAINING_ROWS``
labelled rows (those with the smallest hashes of their doc_id); everything
else is one pass over all documents.

Edge cases: a null or empty text scores the model's base rate; labels with a
null toxic or doc_id are left out, and a doc_id labelled more than once is
toxic if one of its labels says so; without labels the lexicon is empty and
every score is the prior; a null doc_id belongs to the held-out fold; repeated
rows score alike; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import hash52, key_text, ship_package, stage_table, tidy

FOLDS = 5
MAX_TRAINING_ROWS = 24_000
#: Least number of distinct toxic contexts of a learned insult, and its least log-odds.
MIN_CONTEXTS = 6
MIN_LOG_ODDS = 2.5
MAX_WEIGHT = 8.0
STEM_LETTERS = (4, 5, 6, 7)
#: Words within which a negation, or a target, reaches.
NEGATION_SCOPE = 3
TARGET_SCOPE = 4

# Closed word lists of the grammar.
THREATS = frozenset("kill hurt destroy beat burn shoot stab töten schlagen verprügeln tuer frapper matar golpear".split())
TARGETS = frozenset(
    "you your yours u he him she her they them their people everyone "
    "du dich dir dein deine ihr euch sie er "
    "tu toi te vous votre il elle ils elles "
    "usted ustedes ellos ellas él ella".split()
)
NEGATIONS = frozenset(
    "not no never without nobody cannot don't isn't nicht kein keine niemals ohne ne pas jamais sans nunca jamás sin".split()
)
REPORTS = frozenset(
    "said says saying quoted quotes wrote called reported according claimed "
    "sagte sagt schrieb laut zitiert dit disait écrit selon dijo dice escribió según".split()
)
CLAUSE_ENDS = frozenset(".!?;\n")
QUOTES = frozenset("\"“”„«»")

TOKEN = re.compile(r"\w+(?:'\w+)?|[.!?;\n\"“”„«»]")

#: Share of a match's weight by what surrounds it; II and TT are targeted matches, i and t negated ones, q is the factor of reported ones.
FACTORS = {"I": 1.0, "II": 1.5, "T": 0.3, "TT": 1.2, "i": 0.3, "t": 0.1, "q": 0.5}
THREAT_WEIGHT = 4.0


@dataclass(frozen=True)
class Transducer:
    """Deterministic transducer: arcs[state][symbol] = (output, weight, next);
    a symbol without an arc follows the arc of ``None`` and passes unchanged."""

    start: object
    arcs: dict = field(hash=False)

    def step(self, state: object, symbol: str) -> tuple[str, float, object]:
        arc = self.arcs[state].get(symbol)
        if arc is None:
            _, weight, after = self.arcs[state][None]
            return symbol, weight, after
        return arc


def compose(first: Transducer, second: Transducer, symbols: Iterable[str]) -> Transducer:
    """The transducer that feeds the outputs of ``first`` to ``second``;
    weights multiply."""
    symbols = list(symbols)
    start = (first.start, second.start)
    arcs: dict = {}
    todo = [start]
    while todo:
        state = todo.pop()
        if state in arcs:
            continue
        arcs[state] = {}
        for symbol in [*symbols, None]:
            middle, w1, a = first.step(state[0], symbol)
            out, w2, b = second.step(state[1], middle)
            arcs[state][symbol] = (out, w1 * w2, (a, b))
            todo.append((a, b))
    return Transducer(start, arcs)


def negation() -> Transducer:
    """A match within the scope of a negation becomes a negated one."""
    arcs: dict = {0: {None: (None, 1.0, 0), "N": ("N", 1.0, NEGATION_SCOPE)}}
    for left in range(1, NEGATION_SCOPE + 1):
        arcs[left] = {
            None: (None, 1.0, left - 1),
            "N": ("N", 1.0, NEGATION_SCOPE),
            "I": ("i", 1.0, left - 1),
            "T": ("t", 1.0, left - 1),
        }
    return Transducer(0, arcs)


def reported() -> Transducer:
    """After a reporting word or inside quotes, the rest of a clause weighs less."""
    inside = {s: (s, FACTORS["q"], 1) for s in ("I", "T", "i", "t")}
    return Transducer(
        0,
        {
            0: {None: (None, 1.0, 0), "R": ("R", 1.0, 1)},
            1: {None: (None, 1.0, 1), **inside},
        },
    )


def target() -> Transducer:
    """A match soon after a target is a targeted one."""
    arcs: dict = {0: {None: (None, 1.0, 0), "G": ("G", 1.0, TARGET_SCOPE)}}
    for left in range(1, TARGET_SCOPE + 1):
        arcs[left] = {
            None: (None, 1.0, left - 1),
            "G": ("G", 1.0, TARGET_SCOPE),
            "I": ("II", 1.0, left - 1),
            "T": ("TT", 1.0, left - 1),
        }
    return Transducer(0, arcs)


def scorer() -> Transducer:
    """The last stage: the share of a match's weight that counts."""
    return Transducer(0, {0: {None: (None, 0.0, 0), **{s: (s, f, 0) for s, f in FACTORS.items()}}})


def grammar() -> Transducer:
    symbols = ["I", "T", "G", "N", "R", "O"]
    middle = [*symbols, "i", "t", "II", "TT"]
    first = compose(negation(), reported(), symbols)
    return compose(compose(first, target(), symbols), scorer(), middle)


class Lexicon(dict):
    """token -> (class, weight), filled on demand from words, stems and lists."""

    def __init__(self, words: dict[str, float], stems: dict[str, float]):
        super().__init__()
        self.words, self.stems = words, stems

    def __missing__(self, token: str) -> tuple[str, float]:
        if token in CLAUSE_ENDS:
            entry = ("E", 0.0)
        elif token in self.words:
            entry = ("I", self.words[token])
        elif token in THREATS:
            entry = ("T", THREAT_WEIGHT)
        elif token in NEGATIONS:
            entry = ("N", 0.0)
        elif token in REPORTS or token in QUOTES:
            entry = ("R", 0.0)
        elif token in TARGETS:
            entry = ("G", 0.0)
        else:
            stem = max((self.stems[token[:n]] for n in STEM_LETTERS if token[:n] in self.stems and len(token) >= n), default=0.0)
            entry = ("I", stem) if stem else ("O", 0.0)
        if len(self) > 200_000:
            self.clear()
        self[token] = entry
        return entry


class Model:
    """Lexicon, grammar and the logistic function over clause features."""

    def __init__(self, words: dict[str, float], stems: dict[str, float], coefficients: list[float]):
        self.lexicon = Lexicon(words, stems)
        self.grammar = grammar()
        self.coefficients = coefficients

    def clauses(self, text: str) -> list[float]:
        """Scores of the clauses with a match."""
        tagged = list(map(self.lexicon.__getitem__, TOKEN.findall(text.lower())))
        found = [i for i, t in enumerate(tagged) if t[0] in "IT"]
        scores, done = [], -1
        for hit in found:
            if hit <= done:
                continue
            start = hit
            while start > 0 and tagged[start - 1][0] != "E":
                start -= 1
            state, score, at = self.grammar.start, 0.0, start
            while at < len(tagged) and tagged[at][0] != "E":
                symbol, weight = tagged[at]
                _, share, state = self.grammar.step(state, symbol)
                score += share * weight
                at += 1
            done = at
            scores.append(score)
        return scores

    def features(self, text: str | None) -> tuple[float, float, float]:
        scores = self.clauses(text) if text else []
        return max(scores, default=0.0), math.log1p(sum(scores)), math.log1p(len(scores))

    def score(self, text: str | None) -> float:
        z = self.coefficients[0] + sum(c * f for c, f in zip(self.coefficients[1:], self.features(text), strict=True))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def fold(doc_id: Column) -> Column:
    """crc32 of the doc_id as text, modulo ``FOLDS``; 0 is the held-out fold."""
    return F.crc32(key_text(doc_id).cast("binary")) % FOLDS


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of the bounded training sample."""
    sample = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 0))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(hash52(F.lit("toxicity"), key_text(F.col("doc_id"))), "doc_id")
        .limit(MAX_TRAINING_ROWS)
        .select(F.col("doc_id").alias("_id"), "toxic")
    )
    # At most MAX_TRAINING_ROWS rows of (id, label): a proven bound for a broadcast.
    joined = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_id"))
    # One row per id, also where a doc_id repeats.
    one = joined.groupBy("_id").agg(F.coalesce(F.min("text"), F.lit("")).alias("text"), F.first("toxic").alias("toxic"))
    return stage_table(one.select("text", "toxic"), "toxicity-sample")


def _keys(words: list[str]) -> set[str]:
    """Words, and stems written with a final star."""
    found = {w for w in words if w not in CLAUSE_ENDS and w not in QUOTES}
    return found | {w[:n] + "*" for w in found for n in STEM_LETTERS if len(w) >= n}


def _document_counts(rows: DataFrame, only: frozenset[str] | None) -> DataFrame:
    """(key, n): documents that hold a key, added up in each task."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                keys = _keys(TOKEN.findall(text.as_py().lower()))
                counts.update(keys if only is None else keys & only)
            if len(counts) > 500_000:
                yield pa.RecordBatch.from_pydict({"key": list(counts), "n": list(counts.values())})
                counts.clear()
        yield pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["key", "n"]
        )

    return rows.select("text").mapInArrow(run, "key string, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _contexts(rows: DataFrame, keys: frozenset[str]) -> DataFrame:
    """(key, toxic, n): distinct pairs of neighbours of a key."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = set()
            for text, toxic in zip(batch.column(0), batch.column(1), strict=True):
                words = ["", *TOKEN.findall(text.as_py().lower()), ""]
                for before, word, after in zip(words, words[1:], words[2:], strict=False):
                    for key in (word, *(word[:n] + "*" for n in STEM_LETTERS if len(word) >= n)):
                        if key in keys:
                            found.add((key, toxic.as_py(), f"{before} {after}"))
            columns = zip(*found, strict=True) if found else ((), (), ())
            types = (pa.string(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["key", "toxic", "context"]
            )

    return (
        rows.mapInArrow(run, "key string, toxic int, context string")
        .distinct()
        .groupBy("key", "toxic")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _log_odds(toxic: int, clean: int, n_toxic: int, n_clean: int) -> float:
    return math.log((toxic + 0.5) / (n_toxic + 1.0)) - math.log((clean + 0.5) / (n_clean + 1.0))


def learn_lexicon(rows: DataFrame) -> tuple[dict[str, float], dict[str, float]]:
    """Insult words and stems with their weights, from the training rows."""
    sizes = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = sum(n for t, n in sizes.items() if t), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return {}, {}
    toxic = {r.key: r.n for r in _document_counts(rows.where("toxic != 0"), None).where(F.col("n") >= MIN_CONTEXTS).collect()}
    clean = {r.key: r.n for r in _document_counts(rows.where("toxic = 0"), frozenset(toxic)).collect()}
    likely = frozenset(k for k, n in toxic.items() if _log_odds(n, clean.get(k, 0), n_toxic, n_clean) >= MIN_LOG_ODDS)
    seen: dict[tuple[str, bool], int] = {}
    for r in _contexts(rows, likely).collect():
        seen[r.key, r.toxic != 0] = seen.get((r.key, r.toxic != 0), 0) + r.n
    weights = {}
    for key in likely:
        contexts = seen.get((key, True), 0)
        odds = _log_odds(contexts, seen.get((key, False), 0), n_toxic, n_clean)
        if contexts >= MIN_CONTEXTS and odds >= MIN_LOG_ODDS:
            weights[key] = min(MAX_WEIGHT, odds)
    words = {k: w for k, w in weights.items() if not k.endswith("*")}
    # A stem must have more to it than the one word that it is cut from.
    stems = {
        k[:-1]: w
        for k, w in weights.items()
        if k.endswith("*")
        and seen[k, True] >= 2 * max((seen[x, True] for x in words if x.startswith(k[:-1])), default=1)
    }
    return words, stems


def fit_logistic(x: np.ndarray, y: np.ndarray, steps: int = 25, ridge: float = 1e-2) -> list[float]:
    """Newton steps for an L2-regularised logistic regression with a bias."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(w))
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + penalty @ w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + penalty
        w = w - np.linalg.solve(hessian, gradient)
    return [float(v) for v in w]


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    ship_package(docs.sparkSession)
    rows = training_rows(docs, labels)
    words, stems = learn_lexicon(rows)
    model = Model(words, stems, [0.0, 0.0, 0.0, 0.0])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(words, stems, [0.0] * 4)
        for batch in batches:
            f = np.array([own.features(t.as_py()) for t in batch.column(0)], dtype=float).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [pa.array(f[:, 0]), pa.array(f[:, 1]), pa.array(f[:, 2]), batch.column(1)], names=["a", "b", "c", "toxic"]
            )

    found = rows.mapInArrow(run, "a double, b double, c double, toxic int").collect()
    y = np.array([float(r.toxic != 0) for r in found])
    if len(found) and 0 < y.sum() < len(y):
        model.coefficients = fit_logistic(np.array([[r.a, r.b, r.c] for r in found]), y)
    else:
        prior = (y.sum() + 0.5) / (len(y) + 10.0)
        model.coefficients = [math.log(prior / (1 - prior)), 0.0, 0.0, 0.0]
    return model


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    model = fit(docs, labels)
    words, stems, coefficients = model.lexicon.words, model.lexicon.stems, model.coefficients

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(words, stems, coefficients)
        for batch in batches:
            scores = [own.score(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(scores, pa.float64()),
                    pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                ],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "text")
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")
