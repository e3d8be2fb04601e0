"""Toxic passages by maximum-scoring segments, and scores of documents by extreme values.

Every word has log-odds between toxic and other documents, with a Dirichlet prior in proportion to
the word's share of all: a word seen once says little. Log-odds are shrunk towards zero by their
uncertainty, and every other word costs a little, so the scores of ordinary text drift downwards.
A linear scan finds all maximal segments: passages of positive score that no longer or shorter
passage improves on. The best segment of ordinary text of n words follows an extreme-value
distribution, from which its surprise is read; a logistic curve turns surprise into a probability.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.llm.common import free, held_out, labelled, written

_WORD = regex.compile(r"[\w\p{M}]+")
#: A word that comes again within so many words counts half as much as the time before: saying it over
#: and over is some further evidence, but never more than that of two.
REPEAT = 30
_PASSAGE = "array<struct<first: bigint, last: bigint, score: double>>"


def words_of(text: str | None) -> list[str]:
    """Words in lower case, with their combining marks: the same when learning and when scoring."""
    return _WORD.findall((text or "").lower())


def word_scores(
    counts: DataFrame, prior: float = 0.1, shrink: float = 1.64, vocabulary: int = 1_000_000
) -> dict[str, float]:
    """Scores of words from ``word, toxic, other`` counts: log-odds with a prior of ``prior`` times as
    many words as there are, nearer to zero by ``shrink`` standard deviations. All words of positive
    score are the model, all others count as ordinary. More than ``vocabulary`` words, which the
    labelled documents are too few for, are an error: none is left out."""
    totals = counts.agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).first()
    toxic, other = float(totals.toxic or 0), float(totals.other or 0)
    if not toxic or not other:
        return {}
    share, prior = prior * (F.col("toxic") + F.col("other")), prior * (toxic + other)
    a, b = F.col("toxic") + share, F.col("other") + share
    odds = F.log(a / (toxic + prior - a)) - F.log(b / (other + prior - b))
    deviation = F.sqrt(1 / a + 1 / b)
    scored = counts.select("word", (odds - shrink * deviation).alias("score")).where("score > 0")
    found = scored.limit(vocabulary + 1).collect()
    if len(found) > vocabulary:
        raise ValueError(f"more than {vocabulary} words speak for a toxic text; learn from fewer documents")
    return {r.word: r.score for r in found}


def count_words(examples: DataFrame) -> DataFrame:
    """``word, toxic, other``: in how many documents of each class (``y``) a word occurs."""
    words = F.udf(lambda text: list(set(words_of(text))), "array<string>", useArrow=False)
    return (
        examples.select("y", F.explode_outer(words("text")).alias("word")).where("word is not null").groupBy("word")
        .agg(F.sum("y").alias("toxic"), F.sum(1 - F.col("y")).alias("other"))
    )


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments ``(first, last, score)``, in order, in linear time.

    Runs of positive scores are joined with earlier candidates: each keeps the running total before
    it and after it; a new one reaches back to the nearest candidate that began lower, and swallows
    all up to it if it ends higher than that one.
    """
    positive = np.flatnonzero(scores > 0)
    if not len(positive):
        return []
    total = np.concatenate([[0.0], np.cumsum(scores)])
    cuts = np.flatnonzero(np.diff(positive) > 1) + 1
    found: list[list] = []  # first, last, total before, total after, nearest that began lower
    for run in np.split(positive, cuts):
        new = [int(run[0]), int(run[-1]), total[run[0]], total[run[-1] + 1], -1]
        while True:
            at = len(found) - 1
            while at >= 0 and found[at][2] >= new[2]:
                at = found[at][4]
            new[4] = at
            if at < 0 or found[at][3] >= new[3]:
                break
            new[0], new[2] = found[at][0], found[at][2]
            del found[at:]
        found.append(new)
    return [(first, last, float(end - start)) for first, last, start, end, _ in found]


class Model:
    """Word scores, the cost of any other word, and the calibration: ``rate`` and ``log_k`` of the
    extreme-value distribution, ``curve`` of the logistic."""

    def __init__(self, words: dict[str, float], cost: float):
        self.words, self.cost = words, cost
        self.rate, self.log_k = 1.0, 0.0
        self.curve = (0.0, 0.0)

    def passages(self, text: str | None) -> tuple[int, list[tuple[int, int, float]]]:
        words = words_of(text)
        scores = np.fromiter(map(self.words.get, words, repeat(-self.cost)), float, len(words))
        last: dict[str, tuple[int, int]] = {}  # where a word was seen, and how often in that stretch
        for at in np.flatnonzero(scores > 0).tolist():
            before, times = last.get(words[at], (at - REPEAT - 1, 0))
            times = times + 1 if at - before <= REPEAT else 0
            scores[at] *= 0.5**times
            last[words[at]] = at, times
        return len(words), segments(scores)

    def surprise(self, best: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Minus the logarithm of the chance that ordinary text of ``n`` words has a segment of
        ``best`` or more."""
        expected = np.exp(np.clip(self.log_k + np.log(np.maximum(n, 1)) - self.rate * best, -600, 30))
        return -np.log(np.maximum(-np.expm1(-expected), 1e-300))

    def probability(self, best: np.ndarray, n: np.ndarray) -> np.ndarray:
        a, b = self.curve
        return 1 / (1 + np.exp(-np.clip(a + b * np.minimum(self.surprise(best, n), 60.0), -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Intercept and slope, slightly regularised, by Newton's method."""
    design = np.stack([np.ones(len(x)), x], axis=1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (y - p) - 1e-2 * beta
        bend = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        beta = beta + np.clip(np.linalg.solve(bend, slope), -2, 2)
    return float(beta[0]), float(max(beta[1], 0.0))


def fit(examples: DataFrame, cost: float = 0.25, folds: int = 2) -> Model:
    """Fit on ``doc_id, text, y``, a bounded number of rows. The words of each half of the documents
    score the other half, so that the calibration sees words the way a new text shows them; then
    all documents give the final words."""
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(folds))
    examples = written(examples.select("doc_id", "text", "y", half.alias("half")), "toxicity_examples")
    spark = examples.sparkSession
    rows = []
    for fold in range(folds):
        words = word_scores(count_words(examples.where(F.col("half") != fold)))
        part = spark.sparkContext.broadcast(Model(words, cost))
        best = _best(part)
        rows += examples.where(F.col("half") == fold).select("y", best("text").alias("b")).collect()
    model = Model(word_scores(count_words(examples)), cost)
    y = np.array([r.y for r in rows], float)
    if not len(y) or y.min() == y.max():
        model.curve = (-30.0 if not y.sum() else 30.0, 0.0)
        return model
    top, n = np.array([r.b.score for r in rows]), np.array([r.b.n for r in rows], float)
    # best segments of ordinary documents, less the logarithm of their length: a Gumbel distribution
    ordinary = (y == 0) & (top > 0)
    spread = float(top[ordinary].std()) if ordinary.sum() > 1 else 1.0
    model.rate = min(np.pi / (np.sqrt(6) * max(spread, 0.2)), 3.0)
    share = ordinary.sum() / max((y == 0).sum(), 1)
    centre = np.mean(model.rate * top[ordinary] - np.log(np.maximum(n[ordinary], 1))) if ordinary.any() else 0.0
    model.log_k = float(centre - np.euler_gamma + np.log(max(share, 1e-3)))
    model.curve = _logistic(np.minimum(model.surprise(top, n), 60.0), y)
    return model


def _best(model):
    """UDF: number of words and best segment score of a text."""

    def run(text):
        n, found = model.value.passages(text)
        return n, max((s for _, _, s in found), default=0.0)

    return F.udf(run, "struct<n: bigint, score: double>", useArrow=False)


def learn(docs: DataFrame, labels: DataFrame, folds: int = 3, fold: int = 1, rows: int = 20_000):
    """Broadcast model of at most ``rows`` labelled documents that are not held out. Contradicting
    labels of a document both count; repeated documents count once."""
    chosen = labelled(labels, "toxic", folds, fold, rows)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    examples = texts.groupBy("doc_id", "y").agg(F.max("text").alias("text"))
    return docs.sparkSession.sparkContext.broadcast(fit(examples))


def scored(docs: DataFrame, model, name: str) -> DataFrame:
    """``docs`` with ``name``, which must be free: ``score`` (0 to 1) and ``passages`` (first and last word, from 0, and
    the probability that the passage alone gives). Null and empty texts have no passage."""

    def run(text):
        n, found = model.value.passages(text)
        best = np.array([s for _, _, s in found] or [0.0])
        chance = model.value.probability(best, np.full(len(best), n))
        listed = [(a, b, float(p)) for (a, b, _), p in zip(found, chance, strict=False) if p >= 0.5]
        return float(chance.max()), listed

    mark = F.udf(run, f"struct<score: double, passages: {_PASSAGE}>", useArrow=False)
    return docs.withColumn(name, mark("text"))


def score_documents(
    docs: DataFrame, labels: DataFrame, folds: int = 3, fold: int = 1, threshold: float = 0.7
) -> DataFrame:
    """``doc_id, held_out, score, predicted, passages`` for every row of ``docs``. Repeated rows stay
    repeated; a null doc_id is scored, not learned from. Scores depend on nothing but the text."""
    own = docs.select("doc_id", "text")
    marked = scored(own, learn(own, labels, folds, fold), "_toxic")
    return marked.select(
        "doc_id", held_out("doc_id", folds, fold).alias("held_out"), F.col("_toxic.score").alias("score"),
        (F.col("_toxic.score") >= threshold).cast("int").alias("predicted"),
        F.col("_toxic.passages").alias("passages"),
    )


def reject(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """``docs`` without those that score ``threshold`` or more, with all their columns, whatever their
    names. Null and empty texts have no passage and stay; repeated rows share their fate; an empty
    table stays empty."""
    (name,) = free(docs, "_toxic")
    kept = scored(docs, learn(docs, labels), name).where(F.col(f"{name}.score") < threshold)
    return kept.select(docs.columns)
