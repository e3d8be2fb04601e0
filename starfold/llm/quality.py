"""Quality scores of documents: ridge regression on random Fourier features, calibrated.

A text is described by a fixed number of statistics. Random Fourier features of the standardised
statistics approximate a Gaussian kernel. The normal equations of the ridge regression are sums over
rows, which each partition adds up for itself; only their sum is solved on the driver. Isotonic
regression over a bounded number of score bins turns scores into probabilities.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.llm.common import held_out, labelled, written

_CLASSES = np.zeros(256, np.int64)
for _i, _chars in enumerate(
    (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\f\v",
     b"\n", b".,;:'\"-?()", b"!", b"#$%&*+<=>@[\\]^_`{|}~/"), start=1
):
    _CLASSES[list(_chars)] = _i
_TERMINAL = re.compile(r"[.!?][\"')\]]?\s*(?:\n|$)")
STATISTICS = 22


def describe(text: str | None) -> list[float]:
    """``STATISTICS`` numbers about a whole text; null counts as empty."""
    text = text or ""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    size = max(len(raw), 1)
    kinds = np.bincount(_CLASSES, weights=np.bincount(raw, minlength=256), minlength=9) / size
    words = text.split()
    n = max(len(words), 1)
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    lines = [line for line in text.split("\n") if line.strip()]
    pairs = len(set(zip(words, words[1:], strict=False)))
    most = counts.most_common(1)[0][1] if counts else 0
    ends = sum(not w[-1].isalnum() for w in words)
    strange = sum(not w[-1].isalnum() and w[-1] not in ".,;:?)'\"" for w in words)
    per_line = np.array([len(line) for line in lines] or [0])
    p = np.array(list(counts.values()) or [1]) / n
    return [
        float(np.log1p(len(text))), float(np.log1p(len(words))), *kinds.tolist(),
        float(lengths.mean()) if len(words) else 0.0, float(lengths.std()) if len(words) else 0.0,
        len(counts) / n, pairs / max(len(words) - 1, 1), most / n, ends / n, strange / n,
        len(set(lines)) / max(len(lines), 1), float(np.log1p(per_line.mean())),
        len(_TERMINAL.findall(text)) / max(len(lines), 1),
        float(-(p * np.log(p)).sum() / np.log(n + 1)),
    ]


class Model:
    """Features ``sqrt(2 / m) cos(W x + b)`` of standardised statistics, and what was fitted."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, features: int, width: float, seed: int):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        self.w = rng.normal(0.0, 1.0 / width, (len(mean), features))
        self.b = rng.uniform(0.0, 2 * np.pi, features)
        self.weights: np.ndarray | None = None
        self.knots: tuple[np.ndarray, np.ndarray] = (np.array([0.0]), np.array([0.5]))

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6.0, 6.0)
        waves = np.sqrt(2.0 / len(self.b)) * np.cos(z @ self.w + self.b)
        return np.hstack([waves, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights if self.weights is not None else np.zeros(len(x))

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), *self.knots), 0.0, 1.0)


def isotonic(y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Non-decreasing values nearest to ``y``: adjacent blocks out of order are pooled."""
    blocks: list[list[float]] = []
    for value, w in zip(y, weight, strict=True):
        blocks.append([value, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v, w1, n = blocks.pop()
            u, w0, m = blocks.pop()
            blocks.append([(u * w0 + v * w1) / (w0 + w1), w0 + w1, m + n])
    return np.concatenate([np.full(int(n), v) for v, _, n in blocks])


def _matrix(batch: pd.DataFrame) -> np.ndarray:
    return np.array(batch["stats"].tolist(), dtype=float).reshape(len(batch), STATISTICS)


def fit(
    examples: DataFrame, features: int = 256, width: float = 4.0, ridge: float = 1e-3,
    bins: int = 200, seed: int = 7,
) -> Model:
    """Fit on ``stats`` (array of numbers) and ``y`` (0 or 1). Only sums reach the driver: moments,
    the normal equations of ``features + 1`` unknowns, and counts of ``bins`` score bins. Without
    examples every score is 0.5; with one class only, its share."""
    moments = examples.agg(
        F.count("*").alias("n"),
        *[F.avg(F.col("stats")[i]).alias(f"m{i}") for i in range(STATISTICS)],
        *[F.stddev_pop(F.col("stats")[i]).alias(f"s{i}") for i in range(STATISTICS)],
    ).first()
    mean = np.array([moments[f"m{i}"] or 0.0 for i in range(STATISTICS)])
    scale = np.array([moments[f"s{i}"] or 0.0 for i in range(STATISTICS)])
    model = Model(mean, np.where(scale > 1e-9, scale, 1.0), features, width, seed)
    if not moments["n"]:
        return model

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((features + 1, features + 2))
        for batch in batches:
            z = model.features(_matrix(batch))
            total[:, :-1] += z.T @ z
            total[:, -1] += z.T @ batch["y"].to_numpy(float)
        yield pd.DataFrame({"row": np.arange(features + 1), "sums": list(total)})

    partial = examples.mapInPandas(sums, "row int, sums array<double>")
    cells = partial.select("row", F.posexplode("sums").alias("column", "value"))
    cells = cells.groupBy("row", "column").agg(F.sum("value").alias("value"))
    normal = np.zeros((features + 1, features + 2))
    for r in cells.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("column", "value"))).alias("c")).collect():
        normal[r.row] = [c.value for c in r.c]
    penalty = ridge * moments["n"] * np.eye(features + 1)
    penalty[-1, -1] = 0.0
    model.weights = np.linalg.solve(normal[:, :-1] + penalty + 1e-9 * np.eye(features + 1), normal[:, -1])

    def binned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raw = model.raw(_matrix(batch))
            place = np.clip((raw + 0.5) / 2.0 * bins, 0, bins - 1).astype(int)
            yield pd.DataFrame({"bin": place, "raw": raw, "y": batch["y"].to_numpy(float)})

    counts = examples.mapInPandas(binned, "bin int, raw double, y double").groupBy("bin").agg(
        F.count("*").alias("n"), F.avg("raw").alias("raw"), F.avg("y").alias("y")
    ).orderBy("bin").toPandas()
    fitted = isotonic(counts["y"].to_numpy(), counts["n"].to_numpy(float))
    model.knots = _knots(counts["raw"].to_numpy(), fitted, counts["n"].to_numpy(float))
    return model


def _knots(raw: np.ndarray, fitted: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One knot in the middle of each pooled block, so that scores rise between blocks too."""
    edges = np.flatnonzero(np.diff(fitted)) + 1
    parts = np.split(np.arange(len(fitted)), edges)
    return (
        np.array([np.average(raw[p], weights=n[p]) for p in parts]), np.array([fitted[p[0]] for p in parts])
    )


def score_documents(
    docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0, threshold: float = 0.3,
    rows: int = 200_000, **fitting,
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    At most ``rows`` labels of documents that are not held out are learned from; a document with
    contradicting labels counts for both. Null and empty texts have the statistics of the empty text.
    Repeated rows stay repeated; a null doc_id is scored, not learned from. Scores depend on nothing
    but the text.
    """
    statistics = F.udf(describe, "array<double>", useArrow=False)
    stats = written(docs.select("doc_id", statistics("text").alias("stats")), "quality_statistics")
    chosen = labelled(labels, "quality", folds, fold, rows)
    model = docs.sparkSession.sparkContext.broadcast(fit(stats.join(chosen, "doc_id"), **fitting))

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            scored = batch[["doc_id"]].copy()
            scored["score"] = model.value.score(_matrix(batch))
            yield scored

    doc_id = stats.schema["doc_id"].dataType.simpleString()
    scored = stats.mapInPandas(apply, f"doc_id {doc_id}, score double")
    return scored.select(
        "doc_id", held_out("doc_id", folds, fold).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
