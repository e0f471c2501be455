"""Toxicity: a linear classifier of character n-grams scaled by naive Bayes log-count ratios.

The features of a text are the distinct character n-grams of its lower-cased words (with the white
space around them), hashed. Each is scaled by the log ratio of its smoothed document counts in toxic
and other texts, and a logistic regression is trained on the scaled features.

Defined cases: a null text counts as empty; a text without words scores the model's bias; repeated
rows are scored alike; extra columns play no part. Without examples of both classes every score is
the share of toxic examples (0 without any).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from lodeseam.llm.common import doc_labels

BITS = 20
SIZES = (3, 4, 5, 6)
#: Bounds of the fit: examples of each class, and n-grams kept.
MAX_EXAMPLES = 12_000
MAX_FEATURES = 4_000
_MULTIPLIER = np.uint32(0x01000193)
_MIX = np.uint32(0x9E3779B1)


def grams(text: str | None) -> np.ndarray:
    """The distinct hashed n-grams of a whole text, ascending."""
    words = set((text or "").lower().split())
    raw = np.frombuffer(f" {' '.join(words)} ".encode("utf-8", "surrogatepass"), np.uint8)
    values, spaces = raw.astype(np.uint32), np.concatenate(([0], np.cumsum(raw == 32)))
    found, rolling = [], np.zeros(len(values), np.uint32)
    for n in range(1, max(SIZES) + 1):
        keep = len(values) - n + 1
        if not words or keep <= 0:
            break
        rolling = rolling[:keep] * _MULTIPLIER + values[n - 1:]
        if n in SIZES:  # no white space strictly inside
            inside = spaces[n - 1:n - 1 + keep] == spaces[1:1 + keep]
            mixed = (rolling[inside] + np.uint32(n)) * _MIX
            found.append((mixed ^ (mixed >> np.uint32(15))) & np.uint32((1 << BITS) - 1))
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint32)


@dataclass(frozen=True)
class Linear:
    """``weights`` over the hashed n-grams: the trained weight times the log-count ratio."""

    share: float
    bias: float = 0.0
    weights: np.ndarray | None = None

    def score(self, text: str | None) -> float:
        if self.weights is None:
            return self.share
        return float(1 / (1 + np.exp(-np.clip(self.bias + self.weights[grams(text)].sum(), -700, 700))))


def examples(documents: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES) -> DataFrame:
    """(text, label): up to ``max_examples`` texts of each class, those of smallest id hash."""
    usable = doc_labels(labels, "toxic")
    of_class = [usable.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_examples)
                for k in (0, 1)]
    chosen = of_class[0].union(of_class[1])  # at most 2 * max_examples ids by construction
    return documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "label")


def _gram_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        counts = np.zeros((2, 1 << BITS), np.int32)
        for text, label in zip(batch["text"], batch["label"]):
            counts[label, grams(text)] += 1
        gram = np.flatnonzero(counts.any(axis=0))
        yield pd.DataFrame({"gram": gram, "other": counts[0, gram], "toxic": counts[1, gram]})


def fit(documents: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES,
        max_features: int = MAX_FEATURES, penalty: float = 1e-3, steps: int = 300) -> Linear:
    """Fit on a bounded sample of the labelled rows outside the held-out fifth.

    The driver receives the ``max_features`` n-grams that say most of a class (ratio times the share
    of the class that holds the n-gram) and, per example, which of those it holds.
    """
    sample = examples(documents, labels, max_examples).persist()
    try:
        n = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
        if not (n.get(0) and n.get(1)):
            return Linear(1.0 if n.get(1) else 0.0)
        counts = sample.mapInPandas(_gram_rows, "gram int, other int, toxic int").groupBy("gram").agg(
            F.sum("other").alias("other"), F.sum("toxic").alias("toxic"))
        p, q = (F.col("toxic") + 1) / (n[1] + 2.0), (F.col("other") + 1) / (n[0] + 2.0)
        top = (counts.withColumn("ratio", F.log(p / q))
               .withColumn("rank", F.greatest(F.col("ratio") * F.col("toxic") / n[1],
                                              -F.col("ratio") * F.col("other") / n[0]))
               .orderBy(F.desc("rank"), "gram").limit(max_features).select("gram", "ratio").collect())
        gram = np.array([r.gram for r in top], np.int64)
        ratio = np.array([r.ratio for r in top])
        column = np.full(1 << BITS, -1, np.int32)
        column[gram] = np.arange(len(gram))

        def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                held = (column[grams(t)] for t in batch["text"])
                yield pd.DataFrame({"label": batch["label"], "held": [h[h >= 0].tobytes() for h in held]})
        rows = sample.mapInPandas(features, "label int, held binary").collect()
    finally:
        sample.unpersist()
    held = [np.frombuffer(r.held, np.int32) for r in rows]
    weight, bias = _logistic([ratio[h] for h in held], held, np.array([r.label for r in rows], float),
                             len(gram), penalty, steps)
    weights = np.zeros(1 << BITS, np.float32)
    weights[gram] = weight * ratio
    return Linear(n[1] / (n[0] + n[1]), bias, weights)


def _logistic(values: list, columns: list, y: np.ndarray, width: int, penalty: float,
              steps: int) -> tuple[np.ndarray, float]:
    """Weights and bias by full-batch Adam; both classes weigh the same, the bias is free."""
    row = np.repeat(np.arange(len(y)), [len(c) for c in columns])
    column, value = np.concatenate(columns), np.concatenate(values)
    cost = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    w, first, second = np.zeros(width + 1), np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, steps + 1):
        z = np.bincount(row, value * w[column], len(y)) + w[-1]
        slope = cost * (1 / (1 + np.exp(-np.clip(z, -700, 700))) - y)
        gradient = np.append(np.bincount(column, value * slope[row], width) + penalty * w[:-1], slope.sum())
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient ** 2
        w -= 0.05 * first / (1 - 0.9 ** step) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-9)
    return w[:-1], float(w[-1])


def score(model: Linear, text: Column) -> Column:
    """The model's score of a text column, 0 to 1, higher where toxicity is likelier."""
    @pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype=float)
    return scored(text)
