"""Quality classifier: regularised quadratic discriminant analysis of document statistics.

Each text becomes a short vector of transformed statistics. A class is a Gaussian whose covariance
is shrunk towards the pooled covariance and towards a diagonal. The score is the logistic of the
difference of the two log densities, each from the Mahalanobis distance through the Cholesky
factor, computed once when the model is fitted.

Defined cases: a null text counts as empty; an empty text has statistics of 0 and gets a score like
any other; repeated rows are scored alike; extra columns play no part. Without examples of both
classes every score is the share of label 1 among the examples (0.5 without any).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from lodeseam.llm.common import doc_labels, sized

STATISTICS = ("distinct", "word_length", "upper", "digits", "stops", "symbols", "non_ascii",
              "distinct_lines", "line_length", "repeats", "marked")
#: Statistics of a text are mixed with those of this many plain words, so that a handful of words
#: does not look extreme: characters and stops per word, words per line.
PRIOR, CHARS, STOPS, PER_LINE = 5, 6.0, 0.1, 20
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "!#$%&*+/<=>?@\\^_`{|}~"]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".,;:"]] = True


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of one whole text, in the order of STATISTICS."""
    text = text or ""
    words = text.split()
    n = len(words)
    if n == 0:
        return [0.0] * len(STATISTICS)
    raw = text.encode("utf-8", "surrogatepass")
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, lower, digits = seen[65:91].sum(), seen[97:123].sum(), seen[48:58].sum()
    lines = text.split("\n")
    symbols = seen[_SYMBOL].sum()
    share = lambda part, whole: float(np.arcsin(np.sqrt(min(1.0, part / max(1, whole)))))
    n_chars = len(raw) + PRIOR * CHARS
    return [
        float(np.log(len(set(words)) + PRIOR) - np.log(n + PRIOR)),
        float(np.log((len(text) + PRIOR * CHARS) / (n + PRIOR))),
        share(upper, upper + lower + PRIOR * CHARS),
        share(digits, n_chars),
        share(seen[_STOP].sum() + PRIOR * STOPS, n + PRIOR),
        float(np.log1p(10 * symbols / (n + PRIOR))),
        share(seen[128:].sum(), n_chars),
        share(len(set(lines)) + PRIOR, len(lines) + PRIOR),
        float(np.log1p((n + PRIOR * PER_LINE) / (len(lines) + PRIOR))),
        share(sum(map(eq, words, words[1:])), n + PRIOR),
        share(symbols, n_chars),
    ]


def _matrix(texts: pd.Series) -> np.ndarray:
    return np.array([statistics(t) for t in texts], float).reshape(-1, len(STATISTICS))


@dataclass(frozen=True)
class Discriminant:
    """Two Gaussians over the statistics; ``factors`` are inverse Cholesky factors, kept ready."""

    share: float
    means: np.ndarray | None = None
    factors: np.ndarray | None = None
    offset: float = 0.0

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(x), self.share)
        distance = [(((x - m) @ f.T) ** 2).sum(axis=1) for m, f in zip(self.means, self.factors)]
        return 1 / (1 + np.exp(-np.clip(self.offset + (distance[0] - distance[1]) / 2, -700, 700)))


def moments(labelled: DataFrame) -> DataFrame:
    """(label, i, j, value): per class the sums of x_i x_j over (text, label); x_0 is 1."""
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = len(STATISTICS) + 1
        total = np.zeros((2, size, size))
        for batch in batches:
            x = np.hstack([np.ones((len(batch), 1)), _matrix(batch["text"])])
            for label in (0, 1):
                part = x[(batch["label"] == label).to_numpy()]
                total[label] += part.T @ part
        label, i, j = np.nonzero(np.triu(np.ones((size, size)))[None] * np.ones((2, 1, 1)))
        yield pd.DataFrame({"label": label, "i": i, "j": j, "value": total[label, i, j]})
    sums = labelled.select("text", "label").mapInPandas(partial, "label int, i int, j int, value double")
    return sums.groupBy("label", "i", "j").agg(F.sum("value").alias("value"))


def fit(documents: DataFrame, labels: DataFrame, to_pooled: float = 0.3,
        to_diagonal: float = 0.05) -> Discriminant:
    """Fit on every labelled row outside the held-out fifth.

    A class covariance S becomes (1 - to_diagonal) ((1 - to_pooled) S + to_pooled P) + to_diagonal
    diag(P), with P the pooled covariance. Only sums of products reach the driver: their number
    depends on the number of statistics alone.
    """
    examples = documents.select("doc_id", "text").join(sized(doc_labels(labels, "quality")), "doc_id")
    size = len(STATISTICS) + 1
    total = np.zeros((2, size, size))
    for r in moments(examples).collect():
        total[r.label, r.i, r.j] = total[r.label, r.j, r.i] = r.value
    n = total[:, 0, 0]
    if not n.all():
        return Discriminant(float(n[1] / n.sum()) if n.sum() else 0.5)
    means = total[:, 0, 1:] / n[:, None]
    covariances = total[:, 1:, 1:] / n[:, None, None] - means[:, :, None] * means[:, None, :]
    pooled = (covariances * n[:, None, None]).sum(axis=0) / n.sum()
    diagonal = np.diag(np.diag(pooled) + 1e-6)
    shrunk = (1 - to_diagonal) * ((1 - to_pooled) * covariances + to_pooled * pooled) + to_diagonal * diagonal
    cholesky = np.linalg.cholesky(shrunk)
    spread = 2 * np.log(np.diagonal(cholesky, axis1=1, axis2=2)).sum(axis=1)
    return Discriminant(float(n[1] / n.sum()), means, np.linalg.inv(cholesky),
                        float(np.log(n[1] / n[0]) + (spread[0] - spread[1]) / 2))


def score(model: Discriminant, text: Column) -> Column:
    """The model's score of a text column, 0 to 1, higher where label 1 is likelier."""
    @pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(_matrix(texts)))
    return scored(text)
