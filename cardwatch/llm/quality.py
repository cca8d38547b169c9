"""Quality classifier: regularised quadratic discriminant.

Each text becomes a short vector of transformed statistics (:func:`statistics`,
one pass over its bytes and words).  Per class, a mean and a covariance are
summed over all labelled rows (Spark aggregates; no sample), the covariance is
shrunk towards the pooled one (the more, the fewer rows the class has for its
dimensions) and then towards its own diagonal, and its Cholesky factor is
cached in the model.  The score is the posterior of class 1:
the logistic of the difference of the two Gaussian log-densities, each from a
Mahalanobis distance solved with the cached factor, plus the log prior ratio,
divided by a temperature.

Defined cases: NULL and empty texts have the statistics of no word and are
scored like any text; labels without a document, or NULL labels, are ignored;
repeated labels count each time; with no labelled row every score is 0.5, with
one class only it is that class (0 or 1); an empty table gives an empty
result; existing columns of an output name are replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.common import held_out, quoted, python_workers, written

THRESHOLD = 0.3
#: Statistics of a text, in order.
STATISTICS = ("words", "word_length", "repeated_words", "common_word", "symbols", "upper", "digits", "stops",
              "line_words", "repeated_lines", "wide_words", "capitals", "mixed_words", "pairs")
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~!"]] = True
_MARKS = tuple(c.encode() for c in "#$%&*<>|{}!")


def _logit(part: float, whole: float) -> float:
    """Log odds of a share, with half a count added to either side."""
    return log((part + 0.5) / (max(whole - part, 0) + 0.5))


def statistics(text: str | None) -> list[float]:
    """Transformed statistics of one whole text."""
    data = (text or "").encode("utf-8")
    words = data.split()
    n = len(words)
    counts = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    size, breaks = int(counts.sum()), int(counts[10])
    upper, digits = int(counts[65:91].sum()), int(counts[48:58].sum())
    lower = int(counts[97:123].sum())
    symbols, stops = int(counts[_SYMBOL].sum()), int(counts[46] + counts[44])
    seen = Counter(words)
    lines = [x for x in data.split(b"\n") if x.strip()]
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    marked = sum(len(w) < 2 or w[-1:] in _MARKS for w in words)
    top = max(seen.values(), default=0)
    capitals = sum(w.isupper() for w in words)
    pairs = len(set(zip(words, words[1:])))
    return [log(1 + n), log(1 + (size - n) / max(n, 1)), _logit(repeats, n), _logit(top, n), _logit(symbols, size),
            _logit(upper, upper + lower), _logit(digits, size), _logit(stops, n), log(1 + n / (breaks + 1)),
            _logit(len(lines) - len(set(lines)), len(lines)), _logit(len(seen), n), _logit(capitals, n),
            _logit(marked, n), _logit(max(n - 1, 0) - pairs, max(n - 1, 0))]


def statistics_column(text: str | Column) -> Column:
    @F.pandas_udf("array<double>")
    def stats(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([statistics(t) for t in batch])

    return stats(F.col(text) if isinstance(text, str) else text)


@dataclass(frozen=True)
class Discriminant:
    """A fitted model: per class the log prior, mean and Cholesky factor."""

    constant: float | None
    log_priors: tuple[float, float] = (0.0, 0.0)
    means: tuple[np.ndarray, ...] = ()
    factors: tuple[np.ndarray, ...] = ()
    temperature: float = 1.0

    def log_density(self, x: np.ndarray, k: int) -> np.ndarray:
        z = np.linalg.solve(self.factors[k], (x - self.means[k]).T)
        return -0.5 * (z * z).sum(axis=0) - np.log(np.diag(self.factors[k])).sum()

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Posterior of class 1 for rows of statistics."""
        if self.constant is not None or not len(x):
            return np.full(len(x), self.constant or 0.0)
        odds = (self.log_density(x, 1) - self.log_density(x, 0)) / self.temperature
        odds += self.log_priors[1] - self.log_priors[0]
        return 1.0 / (1.0 + np.exp(-np.clip(odds, -500, 500)))


def _sums(dims: int):
    """Row sums of a partition per class: count, sums and products."""
    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = {}
        for b in batches:
            x = np.stack(b["stats"].to_numpy()) if len(b) else np.empty((0, dims))
            x = np.hstack([np.ones((len(x), 1)), x])
            for k in (0, 1):
                own = x[b["label"].to_numpy() == k]
                total[k] = total.get(k, 0) + own.T @ own
        rows = [(k, i, j, float(m[i, j])) for k, m in total.items() for i in range(dims + 1) for j in range(i + 1)]
        yield pd.DataFrame(rows, columns=["label", "i", "j", "v"])
    return sums


def fit(labelled: DataFrame, pooled: float = 0.1, diagonal: float = 0.05, temperature: float = 5.0) -> Discriminant:
    """Fit from all rows of ``labelled`` (``stats``, ``label`` 0 or 1).

    ``pooled`` is the least share of the pooled covariance in each class's
    (with n rows in d dimensions, d / (n + d) of the remainder comes on top),
    ``diagonal`` then the share of its diagonal.  What reaches the driver is
    one product matrix per class."""
    dims = len(STATISTICS)
    rows = (labelled.select("stats", F.col("label").cast("int").alias("label"))
            .mapInPandas(_sums(dims), "label int, i int, j int, v double")
            .groupBy("label", "i", "j").agg(F.sum("v").alias("v")).collect())
    m = np.zeros((2, dims + 1, dims + 1))
    for k, i, j, v in rows:
        m[k, i, j] = m[k, j, i] = v
    n = m[:, 0, 0]
    if not n.all():
        return Discriminant(float(n[1] > 0) if n.any() else 0.5)
    means = [m[k, 0, 1:] / n[k] for k in (0, 1)]
    own = [m[k, 1:, 1:] / n[k] - np.outer(means[k], means[k]) for k in (0, 1)]
    both = (own[0] * n[0] + own[1] * n[1]) / n.sum()
    factors = []
    for c, rows_of_class in zip(own, n):
        share = pooled + (1 - pooled) * dims / (rows_of_class + dims)
        c = (1 - share) * c + share * both
        c = (1 - diagonal) * c + diagonal * np.diag(np.diag(c)) + 1e-3 * np.eye(dims)
        factors.append(np.linalg.cholesky(c))
    return Discriminant(None, tuple(np.log(n / n.sum())), tuple(means), tuple(factors), temperature)


def score_column(model: Discriminant, stats: Column) -> Column:
    @F.pandas_udf("double")
    def score(batch: pd.Series) -> pd.Series:
        x = np.stack(batch.to_numpy()) if len(batch) else np.empty((0, len(STATISTICS)))
        return pd.Series(model.scores(x))

    return score(stats)


def text_score_column(model: Discriminant, text: Column) -> Column:
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.array([statistics(t) for t in texts]).reshape(len(texts), len(STATISTICS))))

    return score(text)


def _labelled(stats: DataFrame, labels: DataFrame, folds_out: bool) -> DataFrame:
    """Statistics of the rows to learn from, with their label."""
    marks = labels.select(F.col("doc_id"), F.col("quality").cast("int").alias("label")).where(
        F.col("label").isin(0, 1))
    rows = stats.where(~held_out("doc_id")) if folds_out else stats
    return rows.join(marks, "doc_id").select("stats", "label")


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``score``,
    ``predicted``.  Statistics are computed once and written (about a
    twentieth of the text); fitting and scoring read them."""
    python_workers(docs.sparkSession)
    stats = written(docs.select(F.col(id_col).alias("doc_id"), statistics_column(text_col).alias("stats")), "quality")
    model = fit(_labelled(stats, labels, True))
    return (stats.select("doc_id", held_out().alias("held_out"), score_column(model, F.col("stats")).alias("score"))
            .withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0)))


def keep_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier does not reject (their columns
    only).  Learns from the labelled rows outside the held-out fold."""
    python_workers(docs.sparkSession)
    chosen = docs.select(quoted(id_col).alias("doc_id"), quoted(text_col).alias("text")).where(~held_out("doc_id"))
    wanted = labels.select("doc_id", "quality").where(F.col("quality").isin(0, 1))
    stats = chosen.select("doc_id", statistics_column("text").alias("stats"))
    model = fit(_labelled(stats, wanted, False))
    return docs.where(text_score_column(model, quoted(text_col)) >= threshold)


def op2_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The digest columns of the registered query."""
    return score_quality(docs, labels)
