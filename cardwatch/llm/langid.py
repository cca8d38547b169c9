"""Language identification: sparse multinomial logistic regression.

* Features: character 1- to 3-grams of the whole lower-cased text (everything
  but letters counts as one space), hashed into ``DIMS`` buckets by numpy;
  weight 1 + log(count) times the inverse document frequency, at unit length.
* Document frequencies cover every row that may be learnt from: each task
  sends its sums, Spark adds them up, ``DIMS`` numbers reach the driver.
* Training: follow-the-regularised-leader (proximal, per-coordinate rates)
  with elastic-net penalties, over a bounded sample of at most
  ``SAMPLE_PER_CLASS`` rows per language: those whose hash of id, text and row
  number is smallest, so rows that share an id or a text are drawn one by one.
  The bound is a parameter; with fewer rows all are used.
* Calibration: one temperature, chosen on a fifth of the sample that training
  did not see, by log loss.

Defined cases: NULL text, or text without a letter, is ``und`` with score 0;
rows without a language teach nothing; with no row to learn from every
prediction is ``und``; with one language it is always predicted; an empty
table gives an empty result; repeated rows get equal results; of equal
probabilities the first language by name is predicted; long texts are read
whole, in pieces; more than ``MAX_LANGUAGES`` languages are an error (most
likely a wrong column); further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.llm.common import held_out, python_workers

DIMS_BITS = 14
DIMS = 1 << DIMS_BITS
SAMPLE_PER_CLASS = 1000
EPOCHS = 4
UNKNOWN = "und"
_MAYBE_LETTER = re.compile(r"[^\W\d_]")
_CHUNK = 1 << 20
_MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)


def has_letter(text: str | None) -> bool:
    return any(m[0].isalpha() for m in _MAYBE_LETTER.finditer(text or ""))


def _letters(text: str) -> np.ndarray:
    """Code points of the lower-cased text with everything else as spaces."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    keep = (points >= 0xC0) | ((points >= 97) & (points <= 122))
    return np.where(keep, points, np.uint32(32))


def gram_counts(text: str | None) -> np.ndarray:
    """Counts of the hashed 1- to 3-grams of a whole text."""
    counts = np.zeros(DIMS, dtype=np.int64)
    points = _letters(f" {text or ''} ")
    shift = np.uint32(32 - DIMS_BITS)
    for at in range(0, len(points), _CHUNK):  # pieces overlap by two, each start counts once
        p = points[at:at + _CHUNK + 2]
        h = p * _MIX[0]
        grams = [h[:_CHUNK]]
        for order in (1, 2):
            h = (h[:len(p) - order] ^ (p[order:] + np.uint32(order))) * _MIX[order]
            grams.append(h[:_CHUNK])
        for g in grams:
            counts += np.bincount((g ^ (g >> np.uint32(15))) * _MIX[0] >> shift, minlength=DIMS)
    return counts


def _weights(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and unit-length TF-IDF weights of a document."""
    at = np.flatnonzero(counts)
    w = (1.0 + np.log(counts[at])) * idf[at]
    return at, w / max(float(np.sqrt(w @ w)), 1e-12)


def _frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    df = np.zeros(DIMS + 1, dtype=np.int64)
    for b in batches:
        for text in b["text"]:
            df[:DIMS] += gram_counts(text) > 0
        df[DIMS] += len(b)
    at = np.flatnonzero(df)
    yield pd.DataFrame({"gram": at, "n": df[at]})


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """Inverse document frequencies over all rows of ``text``."""
    df = np.zeros(DIMS + 1)
    sums = docs.select("text").mapInPandas(_frequencies, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    for gram, n in sums.collect():  # at most DIMS + 1 rows
        df[gram] = n
    return np.log((1.0 + df[DIMS]) / (1.0 + df[:DIMS])) + 1.0


@dataclass(frozen=True)
class LanguageModel:
    classes: tuple[str, ...]
    idf: np.ndarray
    coef: np.ndarray  # (DIMS, classes), mostly zeros
    bias: np.ndarray
    temperature: float = 1.0

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.classes or not has_letter(text):
            return UNKNOWN, 0.0
        at, w = _weights(gram_counts(text), self.idf)
        p = _softmax((w @ self.coef[at] + self.bias) / self.temperature)
        best = int(p.argmax())
        return self.classes[best], float(p[best])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], n_classes: int, alpha: float = 0.5, beta: float = 1.0,
               l1: float = 0.05, l2: float = 0.01, epochs: int = EPOCHS, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal with elastic net, one example at a time.

    z gathers gradients less the proximal term, n squared gradients; a weight
    is zero while |z| <= l1.  The bias (last row) is not penalised."""
    z, n = np.zeros((DIMS + 1, n_classes)), np.zeros((DIMS + 1, n_classes))
    penalty = np.r_[np.full(DIMS, l1), 0.0][:, None]
    ridge = np.r_[np.full(DIMS, l2), 0.0][:, None]

    def weights(at):
        excess = np.maximum(np.abs(z[at]) - penalty[at], 0.0)
        return -np.sign(z[at]) * excess / ((beta + np.sqrt(n[at])) / alpha + ridge[at])

    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, x, label = rows[i]
            at, x = np.r_[at, DIMS], np.r_[x, 1.0]
            w = weights(at)
            error = _softmax(x @ w)
            error[label] -= 1.0
            g = x[:, None] * error[None, :]
            grown = n[at] + g * g
            z[at] += g - (np.sqrt(grown) - np.sqrt(n[at])) / alpha * w
            n[at] = grown
    w = weights(np.arange(DIMS + 1))
    return w[:DIMS], w[DIMS]


def best_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, from a geometric grid."""
    if not len(labels):
        return 1.0
    grid = np.geomspace(0.05, 5.0, 60)
    loss = [-np.log(_softmax(logits / t)[np.arange(len(labels)), labels] + 1e-12).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def _sample(rows: DataFrame, per_class: int) -> DataFrame:
    """``per_class`` rows of each language (all, if fewer): the smallest by a
    hash of the whole row and its number.  Twice as many pass a first
    threshold, set from the language's count, so the ranking is bounded."""
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    rate = F.least(F.lit(1.0), F.lit(2.0 * per_class) / F.col("n"))
    numbered = rows.withColumn("_place", F.xxhash64("doc_id", "text", F.monotonically_increasing_id()))
    passed = (numbered.join(F.broadcast(counts.limit(MAX_LANGUAGES)), "lang")
              .where(F.pmod("_place", F.lit(1 << 40)) / F.lit(float(1 << 40)) < rate))
    ranked = Window.partitionBy("lang").orderBy(F.pmod("_place", F.lit(1 << 40)), "_place")
    return passed.withColumn("_rank", F.row_number().over(ranked)).where(F.col("_rank") <= per_class).drop("_rank", "_place", "n")


#: Languages beyond this many most likely mean a wrong column.
MAX_LANGUAGES = 1000


def fit(rows: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> LanguageModel:
    """Fit from ``rows`` (doc_id, text, lang)."""
    rows = rows.where(F.col("lang").isNotNull())
    languages = sorted(r[0] for r in rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError("too many languages")
    if not languages:
        return LanguageModel((), np.zeros(DIMS), np.zeros((DIMS, 0)), np.zeros(0))
    idf = inverse_frequencies(rows)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            pairs = [_weights(gram_counts(t), idf) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("string"), "lang": b["lang"],
                                "at": [p[0].astype(np.int32).tobytes() for p in pairs],
                                "w": [p[1].astype(np.float32).tobytes() for p in pairs]})

    sample = _sample(rows, per_class).select("doc_id", "text", "lang").mapInPandas(
        features, "doc_id string, lang string, at binary, w binary").collect()
    sample.sort(key=lambda r: (r.lang, r.doc_id or "", bytes(r.at)))
    number = {lang: i for i, lang in enumerate(languages)}
    examples = [(np.frombuffer(r.at, dtype=np.int32), np.frombuffer(r.w, dtype=np.float32).astype(float), number[r.lang])
                for r in sample]
    fold = np.random.default_rng(5).permutation(len(examples)) % 5 == 0
    if len(examples) < 20:
        fold[:] = False
    coef, bias = train_ftrl([e for e, f in zip(examples, fold) if not f], len(languages))
    kept_out = [e for e, f in zip(examples, fold) if f]
    logits = np.array([x @ coef[at] + bias for at, x, _ in kept_out])
    temperature = best_temperature(logits, np.array([e[2] for e in kept_out]))
    return LanguageModel(tuple(languages), idf, coef.astype(np.float32), bias, temperature)


def language_column(model: LanguageModel, text: Column) -> Column:
    """(lang_pred, score) of whole texts."""
    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.predict(t) for t in texts], columns=["lang_pred", "score"])

    return predict(text)


def predict_languages(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``lang_pred``, ``score``.  The model
    (``DIMS`` by languages) travels with the task."""
    python_workers(docs.sparkSession)
    return (docs.select(F.col(id_col).alias("doc_id"), language_column(model, F.col(text_col)).alias("p"))
            .select("doc_id", "p.lang_pred", "p.score"))


def op9_langid(docs: DataFrame) -> DataFrame:
    """The digest columns of the registered query: learns outside the held-out fold."""
    python_workers(docs.sparkSession)
    model = fit(docs.select("doc_id", "text", "lang").where(~held_out()))
    return predict_languages(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
