"""Quality scores learnt from preferences between pairs of documents.

Every text is reduced to a few shares (of capitals, signs, repeated words and so on). Of two labelled
documents the one with the better label is preferred; a weight per feature is learnt so that the logistic
function of the weighted feature difference gives the odds of the preference (the Bradley-Terry model with
scores linear in the features). A document's own weighted sum is then its score; the threshold is the
quantile of the sample's scores at the share of its bad documents.

The labelled sample is bounded: ``max_labelled`` documents, those with the smallest hashes of their ids.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import held_out, with_struct

MAX_LABELLED = 20_000
PAIRS_PER_DOCUMENT = 20
MAX_PAIRS = 100_000
RIDGE = 1e-3
SEED = 11

_KIND = np.zeros(256, np.int64)  # 0: other ASCII sign
for _bytes, _kind in ((range(97, 123), 1), (range(65, 91), 2), (range(48, 58), 3), (b" \t", 4), (b"\n\r", 5), (b".,;:'\"?-()", 6),
                      (b"!", 7), (b"|", 8), (b"#*$%&<>", 9), (range(128, 256), 10)):
    _KIND[list(_bytes)] = _kind
FEATURES = ["log_words", "capitals", "digits", "marks", "exclamations", "bars", "symbols", "other_signs", "beyond_ascii", "word_length",
            "distinct_words", "commonest_word", "echoes", "repeated_windows", "repeated_lines", "words_per_line", "plain_words",
            "capital_words"]


def features(text: str | None) -> np.ndarray:
    """The features of a whole text; all zero for one without words."""
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return np.zeros(len(FEATURES))
    kinds = np.bincount(_KIND[np.frombuffer(raw, np.uint8)], minlength=11)
    n, solid = len(words), max(1, len(raw) - int(kinds[4] + kinds[5]))
    letters = max(1, int(kinds[1] + kinds[2]))
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    windows = set(zip(words, words[1:], words[2:], words[3:], strict=False)) if n > 3 else ()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return np.array([
        np.log1p(n), kinds[2] / letters, kinds[3] / solid, kinds[6] / solid, kinds[7] / solid, kinds[8] / solid, kinds[9] / solid,
        kinds[0] / solid, kinds[10] / solid, solid / n, len(counts) / n ** 0.8, max(counts.values()) / n,
        sum(map(eq, words, words[1:])) / n, 1 - len(windows) / (n - 3) if n > 3 else 0.0, 1 - len(set(lines)) / len(lines),
        np.log1p(n / len(lines)), sum(map(bytes.isalpha, words)) / n, sum(map(bytes.isupper, words)) / n])


@dataclass(frozen=True)
class Ranking:
    """Weights over standardised features, the threshold score and the slope of the probability."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    slope: float

    def standard(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.scale, -8, 8)
        return np.concatenate([z, z * z / 8], axis=-1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (self.standard(x) @ self.weights - self.threshold), -50, 50)))


def preferences(labels: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """(better, worse) pairs: every document of the rarer label against several others, evenly drawn."""
    good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    few, many = (bad, good) if len(bad) <= len(good) else (good, bad)
    times = max(1, min(PAIRS_PER_DOCUMENT, MAX_PAIRS // len(few)))
    first, second = np.repeat(few, times), many[rng.integers(0, len(many), len(few) * times)]
    return (second, first) if few is bad else (first, second)


def newton(x: np.ndarray, ridge: float, rounds: int = 15) -> np.ndarray:
    """Minimises the mean logistic loss of positive margins ``x @ w`` with a ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(np.clip(x @ w, -50, 50)))
        gradient = ridge * w - x.T @ p / len(x)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x / len(x) + ridge * np.eye(len(w)), gradient)
        w -= step * min(1.0, 5 / max(1e-12, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-4:
            break
    return w


def fit(x: np.ndarray, labels: np.ndarray) -> Ranking:
    """``x``: a row of features per labelled document. With labels of one kind only, every score is that kind's."""
    centre = x.mean(0) if len(x) else np.zeros(len(FEATURES))
    scale = np.maximum(x.std(0), 1e-3) if len(x) else np.ones(len(FEATURES))
    none = np.zeros(2 * len(FEATURES))
    if len(np.unique(labels)) < 2:
        certain = 0.0 if not len(labels) else 50.0 if labels[0] == 1 else -50.0
        return Ranking(centre, scale, none, -certain, 1.0)
    ranking = Ranking(centre, scale, none, 0.0, 1.0)
    z = ranking.standard(x)
    better, worse = preferences(labels, np.random.default_rng(SEED))
    weights = newton(z[better] - z[worse], RIDGE)
    scores = z @ weights
    threshold = float(np.quantile(scores, float((labels == 0).mean())))
    slope = newton(((scores - threshold) * np.where(labels == 1, 1, -1))[:, None], 1e-4)[0]
    return Ranking(centre, scale, weights, threshold, max(float(slope), 1e-6))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, max_labelled: int) -> DataFrame:
    """(doc_id, label, text) of at most ``max_labelled`` labelled documents outside the held-out fold.

    Ids with null or contradicting labels teach nothing. The ids are few, so they are sent to the documents.
    """
    seen = (labels.filter(~held_out()).filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id")
            .agg(F.min(label).alias("label"), F.max(label).alias("other")).filter("label = other").select("doc_id", "label"))
    chosen = seen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_labelled: int = MAX_LABELLED) -> Ranking:
    @F.pandas_udf("array<double>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t).tolist() for t in texts])

    rows = (labelled_sample(docs, labels, label, max_labelled).select("doc_id", "label", of("text").alias("x"))
            .groupBy("doc_id").agg(F.min("label").alias("label"), F.min("x").alias("x")).orderBy("doc_id").toPandas())
    x = np.array(rows["x"].tolist(), float).reshape(len(rows), len(FEATURES))
    return fit(x, rows["label"].to_numpy(int))


def quality_scores(docs: DataFrame, labels: DataFrame, label: str = "quality", max_labelled: int = MAX_LABELLED) -> DataFrame:
    """Adds ``held_out``, ``score`` (0 to 1, higher is better) and ``predicted`` (1 from 0.5 on) to each document.

    ``docs`` has doc_id and text, ``labels`` doc_id and 0/1 labels. Nothing but the text makes a score. A null
    or empty text is scored like any other, as a text without words; a null id is never held out and has no
    label. Several rows of one id count once in training and are scored one by one. Columns named like the
    new ones are replaced. Without labels every score is 0.5, with labels of one kind 0 or 1. Texts of any length
    are read whole; equal scores are judged alike; an empty table of documents gives no rows.
    """
    ranking = train(docs, labels, label, max_labelled)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        x = np.array([features(t) for t in texts]).reshape(len(texts), len(FEATURES))
        return pd.Series(ranking.probability(x))

    scored = with_struct(docs, F.struct(held_out().alias("held_out"), score("text").alias("score")), ["held_out", "score"])
    return with_struct(scored, F.struct((F.col("score") >= 0.5).cast("int").alias("predicted")), ["predicted"])
