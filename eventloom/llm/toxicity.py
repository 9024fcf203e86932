"""A toxicity classifier that does not take the mention of a group for toxicity.

A logistic model over the words that a text contains, over their beginnings, which hold for all forms of a word,
and over the beginnings that several of its words share and that make up a percent of the text or more. Those that tell toxic from other labelled documents are chosen by their likelihood ratio. In training every identity term of a labelled text is also swapped for
the other terms of its family, and the squared change of the score is penalised: terms of a family, with the
neutral words among them, end up with nearly the same weight, however often some of them stand beside abuse.

The labelled sample is bounded (``max_labelled`` documents by smallest hash of the id), and so is the number
of chosen words; documents come to the driver as lists of chosen words only.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import held_out, with_struct
from eventloom.llm.pairwise_quality import labelled_sample

MAX_LABELLED = 20_000
MAX_WORDS = 1_000
# Chance gives a word of no meaning a higher likelihood ratio once in some ten thousand.
MIN_RATIO = 15.0
MAX_WORD_CHARS = 64
RIDGE = 1e-5
# Letters of a word's beginning; words of a text for each that has a frequent beginning.
STEMS, ONE_IN = (4, 5), {"**": 100, "*+": 200}
SWAP_PENALTY = 10.0
THRESHOLD = 0.7
# Families of terms that may stand for each other in a sentence; the first of each is neutral.
FAMILIES = [
    ["person", "man", "woman", "boy", "girl", "transgender", "nonbinary"],
    ["people", "men", "women", "boys", "girls", "immigrants", "refugees", "foreigners"],
    ["believer", "christian", "muslim", "jew", "hindu", "buddhist", "atheist", "catholic", "sikh"],
    ["believers", "christians", "muslims", "jews", "hindus", "buddhists", "atheists", "catholics", "sikhs"],
    ["religious", "islamic", "jewish", "protestant"],
    ["human", "black", "white", "asian", "african", "arab", "latino", "european", "american", "mexican", "chinese", "indian", "roma"],
    ["partnered", "gay", "lesbian", "bisexual", "straight", "queer", "heterosexual", "homosexual"],
    ["adult", "old", "young", "elderly", "teenage"],
    ["healthy", "disabled", "blind", "deaf", "autistic"],
    ["personne", "homme", "femme", "musulman", "chrétien", "juif", "immigré"],
    ["mensch", "mann", "frau", "muslim", "christ", "jude", "ausländer"],
    ["persona", "hombre", "mujer", "musulmán", "cristiano", "judío", "inmigrante"],
]
_WORD = re.compile(r"[^\W_]+")


def marks_of(text: str | None, terms: frozenset[str]) -> set[str]:
    """The words of a whole text and, with a star, the beginnings of those that are not identity terms: what a term
    says is in its own weight alone, so that swapping it changes nothing else. Two signs mark frequent beginnings."""
    counts = Counter(_WORD.findall((text or "").lower()))
    total = counts.total()
    marks = {w for w in counts if len(w) <= MAX_WORD_CHARS}
    forms: dict[str, int] = {}
    times: dict[str, int] = {}
    for w in counts.keys() - terms:
        for n in STEMS:
            if len(w) > n:
                stem = w[:n]
                forms[stem] = forms.get(stem, 0) + 1
                times[stem] = times.get(stem, 0) + counts[w]
    for stem, n in forms.items():
        marks.add(stem + "*")
        if n > 1:
            marks.update(stem + sign for sign, words in ONE_IN.items() if times[stem] * words >= total)
    return marks


def terms_of(families: list[list[str]]) -> frozenset[str]:
    return frozenset(t for f in families for t in f)


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    bias: float
    terms: frozenset[str] = frozenset()

    def probability(self, text: str | None) -> float:
        known = self.weights
        margin = self.bias + sum(sorted(known[w] for w in known.keys() & marks_of(text, self.terms)))
        return float(1 / (1 + np.exp(-min(max(margin, -50.0), 50.0))))


def swaps(texts: list[set[str]], families: list[list[str]]) -> dict[tuple[str, str], int]:
    """How often a swap puts the second term in the place of the first."""
    out: dict[tuple[str, str], int] = {}
    for words in texts:
        for family in families:
            for term in words.intersection(family):
                for other in family:
                    if other not in words:
                        out[term, other] = out.get((term, other), 0) + 1
    return out


def fit(texts: list[set[str]], toxic: np.ndarray, families: list[list[str]] = FAMILIES, ridge: float = RIDGE,
        swap_penalty: float = SWAP_PENALTY, rounds: int = 600) -> Model:
    """Texts as sets of chosen words and beginnings. With labels of one kind only the model is that kind's share."""
    n = len(texts)
    if n == 0 or len(np.unique(toxic)) < 2:
        return Model({}, 0.0 if n == 0 else 50.0 if toxic[0] == 1 else -50.0)
    pairs = swaps(texts, families)
    names = sorted(set().union(*texts, *pairs))
    place = {w: k for k, w in enumerate(names)}
    which = np.array([place[w] for t in texts for w in sorted(t)], np.int64)
    rows = np.repeat(np.arange(n), [len(t) for t in texts])
    a = np.array([place[x] for x, _ in pairs], np.int64)
    b = np.array([place[y] for _, y in pairs], np.int64)
    times = np.array(list(pairs.values()), float) / n
    even = np.where(toxic == 1, 0.5 / (toxic == 1).sum(), 0.5 / (toxic != 1).sum())  # both kinds weigh the same
    w, bias = np.zeros(len(names)), 0.0
    first, second = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    for step in range(1, rounds + 1):
        margin = bias + np.bincount(rows, w[which], n)
        error = (1 / (1 + np.exp(-np.clip(margin, -50, 50))) - toxic) * even
        gradient = np.bincount(which, error[rows], len(names)) + ridge * w
        change = swap_penalty * times * (w[b] - w[a])
        gradient += np.bincount(b, change, len(names)) - np.bincount(a, change, len(names))
        whole = np.append(gradient, error.sum())
        first, second = 0.9 * first + 0.1 * whole, 0.99 * second + 0.01 * whole ** 2
        move = first / (1 - 0.9 ** step) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-9) * 0.1 * (1 - step / (rounds + 1))
        w, bias = w - move[:-1], bias - move[-1]
    return Model(dict(zip(names, w.tolist(), strict=True)), float(bias), terms_of(families))


def _ratio(in_toxic, toxic, in_other, other):
    """Twice the log likelihood ratio of a word's presence in toxic and in other documents, as a column."""
    def part(k, n, p):
        return k * F.log(F.greatest(p, F.lit(1e-12))) + (n - k) * F.log(F.greatest(1 - p, F.lit(1e-12)))

    p = (in_toxic + in_other) / (toxic + other)
    return 2 * (part(in_toxic, toxic, in_toxic / toxic) + part(in_other, other, in_other / other)
                - part(in_toxic, toxic, p) - part(in_other, other, p))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", families: list[list[str]] = FAMILIES,
          max_labelled: int = MAX_LABELLED, max_words: int = MAX_WORDS) -> Model:
    identity = terms_of(families)

    @F.pandas_udf("array<string>")
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series([sorted(marks_of(t, identity)) for t in texts])

    sample = (labelled_sample(docs, labels, label, max_labelled).select("doc_id", "label", found("text").alias("words"))
              .groupBy("doc_id").agg(F.min("label").alias("label"), F.min("words").alias("words")).persist())
    try:
        sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
        toxic, other = F.lit(float(sizes.get(1, 0) or 1)), F.lit(float(sizes.get(0, 0) or 1))
        per_word = sample.select("label", F.explode("words").alias("word")).groupBy("word").agg(
            F.sum(F.col("label").cast("double")).alias("t"), F.sum(1.0 - F.col("label")).alias("o"))
        chosen = (per_word.withColumn("ratio", _ratio(F.col("t"), toxic, F.col("o"), other)).filter(F.col("ratio") >= MIN_RATIO)
                  .orderBy(F.desc("ratio"), "word").limit(max_words).select("word"))
        known = sorted({r["word"] for r in chosen.collect()} | identity)
        rows = sample.select("doc_id", "label", F.array_intersect("words", F.lit(known)).alias("kept")).orderBy("doc_id").collect()
    finally:
        sample.unpersist()
    return fit([set(r["kept"]) for r in rows], np.array([r["label"] for r in rows], float), families)


def toxicity_scores(docs: DataFrame, labels: DataFrame, label: str = "toxic", families: list[list[str]] = FAMILIES,
                    max_labelled: int = MAX_LABELLED, threshold: float = THRESHOLD) -> DataFrame:
    """Adds ``held_out``, ``score`` (0 to 1, higher is more toxic) and ``predicted`` (1 from the threshold on).

    ``docs`` has doc_id and text, ``labels`` doc_id and 0/1 labels; only the text makes a score, and all of it.
    A null or empty text has the score of a text without words. A null id is never held out and has no label;
    several rows of one id count once in training and are scored one by one. Columns named like the new ones
    are replaced. Without labels every score is 0.5, with labels of one kind 0 or 1. Texts of any length are
    read whole; an empty table of documents gives no rows.
    """
    model = train(docs, labels, label, families, max_labelled)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([model.probability(t) for t in texts], dtype=float)

    scored = with_struct(docs, F.struct(held_out().alias("held_out"), score("text").alias("score")), ["held_out", "score"])
    return with_struct(scored, F.struct((F.col("score") >= threshold).cast("int").alias("predicted")), ["predicted"])
