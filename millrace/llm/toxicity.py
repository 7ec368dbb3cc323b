"""Toxicity by non-negative positive-unlabelled (nnPU) learning in numpy.

Texts confirmed as toxic are the positives; a sample of all texts is the
unlabelled set.  With class prior p the risk p*R_pos(+1) + max(0, R_unl(-1) -
p*R_pos(-1)) is minimised for a linear classifier on word presence: the part
that stands for the negatives may not go below zero, which stops the model
from fitting unlabelled positives away.

The prior is the share of toxic rows among all labelled training rows.  Traits
of a text are its words (letter runs in lower case) and the words' beginnings
of 4 to 8 letters.  A trait becomes a feature if its share of the positives
differs from its share of the unlabelled texts by ``MIN_Z`` standard errors.  Both samples are bounded parameters; they are written to the shared
folder, their traits are counted by Spark, and only rows of feature numbers
reach the driver.  Scoring maps rows one to one.

Both bounds on the samples and that on features are parameters; what they cost
against a fit on all texts is measured in the README.

Defined cases: null and empty texts have no words and get the bias alone;
labels for ids that are missing from the documents, and null ids, are ignored; an
id with several labels counts once, as toxic if one of them says so; documents
that repeat an id are all learned from; without any
positive label all scores are 0; very long texts are scored whole; of traits
that tie for the last place the first in order is taken; empty tables give
no model.  Columns of any name may stand beside the named ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import written

MAX_POSITIVE = 2500
MAX_UNLABELLED = 5000
MAX_FEATURES = 1500
STEMS = (4, 5, 6, 7, 8)
MIN_Z = 6.0
MIN_TEXTS = 5
EPOCHS = 500
CACHED_WORDS = 500_000
SAMPLE_PARTS = 32
_LETTERS = regex.compile(r"\p{L}+")


def words_of(text: str | None) -> set[str]:
    return set(_LETTERS.findall((text or "").lower()))


def traits(word: str) -> list[str]:
    """The word and its beginnings, marked by a star."""
    return [word] + [f"{word[:n]}*" for n in STEMS if len(word) > n]


class WordModel:
    """Weights by trait; remembers, up to a limit, which weighted traits a word has."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias, self.known = weights, bias, {}

    def weighted(self, word: str) -> tuple[str, ...]:
        if len(self.known) >= CACHED_WORDS:
            self.known.clear()
        found = self.known[word] = tuple(t for t in traits(word) if t in self.weights)
        return found

    def score(self, text: str | None) -> float:
        known, found = self.known, set()
        for w in words_of(text):
            hit = known.get(w)
            if hit is None:
                hit = self.weighted(w)
            if hit:
                found.update(hit)
        z = self.bias + sum(self.weights[t] for t in sorted(found))
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -60, 60))))


def select_traits(sample: DataFrame, n: int, m: int) -> list[str]:
    """Traits whose shares of the ``n`` positives and ``m`` unlabelled texts differ clearly, the clearest first.

    ``sample`` has (positive, words).  Counting is Spark's; only chosen traits come back.
    Of traits with the same counts that share a beginning only the longest is taken.
    """

    @F.pandas_udf("array<string>")
    def all_traits(words: pd.Series) -> pd.Series:
        return words.map(lambda ws: sorted({t for w in ws for t in traits(w)}))

    counts = sample.select("positive", F.explode(all_traits("words")).alias("trait")).groupBy("trait").agg(F.sum("positive").alias("p"), F.sum(1 - F.col("positive")).alias("u"))
    share = (F.col("p") + F.col("u")) / (n + m)
    error = F.sqrt(share * (1 - share) * (1 / n + 1 / max(m, 1)) + 1e-12)
    clear = counts.filter(F.col("p") + F.col("u") >= MIN_TEXTS).withColumn("z", F.abs(F.col("p") / n - F.col("u") / max(m, 1)) / error).filter(F.col("z") >= MIN_Z)
    family = F.substring("trait", 1, STEMS[0])
    longest = clear.groupBy("p", "u", family).agg(F.max_by("trait", F.struct(F.length("trait"), "trait")).alias("trait"), F.max("z").alias("z"))
    return [r.trait for r in longest.orderBy(F.desc("z"), "trait").limit(MAX_FEATURES).collect()]


def nnpu_risk(w: np.ndarray, xp: np.ndarray, xu: np.ndarray, prior: float) -> tuple[float, float, np.ndarray, np.ndarray]:
    """The positive and the negative part of the risk with the logistic loss, and their gradients."""
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -60, 60)))
    zp, zu = xp @ w, xu @ w
    positive = prior * np.logaddexp(0, -zp).mean()
    negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
    gp = xp.T @ (-(1 - sigmoid(zp))) * (prior / len(xp))
    gn = xu.T @ sigmoid(zu) / len(xu) - xp.T @ sigmoid(zp) * (prior / len(xp))
    return positive, negative, gp, gn


def fit_nnpu(xp: np.ndarray, xu: np.ndarray, prior: float, epochs: int = EPOCHS, rate: float = 0.1, decay: float = 1e-5) -> np.ndarray:
    """Weights by full-batch Adam on the non-negative risk; the last column is the bias."""
    w = np.zeros(xp.shape[1], np.float32)
    w[-1] = np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, epochs + 1):
        _, negative, gp, gn = nnpu_risk(w, xp, xu, prior)
        # below zero the negative part is climbed back up instead
        g = gp + gn if negative >= 0 else -gn
        g[:-1] += decay * w[:-1]
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        w = (w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return w


def _words(df: DataFrame, text: str, positive: int, limit: int) -> DataFrame:
    @F.pandas_udf("array<string>")
    def distinct(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: sorted(words_of(t)))

    return df.select(F.lit(positive).alias("positive"), distinct(F.col(text).cast("string")).alias("words")).limit(limit)


def fit(documents: DataFrame, labels: DataFrame, text: str = "text", id_column: str = "doc_id", toxic: str = "toxic", max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED) -> WordModel | None:
    """Learn from ``labels`` (id, toxic) and the texts of ``documents``; None without positives."""
    known = labels.filter(F.col(toxic).isNotNull() & F.col(id_column).isNotNull()).groupBy(id_column).agg(F.max(F.col(toxic).cast("int")).alias("__toxic"))
    counts = known.agg(F.count("*"), F.sum(F.expr("if(__toxic = 1, 1L, 0L)"))).first()
    n_docs = documents.count()
    if not counts[1] or not n_docs:
        return None
    draw = lambda label: F.pmod(F.xxhash64(id_column, F.lit(label)), F.lit(1 << 30))
    some = lambda share: min(1.0, share) * (1 << 30)
    confirmed = known.filter("__toxic = 1").filter(draw("positive") < some(max_positive / counts[1])).select(id_column)
    positive = _words(documents.select(id_column, text).join(confirmed, id_column, "left_semi"), text, 1, 2 * max_positive)
    unlabelled = _words(documents.filter(draw("unlabelled") < some(max_unlabelled / n_docs)).select(text), text, 0, 2 * max_unlabelled)
    sample = written(positive.union(unlabelled).repartition(SAMPLE_PARTS), "toxicity-sample")
    sizes = {r[0]: r[1] for r in sample.groupBy("positive").count().collect()}
    if not sizes.get(1) or not sizes.get(0):
        return None
    names = select_traits(sample, sizes[1], sizes[0])
    place = {t: i for i, t in enumerate(names)}

    @F.pandas_udf("array<int>")
    def places(words: pd.Series) -> pd.Series:
        return words.map(lambda ws: sorted({place[t] for w in ws for t in traits(w) if t in place}))

    rows = sample.select("positive", places("words").alias("x")).collect()
    x = {side: np.zeros((sizes[side], len(names) + 1), np.float32) for side in (0, 1)}
    for side in x:
        x[side][:, -1] = 1
        for row, hit in zip(x[side], sorted(r.x for r in rows if r.positive == side)):
            row[hit] = 1
    w = fit_nnpu(x[1], x[0], counts[1] / counts[0])
    return WordModel({t: float(v) for t, v in zip(names, w[:-1]) if abs(v) > 1e-4}, float(w[-1]))


def toxicity(model: WordModel | None, text: Column) -> Column:
    """The probability that a text is toxic."""
    if model is None:
        return F.lit(0.0)

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series([model.score(t) for t in texts], dtype=float)

    return F.pandas_udf(run, "double")(text.cast("string"))
