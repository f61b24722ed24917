"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives, and documents taken without
regard to any label are the unlabelled, which hold toxic ones in the share
of the class prior. A linear classifier over the words of a text and their
first letters (inflected and compound words share them) minimises the risk
estimator of Kiryo et al. (2017): the positives' loss times the
prior, plus the unlabelled loss as negatives less the part that the
positives among them account for, where that difference may not fall below
zero (a step that would push it there goes back instead).

The fit uses bounded samples (``MOST_POSITIVE``, ``MOST_UNLABELLED``,
``MOST_FEATURES``), drawn by a hash of doc_id; scoring reads every text.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from omoplate.llm.common import cut_lineage, doc_texts, ready, table

MOST_POSITIVE = 4_000
MOST_UNLABELLED = 12_000
MOST_FEATURES = 2_048
#: Bytes of a word's beginnings that are features of their own.
STEMS = (4, 5, 6, 7)
#: Positives that must hold a feature before it counts.
LEAST_HOLDERS = 4
STEPS = 400
RATE = 0.05
DECAY = 3e-4
THRESHOLD = 0.7

_SEPARATORS = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256))


def distinct_words(text: str) -> set[bytes]:
    return set(text.lower().encode("utf-8", "surrogatepass").translate(_SEPARATORS).split())


def features(text: str) -> list[bytes]:
    """Distinct words, and the distinct beginnings of words behind a ``^``."""
    own = distinct_words(text)
    return sorted(own | {b"^" + w[:n] for n in STEMS for w in own if len(w) >= n})


@dataclass
class Model:
    """Weights of words and of beginnings, and the bias; a bias of None: nothing was learned."""

    words: dict[bytes, float]
    stems: dict[bytes, float]
    bias: float | None

    @classmethod
    def of(cls, names: list[bytes], weights: list[float], bias: float | None) -> Model:
        pairs = list(zip(names, weights))
        return cls({n: w for n, w in pairs if n[:1] != b"^"}, {n[1:]: w for n, w in pairs if n[:1] == b"^"}, bias)

    def score(self, text: str) -> float:
        if self.bias is None:
            return 0.0
        own = distinct_words(text)
        met = [self.words[w] for w in own & self.words.keys()]
        for n in STEMS:  # a shorter word's cut is the word itself, which only counts if it is long enough
            met += [self.stems[w] for w in {w[:n] for w in own} & self.stems.keys() if len(w) == n]
        z = self.bias + math.fsum(met)
        return 1 / (1 + math.exp(-z)) if z > -700 else 0.0


def nn_pu(samples: list[np.ndarray], positive: np.ndarray, n_features: int, prior: float, steps: int = STEPS,
          rate: float = RATE, decay: float = DECAY) -> tuple[np.ndarray, float]:
    """Weights and bias from the feature numbers of each sample; ``positive`` tells the confirmed ones."""
    of = np.repeat(np.arange(len(samples)), [len(w) for w in samples])
    col = np.concatenate(samples).astype(np.int64) if len(of) else np.zeros(0, np.int64)
    n_p, n_u = positive.sum(), (~positive).sum()
    theta = np.zeros(n_features + 1)
    theta[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        z = theta[-1] + np.bincount(of, theta[col], len(samples))
        p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        loss_negative = np.logaddexp(0, z)  # as a negative; its slope is p
        rest = loss_negative[~positive].mean() - prior * loss_negative[positive].mean()
        slope_rest = np.where(positive, -prior * p / n_p, p / n_u)
        if rest >= 0:
            slope = slope_rest + np.where(positive, prior * (p - 1) / n_p, 0)
        else:
            slope = -slope_rest
        grad = np.append(np.bincount(col, slope[of], n_features), slope.sum())
        grad[:-1] += decay * theta[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return theta[:-1], float(theta[-1])


def in_training(doc_id: str | Column = "doc_id") -> Column:
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string")) % 3 != 1, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, most_positive: int = MOST_POSITIVE,
        most_unlabelled: int = MOST_UNLABELLED, most_features: int = MOST_FEATURES) -> Model:
    """A model from the training rows of ``labels`` (doc_id, toxic) and the texts of ``docs``."""
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter(
        F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & in_training())
    prior = marks.agg(F.avg("toxic")).collect()[0][0]
    if not prior or prior >= 1:
        return Model({}, {}, None)
    texts = doc_texts(docs).filter(F.col("doc_id").isNotNull() & in_training())
    by_hash = F.xxhash64("doc_id", F.lit("sample"))
    positive = marks.filter("toxic = 1").select("doc_id").distinct().orderBy(by_hash).limit(most_positive)
    # before the exact cut, a share of the hashes that holds about three times as many
    share = min(1.0, 3 * most_unlabelled / max(1, texts.select("doc_id").count()))
    anyone = texts.select("doc_id").filter(F.pmod(by_hash, F.lit(1 << 30)) < share * (1 << 30)).orderBy(by_hash).limit(most_unlabelled)
    # two samples of fixed size at most, so they may be broadcast
    chosen = positive.withColumn("positive", F.lit(True)).unionByName(anyone.distinct().withColumn("positive", F.lit(False)))

    @F.pandas_udf("array<binary>")
    def features_of(text: pd.Series) -> pd.Series:
        return pd.Series([features(x) for x in text])

    sample = cut_lineage(texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "positive", features_of("text").alias("features")))
    n_p, n_u = (sample.filter(c).count() for c in ("positive", "not positive"))
    if not n_p or not n_u:
        return Model({}, {}, None)
    held = sample.select("positive", F.explode("features").alias("feature")).groupBy("feature").agg(
        F.count_if("positive").alias("p"), F.count_if(~F.col("positive")).alias("u"))
    share = (F.col("p") + F.col("u")) / (n_p + n_u)
    apart = (F.col("p") / n_p - F.col("u") / n_u) / F.sqrt(share * (1 - share) + 1e-9)
    kept = held.filter(F.col("p") >= LEAST_HOLDERS).orderBy(F.abs(apart).desc(), "feature").limit(most_features)
    vocabulary = sorted(bytes(r["feature"]) for r in kept.select("feature").collect())
    number = {w: i for i, w in enumerate(vocabulary)}

    @F.pandas_udf("array<int>")
    def numbers_of(lists: pd.Series) -> pd.Series:
        return pd.Series([[number[f] for f in map(bytes, own) if f in number] for own in lists])

    rows = sample.select("doc_id", "positive", numbers_of("features").alias("own")).orderBy("doc_id", "positive").collect()
    weights, bias = nn_pu([np.array(r["own"], np.int64) for r in rows], np.array([r["positive"] for r in rows]),
                          len(vocabulary), float(prior))
    return Model.of(vocabulary, weights.tolist(), bias)


def score(model: Model, text: str = "text") -> Column:
    """Probability of label 1, from the text alone."""

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(x) for x in texts])

    return run(F.coalesce(F.col(text).cast("string"), F.lit("")))


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, score, predicted``.

    A null or empty text gets the score of no words. A null doc_id is not
    held out. Labels that are null or have no document teach nothing;
    without a toxic and another label in training, every score is 0. An
    empty table gives no rows; other columns are ignored.
    """
    ready(docs.sparkSession)
    model = fit(docs, labels)
    return doc_texts(docs).select("doc_id", (~in_training()).alias("held_out"), score(model).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the texts that score ``threshold`` or more."""
    ready(docs.sparkSession)
    model = fit(docs, labels)
    # the columns travel in a struct, so that none can clash with the score
    scored = docs.select(F.struct("*").alias("row"), "text").select("row", score(model).alias("toxicity"))
    return scored.filter(F.col("toxicity") < threshold).select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE_SQL = {}
