"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text are all that the fit sees: no row is known to be bad. The class prior is
estimated from both (the best bin of a held-back half), and a logistic model minimises the non-negative unbiased
risk ``prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))``.

Features describe a whole text: shares of neighbouring character kinds, repeated neighbours, distinct words, word
lengths. They are vectorised over Arrow batches and need no vocabulary, so the model is a few hundred numbers.

Defined cases: a NULL text counts as empty, an empty text gets a score like any other, repeated rows get equal
scores, extra columns stay. With no positives or no unlabelled rows every score is the prior 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_slices, held_out, lowest_hash, per_text, word_codes

POSITIVES = 4000  # most labelled rows that a fit reads
UNLABELLED = 8000  # most unlabelled rows that a fit reads
THRESHOLD = 0.3

# Character kinds: lower, upper, digit, space, line end, sentence marks, quotes and brackets, other marks, beyond ASCII.
_KINDS = np.full(256, 8, np.uint8)
for _chars, _kind in (("abcdefghijklmnopqrstuvwxyz", 0), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1), ("0123456789", 2), (" \t", 3),
                      ("\n\r", 4), (".,;:?", 5), ("'\"()[]-", 6)):
    _KINDS[[ord(c) for c in _chars]] = _kind
_KINDS[[c for c in range(128) if _KINDS[c] == 8]] = 7
N_KINDS = 9
N_SHAPES = N_KINDS * N_KINDS
N_FEATURES = N_SHAPES + 6


def features(texts: pa.Array) -> np.ndarray:
    """One row of numbers per text."""
    count = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64, count + 1, texts.offset * 8)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    bounds = offsets - offsets[0]
    sizes = np.diff(bounds)
    kinds = _KINDS[raw]
    owner = np.repeat(np.arange(count, dtype=np.int32), sizes)
    out = np.zeros((count, N_FEATURES))
    if len(raw) > 1:
        pair = owner[:-1] * N_SHAPES + kinds[:-1] * np.int32(N_KINDS) + kinds[1:]
        shapes = np.bincount(pair[owner[:-1] == owner[1:]], minlength=count * N_SHAPES).reshape(count, N_SHAPES)
        out[:, :N_SHAPES] = np.sqrt(shapes / np.maximum(sizes - 1, 1)[:, None])

    codes, starts, vocabulary = word_codes(texts)
    words = np.diff(starts)
    text_of = np.repeat(np.arange(count, dtype=np.int64), words)
    distinct = np.bincount(np.unique(text_of * max(len(vocabulary), 1) + codes) // max(len(vocabulary), 1), minlength=count)
    same = np.zeros(len(codes))
    same[1:] = (codes[1:] == codes[:-1]) & (text_of[1:] == text_of[:-1])
    many = np.maximum(words, 1)
    extra = out[:, N_SHAPES:]
    extra[:, 0] = per_text(same, starts) / many
    extra[:, 1] = np.log1p(distinct) / np.log1p(many)
    extra[:, 2] = np.log1p(sizes / many)
    extra[:, 3] = np.log1p(words)
    extra[:, 4] = distinct / many
    extra[:, 5] = np.sqrt(np.minimum(extra[:, 0], 1))
    return out


@dataclass(frozen=True)
class QualityModel:
    weights: np.ndarray
    bias: float
    mean: np.ndarray
    scale: np.ndarray
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        margin = ((x - self.mean) / self.scale).clip(-8, 8) @ self.weights + self.bias
        return 1 / (1 + np.exp(-margin.clip(-30, 30)))


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-z.clip(-30, 30)))


def descend(gradient, size: int, steps: int = 600, rate: float = 0.05) -> np.ndarray:
    """Adam over the whole sample, the same at every run."""
    theta, first, second = np.zeros(size), np.zeros(size), np.zeros(size)
    for step in range(1, steps + 1):
        g = gradient(theta)
        first = 0.9 * first + 0.1 * g
        second = 0.99 * second + 0.01 * g * g
        theta = theta - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return theta


def risk_gradient(theta, positive, unlabelled, prior: float, decay: float = 1e-4):
    """Gradient of the non-negative risk with the logistic loss; where the negative part falls below 0 it is climbed back."""
    zp, zu = positive @ theta, unlabelled @ theta
    np_, nu = len(zp), len(zu)
    up = -prior * (_sigmoid(-zp) @ positive) / np_
    negative_part = _softplus(zu).mean() - prior * _softplus(zp).mean()
    down = (_sigmoid(zu) @ unlabelled) / nu - prior * (_sigmoid(zp) @ positive) / np_
    g = up + down if negative_part >= 0 else -down
    g[:-1] += decay * theta[:-1]
    return g


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, slack: float = 1.0) -> float:
    """Share of positives in the unlabelled scores: the least ratio of both tails, with a bound for chance.

    Above a threshold that only positives pass, the tail of the unlabelled is the prior times that of the positives.
    """
    cuts = np.quantile(positive, np.linspace(0.0, 0.95, 96))
    above_p = (positive[None, :] >= cuts[:, None]).mean(1)
    above_u = (unlabelled[None, :] >= cuts[:, None]).mean(1)
    margin = slack * (np.sqrt(np.log(40) / (2 * len(positive))) + np.sqrt(np.log(40) / (2 * len(unlabelled))))
    best = np.argmin((above_u + margin) / np.maximum(above_p, 1e-9))
    return float(np.clip(above_u[best] / max(above_p[best], 1e-9), 0.02, 0.98))


def fit_pu(positive: np.ndarray, unlabelled: np.ndarray) -> QualityModel:
    """Fit from feature rows of trusted positives and of unlabelled texts."""
    if not len(positive) or not len(unlabelled):
        return QualityModel(np.zeros(N_FEATURES), 0.0, np.zeros(N_FEATURES), np.ones(N_FEATURES), 0.5)
    mean, scale = positive.mean(0), positive.std(0) + 0.02
    ready = lambda x: np.hstack([((x - mean) / scale).clip(-8, 8), np.ones((len(x), 1))])
    p, u = ready(positive), ready(unlabelled)
    # The prior: a plain classifier of positives against unlabelled, judged on the half that it hasn't seen.
    half_p, half_u = max(1, len(p) // 2), max(1, len(u) // 2)

    def plain(theta):
        g = -(_sigmoid(-(p[:half_p] @ theta)) @ p[:half_p]) / half_p + (_sigmoid(u[:half_u] @ theta) @ u[:half_u]) / half_u
        g[:-1] += 1e-3 * theta[:-1]
        return g

    rough = descend(plain, p.shape[1], 200)
    prior = estimate_prior(p[half_p:] @ rough if len(p) > half_p else p @ rough, u[half_u:] @ rough if len(u) > half_u else u @ rough)
    theta = descend(lambda t: risk_gradient(t, p, u, prior), p.shape[1])
    return QualityModel(theta[:-1], float(theta[-1]), mean, scale, prior)


def train(documents: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> QualityModel:
    """Fit on a bounded sample: at most ``positives`` rows labelled good and ``unlabelled`` rows, none of them held out.

    Only their features reach the driver, a bounded table of numbers.
    """
    open_labels = labels.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
    good = open_labels.where("quality = 1").select("doc_id").distinct()
    chosen = lowest_hash(good, "doc_id", positives, 1).select("doc_id", F.lit(1).alias("_side"))
    anything = documents.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()).select("doc_id")
    chosen = chosen.unionByName(lowest_hash(anything, "doc_id", unlabelled, 2).select("doc_id", F.lit(0).alias("_side")))
    as_features = F.arrow_udf(_features_of, "array<double>")
    sample = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # bounded by the two parameters
    rows = sample.select("doc_id", "_side", as_features("text").alias("_x")).orderBy("_side", F.xxhash64(F.lit(3), "doc_id")).collect()
    of = lambda side: np.array([r["_x"] for r in rows if r["_side"] == side]).reshape(-1, N_FEATURES)
    return fit_pu(of(1), of(0))


def _features_of(texts: pa.Array) -> pa.Array:
    return by_slices(lambda part: list(features(part)), texts, pa.list_(pa.float64()))


def score_of(text: Column, model: QualityModel) -> Column:
    """A score between 0 and 1 for every whole text."""

    def run(texts: pa.Array) -> pa.Array:
        return by_slices(lambda part: model.score(features(part)), texts, pa.float64())

    return F.arrow_udf(run, "double").asNondeterministic()(text)


def score(documents: DataFrame, model: QualityModel, text: str = "text", out: str = "score") -> DataFrame:
    """``documents`` with :func:`score_of` the text; no shuffle."""
    return documents.withColumn(out, score_of(F.col(text), model))


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each document."""
    scored = score(documents.select("doc_id", "text"), train(documents, labels))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``documents`` that are predicted good, columns as they were."""
    return documents.where(score_of(F.col("text"), train(documents, labels)) >= THRESHOLD)
