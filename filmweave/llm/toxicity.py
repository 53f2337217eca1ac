"""Toxicity by a support vector machine over a gap-weighted subsequence kernel with Nyström landmarks.

Kernel of two words: the weighted number of letter triples they share in order, a triple that spans ``s`` characters
weighing ``DECAY ** s``, up to ``SPAN`` characters. Skipped characters are gaps, so ``id*iot`` or ``idxiot`` stay near
``idiot``; what is no letter only widens the span, and runs of single letters (``i d i o t``) are read as one word.

Fit: sentences carry the label of their document, an insult may stand in any one of them (multiple instances).
Words that stand in sentences of several different toxic documents and hardly in others start as positive, words of
other sentences as negative; the machine is fitted on Nyström features of some hundred landmark words, then once more
with the clean sentences' words it got wrong. Since its function is a sum over landmarks, it folds into one weight per
letter triple: scoring looks up triples, once for each distinct word of a batch. A text's score is calibrated from
its three worst words, and a sentence's margin is that of its worst word (:func:`worst_sentences`).

Defined cases: NULL counts as empty; a text without words scores as the mildest text; repeated rows score equally;
extra columns stay. Without labels of both kinds every score is 0.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import by_slices, held_out, lowest_hash, text_or_empty, word_codes

TOXIC_ROWS, CLEAN_ROWS = 3000, 6000  # most labelled documents that a fit reads
WORDS = 12000  # most negative words of a fit
POSITIVE_WORDS = 1500  # most positive words of a fit
LANDMARKS = 300
LEAST_SHARE = 0.008  # of the toxic documents, at least two, in which an insult must stand
THRESHOLD = 0.5
DECAY, SPAN = 0.7, 5
MILDEST = -4.0  # margin of a word that isn't there

_BITS = 6
N_TRIPLES = 1 << 3 * _BITS
_EDGE = 27
_STEPS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]


def _symbols(points: np.ndarray) -> np.ndarray:
    """Codes from 1 to 63 of letters, 0 of anything else."""
    ascii_letter = (points >= 97) & (points <= 122)
    beyond = points >= 0xAA
    return np.where(ascii_letter, points - 96, np.where(beyond, 28 + points % 36, 0)).astype(np.int32)


def triples(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, triple and weight of each letter triple within the span, words framed by edge marks; norms are 1."""
    count = len(words)
    if not count:
        return np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0)
    joined = "\0\0\0\0".join(["", *words, ""])  # wide enough to keep words apart
    points = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    sizes = np.fromiter(map(len, words), np.int64, count)
    starts = 4 + np.concatenate([[0], np.cumsum(sizes[:-1] + 4)])
    symbols = _symbols(points)
    symbols[starts - 1] = _EDGE
    symbols[starts + sizes] = _EDGE
    owner = np.repeat(np.arange(count), sizes + 4)
    owner = np.concatenate([np.zeros(3, np.int64), owner, np.full(len(symbols) - 3 - len(owner), count - 1)])
    owners, found, weights = [], [], []
    for a, b in _STEPS:
        first, second, third = symbols[:-b], symbols[a : a - b], symbols[b:]
        good = (first > 0) & (second > 0) & (third > 0) & (owner[:-b] == owner[b:])
        at = np.flatnonzero(good)
        owners.append(owner[at])
        found.append((first[at] << 2 * _BITS) | (second[at] << _BITS) | third[at])
        weights.append(np.full(len(at), DECAY ** (b + 1)))
    owners, found, weights = np.concatenate(owners), np.concatenate(found), np.concatenate(weights)
    norms = np.sqrt(np.bincount(owners, weights * weights, minlength=count))
    return owners, found, weights / norms[owners]


@dataclass(frozen=True)
class ToxicityModel:
    triple_weights: np.ndarray
    bias: float
    calibration: tuple[float, float, float, float]  # of the three worst margins, and a constant

    def word_margins(self, words: list[str]) -> np.ndarray:
        owners, found, weights = triples(words)
        return np.bincount(owners, weights * self.triple_weights[found], minlength=len(words)) + self.bias

    def worst(self, texts: pa.Array) -> np.ndarray:
        """The three highest margins among the words of each text, repeats counted."""
        codes, starts, vocabulary = word_codes(texts)
        words = vocabulary.to_pylist()
        margins = np.maximum(self.word_margins(words), MILDEST) if words else np.empty(0)
        each = margins[codes]
        top = np.full((len(texts), 3), MILDEST)
        left = each.copy()
        filled = np.flatnonzero(np.diff(starts) > 0)
        for rank in range(3):
            if not len(filled):
                break
            highest = np.maximum.reduceat(left, starts[filled])
            top[filled, rank] = np.maximum(highest, MILDEST)
            of_text = np.repeat(highest, np.diff(starts)[filled])
            at = np.flatnonzero(left == of_text)
            owner = np.searchsorted(starts[1:], at, side="right")
            left[at[np.unique(owner, return_index=True)[1]]] = -np.inf
        self._spelled_out(codes, starts, vocabulary, top)
        return top

    def _spelled_out(self, codes, starts, vocabulary, top) -> None:
        """Runs of three or more single letters count as one word more."""
        single = (pc.utf8_length(vocabulary).to_numpy(zero_copy_only=False) == 1)[codes] if len(codes) else np.empty(0, bool)
        edges = np.diff(np.concatenate([[0], single.astype(np.int8), [0]]))
        begins, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        long = ends - begins >= 3
        begins, ends = begins[long], ends[long]
        if not len(begins):
            return
        letters = np.array(vocabulary.to_pylist(), object)
        owner = np.searchsorted(starts[1:], begins, side="right")
        stops = np.minimum(ends, starts[1:][owner])
        margins = self.word_margins(["".join(letters[codes[b:e]]) for b, e in zip(begins, stops, strict=True)])
        for text, margin in zip(owner, margins, strict=True):
            top[text] = np.sort(np.append(top[text], margin))[::-1][:3]

    def score(self, texts: pa.Array) -> np.ndarray:
        a, b, c, constant = self.calibration
        z = self.worst(texts) @ np.array([a, b, c]) + constant
        return 1 / (1 + np.exp(-z.clip(-30, 30)))


NOTHING = ToxicityModel(np.zeros(N_TRIPLES, np.float32), 0.0, (0.0, 0.0, 0.0, -40.0))


def kernel(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Normalised kernel values of every word with every landmark."""
    owners, found, weights = triples(landmarks)
    known, column = np.unique(found, return_inverse=True)
    dense = np.zeros((len(known), len(landmarks)))
    np.add.at(dense, (column, owners), weights)
    out = np.zeros((len(words), len(landmarks)))
    for start in range(0, len(words), 2000):
        part = words[start : start + 2000]
        owners, found, weights = triples(part)
        at = np.searchsorted(known, found).clip(0, max(len(known) - 1, 0))
        hit = known[at] == found if len(known) else np.zeros(len(found), bool)
        block = np.zeros((len(part), len(known)))
        np.add.at(block, (owners[hit], at[hit]), weights[hit])
        out[start : start + 2000] = block @ dense
    return out


def fit_machine(words: list[str], signs: np.ndarray, importance: np.ndarray, landmarks: list[str], cost: float = 3.0):
    """Squared-hinge machine on Nyström features, folded into one weight per triple and a bias."""
    values, vectors = np.linalg.eigh(kernel(landmarks, landmarks) + 1e-6 * np.eye(len(landmarks)))
    keep = values > 1e-4
    root = vectors[:, keep] / np.sqrt(values[keep])
    x = np.hstack([kernel(words, landmarks) @ root, np.ones((len(words), 1))])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    theta = np.zeros(x.shape[1])
    for _ in range(30):  # Newton steps over the rows within the margin
        inside = signs * (x @ theta) < 1
        weighted = x[inside] * (cost * importance[inside])[:, None]
        new = np.linalg.solve(ridge + weighted.T @ x[inside], weighted.T @ signs[inside])
        if np.allclose(new, theta, atol=1e-7):
            break
        theta = new
    owners, found, weights = triples(landmarks)
    folded = np.bincount(found, weights * (root @ theta[:-1])[owners], minlength=N_TRIPLES)
    return folded.astype(np.float32), float(theta[-1])


def calibrate(worst: np.ndarray, toxic: np.ndarray) -> tuple[float, float, float, float]:
    """Logistic fit of the three worst margins, both kinds weighing alike. A worse word never makes a text milder."""
    x = np.hstack([worst, np.ones((len(worst), 1))])
    share = max(toxic.mean(), 1e-9)
    weight = np.where(toxic, 0.5 / share, 0.5 / max(1 - share, 1e-9))
    used = np.arange(4)
    while True:
        own, theta = x[:, used], np.zeros(len(used))
        for _ in range(60):
            p = 1 / (1 + np.exp(-(own @ theta).clip(-30, 30)))
            g = own.T @ (weight * (p - toxic)) / len(x) + 1e-3 * theta
            h = (own * (weight * p * (1 - p))[:, None]).T @ own / len(x) + 1e-3 * np.eye(len(used))
            theta = theta - np.linalg.solve(h, g)
        if (theta[:-1] >= 0).all():
            full = np.zeros(4)
            full[used] = theta
            return tuple(map(float, full))
        used = np.append(used[:-1][theta[:-1] >= 0], 3)


def labelled_sample(documents: DataFrame, labels: DataFrame, toxic_rows: int, clean_rows: int) -> DataFrame:
    """``doc_id, text, toxic`` of at most so many labelled documents that aren't held out."""
    known = labels.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()).where("toxic IS NOT NULL")
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = lowest_hash(known.where("toxic = 1"), "doc_id", toxic_rows, 11)
    chosen = chosen.unionByName(lowest_hash(known.where("toxic <> 1"), "doc_id", clean_rows, 12))
    few = F.broadcast(chosen.withColumn("toxic", (F.col("toxic") == 1).cast("int")))  # bounded by the two parameters
    return documents.select("doc_id", text_or_empty(F.col("text")).alias("text")).join(few, "doc_id")


def _bags(texts: pa.Array) -> pa.Array:
    """Of each text: a number that copies share, and the distinct words of its sentences."""

    def run(part: pa.Array) -> list[dict]:
        out = []
        for text in part.to_pylist():
            words = {w for w in re.split(r"[\s.!?]+", text.lower()) if 3 <= len(w) <= 40}
            longest = max(words, key=lambda w: (len(w), w), default="")
            out.append({"copy": longest, "words": sorted(words)})
        return out

    return by_slices(run, texts, pa.struct([("copy", pa.string()), ("words", pa.list_(pa.string()))]))


def sentence_words(sample: DataFrame) -> DataFrame:
    """Words of the sentences of each document: how many different documents of either label have them.

    Copies of a document count once: documents with the same longest word are taken for copies.
    """
    bags = sample.select("toxic", F.arrow_udf(_bags, "copy string, words array<string>")("text").alias("bag"))
    rows = bags.select("toxic", F.xxhash64("bag.copy").alias("copy"), F.explode("bag.words").alias("word"))
    counts = rows.distinct().groupBy("word")
    return counts.agg(F.sum("toxic").alias("in_toxic"), F.sum(1 - F.col("toxic")).alias("in_clean"))


def train(documents: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS) -> ToxicityModel:
    """Fit on a bounded sample of labelled documents; the driver gets a bounded number of words and margins."""
    sample = stage(labelled_sample(documents, labels, toxic_rows, clean_rows), "toxic-sample")
    counts = stage(sentence_words(sample), "toxic-words")
    least = max(2, math.ceil(LEAST_SHARE * sample.where("toxic = 1").count()))
    insult = (F.col("in_toxic") >= least) & (F.col("in_clean") <= 0.05 * F.col("in_toxic"))
    order = F.when(insult, -F.col("in_toxic")).otherwise(0)
    kept = counts.withColumn("insult", insult).withColumn("_h", F.xxhash64(F.lit(13), "word"))
    positive = kept.where("insult").orderBy(order, "_h", "word").limit(POSITIVE_WORDS)
    clean = kept.where("in_clean > 0 AND NOT insult")
    common = clean.orderBy(F.col("in_clean").desc(), "_h", "word").limit(WORDS // 4)
    rare = clean.orderBy("_h", "word").limit(WORDS - WORDS // 4)
    rows = positive.unionByName(common).unionByName(rare).select("word", "insult", "in_toxic", "in_clean").distinct().collect()
    rows = sorted(rows, key=lambda r: (not r["insult"], r["word"]))
    words = [r["word"] for r in rows]
    signs = np.array([1.0 if r["insult"] else -1.0 for r in rows])
    if not (signs > 0).any() or not (signs < 0).any():
        return NOTHING
    importance = np.array([np.log1p(r["in_toxic"] if r["insult"] else r["in_clean"]) for r in rows])
    shuffle = np.random.default_rng(14).permutation
    yes, no = np.flatnonzero(signs > 0), np.flatnonzero(signs < 0)
    some = lambda at, n: [words[i] for i in at[shuffle(len(at))[:n]]]
    best = yes[np.argsort(-importance[yes], kind="stable")]
    landmarks = [words[i] for i in best[: LANDMARKS // 2]] + some(no, LANDMARKS // 2)
    folded, bias = fit_machine(words, signs, importance, landmarks)

    # The clean sentences' words that it takes for insults become negatives, and some of them landmarks.
    first = ToxicityModel(folded, bias, (1.0, 0.0, 0.0, 0.0))
    hard = clean.where("in_clean > in_toxic").select("word", "in_clean", F.arrow_udf(_margins(first), "double")("word").alias("margin"))
    hard = hard.orderBy(F.col("margin").desc(), "word").limit(WORDS // 4).collect()
    seen = set(words)
    more = [r for r in hard if r["word"] not in seen]
    words += [r["word"] for r in more]
    signs = np.append(signs, np.full(len(more), -1.0))
    importance = np.append(importance, np.log1p([float(r["in_clean"]) for r in more]))
    landmarks += [r["word"] for r in more[: LANDMARKS // 3]]
    folded, bias = fit_machine(words, signs, importance, landmarks)

    rough = ToxicityModel(folded, bias, (1.0, 0.0, 0.0, 0.0))

    def worst(texts: pa.Array) -> pa.Array:
        return by_slices(lambda part: list(rough.worst(part)), texts, pa.list_(pa.float64()))

    rows = sample.select("doc_id", "toxic", F.arrow_udf(worst, "array<double>")("text").alias("worst")).orderBy("doc_id").collect()
    return ToxicityModel(folded, bias, calibrate(np.array([r["worst"] for r in rows]), np.array([r["toxic"] == 1 for r in rows])))


def _margins(model: ToxicityModel):
    def run(words: pa.Array) -> pa.Array:
        return by_slices(lambda part: model.word_margins(part.to_pylist()), words, pa.float64())

    return run


def score(documents: DataFrame, model: ToxicityModel, text: str = "text", out: str = "score") -> DataFrame:
    """``documents`` with a score between 0 and 1; no shuffle, every whole text."""

    def run(texts: pa.Array) -> pa.Array:
        return by_slices(model.score, texts, pa.float64())

    return documents.withColumn(out, F.arrow_udf(run, "double").asNondeterministic()(F.col(text)))


def worst_sentences(documents: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """``doc_id, sentence, margin`` for the sentences whose worst word lies on the toxic side."""
    sentences = documents.select("doc_id", F.explode(F.split(text_or_empty(F.col(text)), r"(?<=[.!?])\s+|\n")).alias("sentence"))

    def run(texts: pa.Array) -> pa.Array:
        return by_slices(lambda part: model.worst(part)[:, 0], texts, pa.float64())

    scored = sentences.withColumn("margin", F.arrow_udf(run, "double").asNondeterministic()("sentence"))
    return scored.where("margin > 0")


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each document."""
    scored = score(documents.select("doc_id", "text"), train(documents, labels))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
