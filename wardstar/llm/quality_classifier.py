"""Quality classifier: naive Bayes support vectors.

A text becomes the set of its n-grams: words, and runs of one to three word shapes (letters by
case, digits, other characters as they are, "=" for a word that repeats the one before). Each
indicator is scaled by the log-count ratio of the two classes; a linear hinge-loss model on the
scaled, length-normalised vectors is fitted by dual coordinate descent; a logistic curve through
margins of documents left out of a fit turns margins into probabilities.

The fit sees at most FIT_ROWS labelled documents, chosen by a hash. Every text is scored whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardstar.llm.words import split_words

FIT_ROWS = 8_000
BITS = 18
DIMENSIONS = 1 << BITS
KEEP_FROM = 0.3
HELD_OUT_FOLD, FOLDS = 0, 5
COST = 1.0
ROUNDS = 30
INTERPOLATION = 0.9

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def shape(word: bytes) -> str:
    """Letters as a (lower case), A (first one upper) or C (all upper), digits as 0."""
    text = word.decode("utf-8", "surrogatepass")
    text = re.sub(r"[^\W\d_]+", lambda m: _case(m.group()), text)
    return re.sub(r"\d+", "0", text)[:8]


def _case(letters: str) -> str:
    if len(letters) > 1 and letters.isupper():
        return "C"
    return "A" if letters[0].isupper() else "a"


class Features:
    """Distinct feature numbers of a text."""

    def __init__(self) -> None:
        self.place: dict[bytes, int] = {}
        self.words = np.empty(0, np.uint64)
        self.shapes = np.empty(0, np.uint64)

    def _learn(self, words: list[bytes]) -> None:
        if len(self.place) > 300_000:
            self.place.clear()
        fresh = [w for w in dict.fromkeys(words) if w not in self.place]
        first, after = len(self.place), len(self.place) + len(fresh)
        self.place.update(zip(fresh, range(first, after), strict=True))
        if after > len(self.words):
            grown = np.empty(after, np.uint64)
            self.words = np.concatenate([self.words[:first], grown])
            self.shapes = np.concatenate([self.shapes[:first], grown])
        bare = (w.lower().strip(b".,;:!?\"'()") for w in fresh)
        self.words[first:after] = np.frombuffer(b"".join(map(xxhash.xxh64_digest, bare)), ">u8")
        self.shapes[first:after] = np.frombuffer(b"".join(xxhash.xxh64_digest(shape(w)) for w in fresh), ">u8")

    def __call__(self, text: str | None) -> np.ndarray:
        words = split_words(text)
        if not words:
            return np.empty(0, np.int64)
        try:
            at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        except KeyError:
            self._learn(words)
            at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        s = self.shapes[at]
        s[1:][at[1:] == at[:-1]] = np.uint64(61)
        one = (s + _B) * _A
        two = (one[:-1] + s[1:]) * _A
        three = (two[:-1] + s[2:]) * _A
        grams = np.concatenate([self.words[at] * _B, one, two, three])
        return np.unique((grams ^ (grams >> np.uint64(29))) * _A >> np.uint64(64 - BITS)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    """score = 1 / (1 + exp(-(slope * margin + offset))); margin = weights . x / |scale . x| + bias."""

    scale: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, features: np.ndarray) -> float:
        norm = float(np.sqrt((self.scale[features] ** 2).sum())) or 1.0
        return float(self.weights[features].sum()) / norm + self.bias

    def score(self, features: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(features) + self.offset, -500, 500))))


def log_count_ratio(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """log of the smoothed, normalised indicator counts of label 1 over those of label 0."""
    counts = np.ones((2, DIMENSIONS))
    for row, label in zip(rows, labels, strict=True):
        counts[label, row] += 1
    p = counts / counts.sum(axis=1, keepdims=True)
    return np.log(p[1] / p[0])


def fit_hinge(rows: list[np.ndarray], labels: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray, float]:
    """Scale, weights on plain indicators, bias: dual coordinate descent on the scaled vectors.

    Classes weigh alike: the cost of a document is divided by the share of its class.
    """
    scale = log_count_ratio(rows, labels)
    y = 2.0 * labels - 1
    share = np.bincount(labels, minlength=2) / len(labels)
    most = COST / (2 * share[labels])
    values = []
    for row in rows:
        v = scale[row]
        values.append(v / (np.sqrt((v**2).sum()) or 1.0))
    square = np.array([(v**2).sum() + 1 for v in values])
    w, bias, alpha = np.zeros(DIMENSIONS), 0.0, np.zeros(len(rows))
    order = np.random.default_rng(seed)
    for _ in range(ROUNDS):
        largest = 0.0
        for i in order.permutation(len(rows)):
            gradient = y[i] * (w[rows[i]] @ values[i] + bias) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), most[i])
            step = (new - alpha[i]) * y[i]
            if step:
                w[rows[i]] += step * values[i]
                bias += step
                alpha[i] = new
                largest = max(largest, abs(step))
        if largest < 1e-3:
            break
    mean = np.abs(w).sum() / max(1, np.count_nonzero(w))
    return scale, ((1 - INTERPOLATION) * mean * np.sign(w) + INTERPOLATION * w) * scale, bias


def fit_curve(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through smoothed labels."""
    n1, n0 = int(labels.sum()), int((1 - labels).sum())
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margins, np.ones(len(margins))], 1)
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (p - target) + 1e-6 * beta
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta = beta - step
        if np.abs(step).max() < 1e-8:
            break
    return float(max(beta[0], 1e-3)), float(beta[1])


def fit(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    """The model of labelled feature sets; with one class only, every score is its share."""
    none = np.zeros(DIMENSIONS)
    if len(set(labels.tolist())) < 2:
        share = (labels.sum() + 1) / (len(labels) + 2)
        return Model(none, none, 0.0, 1.0, float(np.log(share / (1 - share))))
    half = np.arange(len(rows)) % 2
    margins = np.zeros(len(rows))
    for left in (0, 1):
        inside = np.flatnonzero(half != left)
        if len(set(labels[inside].tolist())) < 2:
            inside = np.arange(len(rows))
        scale, weights, bias = fit_hinge([rows[i] for i in inside], labels[inside])
        part = Model(scale, weights, bias, 1.0, 0.0)
        for i in np.flatnonzero(half == left):
            margins[i] = part.margin(rows[i])
    return Model(*fit_hinge(rows, labels), *fit_curve(margins, labels))


def fold(doc_id: str) -> Column:
    return F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary")) % FOLDS


def train(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    fit_rows: int = FIT_ROWS,
) -> Model:
    """Fit on at most ``fit_rows`` labelled documents outside the held-out fold.

    Labels other than 0 and 1 and null ids are left out; a document with several labels counts
    with the largest.
    """
    known = labels.select(F.col(f"`{doc_id}`").alias("k"), F.col(f"`{label}`").cast("int").alias("y"))
    known = known.filter("k is not null and y in (0, 1)").groupBy("k").agg(F.max("y").alias("y"))
    chosen = known.filter(fold("k") != HELD_OUT_FOLD).orderBy(F.xxhash64("k"), "k").limit(fit_rows)
    texts = docs.select(F.col(f"`{doc_id}`").alias("k"), F.col(f"`{text}`").alias("t"))

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = Features()
        for batch in batches:
            sets = [made(t).astype("<i4").tobytes() for t in batch["t"]]
            yield pd.DataFrame({"k": batch["k"], "y": batch["y"], "f": sets})

    # both sides of the limit are bounded by fit_rows
    rows = texts.join(F.broadcast(chosen), "k").mapInPandas(features, "k bigint, y int, f binary").toPandas()
    rows = rows.sort_values(["k", "f"], kind="stable")
    sets = [np.frombuffer(f, "<i4").astype(np.int64) for f in rows["f"]]
    return fit(sets, rows["y"].to_numpy(np.int64))


def scored(docs: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 in ``into``; null and empty texts have a score too."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        made, known = Features(), sent.value
        for batch in texts:
            yield pd.Series([known.score(made(t)) for t in batch], dtype="float64")

    return docs.withColumn(into, score(F.col(f"`{text}`")))
