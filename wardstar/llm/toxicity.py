"""Toxicity by a classifier chain.

Categories are predicted one after the other: the model of a category sees the text and the
probabilities of the categories before it. In training these probabilities come from models that
have not seen the document (out-of-fold), so later models learn how far earlier ones can be
trusted on new texts.

The verdict is the last category of the chain: whether a document is toxic is decided with the
probabilities that it repeats telling words or is dense with them.

The text enters as the set of its telling features: words and word beginnings that are far more
frequent in toxic than in other labelled documents, counted over all of these. Counts of all
features are summed up before they are shuffled; at most VOCABULARY of them are kept. Models are
linear with a logistic link, fitted on at most FIT_ROWS labelled documents. Every text is scored
whole, each distinct word once per task. Of the texts only those with a label are shuffled.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstar.llm.quality_classifier import HELD_OUT_FOLD, fold
from wardstar.llm.words import plain_words
from wardstar.operators.joins import lookup_join, may_match
from wardstar.session import stage

CATEGORIES = ("repeated", "dense", "toxic")
FIT_ROWS = 10_000
VOCABULARY = 4096
PREFIXES = (4, 5, 6)
LEAST_SCORE = 5.0
LEAST_DOCUMENTS = 3
INNER_FOLDS = 4
ROUNDS = 12
TOXIC_FROM = 0.5
# What makes a toxic document one with repeated or dense toxic language: occurrences of telling words, their share.
REPEATED_FROM, DENSE_FROM = 3, 0.02
COUNTED_FEATURES = 400_000  # that a task holds before it passes them on


def parts(word: bytes) -> list[bytes]:
    """A word as a feature, and its beginnings."""
    return [word, *[word[:n] + b"*" for n in PREFIXES if len(word) > n]]


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents with each feature by label; the row without a feature counts all documents."""
    both: tuple[Counter, Counter] = (Counter(), Counter())

    def counted() -> pd.DataFrame:
        names = list(both[0].keys() | both[1].keys())
        rows = pd.DataFrame({"feature": names, "n0": [both[0][f] for f in names], "n1": [both[1][f] for f in names]})
        both[0].clear(), both[1].clear()
        return rows

    for batch in batches:
        for text, label in zip(batch["t"], batch["y"], strict=True):
            both[int(label)].update({p for w in set(plain_words(text)) for p in parts(w)})
            both[int(label)][None] += 1
            if len(both[0]) + len(both[1]) > COUNTED_FEATURES:
                yield counted()
    yield counted()


def vocabulary(rows: DataFrame, most: int = VOCABULARY) -> dict[bytes, int]:
    """The features that tell toxic documents, numbered. ``rows``: t (text), y (0 or 1)."""
    counted = rows.mapInPandas(_count, "feature binary, n0 bigint, n1 bigint")
    summed = counted.groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    often = stage(summed.filter((F.col("n1") >= LEAST_DOCUMENTS) | F.col("feature").isNull()), "toxic-counts")
    totals = often.filter("feature is null").first()
    if totals is None or not totals["n0"] or not totals["n1"]:
        return {}
    p, n = F.col("n1") + 0.5, F.col("n0") + 0.5
    ratio = F.log(p / n) - math.log((totals["n1"] + 1) / (totals["n0"] + 1))
    scored = often.filter("feature is not null").withColumn("z", ratio / F.sqrt(1 / p + 1 / n))
    best = scored.filter(F.col("z") >= LEAST_SCORE).orderBy(F.desc("z"), "feature").limit(most)
    return {bytes(r["feature"]): i for i, r in enumerate(best.select("feature").collect())}


class Reader:
    """Feature numbers of a text, how many of its words have any, and its words."""

    def __init__(self, known: dict[bytes, int]):
        self.known = known
        self.cache: dict[bytes, tuple[int, ...]] = {}

    def _look(self, word: bytes) -> tuple[int, ...]:
        found = tuple(self.known[p] for p in parts(word) if p in self.known)
        if len(self.cache) > 500_000:
            self.cache.clear()
        self.cache[word] = found
        return found

    def __call__(self, text: str | None) -> tuple[list[int], int, int]:
        words = plain_words(text)
        counts = Counter(words)
        cache, look = self.cache, self._look
        found: set[int] = set()
        telling = 0
        for word, n in counts.items():
            hit = cache.get(word)
            if hit is None:
                hit = look(word)
            if hit:
                found.update(hit)
                telling += n
        return sorted(found), telling, len(words)


@dataclass(frozen=True)
class Linear:
    weights: np.ndarray
    chain: np.ndarray
    bias: float

    def probability(self, features: list[int], earlier: list[float]) -> float:
        total = self.weights[features].sum() + self.bias + float(np.dot(self.chain, [logit(p) for p in earlier]))
        return float(1 / (1 + math.exp(-max(-500.0, min(500.0, total)))))


def logit(p: float) -> float:
    p = min(max(p, 1e-3), 1 - 1e-3)
    return math.log(p / (1 - p))


def fit_linear(rows: list[list[int]], earlier: np.ndarray, y: np.ndarray, size: int, seed: int = 0) -> Linear:
    """Logistic regression by adaptive gradient steps; with one class only, its smoothed share."""
    n, chained = len(rows), earlier.shape[1]
    if n == 0 or y.min() == y.max():
        share = (y.sum() + 1) / (n + 2)
        return Linear(np.zeros(size), np.zeros(chained), logit(float(share)))
    features = [np.array(r, np.int64) for r in rows]
    before = np.vectorize(logit, otypes=[float])(earlier) if earlier.size else earlier
    weights, seen = np.zeros(size), np.full(size, 1e-2)
    chain, chain_seen, bias, bias_seen = np.zeros(chained), np.full(chained, 1e-2), 0.0, 1e-2
    draw = np.random.default_rng(seed)
    for _ in range(ROUNDS):
        for i in draw.permutation(n):
            at = features[i]
            z = weights[at].sum() + bias + chain @ before[i]
            gradient = 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - y[i]
            own = gradient + 1e-4 * weights[at]
            seen[at] += own**2
            weights[at] -= 0.1 * own / np.sqrt(seen[at])
            along = gradient * before[i] + 1e-4 * chain
            chain_seen += along**2
            chain = chain - 0.1 * along / np.sqrt(chain_seen)
            bias_seen += gradient**2
            bias -= 0.1 * gradient / math.sqrt(bias_seen)
    return Linear(weights, chain, float(bias))


@dataclass(frozen=True)
class Chain:
    known: dict[bytes, int]
    models: tuple[Linear, ...]

    def probabilities(self, features: list[int]) -> list[float]:
        out: list[float] = []
        for model in self.models:
            out.append(model.probability(features, out))
        return out


def fit_chain(known: dict[bytes, int], rows: list[list[int]], labels: np.ndarray) -> Chain:
    """One model per column of ``labels``, in order; earlier probabilities are out-of-fold."""
    n, categories = labels.shape
    size = max(1, len(known))
    earlier = np.zeros((n, 0))
    part = np.arange(n) % INNER_FOLDS
    models = []
    for c in range(categories):
        y = labels[:, c].astype(float)
        models.append(fit_linear(rows, earlier, y, size))
        out = np.zeros(n)
        for k in range(INNER_FOLDS):
            inside, left = np.flatnonzero(part != k), np.flatnonzero(part == k)
            model = fit_linear([rows[i] for i in inside], earlier[inside], y[inside], size, k + 1)
            for i in left:
                out[i] = model.probability(rows[i], list(earlier[i]))
        earlier = np.column_stack([earlier, out])
    return Chain(known, tuple(models))


def train(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    fit_rows: int = FIT_ROWS,
) -> Chain:
    """The chain over CATEGORIES from at most ``fit_rows`` labelled documents, chosen by a hash.

    Its vocabulary comes from all labelled documents that are not left out. Documents of the
    held-out fold are left out, so that the chain can be measured on them; so are null ids and
    labels other than 0 and 1. A document with several labels counts with the largest. Rows that
    repeat an id and its text are fitted once. "repeated" and "dense" are toxic documents in which
    telling words occur several times, or with a large share of them.
    """
    given = labels.select(F.col(f"`{doc_id}`").alias("k"), F.col(f"`{label}`").cast("int").alias("y"))
    given = given.filter("k is not null and y in (0, 1)").groupBy("k").agg(F.max("y").alias("y"))
    known_labels = stage(given.filter(fold("k") != HELD_OUT_FOLD), "toxic-labels")
    texts = docs.select(F.col(f"`{doc_id}`").alias("k"), F.col(f"`{text}`").alias("t"))
    few = may_match(texts, known_labels, "k")
    labelled = stage(
        lookup_join(few, known_labels, "k", "inner", keys_from=texts.select("k"), broadcast=False), "toxic-texts"
    )
    known = vocabulary(labelled.select("t", "y"))
    hashed = labelled.withColumn("h", F.xxhash64("k", "t"))
    last = hashed.select("h").distinct().orderBy("h").limit(fit_rows).agg(F.max("h")).first()[0]
    rows = hashed.filter(F.col("h") <= F.lit(last)).dropDuplicates(["h"])

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(known)
        for batch in batches:
            made = [reader(t) for t in batch["t"]]
            yield pd.DataFrame(
                {
                    "k": batch["k"],
                    "y": batch["y"],
                    "f": [m[0] for m in made],
                    "telling": [m[1] for m in made],
                    "words": [m[2] for m in made],
                }
            )

    # at most fit_rows rows of at most VOCABULARY numbers
    found = rows.mapInPandas(read, "k bigint, y int, f array<int>, telling bigint, words bigint").toPandas()
    found = found.sort_values(["k", "words", "telling"], kind="stable")
    y = found["y"].to_numpy()
    sets = [[int(i) for i in f] for f in found["f"]]
    several = found["telling"].to_numpy() >= REPEATED_FROM
    dense = found["telling"].to_numpy() >= DENSE_FROM * np.maximum(found["words"].to_numpy(), 1)
    table = np.stack([y * several, y * dense, y], 1) if sets else np.zeros((0, len(CATEGORIES)))
    return fit_chain(known, sets, table)


def scored(docs: DataFrame, model: Chain, text: str = "text", into: str = "toxicity") -> DataFrame:
    """``docs`` with a struct of the probabilities of CATEGORIES; null and empty texts have them too."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join(f"{c} double" for c in CATEGORIES)

    @F.pandas_udf(schema)
    def probabilities(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        chain = sent.value
        reader = Reader(chain.known)
        for batch in texts:
            yield pd.DataFrame([chain.probabilities(reader(t)[0]) for t in batch], columns=list(CATEGORIES), dtype="float64")

    return docs.withColumn(into, probabilities(F.col(f"`{text}`")))
