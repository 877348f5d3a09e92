"""Quality rules as weak supervision.

Rules look at one document and vote good, bad or abstain. Expectation-maximisation over the
counts of vote patterns estimates how often each rule gives each vote on good and on bad
documents; the posterior probability of being good replaces "all rules must pass".

The text is read by one Arrow-batched function that returns counts; votes are column
expressions on these counts. Only the counts of the distinct vote patterns reach the driver:
at most 3 ** len(RULES) rows, however many documents there are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


from wardstar.llm.words import BLANKS, raw

# Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

KEEP_FROM = 0.5
# A bad vote is taken to be at least so many times as likely on a bad document as on a good one.
LEAST_GAIN = 10.0
MEASURES = (
    "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_distinct n_twins n_upper n_letters n_marks"
).split()
MEASURE_TYPE = T.StructType([T.StructField(name, T.LongType(), False) for name in MEASURES])

_UPPER = bytes(range(65, 91))
_LETTERS = bytes([*range(65, 91), *range(97, 123)])


def _without(data: bytes, drop: bytes) -> int:
    return len(data) - len(data.translate(None, drop))


def repeated_words(numbers: np.ndarray) -> int:
    """Words inside any 3-word window that the text has twice or more, the first one included."""
    n = len(numbers)
    if n < 4:
        return 0
    pairs = np.unique(numbers[:-1] * (int(numbers.max()) + 1) + numbers[1:], return_inverse=True)[1]
    windows = pairs[:-1] * (int(numbers.max()) + 1) + numbers[2:]
    _, where, count = np.unique(windows, return_inverse=True, return_counts=True)
    hit = count[where] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= hit
    return int(covered.sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The counts named in MEASURES, for one whole text; null counts as empty."""
    data = raw(text)
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.strip()]
    known: dict[bytes, int] = {}
    numbers = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    return (
        len(words),
        len(text or "") - _without(data, BLANKS),
        _without(data, SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(numbers),
        len(lines),
        len(known),
        int((numbers[1:] == numbers[:-1]).sum()),
        _without(data, _UPPER),
        _without(data, _LETTERS),
        _without(data, b"!?"),
    )


@F.pandas_udf(MEASURE_TYPE)
def measures(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measure(t) for t in texts], columns=MEASURES).astype("int64")


def _share(part: Column, whole: Column) -> Column:
    return part / F.greatest(whole, F.lit(1))


def _bad_if(condition: Column) -> Column:
    return F.when(condition, -1).otherwise(0)


def rules(m: Column) -> dict[str, Column]:
    """Votes over the struct ``m`` of measures: 1 good, -1 bad, 0 abstain.

    A rule that looks for one kind of junk abstains when it finds none: the text may well be
    junk of another kind. Good votes come from rules on what prose looks like.
    """
    words, enough = m.n_words, m.n_words >= 20
    symbols, repeats = _share(m.n_symbols, words), _share(m.n_repeat_words, words)
    capitals, marks, variety = _share(m.n_upper, m.n_letters), _share(m.n_marks, words), _share(m.n_distinct, words)
    return {
        "symbols": _bad_if(symbols >= 0.15),
        "repeats": _bad_if(enough & (repeats >= 0.5)),
        "twins": _bad_if(enough & (_share(m.n_twins, words) >= 0.15)),
        "variety": _bad_if(enough & (words <= 1000) & (variety <= 0.15)),
        "capitals": _bad_if((m.n_letters >= 50) & (capitals >= 0.3)),
        "marks": _bad_if(marks >= 0.2),
        "lines": _bad_if((m.n_lines >= 4) & (_share(m.n_dup_lines, m.n_lines) >= 0.5)),
        "tiny": _bad_if(words < 5),
        "plain": F.when((symbols < 0.02) & (marks < 0.05) & (capitals < 0.15), 1).otherwise(0),
        "fresh": F.when(enough & (repeats < 0.5), 1).otherwise(0),
        "long": F.when(words >= MIN_WORDS, 1).otherwise(0),
    }


def base_failed(m: Column) -> Column:
    return (m.n_words < MIN_WORDS) | (m.n_repeat_words * 100 > m.n_words * MAX_REPEAT_PERCENT)


@dataclass(frozen=True)
class LabelModel:
    """Votes are taken as independent given the class.

    prior_good: share of good documents. chance[c, r, v + 1]: probability that rule r votes v
    on class c (0 bad, 1 good).
    """

    prior_good: float
    chance: np.ndarray
    names: tuple[str, ...]

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        logs = np.log(self.chance)[:, np.arange(votes.shape[1]), votes + 1].sum(axis=2)
        logs += np.log([[1 - self.prior_good], [self.prior_good]])
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))

    def probability(self, votes: dict[str, Column]) -> Column:
        """The posterior as a column over the vote columns."""
        odds = F.lit(float(np.log(self.prior_good / (1 - self.prior_good))))
        gain = np.log(self.chance[1]) - np.log(self.chance[0])
        for (bad, none, good), name in zip(gain.tolist(), self.names, strict=True):
            odds = odds + F.when(votes[name] == 1, good).when(votes[name] == -1, bad).otherwise(none)
        return 1 / (1 + F.exp(-odds))


def estimate(votes: np.ndarray, counts: np.ndarray, names: tuple[str, ...], rounds: int = 200) -> LabelModel:
    """Expectation-maximisation on distinct vote patterns and their counts.

    Rules that fire on the same kind of junk are correlated, and without a bound the bad class
    may shrink to that kind while the votes of other rules count as noise. So the rate of bad
    votes keeps a ratio of LEAST_GAIN at least between the classes, at an unchanged overall rate.
    A smoothing count keeps every probability above 0; no documents give the start values.
    """
    n_rules = len(names)
    model = LabelModel(0.8, np.tile([[[0.4, 0.1, 0.5]], [[0.01, 0.1, 0.89]]], (1, n_rules, 1)), names)
    if not counts.sum():
        return model
    one_hot = (votes[:, :, None] == np.array([-1, 0, 1])).astype(float)
    for _ in range(rounds):
        good = model.posterior(votes)
        weight = np.stack([(1 - good) * counts, good * counts])
        cells = np.einsum("cp,prv->crv", weight, one_hot) + 0.5
        chance = cells / cells.sum(axis=2, keepdims=True)
        prior = float((weight[1].sum() + 1) / (counts.sum() + 2))
        low = chance[0, :, 0] < LEAST_GAIN * chance[1, :, 0]
        overall = (1 - prior) * chance[0, low, 0] + prior * chance[1, low, 0]
        on_good = np.minimum(overall / (prior + LEAST_GAIN * (1 - prior)), 0.9 / LEAST_GAIN)
        for c, rate in ((0, LEAST_GAIN * on_good), (1, on_good)):
            chance[c, low, 1:] *= ((1 - rate) / (1 - chance[c, low, 0]))[:, None]
            chance[c, low, 0] = rate
        settled = np.abs(chance - model.chance).max() < 1e-9
        model = LabelModel(prior, chance, names)
        if settled:
            break
    return model


def measured(docs: DataFrame, text: str = "text", into: str = "measures") -> DataFrame:
    """``docs`` with a struct column ``into`` of MEASURES over the whole text."""
    return docs.withColumn(into, measures(F.col(f"`{text}`")))


def fit(docs: DataFrame, into: str = "measures") -> LabelModel:
    """The label model of all documents of a :func:`measured` table."""
    votes = rules(F.col(into))
    patterns = docs.groupBy(*[v.cast("int").alias(n) for n, v in votes.items()]).agg(F.count(F.lit(1)).alias("n"))
    # at most 3 ** len(votes) rows, whatever the size of docs
    found = [tuple(r) for r in patterns.collect()]
    table = np.array(sorted(found), dtype=np.int64).reshape(len(found), len(votes) + 1)
    return estimate(table[:, :-1], table[:, -1].astype(float), tuple(votes))


def judged(docs: DataFrame, model: LabelModel, into: str = "measures", keep_from: float = KEEP_FROM) -> DataFrame:
    """Columns base_failed, quality_probability and kept beside those of a measured table."""
    m = F.col(into)
    failed = base_failed(m)
    probability = model.probability(rules(m))
    return docs.withColumns(
        {
            "base_failed": failed,
            "quality_probability": probability,
            "kept": ~failed & (probability >= keep_from),
        }
    )


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is kept, with exactly the columns of ``docs``.

    The texts are measured twice, for the model and for the filter, so that no copy of them
    is stored. Null and empty texts fail the base rules; equal rows share one verdict.
    """
    into = "_measures"
    while into in docs.columns:
        into += "_"
    model = fit(measured(docs.select(text), text, into), into)
    held = measured(docs, text, into)
    m = F.col(into)
    return held.filter(~base_failed(m) & (model.probability(rules(m)) >= KEEP_FROM)).drop(into)
