"""Personal data by weak supervision.

Base patterns find spans of four kinds. They take the longest run and drop it when a check
fails, so a phone number right before a card number hides both. Candidates are the base spans,
the runs that were dropped, cut at their blanks, and numbers in national form. Labelers vote on a
candidate or abstain: the pattern with its checks, a gazetteer of prefixes and top-level domains,
words around it, its grouping, and the characters next to it. Expectation-maximisation over the
counts of vote patterns estimates their reliability for each kind; its posteriors train a span
classifier on the votes and the shape of the span. Candidates that it accepts and that touch no
base span are added.

Every text is read once and whole. Only counts of vote patterns (at most 4 * 3 ** 5) and a bounded
sample of candidates for the classifier reach the driver.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstar.session import stage

# Kinds in order, patterns, gazetteers.
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NUMERIC = re.compile(r"[0-9][0-9.\x20-]{6,}")
NATIONAL = re.compile(r"(?<!\+[0-9] )(?<!\+[0-9]{2} )(?<!\+[0-9]{3} )\([0-9]{3}\) ?[0-9]{3}[ -][0-9]{4}(?![0-9])|(?<![0-9+().-])[0-9]{3}-[0-9]{3}-[0-9]{4}(?![0-9-])")
MASKED = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?[\[(]at[\])] ?[A-Za-z0-9-]{1,64}(?: ?[\[(]dot[\])] ?[A-Za-z0-9-]{2,24}){1,4}")
TOP_LEVEL = frozenset("com org net edu gov int info biz io co uk de fr es it nl eu us ca au ch at be se pl example".split())
CALLING_CODES = tuple("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91 351 352 353 358 380 420".split())
CARD_PREFIXES = ("4", "51", "52", "53", "54", "55", "22", "23", "24", "25", "26", "27", "34", "37", "6011", "65", "36", "38", "35", "62")
NEAR_GOOD = re.compile(r"\b(e-?mail|mail|contact|write|phone|tel|telephone|telefon|call|mobile|fax|card|visa|mastercard|amex|credit|ip|host|address|server|correo|courriel)\b", re.I)
NEAR_BAD = re.compile(r"(version|release|token|secret|password|key|id|isbn|sku|order|invoice|hash|sha|md5|section|chapter|v)[ \"'=:#.]*$", re.I)

NEAR = 40
LABELERS = ("pattern", "gazetteer", "context", "grouping", "edges")
DIMENSIONS = 1 << 12
FIT_ROWS = 20_000
ACCEPT = 0.5


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) << (i & 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _good_ip(text: str) -> bool:
    return all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in text.split("."))


def _good_card(text: str) -> bool:
    return 12 <= len(d := _digits(text)) <= 19 and luhn(d)


def _good_phone(text: str) -> bool:
    return 9 <= len(_digits(text)) <= 15


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the address pattern, each '@' looked at once."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            found.append((start, end))
        else:
            end = max(end, at + 1)
        at = text.find("@", at + 1)
    return found


Span = tuple[str, int, int]


def base_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Spans of the base patterns, and the runs of digits that failed their checks."""
    good: list[Span] = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    bad: list[Span] = []
    for run in NUMERIC.finditer(text):
        for kind, pattern, check in (("ip", IP, _good_ip), ("card", CARD, _good_card)):
            for m in pattern.finditer(text, run.start(), run.end()):
                if check(m.group()):
                    good.append((kind, m.start(), m.end()))
                elif kind == "card" and m.end() - m.start() > 12:
                    bad.append((kind, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            (good if _good_phone(m.group()) else bad).append(("phone", m.start(), m.end()))
    return sorted(good, key=order), bad


def order(span: Span) -> tuple[int, int, int]:
    return span[1], KINDS.index(span[0]), span[2]


def _cut(text: str, span: Span) -> Iterator[Span]:
    """Parts of a dropped run that begin and end at its blanks and pass the checks."""
    kind, start, end = span
    check, most = (_good_card, 19) if kind == "card" else (_good_phone, 15)
    words = [(m.start(), m.end()) for m in re.compile(r"[^\x20]+").finditer(text, start, end)]
    for i, (a, _) in enumerate(words[: 1 if kind == "phone" else None]):
        digits = ""
        for at in range(i, len(words)):
            first, b = words[at]
            digits += _digits(text[first:b])
            if len(digits) > most:
                break
            if check(digits):
                yield kind, a, b


def candidates(text: str, good: list[Span], bad: list[Span]) -> list[Span]:
    """Further spans to vote on."""
    found = {s for b in bad for s in _cut(text, b)}
    if "-" in text or ")" in text:
        found |= {("phone", m.start(), m.end()) for m in NATIONAL.finditer(text)}
    if "at]" in text or "at)" in text:
        found |= {("email", m.start(), m.end()) for m in MASKED.finditer(text)}
    return sorted(found - set(good), key=order)


def votes(text: str, span: Span) -> list[int]:
    """Votes of the LABELERS: 1 personal, -1 not, 0 abstain."""
    kind, start, end = span
    body, before = text[start:end], text[max(0, start - NEAR) : start]
    after = text[end : end + NEAR]
    digits = _digits(body)
    if kind == "email":
        pattern = 1 if DOMAIN.search(body, body.find("@") + 1) and "@" in body else 0
        gazetteer = 1 if re.split(r"[.\])\x20]+", body.lower())[-1] in TOP_LEVEL else -1
        grouping = -1 if ".." in body or body[0] in ".-%" else 1
    elif kind == "ip":
        pattern = 1 if _good_ip(body) else -1
        gazetteer = -1 if body.startswith(("0.", "127.", "255.")) else 0
        grouping = -1 if re.match(r"\.[0-9]", after) or re.search(r"[0-9]\.$", before) else 1
    elif kind == "card":
        pattern = 1 if _good_card(body) else -1
        gazetteer = 1 if digits.startswith(CARD_PREFIXES) else -1
        grouping = 1 if re.fullmatch(r"[0-9]{13,19}|([0-9]{4}[ -]){3}[0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}", body) else -1
    else:
        pattern = 1 if body[0] == "+" and _good_phone(body) else 0
        gazetteer = 0 if body[0] != "+" else 1 if digits.startswith(CALLING_CODES) else -1
        shaped = re.fullmatch(r"\+[0-9]{1,3}[ .-]?(\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}([ .-]?[0-9]{2,4}){1,4}|\+[0-9]{9,15}", body)
        grouping = 1 if shaped or NATIONAL.fullmatch(body) else -1
    context = -1 if NEAR_BAD.search(before) else 1 if NEAR_GOOD.search(before) else 0
    touched = (before[-1:] or " ") + (after[:1] or " ")
    edges = -1 if any(c.isalnum() or c in "_=/" for c in touched) else 1
    return [pattern, gazetteer, context, grouping, edges]


def _shape(text: str, span: Span) -> str:
    body = re.sub(r"[^\W\d_]+", "a", text[span[1] : span[2]])
    return re.sub(r"[0-9]", "9", body)[:40]


FOUND = (
    "base array<struct<kind:string,start:int,stop:int>>, "
    "more array<struct<kind:string,start:int,stop:int,votes:array<int>,shape:string>>"
)


def _read(texts: pd.Series) -> pd.DataFrame:
    base, more = [], []
    for text in texts:
        text = text or ""
        good, bad = base_spans(text)
        every = [*good, *candidates(text, good, bad)]
        base.append([{"kind": k, "start": a, "stop": b} for k, a, b in good])
        more.append(
            [
                {"kind": s[0], "start": s[1], "stop": s[2], "votes": votes(text, s), "shape": _shape(text, s)}
                for s in every
            ]
        )
    return pd.DataFrame({"base": base, "more": more})


# chance of the votes -1, 0 and 1 on what is not personal and on what is, before any count
START = np.array([[0.7, 0.2, 0.1], [0.1, 0.2, 0.7]])


def reliabilities(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Posterior of "personal" for each vote pattern of one kind.

    Votes are independent given the class; a vote for a class is at least twice as likely on it.
    """
    rules = patterns.shape[1]
    chance = np.tile(START[:, None, :], (1, rules, 1))
    prior = 0.5
    hot = (patterns[:, :, None] == np.array([-1, 0, 1])).astype(float)
    for _ in range(rounds):
        logs = np.log(chance)[:, np.arange(rules), patterns + 1].sum(axis=2) + np.log([[1 - prior], [prior]])
        good = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))
        cells = np.einsum("cp,prv->crv", np.stack([(1 - good) * counts, good * counts]), hot) + START[:, None, :]
        chance = cells / cells.sum(axis=2, keepdims=True)
        for vote, own in ((0, 0), (2, 1)):
            low = chance[own, :, vote] < 2 * chance[1 - own, :, vote]
            middle = chance[:, low, vote].mean(axis=0)
            chance[own, low, vote], chance[1 - own, low, vote] = middle * 4 / 3, middle * 2 / 3
        chance /= chance.sum(axis=2, keepdims=True)
        prior = float((good @ counts + 1) / (counts.sum() + 2))
    return good


@dataclass(frozen=True)
class SpanClassifier:
    weights: np.ndarray

    def score(self, features: list[int]) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.weights[features].sum(), -500, 500))))


def features(kind: str, votes_: list[int], shape: str) -> list[int]:
    """Feature numbers of a span: kind, each vote, each two votes, runs of its shape."""
    named = [kind, *[f"{kind}:{r}={v}" for r, v in zip(LABELERS, votes_, strict=True)]]
    named += [f"{kind}:{i}{votes_[i]}{j}{votes_[j]}" for i in range(len(votes_)) for j in range(i)]
    short = re.sub(r"9+", lambda m: f"9{len(m.group())}", shape)
    named += [f"{kind}~{short[i : i + 4]}" for i in range(max(1, len(short) - 3))]
    return sorted({xxhash.xxh64_intdigest(n) % DIMENSIONS for n in named})


def fit_classifier(rows: list[list[int]], target: np.ndarray, rounds: int = 40) -> SpanClassifier:
    """Logistic regression on probabilistic labels, by adaptive gradient steps."""
    weights, seen = np.zeros(DIMENSIONS), np.full(DIMENSIONS, 1e-2)
    draw = np.random.default_rng(0)
    for _ in range(rounds if rows else 0):
        for i in draw.permutation(len(rows)):
            at = rows[i]
            gradient = 1 / (1 + np.exp(-np.clip(weights[at].sum(), -30, 30))) - target[i] + 1e-4 * weights[at]
            seen[at] += gradient**2
            weights[at] -= 0.2 * gradient / np.sqrt(seen[at])
    return SpanClassifier(weights)


def read_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Base spans and candidates with their votes of every whole text, stored."""
    spans = F.pandas_udf(_read, FOUND)(F.col(f"`{text}`"))
    told = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("k"), spans.alias("found"))
    return stage(told.select("k", "found.base", "found.more"), "pii-spans")


def fit(found: DataFrame, fit_rows: int = FIT_ROWS) -> SpanClassifier:
    """Reliabilities from the vote patterns of all candidates, then the classifier."""
    each = found.select("k", F.explode("more").alias("m")).select("k", "m.*")
    counted = each.groupBy("kind", "votes").agg(F.count(F.lit(1)).alias("n")).collect()
    posterior: dict[tuple[str, tuple[int, ...]], float] = {}
    for kind in KINDS:
        own = sorted((tuple(r["votes"]), r["n"]) for r in counted if r["kind"] == kind)
        if own:
            good = reliabilities(np.array([v for v, _ in own]), np.array([n for _, n in own], float))
            posterior |= {(kind, v): p for (v, _), p in zip(own, good.tolist(), strict=True)}
    # a sample by hash of the distinct (kind, votes, shape), with how often they occur
    kinds = each.groupBy("kind", "votes", "shape").agg(F.count(F.lit(1)).alias("n"))
    sample = kinds.orderBy(F.xxhash64("kind", "votes", "shape"), "kind", "shape").limit(fit_rows).collect()
    rows = [features(r["kind"], list(r["votes"]), r["shape"]) for r in sample]
    target = np.array([posterior[r["kind"], tuple(r["votes"])] for r in sample])
    return fit_classifier(rows, target)


class Taken:
    """Places of a text that spans cover, as sorted intervals that do not overlap."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.starts: list[int] = []
        self.stops: list[int] = []
        for start, stop in sorted(spans):
            if self.stops and start < self.stops[-1]:
                self.stops[-1] = max(self.stops[-1], stop)
            else:
                self.starts.append(start)
                self.stops.append(stop)

    def free(self, start: int, stop: int) -> bool:
        at = bisect_right(self.stops, start)
        return at == len(self.starts) or self.starts[at] >= stop

    def add(self, start: int, stop: int) -> None:
        at = bisect_right(self.stops, start)
        self.starts.insert(at, start)
        self.stops.insert(at, stop)


SPAN = "array<struct<kind:string,start:int,stop:int,score:double>>"


def accepted(found: DataFrame, model: SpanClassifier, accept: float = ACCEPT) -> DataFrame:
    """k, base, added: candidates that the classifier accepts, best first where they overlap."""
    sent = found.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(SPAN)
    def added(base: pd.Series, more: pd.Series) -> pd.Series:
        known, out = sent.value, []
        for spans, others in zip(base, more, strict=True):
            taken = Taken([(s["start"], s["stop"]) for s in spans])
            known_spans = {(s["kind"], s["start"], s["stop"]) for s in spans}
            scored = []
            for m in others:
                if (m["kind"], m["start"], m["stop"]) not in known_spans:
                    score = known.score(features(m["kind"], [int(v) for v in m["votes"]], m["shape"]))
                    if score >= accept:
                        scored.append((-score, m["start"] - m["stop"], m["start"], m))
            kept = []
            for score, _, _, m in sorted(scored, key=lambda x: x[:3]):
                if taken.free(m["start"], m["stop"]):
                    taken.add(m["start"], m["stop"])
                    kept.append({"kind": m["kind"], "start": m["start"], "stop": m["stop"], "score": -score})
            out.append(kept)
        return pd.Series(out)

    return found.select("k", "base", F.when(F.size("more") > F.size("base"), added("base", "more")).otherwise(F.array().cast(SPAN)).alias("added"))


def joined(spans):
    """kind:start:end of an array of spans, by start, then kind as listed, comma-joined."""
    rank = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    keyed = F.transform(spans, lambda s: F.struct(s.start, rank[s.kind].alias("rank"), s.stop, s.kind))
    return F.concat_ws(
        ",", F.transform(F.array_sort(keyed), lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.stop.cast("string")))
    )


def count_of(spans, kind: str):
    return F.size(F.filter(spans, lambda s: s.kind == kind)).cast("bigint")
