"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source is wanted target / source size times. The whole part is taken as
it is; the fraction is rounded so that each source keeps its words: two open documents are
paired, mass moves at random from one to the other until one of them is integral, and the
other stays open. Large documents meet first, so what is open at the end tends to be small.
Rows that agree in id, source and size are one class that wants as many copies as all of them
together; its copies are dealt evenly to its rows.

The pairs form a reduction tree: a leaf holds a bounded share of one source, picked by a hash,
one document at most stays open in each, and those meet in the next level until one per source
is left, which a last draw decides. Draws are hashes, so a rerun takes the same documents.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardstar.llm.tasks import release
from wardstar.operators.joins import fits_broadcast, lookup_join, may_match
from wardstar.operators.keys import with_dense_key
from wardstar.session import stage

# Fixed values.
WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
WORD = r"[^\x20\x09-\x0D]+"

LEAF_ROWS = 2_000
FAN_IN = 1_000
OPEN = -1


def pivot(mass: list[float], sizes: list[int], draws: list[float]) -> tuple[list[int], float]:
    """Outcome of each document (1, 0 or OPEN) and the mass of the one that stays open.

    A pair moves words, so that sum(mass * size) stays as it is: either up to the point where the
    first document is full or the second empty, or the other way, with the probabilities that
    leave every expectation unchanged.
    """
    out = [OPEN] * len(mass)
    kept, a = -1, 0.0
    for i, b in enumerate(mass):
        if kept < 0:
            kept, a = i, b
            continue
        s, t = sizes[kept], sizes[i]
        up, down = min((1 - a) * s, b * t), min(a * s, (1 - b) * t)
        moved = up if draws[i] * (up + down) < down else -down
        a, b = a + moved / s, b - moved / t
        first, second = _settled(a), _settled(b)
        out[kept], out[i] = first, second
        if first != OPEN:
            kept, a = (i, b) if second == OPEN else (-1, 0.0)
    return out, a


def _settled(mass: float) -> int:
    return 0 if mass < 1e-9 else 1 if mass > 1 - 1e-9 else OPEN


def _resolve(group: pd.DataFrame) -> pd.DataFrame:
    release()
    group = group.sort_values(["size", "draw"], ascending=[False, True], kind="stable")
    outcome, left = pivot(group["mass"].tolist(), group["size"].tolist(), group["draw"].tolist())
    group["outcome"] = outcome
    group.loc[group["outcome"] == OPEN, "mass"] = left
    return group


def _draw(seed: int) -> Column:
    """A number in [0, 1) from what tells documents apart."""
    bits = F.shiftrightunsigned(F.xxhash64("k", "s", "size", F.lit(seed)), 11)
    return bits / F.lit(float(1 << 53))


def _level(rows: DataFrame, keys: list[str], seed: int, label: str) -> tuple[DataFrame, DataFrame]:
    """The documents that one level of the tree decides, and those that stay open."""
    drawn = rows.withColumn("draw", _draw(seed))
    done = stage(drawn.groupBy(*keys).applyInPandas(_resolve, drawn.schema), label)
    return done.filter(F.col("outcome") != OPEN), done.filter(F.col("outcome") == OPEN)


def size_of(text: str) -> Column:
    """Words of a text column; null has none."""
    return F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = MOST_COPIES) -> DataFrame:
    """Adds ``target`` to one row per source (sn: source is null, sk: source, source_size).

    Weights go round the sources in code point order, null last. A target stops at ``cap``
    times the source's size; the rest is shared anew until nothing is above: each round needs
    two sums, and a source that was stopped stays so because the others' share only grows.
    """
    ranked = with_dense_key(sources, "rank", ["sn", "sk"], start=0, label="mix-sources")
    weighted = ranked.withColumn(
        "weight",
        F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")),
    ).withColumn("most", F.col("source_size") * cap)
    share, stopped = 0.0, -1
    while True:
        full = F.col("most") < F.lit(share) * F.col("weight")
        now = weighted.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)).alias("total"),
            F.coalesce(F.sum(F.when(full, F.col("most"))), F.lit(0)).alias("fixed"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)).alias("free"),
            F.count(F.when(full, 1)).alias("stopped"),
        ).first()
        if now["stopped"] == stopped or not now["free"]:
            break
        share, stopped = (now["total"] - now["fixed"]) / now["free"], now["stopped"]
    target = F.least(F.col("most").cast("double"), F.lit(share) * F.col("weight"))
    return weighted.withColumn("target", target).drop("rank", "weight", "most")


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: int = 0,
) -> DataFrame:
    """Copies of each document: columns k (id), s (source), size, n, source_size, target, copies.

    One row for all rows that agree in id, source and size (``n`` of them, which take ``copies``
    together: ``copies_of_row``). Documents without words are taken as often as the whole part says. A null id or source
    is a value like any other. A table without rows gives none.
    """
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("k"), F.col(f"`{source}`").cast("string").alias("s"), size_of(text).alias("size")
    )
    counted = rows.groupBy("k", "s", "size").agg(F.count(F.lit(1)).alias("n"))
    unit = stage(
        counted.select(
            "*",
            F.col("s").isNull().alias("sn"),
            F.coalesce("s", F.lit("")).alias("sk"),
        ),
        "mix-units",
    )
    keys = ["sn", "sk"]
    sources = unit.groupBy(*keys).agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"),
        F.ceil(F.count(F.lit(1)) / LEAF_ROWS).alias("leaves"),
    )
    info = stage(targets(sources), "mix-targets")
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    known = lookup_join(unit, info, keys, "inner", spread=["k", "size"]).withColumn("times", times * F.col("n"))
    parts = known.withColumns(
        {
            "whole": F.floor("times"),
            "mass": F.col("times") - F.floor("times"),
            "leaf": F.pmod(F.xxhash64("k", "size"), F.col("leaves")),
            "outcome": F.lit(0),
            "draw": F.lit(0.0),
        }
    ).drop("times", "leaves")
    fixed = (F.col("mass") <= 0) | (F.col("size") == 0)
    decided = [parts.filter(fixed)]
    done, still = _level(parts.filter(~fixed), [*keys, "leaf"], seed, "mix-leaves")
    decided.append(done)
    leaves = info.agg(F.max("leaves")).first()[0] or 0
    level = 1
    while leaves > 1:
        still = still.withColumn("leaf", F.floor(F.col("leaf") / FAN_IN))
        done, still = _level(still, [*keys, "leaf"], seed + level, "mix-level")
        decided.append(done)
        leaves, level = math.ceil(leaves / FAN_IN), level + 1
    done, still = _level(still, keys, seed + level, "mix-sources")
    last = still.withColumn("outcome", (_draw(seed + level + 1) < F.col("mass")).cast("int"))
    result = decided[0]
    for part in [*decided[1:], done, last]:
        result = result.unionByName(part)
    return result.select(
        "k", "s", "size", "n", "source_size", "target", (F.col("whole") + F.col("outcome")).alias("copies")
    )


def copies_of_row(copies: Column, n: Column, row: Column) -> Column:
    """How many of a class's ``copies`` its row number ``row`` (from 0) of ``n`` takes."""
    return (F.floor(copies / n) + (row < copies % n).cast("int")).cast("bigint")


def mixed_rows(made: DataFrame) -> DataFrame:
    """A row for every document of ``mix``: k, s, size, source_size, target, copies (of this row)."""
    each = made.withColumn("row", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)))
    return each.select(
        "k", "s", "size", "source_size", "target", copies_of_row(F.col("copies"), F.col("n"), F.col("row")).alias("copies")
    )


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Rows of ``docs`` as often as the mix takes them, with exactly the columns of ``docs``.

    Rows of one class are told apart by their place in stored files; only such rows are numbered.
    """
    chosen = mix(docs, doc_id, text, source).filter("copies > 0")
    columns = [f"c{i}" for i in range(len(docs.columns))]
    doc = docs.select(
        *_class(F.col(f"`{doc_id}`"), F.col(f"`{source}`"), size_of(text)),
        *[F.col(f"`{c}`").alias(a) for c, a in zip(docs.columns, columns, strict=True)],
    )
    found = stage(chosen.select(*_class(F.col("k"), F.col("s"), F.col("size")), "n", "copies"), "mix-classes")
    # Rows of repeated classes are picked on the scan, so that the other texts are not shuffled for them too.
    alone, repeated = found.filter("n = 1"), stage(found.filter("n > 1"), "mix-repeated-classes")
    single = lookup_join(doc, alone, CLASS, "inner", spread=columns[:1], keys_from=doc.select(*CLASS))
    single = single.withColumn("row", F.lit(0).cast("bigint"))
    likely = doc if fits_broadcast(repeated) else stage(may_match(doc, repeated, CLASS), "mix-likely")
    taken = lookup_join(likely, repeated, CLASS, "inner", spread=columns[:1], keys_from=likely.select(*CLASS))
    numbered = with_dense_key(taken, "number", CLASS, start=0, label="mix-repeated")
    first = numbered.groupBy(*CLASS).agg(F.min("number").alias("first"))
    several = lookup_join(numbered, first, CLASS, "inner", spread=["number"])
    several = several.withColumn("row", F.col("number") - F.col("first")).drop("number", "first")
    rows = single.unionByName(several).withColumn("copies", copies_of_row(F.col("copies"), F.col("n"), F.col("row")))
    rows = rows.filter("copies > 0").withColumn("copy", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))
    return rows.select(*[F.col(a).alias(c) for c, a in zip(docs.columns, columns, strict=True)])


CLASS = ["kn", "kk", "sn", "sk", "size"]


def _class(k: Column, s: Column, size: Column) -> list[Column]:
    """What rows of one class agree in, free of nulls."""
    values = [("k", k.cast("string")), ("s", s.cast("string"))]
    named = [c for n, v in values for c in (v.isNull().alias(f"{n}n"), F.coalesce(v, F.lit("")).alias(f"{n}k"))]
    return [*named, size.alias("size")]
