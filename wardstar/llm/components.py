"""Connected components of a table of links, without bringing links or components together."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstar.session import stage


# Links that one task contracts at most.
PART_LINKS = 1_000_000


def _contract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links of one partition as stars: every node to the smallest one it reaches there."""
    above: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := above.get(top, top)) != top:
            top = up
        while x != top:
            above[x], x = top, above.get(x, top)
        return top

    for batch in batches:
        for a, b in zip(batch["a"].tolist(), batch["b"].tolist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                above[max(a, b)] = min(a, b)
    nodes = list(above)
    yield pd.DataFrame({"a": nodes, "b": [root(x) for x in nodes]}, dtype="int64")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that has links to others; component is its smallest node.

    Each round contracts the links inside every partition, keeps one smaller neighbour per
    node, ties the others to it, and moves each node up by one step. Components halve their
    depth each round, so long chains take logarithmically many. Links that fit one part of
    PART_LINKS are settled by contracting that part. Nulls link nothing.
    """
    links = links.select(F.col(a).cast("bigint").alias("a"), F.col(b).cast("bigint").alias("b"))
    now = stage(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "links")
    seen = None
    while True:
        if now.count() <= PART_LINKS:
            done = stage(now.coalesce(1).mapInPandas(_contract, "a bigint, b bigint"), "links")
            return done.select(F.col("a").alias("node"), F.col("b").alias("component"))
        stars = now.repartition("a").mapInPandas(_contract, "a bigint, b bigint")
        # one b per partition that knows the node, so these sets are small
        least = stars.groupBy("a").agg(F.min("b").alias("b"), F.collect_set("b").alias("more"))
        tied = stage(
            least.select("a", "b").unionByName(least.select(F.explode("more").alias("a"), "b").filter("a <> b")),
            "links",
        )
        up = tied.groupBy(F.col("a").alias("b")).agg(F.min("b").alias("top"))
        now = stage(
            tied.join(up, "b", "left").select("a", F.coalesce("top", "b").alias("b")).distinct(), "links"
        )
        state = now.agg(F.count("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        seen = state
