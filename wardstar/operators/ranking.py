"""Best rows per group and first rows per group, safe for groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_k(
    df: DataFrame,
    by: list[str],
    order: list[Column],
    k: int | Column,
    rank: str = "rank",
) -> DataFrame:
    """The first ``k`` rows of each group in ``order``, numbered from 1.

    ``order`` must have no ties; ``k`` may be a column that is the same for all rows of a group.
    Each group is first cut to ``k`` rows per partition of ``df``, so the number of pieces grows
    with the table and no piece is larger than a partition.
    """
    salted = df.withColumn("_salt", F.spark_partition_id())
    per_salt = Window.partitionBy(*by, "_salt").orderBy(*order)
    kept = salted.withColumn(rank, F.row_number().over(per_salt)).filter(F.col(rank) <= k)
    per_group = Window.partitionBy(*by).orderBy(*order)
    return (
        kept.drop("_salt", rank)
        .withColumn(rank, F.row_number().over(per_group))
        .filter(F.col(rank) <= k)
    )


def first_seen_list(
    df: DataFrame, by: str, value: str, seen: str, k: int, out: str, separator: str = ", "
) -> DataFrame:
    """One row per ``by``: the first ``k`` distinct non-null values, in order of ``seen``."""
    distinct = (
        df.filter(F.col(by).isNotNull() & F.col(value).isNotNull())
        .groupBy(by, value)
        .agg(F.min(seen).alias("_seen"))
    )
    best = top_k(distinct, [by], [F.col("_seen"), F.col(value)], k, "_rank")
    ordered = F.array_sort(F.collect_list(F.struct("_rank", F.col(value).cast("string").alias("_v"))))
    return best.groupBy(by).agg(
        F.concat_ws(separator, F.transform(ordered, lambda x: x["_v"])).alias(out)
    )
