"""Duplicate dimension rows and the facts that point to them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from wardstar import schemas
from wardstar.operators.joins import bounded, lookup_join
from wardstar.session import stage


def natural_key(columns: list[str]) -> dict[str, Column]:
    """Key parts compared without regard to case and outer blanks."""
    return {f"_k{i}": F.lower(F.trim(F.col(c))) for i, c in enumerate(columns)}


def duplicate_groups(dim: DataFrame, key: str, natural: list[str]) -> DataFrame:
    """Natural keys held by several rows: lowest key and row count.

    Minimum and count are combined before the shuffle, so a group of any size is
    one row per task. Rows with a null part are never duplicates.
    """
    parts = natural_key(natural)
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in natural])
    return (
        dim.filter(complete)
        .groupBy(*[e.alias(n) for n, e in parts.items()])
        .agg(F.min(key).alias("key_to_keep"), F.count(F.lit(1)).alias("n_rows"))
        .filter("n_rows > 1")
    )


def replaced_keys(dim: DataFrame, key: str, natural: list[str]) -> DataFrame:
    """``key, canonical`` for every row that its group's lowest key replaces."""
    parts = natural_key(natural)
    groups = duplicate_groups(dim, key, natural).select(*parts, F.col("key_to_keep").alias("canonical"))
    keyed = dim.select(key, *[e.alias(n) for n, e in parts.items()])
    return (
        lookup_join(keyed, groups, list(parts), "inner", [key])
        .filter(F.col(key) != F.col("canonical"))
        .select(key, "canonical")
    )


def drop_duplicates(dim: DataFrame, replaced: DataFrame, key: str) -> DataFrame:
    return dim.join(bounded(replaced.select(key)), key, "left_anti")


def repoint(
    facts: DataFrame, replaced: DataFrame, key: str, keys_from: DataFrame | None = None
) -> DataFrame:
    """Facts of a replaced row point to the row that is kept."""
    return (
        lookup_join(facts, replaced, key, "left", keys_from=keys_from)
        .withColumn(key, F.coalesce("canonical", F.col(key)))
        .select(*facts.columns)
    )


def dedup_star(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """De-duplicate organisations, providers and payers and re-point the facts.

    The replaced keys are written first: two results read them, and their true size
    decides whether the facts have to be shuffled for the re-pointing.
    """
    out = dict(tables)
    stored = tables["fact_patient_events"]
    facts = stored
    for name, (key, natural) in schemas.NATURAL_KEYS.items():
        replaced = stage(replaced_keys(tables[name], key, natural), f"replaced-{key}")
        out[name] = drop_duplicates(tables[name], replaced, key)
        facts = repoint(facts, replaced, key, stored)
    out["fact_patient_events"] = facts
    return out
