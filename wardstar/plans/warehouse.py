"""The stages of a full run: load, clean, de-duplicate, report, build the corpus."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wardstar import schemas
from wardstar.operators import clean, dates, dedup, documents, flatten, keys, loading, quality
from wardstar.operators.joins import lookup_join
from wardstar.operators.vectors import embed
from wardstar.sources.tables import read_source


def load_dimensions(sources: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The four dimensions that no event is read for, with their source ids."""
    return {
        "dim_payer": loading.load_payers(sources["payers"]),
        "dim_organization": loading.load_organizations(sources["organizations"]),
        "dim_provider": loading.load_providers(sources["providers"]),
        "dim_patient": loading.load_patients(sources["patients"]),
    }


def load_star(
    sources: dict[str, DataFrame], dims: dict[str, DataFrame] | None = None
) -> dict[str, DataFrame]:
    """Star tables from the ten source tables (absent ones are left out).

    ``dims``: what :func:`load_dimensions` made of them, where it ran already.
    """
    dims = load_dimensions(sources) if dims is None else dims
    facts = loading.load_facts(sources, dims)
    star = {n: d.drop(loading.SOURCE_ID) for n, d in dims.items()}
    star["fact_patient_events"] = facts.select(*schemas.STAR["fact_patient_events"].names)
    star["dim_date"] = dates.date_dimension(facts.select("date_key"))
    return star


def read_sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {n: read_source(spark, folder, n) for n in schemas.SOURCES}


def merge_star(first: dict[str, DataFrame], records: DataFrame) -> dict[str, DataFrame]:
    """Add flattened records to a star; their keys go on after the existing ones."""
    starts = {key: keys.next_key(first[n], key) for n, key in flatten.DIMENSIONS.items()}
    starts["event_key"] = keys.next_key(first["fact_patient_events"], "event_key")
    second = flatten.flatten(records, starts)
    out = {}
    for name, schema in schemas.STAR.items():
        left, right = (t[name].select(*schema.names) for t in (first, second))
        out[name] = left.unionByName(right)
    out["dim_date"] = out["dim_date"].dropDuplicates(["date_key"])
    return out


def clean_star(tables: dict[str, DataFrame], name_fn: Callable | None = None) -> dict[str, DataFrame]:
    """Standardise, impute and repair every dimension, then remove duplicates."""
    tidy = {
        **tables,
        "dim_patient": clean.clean_patients(tables["dim_patient"]),
        "dim_organization": clean.standardise_place(tables["dim_organization"]),
        "dim_provider": clean.clean_providers(tables["dim_provider"], name_fn),
        "dim_date": dates.repair_dates(tables["dim_date"]),
    }
    return dedup.dedup_star(tidy)


def reports(tables: dict[str, DataFrame], as_of: Column | None = None) -> dict[str, DataFrame]:
    checks = quality.null_checks(tables)
    return {
        "table_counts": quality.table_counts(tables),
        "null_checks": checks,
        "all_clean": quality.all_clean(checks),
        "validations": quality.validations(tables, as_of),
        "rule_checks": quality.rule_checks(tables),
        "references": keys.referential_report(
            tables["fact_patient_events"], {k: tables[t] for k, t in schemas.FOREIGN_KEYS.items()}
        ),
    }


def preview(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """What is wrong before cleaning."""
    return {
        "nulls": quality.null_profile(tables["dim_patient"]),
        "duplicates": quality.duplicate_profile(tables),
    }


def corpus_with_vectors(
    tables: dict[str, DataFrame], make_predict_fn: Callable | None = None, sparse: bool = False
) -> DataFrame:
    """``sparse``: vectors in the short form of a stored corpus, which is read back as arrays."""
    return embed(documents.build_corpus(tables), "content", "embedding", make_predict_fn, sparse=sparse)


def fact_summary(facts: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Events and cost per year and category."""
    dated = lookup_join(facts, dim_date.select("date_key", "year"), "date_key", "inner")
    return dated.groupBy("year", "event_category").agg(
        F.count(F.lit(1)).alias("events"), F.sum(F.col("cost").cast("decimal(18,2)")).alias("total_cost")
    )
