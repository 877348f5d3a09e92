"""Counts, null and duplicate profiles and validations of the star tables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from wardstar.functions.scalars import is_blank, percent
from wardstar.operators.dedup import natural_key
from wardstar.operators.joins import lookup_join

ZIP_FORMAT = "^[0-9]{5}$"


def count_where(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def _named_counts(df: DataFrame, counts: dict[str, Column], label: str) -> DataFrame:
    """One scan of ``df``, one result row per named count."""
    measured = df.agg(*[c.cast("bigint").alias(f"_{i}") for i, c in enumerate(counts.values())])
    rows = F.array(
        *[F.struct(F.lit(n).alias(label), F.col(f"_{i}").alias("n")) for i, n in enumerate(counts)]
    )
    return measured.select(F.inline(rows))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    every = F.count(F.lit(1))
    patients = {
        "Total Patients": every,
        "Patients with Gender": count_where(~is_blank(F.col("gender"))),
        "Patients with Birthdate": count_where(F.col("birthdate").isNotNull()),
    }
    return _union(
        [
            _named_counts(tables["dim_patient"], patients, "metric"),
            _named_counts(tables["dim_organization"], {"Total Organizations": every}, "metric"),
            _named_counts(tables["dim_provider"], {"Total Providers": every}, "metric"),
            _named_counts(tables["dim_payer"], {"Total Payers": every}, "metric"),
            _named_counts(tables["fact_patient_events"], {"Total Events": every}, "metric"),
        ]
    )


def with_status(report: DataFrame) -> DataFrame:
    """``PASS`` for a count of 0, else ``FAIL (n)``."""
    failed = F.concat(F.lit("FAIL ("), F.col("n").cast("string"), F.lit(")"))
    return report.withColumn("status", F.when(F.col("n") == 0, F.lit("PASS")).otherwise(failed))


def null_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """Counts of values that cleaning should have filled."""
    patients = {
        "NULL Genders Remaining": count_where(is_blank(F.col("gender"))),
        "NULL Birthdates Remaining": count_where(F.col("birthdate").isNull()),
        "NULL Cities (Patients)": count_where(is_blank(F.col("city"))),
    }
    organizations = {"NULL Cities (Orgs)": count_where(is_blank(F.col("city")))}
    providers = {"NULL Provider Specialties": count_where(is_blank(F.col("specialty")))}
    return with_status(
        _union(
            [
                _named_counts(tables["dim_patient"], patients, "check"),
                _named_counts(tables["dim_organization"], organizations, "check"),
                _named_counts(tables["dim_provider"], providers, "check"),
            ]
        )
    )


def all_clean(checks: DataFrame) -> DataFrame:
    return checks.agg(F.bool_and(F.col("n") == 0).alias("all_clean"))


def null_profile(patients: DataFrame) -> DataFrame:
    total = F.col("total")
    counted = patients.agg(
        F.count(F.lit(1)).alias("total"),
        count_where(is_blank(F.col("gender"))).alias("null_gender"),
        count_where(F.col("birthdate").isNull()).alias("null_birthdate"),
        count_where(is_blank(F.col("city"))).alias("null_city"),
    )
    return counted.withColumns(
        {f"pct_{c}": percent(F.col(f"null_{c}"), total) for c in ("gender", "birthdate", "city")}
    )


def duplicate_count(dim: DataFrame, natural: list[str], name: str, nulls_equal: bool = True) -> DataFrame:
    """Rows beyond the first of each natural key.

    With ``nulls_equal`` a missing part counts as empty text; otherwise only
    complete keys are distinct values, so each null row counts as one beyond.
    """
    parts = natural_key(natural).values()
    if nulls_equal:
        parts = [F.coalesce(p, F.lit("")) for p in parts]
    per_key = dim.groupBy(*[p.alias(f"_k{i}") for i, p in enumerate(parts)]).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in per_key.columns[:-1]])
    return per_key.agg(
        F.lit(name).alias("dimension"),
        (F.coalesce(F.sum("_rows"), F.lit(0)) - count_where(complete)).alias("duplicates"),
    )


def duplicate_profile(tables: dict[str, DataFrame]) -> DataFrame:
    return _union(
        [
            duplicate_count(tables["dim_organization"], ["name", "city", "state"], "organization"),
            duplicate_count(tables["dim_provider"], ["name", "specialty"], "provider"),
            duplicate_count(tables["dim_payer"], ["name"], "payer", nulls_equal=False),
        ]
    )


def events_before_birth(facts: DataFrame, patients: DataFrame) -> DataFrame:
    births = patients.select("patient_key", "birthdate")
    dated = facts.select("patient_key", "date_key", "event_key")
    return lookup_join(dated, births, "patient_key", "inner", ["event_key"]).filter(
        F.col("date_key") < F.col("birthdate")
    )


def validations(tables: dict[str, DataFrame], as_of: Column | None = None) -> DataFrame:
    """Future birthdates, events before birth and malformed zips, with pass or fail."""
    today = F.current_date() if as_of is None else as_of
    patients = tables["dim_patient"]
    on_patients = {
        "Birthdate in Future": count_where(F.col("birthdate") > today),
        "Invalid Zip Format": count_where(~F.col("zip").rlike(ZIP_FORMAT)),
    }
    early = events_before_birth(tables["fact_patient_events"], patients)
    return with_status(
        _union(
            [
                _named_counts(patients, on_patients, "check"),
                _named_counts(early, {"Event Before Birth": F.count(F.lit(1))}, "check"),
            ]
        )
    )


@dataclass(frozen=True)
class Rule:
    """A column that must match a pattern."""

    name: str
    table: str
    column: str
    pattern: str


# Format and domain rules.
RULES = [
    Rule("NS_ALPHA", "dim_provider", "name", r"^[a-zA-Z \-\.]+$"),
    Rule("NS_TEXAS", "dim_patient", "state", "^(TX|Texas)$"),
    Rule("NS_TEXAS", "dim_organization", "state", "^(TX|Texas)$"),
    Rule("NS_ZIP", "dim_patient", "zip", ZIP_FORMAT),
]


def rule_checks(tables: dict[str, DataFrame], rules: list[Rule] | None = None) -> DataFrame:
    """Non-null values that break a rule; all rules of one table share a scan."""
    rules = RULES if rules is None else rules
    parts = []
    for table in dict.fromkeys(r.table for r in rules):
        mine = [r for r in rules if r.table == table]
        counts = {
            f"{r.name}:{r.table}.{r.column}": count_where(~F.col(r.column).rlike(r.pattern)) for r in mine
        }
        parts.append(_named_counts(tables[table], counts, "check"))
    return with_status(_union(parts))
