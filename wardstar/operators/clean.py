"""Standardising, imputing and repairing dimension rows."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from wardstar.functions.scalars import any_of, blank_to, bucket, is_blank, lookup, pick
from wardstar.operators.calls import answered
from wardstar.session import stage

# Defaults, zips and placeholder names.
DEFAULT_CITY = "UNKNOWN"
DEFAULT_SPECIALTY = "General Practice"
BIRTH_START = "1940-01-01"
BIRTH_DAYS = 25000
CITY_ZIPS = {
    "AUSTIN": "78701",
    "HOUSTON": "77002",
    "DALLAS": "75201",
    "SAN ANTONIO": "78205",
    "FORT WORTH": "76102",
    "EL PASO": "79901",
    "ARLINGTON": "76010",
    "CORPUS CHRISTI": "78401",
    "PLANO": "75074",
    "LAREDO": "78040",
}
FALLBACK_ZIPS = ["75001", "73301", "77001", "78745", "75241", "75551", "76087", "79108"]
PLACEHOLDER_NAMES = ["Dr. XYZ", "Dr. ABC", "Dr. X", "Dr. W", "Dr. Sample Doctor"]

# Names used when the caller supplies no name function.
DOCTOR_NAMES = [
    "Alice Chen", "Maria Lopez", "James Walker", "Priya Patel", "Daniel Kim",
    "Laura Schmidt", "Omar Haddad", "Grace Okafor", "Peter Novak", "Sofia Rossi",
]


def standard_state(c: Column) -> Column:
    return F.when(F.lower(c) == "texas", F.lit("TX")).otherwise(c)


def standard_city(c: Column) -> Column:
    return F.upper(F.trim(F.coalesce(c, F.lit(DEFAULT_CITY))))


def standardise_place(df: DataFrame) -> DataFrame:
    """Patients and organisations: short state, upper-case city."""
    return df.withColumns(
        {"state": standard_state(F.col("state")), "city": standard_city(F.col("city"))}
    )


def standardise_provider(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "name": F.trim("name"),
            "specialty": blank_to(F.col("specialty"), DEFAULT_SPECIALTY),
        }
    )


def impute_gender(c: Column, key: Column) -> Column:
    chosen = F.when(bucket(key, "gender", 2) == 0, F.lit("M")).otherwise(F.lit("F"))
    return blank_to(c, chosen)


def impute_birthdate(c: Column, key: Column) -> Column:
    days = bucket(key, "birthdate", BIRTH_DAYS).cast("int")
    return F.coalesce(c, F.date_add(F.lit(BIRTH_START).cast("date"), days))


def without_digits(name: Column) -> Column:
    return F.when(name.rlike("[0-9]"), F.trim(F.regexp_replace(name, "[0-9]+", ""))).otherwise(name)


def zip_missing(c: Column) -> Column:
    return is_blank(c) | (c == "0") | (F.length(c) < 5)


def repair_zip(c: Column, city: Column, key: Column) -> Column:
    """A missing zip becomes that of its city, else one of the fallback zips."""
    found = lookup(CITY_ZIPS, F.upper(city), pick(FALLBACK_ZIPS, key, "zip"))
    return F.when(zip_missing(c), found).otherwise(c)


def is_placeholder(name: Column) -> Column:
    lowered = F.lower(name)
    return (
        is_blank(name)
        | any_of(lowered, ["unknown"])
        | lowered.isin([n.lower() for n in PLACEHOLDER_NAMES])
    )


def doctor_name(raw: Column) -> Column:
    """Post-format of a generated name: no quotes or dots, ``Dr.`` in front; null is ``Dr. Unknown``."""
    bare = F.replace(F.replace(F.trim(raw), F.lit('"'), F.lit("")), F.lit("."), F.lit(""))
    titled = F.when(~F.contains(bare, F.lit("Dr")), F.concat(F.lit("Dr. "), bare)).otherwise(bare)
    dotted = F.when(
        F.startswith(titled, F.lit("Dr")) & ~F.startswith(titled, F.lit("Dr.")),
        F.regexp_replace(titled, "^Dr", "Dr."),
    ).otherwise(titled)
    return F.coalesce(dotted, F.lit("Dr. Unknown"))


def fill_names(
    providers: DataFrame, name_fn: Callable[[pd.Series], pd.Series] | None = None, **calling
) -> DataFrame:
    """Replace placeholder provider names.

    ``name_fn`` turns specialties into raw names (null on failure), for instance by calling a
    model; by default names come from a seeded list. The function is called for each row that
    needs a name, once, several calls at a time; ``calling`` are options of
    :func:`wardstar.operators.calls.answered`. A call that fails gives the name for failures.
    """
    placeholder = is_placeholder(F.col("name"))
    if name_fn is None:
        raw = pick(DOCTOR_NAMES, F.col("provider_key"), "name")
        return providers.withColumn(
            "name", F.when(placeholder, doctor_name(raw)).otherwise(F.col("name"))
        )
    marked = providers.withColumn("_fill", F.coalesce(placeholder, F.lit(True)))
    asked = answered(marked.filter("_fill"), "specialty", name_fn, per=["provider_key"], **calling)
    filled = asked.withColumn("name", doctor_name(F.col("response"))).drop("response", "error")
    return marked.filter("not _fill").unionByName(stage(filled, "names")).drop("_fill")


def clean_patients(df: DataFrame) -> DataFrame:
    key = F.col("patient_key")
    return (
        standardise_place(df.drop("full_name"))
        .withColumn("gender", impute_gender(F.col("gender"), key))
        .withColumn("birthdate", impute_birthdate(F.col("birthdate"), key))
        .withColumn("zip", repair_zip(F.col("zip"), F.col("city"), key))
    )


def clean_providers(
    df: DataFrame, name_fn: Callable[[pd.Series], pd.Series] | None = None, **calling
) -> DataFrame:
    """Names are repaired here, before duplicates are looked for."""
    tidy = standardise_provider(df).withColumn("name", without_digits(F.col("name")))
    return fill_names(tidy, name_fn, **calling)
