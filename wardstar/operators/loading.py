"""Source tables to dimensions and to one fact table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from wardstar.functions.scalars import date_of, is_blank, money, safe_double
from wardstar.operators.joins import fits_broadcast, lookup_join
from wardstar.operators.keys import key_map, with_dense_key
from wardstar.session import stage

SOURCE_ID = "source_id"

# Event category of each source table, in loading order.
CATEGORIES = {
    "encounters": "Encounter",
    "careplans": "CarePlan",
    "conditions": "Diagnosis",
    "medications": "Medication",
    "allergies": "Allergy",
    "observations": "Observation",
}

# Source column behind each event column; what is not listed is null.
_SHARED = {"date": "START", "encounter_id": "ENCOUNTER", "code": "CODE"}
EVENT_COLUMNS = {
    "encounters": {
        "date": "START",
        "provider_id": "PROVIDER",
        "org_id": "ORGANIZATION",
        "payer_id": "PAYER",
        "encounter_id": "Id",
        "code": "ENCOUNTERCLASS",
        "cost": "TOTAL_CLAIM_COST",
    },
    "careplans": _SHARED,
    "conditions": _SHARED,
    "medications": {**_SHARED, "payer_id": "PAYER", "cost": "TOTALCOST"},
    "allergies": _SHARED,
    "observations": {**_SHARED, "date": "DATE", "value": "VALUE", "units": "UNITS"},
}

EVENT_ORDER = [
    "load_order", "encounter_id", "date_key", "patient_key", "provider_key", "org_key", "payer_key",
    "code", "description", "numeric_value", "units", "cost",
]


def zip_text(c: Column) -> Column:
    """Zip as text; a zip that was read as a number loses its fraction."""
    text = F.regexp_replace(c.cast("string"), r"\.0$", "")
    return F.when(~is_blank(text), text)


def full_name(first: Column, last: Column) -> Column:
    return F.concat_ws(" ", first, last)


def _load(df: DataFrame, key: str, columns: dict[str, Column], start: int) -> DataFrame:
    rows = df.select(F.col("Id").cast("string").alias(SOURCE_ID), *[e.alias(n) for n, e in columns.items()])
    return with_dense_key(rows, key, [SOURCE_ID, *columns], start, f"dim-{key}")


def load_payers(df: DataFrame, start: int = 1) -> DataFrame:
    return _load(df, "payer_key", {"name": F.col("NAME")}, start)


def load_organizations(df: DataFrame, start: int = 1) -> DataFrame:
    columns = {"name": F.col("NAME"), "city": F.col("CITY"), "state": F.col("STATE")}
    return _load(df, "org_key", columns, start)


def load_providers(df: DataFrame, start: int = 1) -> DataFrame:
    columns = {"name": F.col("NAME"), "specialty": F.col("SPECIALITY")}
    return _load(df, "provider_key", columns, start)


def load_patients(df: DataFrame, start: int = 1) -> DataFrame:
    columns = {
        "full_name": full_name(F.col("FIRST"), F.col("LAST")),
        "gender": F.col("GENDER"),
        "birthdate": date_of(F.col("BIRTHDATE")),
        "city": F.col("CITY"),
        "state": F.col("STATE"),
        "zip": zip_text(F.col("ZIP")),
    }
    return _load(df, "patient_key", columns, start)


def event_rows(name: str, df: DataFrame) -> DataFrame:
    """One source table in the common event shape, ids not yet replaced by keys."""
    source = EVENT_COLUMNS[name]

    def col(field: str) -> Column:
        column = source.get(field)
        return F.col(column) if column in df.columns else F.lit(None)

    return df.select(
        F.lit(list(CATEGORIES).index(name)).alias("load_order"),
        F.lit(CATEGORIES[name]).alias("event_category"),
        F.col("PATIENT").cast("string").alias("patient_id"),
        *[col(f).cast("string").alias(f) for f in ("provider_id", "org_id", "payer_id")],
        date_of(col("date")).alias("date_key"),
        col("encounter_id").cast("string").alias("encounter_id"),
        col("code").cast("string").alias("code"),
        F.col("DESCRIPTION").cast("string").alias("description"),
        money(safe_double(col("value"))).alias("numeric_value"),
        col("units").cast("string").alias("units"),
        money(safe_double(col("cost"))).alias("cost"),
    )


def unify_events(sources: dict[str, DataFrame]) -> DataFrame:
    """All event sources in one table, so that each lookup runs once."""
    parts = [event_rows(n, sources[n]) for n in CATEGORIES if n in sources]
    return reduce(lambda a, b: a.unionByName(b), parts)


def replace_ids(events: DataFrame, maps: dict[str, DataFrame]) -> DataFrame:
    """Source ids become keys: events of unknown patients are dropped, other unknown ids become null."""
    if not all(fits_broadcast(m) for m in maps.values()):
        # Some lookup has to shuffle: its hot keys are counted in columnar files.
        events = stage(events, "source-events")
    out = events
    for column, key, how in (
        ("patient_id", "patient_key", "inner"),
        ("provider_id", "provider_key", "left"),
        ("org_id", "org_key", "left"),
        ("payer_id", "payer_key", "left"),
    ):
        known = maps[key].select(F.col(SOURCE_ID).alias(column), key)
        out = lookup_join(out, known, column, how, keys_from=events)
    return out.drop("patient_id", "provider_id", "org_id", "payer_id")


def load_facts(sources: dict[str, DataFrame], dims: dict[str, DataFrame], start: int = 1) -> DataFrame:
    """The numbered fact table from event sources and loaded dimensions (with source ids)."""
    maps = {
        key: key_map(dims[name], SOURCE_ID, key)
        for name, key in (
            ("dim_patient", "patient_key"),
            ("dim_provider", "provider_key"),
            ("dim_organization", "org_key"),
            ("dim_payer", "payer_key"),
        )
    }
    events = replace_ids(unify_events(sources), maps)
    return with_dense_key(events, "event_key", EVENT_ORDER, start, "facts").drop("load_order")
