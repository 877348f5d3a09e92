"""Nested extraction records to star tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardstar.functions.scalars import date_of, money
from wardstar.operators.dates import date_dimension
from wardstar.operators.keys import with_dense_key, with_expanded_key

DIMENSIONS = {
    "dim_patient": "patient_key",
    "dim_provider": "provider_key",
    "dim_organization": "org_key",
    "dim_payer": "payer_key",
}


def number_records(records: DataFrame, start: int = 1, places: bool = False) -> DataFrame:
    """``record_no`` in the order of the record ids (as numbers where they are numbers)."""
    sortable = records.withColumn("_id_number", F.col("record_id").try_cast("bigint"))
    return with_dense_key(
        sortable, "record_no", ["_id_number", "record_id"], start, "records", places=places
    ).drop("_id_number")


def flatten(records: DataFrame, starts: dict[str, int] | None = None) -> dict[str, DataFrame]:
    """Star tables from ``record_id, rec``.

    Each record adds one row to every dimension, so one number per record gives
    all four keys of that record's events and no join is needed. A record without
    events still has its dimension rows; a missing object is a row of nulls.
    """
    offsets = {key: (starts or {}).get(key, 1) - 1 for key in DIMENSIONS.values()}
    numbered = number_records(records, places=True)
    tables = {}
    for name, key in DIMENSIONS.items():
        fields = [f.name for f in records.schema["rec"].dataType[name].dataType.fields]
        tables[name] = numbered.select(
            (F.col("record_no") + offsets[key]).alias(key),
            *[
                (date_of(F.col(f"rec.{name}.{f}")) if f == "birthdate" else F.col(f"rec.{name}.{f}")).alias(f)
                for f in fields
            ],
        )
    def events(rows: DataFrame) -> DataFrame:
        known = [c for c in rows.columns if c not in ("record_id", "rec", "record_no")]
        exploded = rows.select("record_no", *known, F.explode("rec.fact_patient_events").alias("e"))
        return exploded.select(
            *known,
            *[(F.col("record_no") + offsets[key]).alias(key) for key in DIMENSIONS.values()],
            date_of(F.col("e.event_date")).alias("date_key"),
            *[F.col(f"e.{f}").alias(f) for f in ("event_category", "encounter_id", "code", "description")],
            money(F.col("e.numeric_value")).alias("numeric_value"),
            F.col("e.units").alias("units"),
            money(F.col("e.cost")).alias("cost"),
        )

    start = (starts or {}).get("event_key", 1)
    tables["fact_patient_events"] = with_expanded_key(numbered, events, "event_key", start, "flat-facts")
    tables["dim_date"] = date_dimension(tables["fact_patient_events"].select("date_key"))
    return tables
