"""Columns and types of the source tables, the extraction record and the star tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(spec: str) -> T.StructType:
    kinds = {
        "string": T.StringType(),
        "int": T.IntegerType(),
        "long": T.LongType(),
        "date": T.DateType(),
        "double": T.DoubleType(),
        "money": T.DecimalType(10, 2),
    }
    fields = []
    for part in spec.split():
        name, _, kind = part.partition(":")
        fields.append(T.StructField(name, kinds[kind or "string"], True))
    return T.StructType(fields)


# Every source column is text; the loaders convert what they need.
SOURCES = {
    "payers": _struct("Id NAME"),
    "organizations": _struct("Id NAME CITY STATE"),
    "providers": _struct("Id NAME SPECIALITY"),
    "patients": _struct("Id FIRST LAST GENDER BIRTHDATE CITY STATE ZIP"),
    "encounters": _struct(
        "Id START PATIENT PROVIDER ORGANIZATION PAYER ENCOUNTERCLASS DESCRIPTION TOTAL_CLAIM_COST"
    ),
    "careplans": _struct("START PATIENT ENCOUNTER CODE DESCRIPTION"),
    "conditions": _struct("START PATIENT ENCOUNTER CODE DESCRIPTION"),
    "medications": _struct("START PATIENT ENCOUNTER CODE DESCRIPTION PAYER TOTALCOST"),
    "allergies": _struct("START PATIENT ENCOUNTER CODE DESCRIPTION"),
    "observations": _struct("DATE PATIENT ENCOUNTER CODE DESCRIPTION VALUE UNITS"),
}

STAR = {
    "dim_date": _struct("date_key:date year:int month:int month_name day_of_week"),
    "dim_patient": _struct(
        "patient_key:long full_name gender birthdate:date city state zip"
    ),
    "dim_organization": _struct("org_key:long name city state"),
    "dim_provider": _struct("provider_key:long name specialty"),
    "dim_payer": _struct("payer_key:long name"),
    "fact_patient_events": _struct(
        "event_key:long patient_key:long date_key:date provider_key:long org_key:long payer_key:long "
        "event_category encounter_id code description numeric_value:money units cost:money"
    ),
}

# Natural keys that decide whether two dimension rows are the same.
NATURAL_KEYS = {
    "dim_organization": ("org_key", ["name", "city", "state"]),
    "dim_provider": ("provider_key", ["name", "specialty"]),
    "dim_payer": ("payer_key", ["name"]),
}

FOREIGN_KEYS = {
    "patient_key": "dim_patient",
    "date_key": "dim_date",
    "provider_key": "dim_provider",
    "org_key": "dim_organization",
    "payer_key": "dim_payer",
}

EVENT = _struct(
    "event_category event_date encounter_id code description numeric_value:double units cost:double"
)

RECORD = T.StructType(
    [
        T.StructField("dim_patient", _struct("full_name gender birthdate city state zip")),
        T.StructField("dim_provider", _struct("name specialty")),
        T.StructField("dim_organization", _struct("name city state")),
        T.StructField("dim_payer", _struct("name")),
        T.StructField("fact_patient_events", T.ArrayType(EVENT)),
        T.StructField("metadata", _struct("source_row_id:long sample_name")),
    ]
)
