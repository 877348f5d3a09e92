"""Transcriptions to nested records."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from wardstar import schemas
from wardstar.functions.scalars import bucket, is_blank, pick, safe_double
from wardstar.functions.text import normalise, row_context
from wardstar.operators.calls import answered
from wardstar.operators.keys import with_dense_key
from wardstar.session import stage
from wardstar.sources.tables import parse_records

# Slice of the rows, first output number, defaults for missing demographics.
SLICE_START, SLICE_END = 1500, 2000
FIRST_OUTPUT = 1500
CITIES = ["Austin", "Houston", "Dallas", "San Antonio"]
STATE = "TX"
ZIPS = ["75001", "78701"]
BIRTH_START = "1950-01-01"
BIRTH_DAYS = 14975  # up to 1990-12-31
ORGANIZATIONS = ["Texas General Hospital", "Austin Medical Center"]
PAYERS = ["Blue Cross TX", "Aetna", "Medicare"]
PROVIDERS = ["Dr. Alice Chen"]
SPECIALTY_WORDS = {"Cardiology": ["heart", "cardiac"], "Surgery": ["surgery", "surgical"]}
DEFAULT_SPECIALTY = "General Practice"

BATCH_TEXTS = 100  # texts of one call of a batch function

PROMPT_HEAD = (
    "Extract the patient, provider, organization, payer and medical events of the transcription as JSON.\n"
    "Fill missing demographics with plausible Texas values; never invent medical events.\n"
    "Target schema:\n"
)
PROMPT_TRANSCRIPTION = "\nTranscription:\n"

# Patterns of the default extractor, for normalised text.
AGE = r"(?:^| )([0-9]{1,3}) years? old"
FEMALE = r"(?:^| )(?:female|woman|lady|girl)(?:[ .]|$)"
MALE = r"(?:^| )(?:male|man|gentleman|boy)(?:[ .]|$)"
VITAL = (
    r"(weight|height|temperature|pulse|respirations|blood pressure) (?:is |of |was )?"
    r"([0-9]+(?:\.[0-9]+)?)(?:/[0-9]+)? ?(kg|pounds|lbs|inches|cm|mmhg|bpm|degrees)?"
)
MEDICATION = r"([a-z]+) ([0-9]+(?:\.[0-9]+)?) ?(mg|mcg|ml)(?:[ .]|$)"
TEXT_DATE = r"([0-9]{4}-[0-9]{2}-[0-9]{2})"


def row_slice(
    df: DataFrame, order_by: list[str], start: int = SLICE_START, end: int | None = SLICE_END
) -> DataFrame:
    """Rows ``start <= source_row_id < end`` counted from 0 in the given order; no ``end`` takes all."""
    numbered = with_dense_key(df, "source_row_id", order_by, 0, "transcriptions")
    wanted = numbered.filter(F.col("source_row_id") >= start)
    return wanted if end is None else wanted.filter(F.col("source_row_id") < end)


def prompts(df: DataFrame, schema_text: str, head: str = PROMPT_HEAD) -> DataFrame:
    """Add ``row_context`` (all columns as lines) and ``prompt``."""
    context = row_context(df)
    return df.withColumn("row_context", context).withColumn(
        "prompt",
        F.concat(F.lit(head), F.lit(schema_text), F.lit(PROMPT_TRANSCRIPTION), F.col("row_context")),
    )


def _none(kind: str) -> Column:
    return F.lit(None).cast(kind)


def _events(text: Column, pattern: str, category: str, date: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def event(match: Column) -> Column:
        return F.struct(
            F.lit(category).alias("event_category"),
            date.alias("event_date"),
            _none("string").alias("encounter_id"),
            _none("string").alias("code"),
            F.regexp_extract(match, pattern, 1).alias("description"),
            safe_double(F.regexp_extract(match, pattern, 2)).alias("numeric_value"),
            F.nullif(F.regexp_extract(match, pattern, 3), F.lit("")).alias("units"),
            _none("double").alias("cost"),
        )

    return F.transform(found, event)


def rule_record(clean: Column, date: Column, as_of: str) -> Column:
    """Record found by rules in normalised text: age, gender, vitals and medications that it states."""
    age = F.regexp_extract(clean, AGE, 1).try_cast("int")
    birth_year = F.year(F.lit(as_of).cast("date")) - age
    birthdate = F.concat(birth_year.cast("string"), F.lit("-01-01"))
    gender = F.when(clean.rlike(FEMALE), F.lit("F")).when(clean.rlike(MALE), F.lit("M"))
    specialty = F.coalesce(
        *[
            F.when(F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(clean, w)), F.lit(name))
            for name, words in SPECIALTY_WORDS.items()
        ]
    )
    events = F.concat(_events(clean, VITAL, "Observation", date), _events(clean, MEDICATION, "Medication", date))
    return F.struct(
        F.struct(
            _none("string").alias("full_name"), gender.alias("gender"), birthdate.alias("birthdate"),
            _none("string").alias("city"), _none("string").alias("state"), _none("string").alias("zip"),
        ).alias("dim_patient"),
        F.struct(_none("string").alias("name"), specialty.alias("specialty")).alias("dim_provider"),
        F.struct(
            _none("string").alias("name"), _none("string").alias("city"), _none("string").alias("state")
        ).alias("dim_organization"),
        F.struct(_none("string").alias("name")).alias("dim_payer"),
        events.alias("fact_patient_events"),
    )


def responses(
    df: DataFrame,
    text: str,
    extract_fn: Callable[[pd.Series], pd.Series] | None = None,
    as_of: str = "2024-01-01",
    batched: bool = False,
    **calling,
) -> DataFrame:
    """Add ``response``, the JSON record of each text, and ``error``, why there is none.

    ``extract_fn`` maps texts (or prompts) to JSON texts, for instance by calling a model: one
    text per call, or BATCH_TEXTS of them with ``batched``; ``calling`` are options of
    :func:`wardstar.operators.calls.answered`, such as the log that makes a run resumable. The
    default applies rules inside the JVM.
    """
    if extract_fn is None:
        date = F.regexp_extract(F.coalesce(F.col(text), F.lit("")), TEXT_DATE, 1)
        prepared = df.withColumns(
            {"_clean": normalise(F.col(text)), "_date": F.nullif(date, F.lit(""))}
        )
        record = rule_record(F.col("_clean"), F.col("_date"), as_of)
        return prepared.withColumns({"response": F.to_json(record), "error": _none("string")}).drop("_clean", "_date")
    return answered(df, text, extract_fn, **({"texts_per_call": BATCH_TEXTS} if batched else {}), **calling)


def _blank_to(c: Column, default: Column) -> Column:
    return F.when(is_blank(c), default).otherwise(c)


def impute_record(rec: str, key: str) -> Column:
    """Missing demographics filled by a seeded choice; events stay as they are."""
    k = F.col(key)

    def field(path: str) -> Column:
        return F.col(f"{rec}.{path}")

    days = bucket(k, "record-birthdate", BIRTH_DAYS).cast("int")
    born = F.date_add(F.lit(BIRTH_START).cast("date"), days).cast("string")
    return F.struct(
        F.struct(
            field("dim_patient.full_name").alias("full_name"),
            field("dim_patient.gender").alias("gender"),
            _blank_to(field("dim_patient.birthdate"), born).alias("birthdate"),
            _blank_to(field("dim_patient.city"), pick(CITIES, k, "record-city")).alias("city"),
            _blank_to(field("dim_patient.state"), F.lit(STATE)).alias("state"),
            _blank_to(field("dim_patient.zip"), pick(ZIPS, k, "record-zip")).alias("zip"),
        ).alias("dim_patient"),
        F.struct(
            _blank_to(field("dim_provider.name"), pick(PROVIDERS, k, "record-provider")).alias("name"),
            _blank_to(field("dim_provider.specialty"), F.lit(DEFAULT_SPECIALTY)).alias("specialty"),
        ).alias("dim_provider"),
        F.struct(
            _blank_to(field("dim_organization.name"), pick(ORGANIZATIONS, k, "record-org")).alias("name"),
            _blank_to(field("dim_organization.city"), pick(CITIES, k, "record-org-city")).alias("city"),
            _blank_to(field("dim_organization.state"), F.lit(STATE)).alias("state"),
        ).alias("dim_organization"),
        F.struct(
            _blank_to(field("dim_payer.name"), pick(PAYERS, k, "record-payer")).alias("name")
        ).alias("dim_payer"),
        field("fact_patient_events").alias("fact_patient_events"),
        F.struct(F.col("source_row_id").cast("bigint").alias("source_row_id"),
                 F.col("sample_name").cast("string").alias("sample_name")).alias("metadata"),
    )


def split_responses(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose response is a record, and the rejects with their ``error`` where a call failed.

    The responses are written first: both results read them, and no text is sent
    to the extraction function twice.
    """
    parsed = parse_records(stage(df, "responses"), "response", schemas.RECORD)
    good = parsed.filter("not is_bad").drop("is_bad", "error")
    return good, parsed.filter("is_bad").drop("is_bad", "rec")


def records_from(good: DataFrame, first: int = FIRST_OUTPUT) -> DataFrame:
    """``record_id, rec`` with provenance, numbered over the successful rows only.

    Numbering looks at its input twice: records are numbered as they were read and filled in once, afterwards.
    """
    read = good.select("source_row_id", "sample_name", "rec")
    numbered = with_dense_key(read, "record_id", ["source_row_id"], first, "records")
    filled = impute_record("rec", "source_row_id").alias("rec")
    return numbered.select(F.col("record_id").cast("string").alias("record_id"), filled)
