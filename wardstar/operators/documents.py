"""The denormalised star, event texts and actor profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from wardstar.functions.scalars import plain_id
from wardstar.operators.joins import lookup_join
from wardstar.operators.ranking import first_seen_list, top_k

LISTED = 10  # categories and patient ids named in a profile
ID_COLUMNS = {
    "patient": "patient_id",
    "provider": "provider_id",
    "organization": "organization_id",
    "payer": "payer_id",
}
ACTOR_KEYS = {
    "patient": "patient_key",
    "provider": "provider_key",
    "organization": "org_key",
    "payer": "payer_key",
}
# Form of a document, in the last three bits of its id.
FORMS = {
    "event": 0,  # and 1 for the short text
    "patient_profile": 2,
    "provider_profile": 3,
    "organization_profile": 4,
    "payer_profile": 5,
}
CORPUS = [
    "doc_id", "type", "content", "content_key", "patient_id", "provider_id", "organization_id", "payer_id", "metadata",
]


def denormalise(star: dict[str, DataFrame], with_dates: bool = True) -> DataFrame:
    """One row per fact with its dimension attributes; facts without a match are kept."""
    dims = [
        ("patient_key", star["dim_patient"].withColumnsRenamed(
            {"city": "patient_city", "state": "patient_state", "zip": "patient_zip"})),
        ("provider_key", star["dim_provider"].withColumnsRenamed({"name": "provider_name"})),
        ("payer_key", star["dim_payer"].withColumnsRenamed({"name": "payer_name"})),
        ("org_key", star["dim_organization"].withColumnsRenamed(
            {"name": "org_name", "city": "org_city", "state": "org_state"})),
    ]
    if with_dates:
        dims.append(("date_key", star["dim_date"]))
    facts = star["fact_patient_events"]
    out = facts
    for key, dim in dims:
        out = lookup_join(out, dim, key, "left", ["event_key"], keys_from=facts)
    return out


def document_id(key: Column, form: Column) -> Column:
    """A number that is unique in the corpus and the same in every run."""
    return F.shiftleft(key.cast("bigint"), 3) + form


def _text(c: Column | str, null_text: str) -> Column:
    column = F.col(c) if isinstance(c, str) else c
    return F.coalesce(column.cast("string"), F.lit(null_text))


def _id(df: DataFrame, key: str) -> Column:
    kind = df.schema[key].dataType
    return plain_id(F.col(key), is_text=not isinstance(kind, (T.LongType, T.IntegerType, T.ShortType)))


def _metadata(entries: dict[str, Column]) -> Column:
    pairs = [x for name, value in entries.items() for x in (F.lit(name), value.cast("string"))]
    return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())


def event_documents(facts: DataFrame, null_text: str = "unknown") -> DataFrame:
    """Two texts per denormalised fact: a detailed one and a short one for keyword search."""

    def optional(present: str, *parts: Column) -> Column:
        return F.when(F.col(present).isNotNull(), F.concat(*parts)).otherwise(F.lit(""))

    def shown(name: str) -> Column:
        return _text(name, null_text)

    lit = F.lit
    prepared = facts.select(
        "*",
        _id(facts, "patient_key").alias("_patient"),
        F.coalesce("event_category", lit("Event")).alias("_category"),
        *[
            F.when(F.col(key).isNotNull(), _id(facts, key)).alias(f"_{actor}")
            for actor, key in ACTOR_KEYS.items()
            if actor != "patient"
        ],
    )
    detailed = F.concat(
        F.col("_category"), lit(" for Patient "), F.col("_patient"), lit(". "),
        optional("description", lit("Description: "), F.col("description"), lit(". ")),
        optional("numeric_value", lit("Value: "), shown("numeric_value"), lit(" "), shown("units"), lit(". ")),
        lit("Date: "), shown("date_key"), lit(". "),
        lit("Patient demographics: "), shown("gender"), lit(", "), shown("patient_city"), lit(". "),
        optional("provider_name", lit("Provider: "), F.col("provider_name"), lit(" ("), shown("specialty"), lit("). ")),
        optional("org_name", lit("Organization: "), F.col("org_name"), lit(", "), shown("org_city"), lit(", "),
                 shown("org_state"), lit(". ")),
        optional("payer_name", lit("Covered by: "), F.col("payer_name"), lit(". ")),
    )
    short = F.concat(
        lit("Patient "), F.col("_patient"), lit(" had "), F.lower("_category"), lit(" on "), shown("date_key"),
        lit("."), optional("description", lit(" "), F.col("description")),
    )

    def related(key: str, name: str) -> Column:
        return F.when(F.col(key).isNotNull(), shown(name))

    metadata = _metadata(
        {
            "source": lit("warehouse"),
            "patient_id": F.col("_patient"),
            "type": lit("event"),
            "date": _text("date_key", ""),
            "category": F.col("_category"),
            "provider_id": F.col("_provider"),
            "related_provider": related("provider_key", "provider_name"),
            "organization_id": F.col("_organization"),
            "related_organization": related("org_key", "org_name"),
            "payer_id": F.col("_payer"),
            "related_payer": related("payer_key", "payer_name"),
        }
    )
    return prepared.select(
        "event_key",
        lit("event").alias("type"),
        F.col("_patient").alias("patient_id"),
        F.col("_provider").alias("provider_id"),
        F.col("_organization").alias("organization_id"),
        F.col("_payer").alias("payer_id"),
        metadata.alias("metadata"),
        F.posexplode(F.array(detailed, short)).alias("_form", "content"),
    ).select(
        document_id(F.col("event_key"), F.col("_form")).alias("doc_id"),
        "type",
        "content",
        F.md5("content").alias("content_key"),
        *CORPUS[4:],
    )


def actor_counts(facts: DataFrame) -> DataFrame:
    """Events and distinct patients per actor; events without that actor are not counted.

    Events are first counted per (actor, patient), so an actor with a large share of
    all events is spread over its patients.
    """
    parts = []
    for actor, key in ACTOR_KEYS.items():
        pairs = _actor_patients(facts, key)
        parts.append(
            pairs.groupBy(F.lit(actor).alias("actor_type"), F.col(key).alias("actor_key")).agg(
                F.sum("_events").alias("event_count"), F.count(F.lit(1)).alias("patient_count")
            )
        )
    return reduce(lambda a, b: a.unionByName(b), parts)


def _actor_patients(facts: DataFrame, key: str) -> DataFrame:
    keys = ["patient_key"] if key == "patient_key" else [key, "patient_key"]
    return (
        facts.filter(F.col(key).isNotNull())
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_events"), F.min("event_key").alias("_first"))
    )


def category_lists(facts: DataFrame) -> DataFrame:
    """Up to ten event categories per patient, first seen first."""
    return first_seen_list(facts, "patient_key", "event_category", "event_key", LISTED, "categories")


def date_lists(facts: DataFrame) -> DataFrame:
    """Distinct event dates per patient (at most one per calendar day)."""
    days = facts.filter(F.col("date_key").isNotNull()).select("patient_key", "date_key").distinct()
    return days.groupBy("patient_key").agg(F.array_sort(F.collect_list("date_key")).alias("dates"))


def _actor_profile_facts(facts: DataFrame, key: str) -> DataFrame:
    """Per actor: events, patients and the first ten patient ids."""
    pairs = _actor_patients(facts, key)
    counts = pairs.groupBy(key).agg(
        F.sum("_events").alias("event_count"), F.count(F.lit(1)).alias("patient_count")
    )
    first = top_k(
        pairs.select(key, "patient_key", "_first"),
        [key], [F.col("_first"), F.col("patient_key")], LISTED, "_rank",
    )
    ids = F.array_sort(F.collect_list(F.struct("_rank", _id(facts, "patient_key").alias("_v"))))
    listed = first.groupBy(key).agg(
        F.concat_ws(", ", F.transform(ids, lambda x: x["_v"])).alias("patient_list")
    )
    return counts.join(listed, key, "left")


def _profile(df: DataFrame, actor: str, source: str, content: Column, counts: list[str]) -> DataFrame:
    own = _id(df, ACTOR_KEYS[actor])
    entries = {"source": F.lit(source), ID_COLUMNS[actor]: own, "type": F.lit(f"{actor}_profile")}
    entries.update({c: F.col(c) for c in counts})
    return df.select(
        document_id(F.col(ACTOR_KEYS[actor]), F.lit(FORMS[f"{actor}_profile"])).alias("doc_id"),
        F.lit(f"{actor}_profile").alias("type"),
        content.alias("content"),
        F.md5(content).alias("content_key"),
        *[(own if a == actor else F.lit(None).cast("string")).alias(c) for a, c in ID_COLUMNS.items()],
        _metadata(entries).alias("metadata"),
    )


def _with_counts(dim: DataFrame, per_actor: DataFrame, key: str) -> DataFrame:
    joined = dim.join(per_actor, key, "left")
    return joined.fillna(0, [c for c in ("event_count", "patient_count", "provider_count") if c in joined.columns])


def patient_profiles(patients: DataFrame, facts: DataFrame, null_text: str = "unknown") -> DataFrame:
    counts = facts.groupBy("patient_key").agg(F.count(F.lit(1)).alias("event_count"))
    df = _with_counts(patients, counts.join(category_lists(facts), "patient_key", "left"), "patient_key")
    lit = F.lit

    def shown(name: str) -> Column:
        return _text(name, null_text)

    types = F.when(
        F.coalesce("categories", lit("")) != "", F.concat(lit("Event types: "), F.col("categories"), lit(". "))
    ).otherwise(lit(""))
    events = F.when(F.col("event_count") == 0, lit("No recorded medical events.")).otherwise(
        F.concat(lit("Has "), F.col("event_count").cast("string"), lit(" medical events. "), types)
    )
    content = F.concat(
        lit("Patient "), _id(df, "patient_key"), lit(": "), shown("gender"), lit(", born "), shown("birthdate"),
        lit(", lives in "), shown("city"), lit(", "), shown("state"), lit(" "), shown("zip"), lit(". "), events,
    )
    return _profile(df, "patient", "patient_dim", content, ["event_count"])


def _summary(verb: str, *middle: Column) -> Column:
    lit = F.lit
    listed = F.when(
        F.col("patient_count") > 0, F.concat(lit("Patient IDs: "), F.col("patient_list"), lit("."))
    ).otherwise(lit(""))
    return F.concat(
        lit(f"{verb} "), F.col("patient_count").cast("string"), lit(" patients with "),
        F.col("event_count").cast("string"), lit(" total events. "), *middle, listed,
    )


def provider_profiles(providers: DataFrame, facts: DataFrame, null_text: str = "unknown") -> DataFrame:
    df = _with_counts(providers, _actor_profile_facts(facts, "provider_key"), "provider_key")
    content = F.concat(
        F.lit("Provider "), _id(df, "provider_key"), F.lit(": "), _text("name", null_text),
        F.lit(", Specialty: "), _text("specialty", null_text), F.lit(". "), _summary("Treated"),
    )
    return _profile(df, "provider", "provider_dim", content, ["event_count", "patient_count"])


def provider_counts(facts: DataFrame, providers: DataFrame) -> DataFrame:
    """Distinct non-null provider names per organisation."""
    pairs = facts.filter("org_key is not null and provider_key is not null").select("org_key", "provider_key").distinct()
    names = providers.filter(F.col("name").isNotNull()).select("provider_key", "name")
    named = lookup_join(pairs, names, "provider_key", "inner").select("org_key", "name").distinct()
    return named.groupBy("org_key").agg(F.count(F.lit(1)).alias("provider_count"))


def organization_profiles(
    organizations: DataFrame, facts: DataFrame, providers: DataFrame, null_text: str = "unknown"
) -> DataFrame:
    per_org = _actor_profile_facts(facts, "org_key").join(provider_counts(facts, providers), "org_key", "left")
    df = _with_counts(organizations, per_org, "org_key")
    n_providers = F.concat(F.lit("Has "), F.col("provider_count").cast("string"), F.lit(" providers. "))
    content = F.concat(
        F.lit("Organization "), _id(df, "org_key"), F.lit(": "), _text("name", null_text),
        F.lit(", Location: "), _text("city", null_text), F.lit(", "), _text("state", null_text), F.lit(". "),
        _summary("Served", n_providers),
    )
    return _profile(df, "organization", "org_dim", content, ["event_count", "patient_count"])


def payer_profiles(payers: DataFrame, facts: DataFrame, null_text: str = "unknown") -> DataFrame:
    df = _with_counts(payers, _actor_profile_facts(facts, "payer_key"), "payer_key")
    content = F.concat(
        F.lit("Payer "), _id(df, "payer_key"), F.lit(": "), _text("name", null_text), F.lit(". "),
        _summary("Covers"),
    )
    return _profile(df, "payer", "payer_dim", content, ["event_count", "patient_count"])


def profiles(star: dict[str, DataFrame], null_text: str = "unknown") -> DataFrame:
    facts = star["fact_patient_events"]
    parts = [
        patient_profiles(star["dim_patient"], facts, null_text),
        provider_profiles(star["dim_provider"], facts, null_text),
        organization_profiles(star["dim_organization"], facts, star["dim_provider"], null_text),
        payer_profiles(star["dim_payer"], facts, null_text),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def build_corpus(star: dict[str, DataFrame], null_text: str = "unknown") -> DataFrame:
    """Event texts and profiles as one document table with unique ids."""
    events = event_documents(denormalise(star, with_dates=False), null_text)
    return events.unionByName(profiles(star, null_text))


def build_diagnostics(star: dict[str, DataFrame], corpus: DataFrame) -> DataFrame:
    """Table sizes, document total and number of actors with events."""
    sizes = {
        "Total patients": "dim_patient",
        "Total providers": "dim_provider",
        "Total organizations": "dim_organization",
        "Total payers": "dim_payer",
    }
    parts = [
        star[t].agg(F.lit(n).alias("metric"), F.count(F.lit(1)).alias("n")) for n, t in sizes.items()
    ]
    parts.append(corpus.agg(F.lit("Total documents").alias("metric"), F.count(F.lit(1)).alias("n")))
    labels = {
        "patient": "Patients with events",
        "provider": "Providers with events",
        "organization": "Organizations with events",
        "payer": "Payers with events",
    }
    # One scan of the facts: events per (kind of actor, actor) first, then events and actors per kind.
    named = F.array(*[F.struct(F.lit(a).alias("actor"), F.col(ACTOR_KEYS[a]).alias("key")) for a in labels])
    total = F.struct(F.lit("event").alias("actor"), F.lit(None).cast("bigint").alias("key"))
    each = star["fact_patient_events"].select(F.inline(F.concat(named, F.array(total))))
    counted = each.groupBy("actor", "key").agg(F.count(F.lit(1)).alias("events"))
    kinds = counted.groupBy("actor").agg(F.sum("events").alias("events"), F.count("key").alias("actors"))
    wanted = star["dim_payer"].sparkSession.createDataFrame(
        [*((a, label) for a, label in labels.items()), ("event", "Total events")], "actor string, metric string"
    )
    found = wanted.join(kinds, "actor", "left")
    number = F.when(F.col("actor") == "event", F.col("events")).otherwise(F.col("actors"))
    parts.append(found.select("metric", F.coalesce(number, F.lit(0)).alias("n")))
    return reduce(lambda a, b: a.unionByName(b), parts)
