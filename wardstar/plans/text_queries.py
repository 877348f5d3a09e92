"""Free text, extraction, documents and profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from wardstar import schemas
from wardstar.functions import text
from wardstar.functions.chunks import chunk_documents as chunks_of
from wardstar.operators import documents, extract
from wardstar.plans.registry import query
from wardstar.plans.standins import SQL_CLEAN, SQL_CORPUS, SQL_EVENT_DOCS, SQL_PROFILES, SQL_STAR, clean_star, corpus as built_corpus, sql_bucket, star, table
from wardstar.plans.warehouse_queries import _plain
from wardstar.session import fresh_path, spread
from wardstar.sources import sinks, tables

_SPACE = r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def sql_normalise(column: str) -> str:
    return (
        f"trim(regexp_replace(regexp_replace(regexp_replace(lower(coalesce({column}, '')), "
        f"'[{_SPACE},:]+', ' ', 'g'), '[\\r\\n\\t\\-]+', ' ', 'g'), '[{_SPACE}]+', ' ', 'g'))"
    )


@query(f"SELECT doc_id, {sql_normalise('text')} AS clean_transcription FROM documents")
def normalise_text(spark: SparkSession, sf: str) -> DataFrame:
    rows = spread(table(spark, sf, "documents").select("doc_id", "text"))
    return text.with_clean_transcription(rows, "text").drop("text")


@query(f"SELECT doc_id, source AS sample_name, {sql_normalise('text')} AS clean_transcription FROM documents")
def transcription_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Texts with line breaks and quotes written as CSV, read back and normalised."""
    path = fresh_path(spark, "transcriptions")
    rows = table(spark, sf, "documents").select("doc_id", F.col("text").alias("transcription"), F.col("source").alias("sample_name"))
    sinks.export_csv(spread(rows), path)
    read = tables.read_transcriptions(spark, path)
    cleaned = text.with_clean_transcription(read)
    return cleaned.select(F.col("doc_id").cast("bigint").alias("doc_id"), "sample_name", "clean_transcription")


CONTEXT_SQL = r"""
  'conv_id: ' || conv_id || chr(10) || 'turn: ' || turn || chr(10) || 'role: ' || coalesce(nullif(role, 'system'), 'nan')
  || chr(10) || 'text: ' || text"""


def _turns(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", F.nullif(F.col("role"), F.lit("system")).alias("role"), "text"
    )


@query(f"SELECT conv_id, turn, {CONTEXT_SQL} AS row_context FROM conversations")
def row_context(spark: SparkSession, sf: str) -> DataFrame:
    rows = _turns(spark, sf)
    return rows.select("conv_id", "turn", text.row_context(rows).alias("row_context"))


@query(f"""
SELECT conv_id, turn, 'Answer in JSON.' || '{{}}' || chr(10) || 'Transcription:' || chr(10) || {CONTEXT_SQL} AS prompt
FROM conversations
""")
def prompts(spark: SparkSession, sf: str) -> DataFrame:
    return extract.prompts(_turns(spark, sf), "{}", "Answer in JSON.").select("conv_id", "turn", "prompt")


@query("""
SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS source_row_id, o_orderkey FROM orders
QUALIFY source_row_id >= 500 AND source_row_id < 1000
""")
def row_slice(spark: SparkSession, sf: str) -> DataFrame:
    """A slice by position; every row of the table is numbered for it."""
    rows = table(spark, sf, "orders").select("o_orderdate", "o_orderkey")
    return extract.row_slice(rows, ["o_orderdate", "o_orderkey"], 500, 1000).drop("o_orderdate")


NOTE_SQL = """
note AS (
  SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS source_row_id, o_orderpriority AS sample_name,
    'Seen ' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || ': ' || CASE WHEN c_mktsegment = 'BUILDING' THEN 'This is a ' ELSE 'A ' || (20 + c_nationkey) || '-year-old ' END
    || CASE WHEN c_mktsegment = 'MACHINERY' THEN 'woman' WHEN c_mktsegment = 'FURNITURE' THEN 'gentleman' ELSE 'person' END
    || '. Weight: ' || CAST(floor(o_totalprice / 1000) AS BIGINT) || ' pounds, blood pressure of 120/80 mmHg.'
    || CASE WHEN o_orderstatus = 'F' THEN ' Cardiac history. Takes lisinopril ' || (c_nationkey + 1) || ' mg daily' ELSE chr(10) || 'No drugs' END AS transcription
  FROM orders JOIN customer ON o_custkey = c_custkey)
"""


def _notes(spark: SparkSession, sf: str) -> DataFrame:
    """A short note per order, in the wording of transcriptions."""
    rows = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    segment, nation = F.col("c_mktsegment"), F.col("c_nationkey")
    lit = F.lit
    note = F.concat(
        lit("Seen "), F.date_format("o_orderdate", "yyyy-MM-dd"), lit(": "),
        F.when(segment == "BUILDING", lit("This is a ")).otherwise(F.concat(lit("A "), (nation + 20).cast("string"), lit("-year-old "))),
        F.when(segment == "MACHINERY", lit("woman")).when(segment == "FURNITURE", lit("gentleman")).otherwise(lit("person")),
        lit(". Weight: "), F.floor(F.col("o_totalprice") / 1000).cast("string"), lit(" pounds, blood pressure of 120/80 mmHg."),
        F.when(F.col("o_orderstatus") == "F", F.concat(lit(" Cardiac history. Takes lisinopril "), (nation + 1).cast("string"), lit(" mg daily")))
        .otherwise(lit("\nNo drugs")),
    )
    return rows.select("o_orderkey", F.col("o_orderpriority").alias("sample_name"), note.alias("transcription"))


def _sql_pick(options: list[str], salt: str) -> str:
    return f"{options}[{sql_bucket('source_row_id', salt, len(options))} + 1]"


@query("WITH " + NOTE_SQL + f""",
clean AS (SELECT *, {sql_normalise('transcription')} AS t, regexp_extract(transcription, '([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})', 1) AS d FROM note),
events AS (
  SELECT source_row_id AS row_id, 'Observation' AS event_category, 'weight' AS description,
         CAST(regexp_extract(t, 'weight ([0-9]+)', 1) AS DOUBLE) AS numeric_value, 'pounds' AS units, d AS event_date FROM clean
  UNION ALL SELECT source_row_id, 'Observation', 'blood pressure', 120, 'mmhg', d FROM clean
  UNION ALL SELECT source_row_id, 'Medication', 'lisinopril', CAST(regexp_extract(t, 'lisinopril ([0-9]+)', 1) AS DOUBLE), 'mg', d
  FROM clean WHERE contains(t, 'lisinopril'))
SELECT CAST(1500 + c.source_row_id AS VARCHAR) AS record_id, c.source_row_id, sample_name,
  CASE WHEN contains(t, 'woman') THEN 'F' WHEN contains(t, 'gentleman') THEN 'M' END AS gender,
  CASE WHEN contains(t, 'year old') THEN (2024 - CAST(regexp_extract(t, '([0-9]+) year old', 1) AS INTEGER)) || '-01-01'
       ELSE CAST(DATE '1950-01-01' + CAST({sql_bucket('source_row_id', 'record-birthdate', 14975)} AS INTEGER) AS VARCHAR) END AS birthdate,
  {_sql_pick(extract.CITIES, 'record-city')} AS city, 'TX' AS state, {_sql_pick(extract.ZIPS, 'record-zip')} AS zip,
  CASE WHEN contains(t, 'cardiac') THEN 'Cardiology' ELSE 'General Practice' END AS specialty,
  {_sql_pick(extract.ORGANIZATIONS, 'record-org')} AS organization, {_sql_pick(extract.PAYERS, 'record-payer')} AS payer,
  event_category, description, numeric_value, units, event_date
FROM clean c JOIN events e ON c.source_row_id = e.row_id
""")
def extract_records(spark: SparkSession, sf: str) -> DataFrame:
    """Notes to nested records: rules, parsing, provenance, numbering and imputed demographics."""
    notes = extract.row_slice(_notes(spark, sf), ["o_orderkey"], 0, None)
    good, _ = extract.split_responses(extract.responses(spread(notes), "transcription"))
    records = extract.records_from(good)
    return records.select(
        "record_id", "rec.metadata.source_row_id", "rec.metadata.sample_name",
        *[f"rec.dim_patient.{c}" for c in ("gender", "birthdate", "city", "state", "zip")],
        "rec.dim_provider.specialty",
        F.col("rec.dim_organization.name").alias("organization"),
        F.col("rec.dim_payer.name").alias("payer"),
        F.explode("rec.fact_patient_events").alias("e"),
    ).select("*", "e.event_category", "e.description", "e.numeric_value", "e.units", "e.event_date").drop("e")


@query("WITH " + NOTE_SQL + """
SELECT sample_name, count(*) FILTER (WHERE NOT contains(transcription, 'woman')) AS good,
  count(*) FILTER (WHERE contains(transcription, 'woman')) AS rejected FROM note GROUP BY 1
""")
def extract_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """A caller-supplied function that fails on some rows: these become rejects, the rest is kept."""

    def answer(texts):
        if any("woman" in t for t in texts if t is not None):
            raise ValueError("not readable")
        return texts.map(lambda t: '{"dim_payer": {"name": "Aetna"}}')

    answered = extract.responses(_notes(spark, sf), "transcription", answer)
    good, rejects = extract.split_responses(answered)
    marked = good.select("sample_name", F.lit(True).alias("ok")).unionByName(rejects.select("sample_name", F.lit(False).alias("ok")))
    return marked.groupBy("sample_name").agg(
        F.count_if("ok").alias("good"), F.count_if(~F.col("ok")).alias("rejected"))


@query("WITH " + NOTE_SQL + """
SELECT CAST(1499 + row_number() OVER (ORDER BY source_row_id) AS VARCHAR) AS record_id, source_row_id, sample_name
FROM note WHERE NOT contains(transcription, 'woman')
""")
def extract_numbering(spark: SparkSession, sf: str) -> DataFrame:
    """Records are numbered over the rows with an answer: a reject leaves no gap."""

    def answer(texts):
        if any("woman" in t for t in texts if t is not None):
            raise ValueError("not readable")
        return texts.map(lambda t: '{"dim_payer": {"name": "Aetna"}}')

    notes = extract.row_slice(_notes(spark, sf), ["o_orderkey"], 0, None)
    good, _ = extract.split_responses(extract.responses(notes, "transcription", answer))
    return extract.records_from(good).select("record_id", "rec.metadata.source_row_id", "rec.metadata.sample_name")


def _sql_pattern(pattern: str) -> str:
    return pattern.replace("'", "''")


@query(f"""
WITH clean AS (SELECT doc_id, {sql_normalise('text')} AS t, regexp_extract(text, '{extract.TEXT_DATE}', 1) AS d FROM documents)
SELECT doc_id,
  CASE WHEN regexp_matches(t, '{extract.FEMALE}') THEN 'F' WHEN regexp_matches(t, '{extract.MALE}') THEN 'M' END AS gender,
  2024 - TRY_CAST(nullif(regexp_extract(t, '{extract.AGE}', 1), '') AS INTEGER) || '-01-01' AS birthdate,
  CASE WHEN contains(t, 'heart') OR contains(t, 'cardiac') THEN 'Cardiology' WHEN contains(t, 'surgery') OR contains(t, 'surgical') THEN 'Surgery' END AS specialty,
  CAST(len(regexp_extract_all(t, '{_sql_pattern(extract.VITAL)}')) AS BIGINT) AS observations,
  CAST(len(regexp_extract_all(t, '{_sql_pattern(extract.MEDICATION)}')) AS BIGINT) AS medications,
  CASE WHEN regexp_matches(t, '{_sql_pattern(extract.VITAL)}|{_sql_pattern(extract.MEDICATION)}') THEN nullif(d, '') END AS event_date
FROM clean
""")
def extract_documents(spark: SparkSession, sf: str) -> DataFrame:
    """What the rules find in the whole text of every document."""
    found = extract.responses(spread(table(spark, sf, "documents").select("doc_id", "text")), "text")
    parsed = tables.parse_records(found, "response", schemas.RECORD)
    events = F.col("rec.fact_patient_events")
    kind = lambda name: F.size(F.filter(events, lambda e: e["event_category"] == name)).cast("bigint")
    return parsed.select(
        "doc_id", "rec.dim_patient.gender", "rec.dim_patient.birthdate", "rec.dim_provider.specialty",
        kind("Observation").alias("observations"), kind("Medication").alias("medications"),
        F.try_element_at(events, F.lit(1))["event_date"].alias("event_date"),
    )


@query()
def chunk_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Whole documents cut into overlapping chunks."""
    return _plain(chunks_of(spread(table(spark, sf, "documents").select("doc_id", "text")), "doc_id", "text"))


@query("""
SELECT doc_id, CAST(length(text) AS BIGINT) AS covered, 0::BIGINT AS too_long, 0::BIGINT AS altered FROM documents WHERE text <> ''
""")
def chunk_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks cover each document without gaps, stay within the size and repeat the text as it is."""
    rows = table(spark, sf, "documents").select("doc_id", "text")
    pieces = chunks_of(spread(rows), "doc_id", "text").join(rows, "doc_id")
    before = Window.partitionBy("doc_id").orderBy("chunk_no")
    new = F.col("end") - F.greatest(F.col("start"), F.coalesce(F.lag("end").over(before), F.lit(0)))
    gap = F.col("start") > F.coalesce(F.lag("end").over(before), F.lit(0))
    same = F.col("chunk") == F.substring(F.col("text"), F.col("start") + 1, F.col("end") - F.col("start"))
    return pieces.select("doc_id", new.alias("new"), gap.alias("gap"), same.alias("same"), "chunk").groupBy("doc_id").agg(
        F.sum("new").cast("bigint").alias("covered"),
        F.count_if(F.length("chunk") > 500).alias("too_long"),
        F.count_if(F.col("gap") | ~F.col("same")).alias("altered"),
    )


@query("""
WITH m AS (SELECT *, CASE WHEN p_size < 10 THEN NULL ELSE p_size END AS s FROM part)
SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS whole, coalesce(CAST(s AS VARCHAR), '0') AS nullable,
  CAST(p_size AS VARCHAR) AS padded, CAST(p_size AS VARCHAR) AS fraction, p_name AS name FROM m
""")
def normalise_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Keys as text: leading zeros and fractions go, null is 0, words stay."""
    from wardstar.functions.scalars import plain_id

    size = F.col("p_size").cast("string")
    return table(spark, sf, "part").select(
        "p_partkey",
        plain_id(F.col("p_partkey"), is_text=False).alias("whole"),
        plain_id(F.when(F.col("p_size") >= 10, size)).alias("nullable"),
        plain_id(F.lpad(size, 6, "0")).alias("padded"),
        plain_id(F.concat(size, F.lit(".0"))).alias("fraction"),
        plain_id(F.col("p_name")).alias("name"),
    )


@query("WITH " + SQL_CLEAN + "," + SQL_EVENT_DOCS + """
SELECT event_key, gender, patient_city, provider_name, specialty, org_name, org_state, payer_name,
  CAST(year(date_key) AS BIGINT) AS year, dayname(date_key) AS day_of_week FROM joined
""")
def star_denormalise(spark: SparkSession, sf: str) -> DataFrame:
    joined = documents.denormalise(clean_star(spark, sf))
    return _plain(joined.select(
        "event_key", "gender", "patient_city", "provider_name", "specialty", "org_name", "org_state",
        "payer_name", "year", "day_of_week"))


EVENT_META = ["category", "date", "related_provider", "related_organization", "related_payer", "source"]


@query("WITH " + SQL_CLEAN + "," + SQL_EVENT_DOCS + "SELECT * FROM event_docs")
def event_documents(spark: SparkSession, sf: str) -> DataFrame:
    facts = documents.denormalise(clean_star(spark, sf), with_dates=False)
    docs = documents.event_documents(facts)
    return docs.select("*", *[F.col("metadata")[m].alias(m) for m in EVENT_META]).drop("metadata", "content_key")


@query("WITH " + SQL_CLEAN + "," + SQL_PROFILES + "SELECT doc_id, type, content, actor_id, event_count, patient_count FROM profile_docs")
def profiles(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents.profiles(clean_star(spark, sf))

    def number(name: str) -> Column:
        return F.col("metadata")[name].cast("bigint").alias(name)

    ids = [F.col(c) for c in documents.ID_COLUMNS.values()]
    return docs.select("doc_id", "type", "content", F.coalesce(*ids).alias("actor_id"), number("event_count"), number("patient_count"))


@query("WITH " + SQL_CORPUS + "SELECT * FROM corpus")
def corpus(spark: SparkSession, sf: str) -> DataFrame:
    return built_corpus(spark, sf).drop("metadata", "embedding", "content_key")


@query("WITH " + SQL_CORPUS + """
SELECT 'Total patients' AS metric, count(*) AS n FROM c_patient
UNION ALL SELECT 'Total providers', count(*) FROM c_provider UNION ALL SELECT 'Total organizations', count(*) FROM c_org
UNION ALL SELECT 'Total payers', count(*) FROM c_payer UNION ALL SELECT 'Total events', count(*) FROM c_fact
UNION ALL SELECT 'Total documents', count(*) FROM corpus
UNION ALL SELECT 'Patients with events', count(DISTINCT patient_key) FROM c_fact
UNION ALL SELECT 'Providers with events', count(DISTINCT provider_key) FROM c_fact
UNION ALL SELECT 'Organizations with events', count(DISTINCT org_key) FROM c_fact
UNION ALL SELECT 'Payers with events', count(DISTINCT payer_key) FROM c_fact
""")
def corpus_diagnostics(spark: SparkSession, sf: str) -> DataFrame:
    return documents.build_diagnostics(clean_star(spark, sf), built_corpus(spark, sf))


ACTOR_COUNTS_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS actor_type, {k} AS actor_key, count(*) AS event_count, count(DISTINCT patient_key) AS patient_count "
    f"FROM c_fact WHERE {k} IS NOT NULL GROUP BY 2"
    for a, k in documents.ACTOR_KEYS.items()
)


@query("WITH " + SQL_CLEAN + ACTOR_COUNTS_SQL)
def actor_counts(spark: SparkSession, sf: str) -> DataFrame:
    return documents.actor_counts(clean_star(spark, sf)["fact_patient_events"])


@query("WITH " + SQL_CLEAN + """
SELECT org_key, count(DISTINCT d.name) AS provider_count FROM c_fact f JOIN c_provider d ON f.provider_key = d.provider_key
WHERE org_key IS NOT NULL GROUP BY 1
""")
def provider_counts(spark: SparkSession, sf: str) -> DataFrame:
    t = clean_star(spark, sf)
    return documents.provider_counts(t["fact_patient_events"], t["dim_provider"])


@query("WITH " + SQL_STAR + """
, firsts AS (SELECT patient_key, event_category, min(event_key) AS first FROM fact GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY patient_key ORDER BY first) AS rn FROM firsts),
cats AS (SELECT patient_key, string_agg(event_category, ', ' ORDER BY first) AS categories FROM ranked WHERE rn <= 10 GROUP BY 1),
days AS (SELECT patient_key, string_agg(CAST(d AS VARCHAR), ',' ORDER BY d) AS dates FROM (SELECT DISTINCT patient_key, date_key AS d FROM fact) GROUP BY 1)
SELECT patient_key, categories, dates FROM cats FULL JOIN days USING (patient_key)
""")
def category_list(spark: SparkSession, sf: str) -> DataFrame:
    """Event categories in order of first appearance, and the distinct dates, per patient."""
    facts = star(spark, sf)["fact_patient_events"]
    days = documents.date_lists(facts).select(
        "patient_key", F.array_join(F.transform("dates", lambda d: d.cast("string")), ",").alias("dates"))
    return documents.category_lists(facts).join(days, "patient_key", "full")
