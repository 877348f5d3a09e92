"""Questions, nearest neighbours, keyword and fuzzy search, answers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wardstar.functions.fuzzy import fuzzy_score
from wardstar.functions.questions import SYNONYMS, expand, with_actor
from wardstar.functions.text import keywords
from wardstar.operators import retrieval
from wardstar.operators.ranking import top_k
from wardstar.operators.vectors import diversify, embed as embed_texts, nearest, squared_distance
from wardstar.plans.registry import query
from wardstar.plans.standins import SQL_CORPUS, clean_star, corpus, corpus_index, table
from wardstar.session import spread

QUESTION_SQL = """
q AS (
  SELECT 'turn:' || conv_id || ':' || turn AS query_id, text AS query FROM conversations
  UNION ALL SELECT 'order:' || o_orderkey, 'What medication did PATIENT 00' || o_custkey || ' get after the visit to doctor 5?' FROM orders
  UNION ALL SELECT 'customer:' || c_custkey, 'Observation of patient id  ' || c_custkey || ', patient number 3' FROM customer
  UNION ALL SELECT 'supplier:' || s_suppkey, 'Tell me about physician' || s_suppkey || ' and hospital 7' FROM supplier
  UNION ALL SELECT 'part:' || p_partkey, 'Any procedure at facility ' || p_partkey || '? ' || p_name FROM part
  UNION ALL SELECT 'nation:' || n_nationkey, 'Which clinic has insurance coverage in ' || n_name FROM nation
  UNION ALL SELECT 'region:' || r_regionkey, 'Outpatient diagnosis by dr. in ' || r_name FROM region)
"""


def _questions(spark: SparkSession, sf: str) -> DataFrame:
    def of(name: str, id_: Column, query: Column) -> DataFrame:
        return table(spark, sf, name).select(id_.alias("query_id"), query.alias("query"))

    lit, col = F.lit, F.col

    def key(prefix: str, *parts: str) -> Column:
        return F.concat_ws(":", lit(prefix), *parts)

    parts = [
        of("conversations", key("turn", "conv_id", "turn"), col("text")),
        of("orders", key("order", "o_orderkey"), F.concat(lit("What medication did PATIENT 00"), "o_custkey", lit(" get after the visit to doctor 5?"))),
        of("customer", key("customer", "c_custkey"), F.concat(lit("Observation of patient id  "), "c_custkey", lit(", patient number 3"))),
        of("supplier", key("supplier", "s_suppkey"), F.concat(lit("Tell me about physician"), "s_suppkey", lit(" and hospital 7"))),
        of("part", key("part", "p_partkey"), F.concat(lit("Any procedure at facility "), "p_partkey", lit("? "), "p_name")),
        of("nation", key("nation", "n_nationkey"), F.concat(lit("Which clinic has insurance coverage in "), "n_name")),
        of("region", key("region", "r_regionkey"), F.concat(lit("Outpatient diagnosis by dr. in "), "r_name")),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def _sql_actor(flavour: str) -> str:
    console = flavour == "console"
    ids = {
        "patient": ["patient\\s*", "patient\\s+id\\s*"] + (["patient\\s+number\\s*"] if console else []),
        "provider": ["provider\\s*"] + (["provider\\s+id\\s*"] if console else []) + ["doctor\\s*", "physician\\s*"],
        "organization": ["organization\\s*", "org\\s*", "hospital\\s*"] + (["facility\\s*"] if console else []),
        "payer": ["payer\\s*", "insurance\\s*"],
    }
    words = {
        "patient": ["patient"],
        "provider": ["doctor", "physician", "provider"] + (["dr."] if console else []),
        "organization": ["hospital", "organization", "facility"] + (["clinic"] if console else []),
        "payer": ["insurance", "payer"] + (["coverage"] if console else []),
    }
    found = {a: "coalesce(" + ", ".join(f"nullif(regexp_extract(lower(query), '{p}([0-9]+)', 1), '')" for p in ps) + ")" for a, ps in ids.items()}
    by_id = " ".join(f"WHEN {e} IS NOT NULL THEN '{a}'" for a, e in found.items())
    by_word = " ".join("WHEN " + " OR ".join(f"contains(lower(query), '{w}')" for w in ws) + f" THEN '{a}'" for a, ws in words.items())
    digits = f"coalesce({', '.join(found.values())})"
    return f"CASE {by_id} {by_word} END AS actor_type, CASE WHEN {digits} IS NOT NULL THEN coalesce(nullif(ltrim({digits}, '0'), ''), '0') END AS actor_id"


@query("WITH " + QUESTION_SQL + f"SELECT query_id, {_sql_actor('console')} FROM q")
def actor_detect(spark: SparkSession, sf: str) -> DataFrame:
    return with_actor(_questions(spark, sf)).drop("query")


@query("WITH " + QUESTION_SQL + f"SELECT query_id, {_sql_actor('service')} FROM q")
def actor_detect_service(spark: SparkSession, sf: str) -> DataFrame:
    """The narrower patterns of the service."""
    return with_actor(_questions(spark, sf), flavour="service").drop("query")


_SYNONYM_SQL = "list_sort(list_distinct(flatten([" + ", ".join(
    f"CASE WHEN contains(lower(query), '{k}') THEN {terms} ELSE [] END" for k, terms in SYNONYMS.items()) + "])))"


@query("WITH " + QUESTION_SQL + f"""
SELECT query_id, concat_ws(' ', query, nullif(array_to_string({_SYNONYM_SQL}, ' '), '')) AS expanded FROM q
""")
def query_expand(spark: SparkSession, sf: str) -> DataFrame:
    return _questions(spark, sf).select("query_id", expand(F.col("query")).alias("expanded"))


@query("""
SELECT doc_id, CASE WHEN regexp_matches(text, '[\\p{L}\\p{N}]') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS squared_length, 0.0::DOUBLE AS distance
FROM documents
""")
def embed(spark: SparkSession, sf: str) -> DataFrame:
    """Default vectors of whole documents: length, and distance to the vector of the normalised text."""
    rows = embed_texts(spread(table(spark, sf, "documents").select("doc_id", "text")), "text")
    rows = embed_texts(rows.withColumn("lowered", F.lower("text")), "lowered", "again")
    length = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return rows.select(
        "doc_id", F.round(length, 4).alias("squared_length"), F.round(squared_distance("embedding", "again"), 6).alias("distance"))


CENTROID_SQL = """
vec AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
flat AS (SELECT vec_id, label, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM vec),
mean AS (SELECT label, i, CAST(CAST(avg(x) AS FLOAT) AS DOUBLE) AS m FROM flat GROUP BY 1, 2)
"""


def _centroids(spark: SparkSession, sf: str) -> DataFrame:
    """The mean vector of each label: one query per label, however many vectors there are."""
    flat = table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    mean = flat.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).cast("float").alias("m"))
    ordered = F.array_sort(F.collect_list(F.struct("i", "m")))
    return mean.groupBy(F.col("label").alias("query_id")).agg(F.transform(ordered, lambda s: s["m"]).alias("vector"))


@query("WITH " + CENTROID_SQL + """,
dist AS (SELECT mean.label AS query_id, vec_id, sum((x - m) * (x - m)) AS distance FROM flat JOIN mean ON flat.i = mean.i GROUP BY 1, 2)
SELECT CAST(query_id AS BIGINT) AS query_id, vec_id, round(distance, 4) AS distance, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM dist) WHERE rank <= 100
""")
def knn(spark: SparkSession, sf: str) -> DataFrame:
    """The 100 vectors nearest to each label's mean, over all vectors."""
    queries = _centroids(spark, sf).withColumn("k", F.lit(100))
    found = nearest(table(spark, sf, "embeddings"), queries, "vec_id")
    return found.select(
        F.col("query_id").cast("bigint").alias("query_id"), "vec_id",
        F.round("distance", 4).alias("distance"), F.col("rank").cast("bigint").alias("rank"))


@query("WITH " + CENTROID_SQL + """,
dist AS (SELECT flat.label AS query_id, vec_id, sum((x - m) * (x - m)) AS distance FROM flat JOIN mean ON flat.i = mean.i AND flat.label = mean.label GROUP BY 1, 2)
SELECT CAST(query_id AS BIGINT) AS query_id, vec_id, round(distance, 4) AS distance, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM dist) WHERE rank <= 150
""")
def knn_filtered(spark: SparkSession, sf: str) -> DataFrame:
    """The 150 vectors of each label nearest to its mean: the filter comes before the ranking."""
    queries = _centroids(spark, sf)
    pairs = table(spark, sf, "embeddings").join(queries, F.col("label") == F.col("query_id"))
    measured = pairs.select("query_id", "vec_id", squared_distance("embedding", "vector").alias("distance"))
    best = top_k(measured, ["query_id"], [F.col("distance"), F.col("vec_id")], 150)
    return best.select(
        F.col("query_id").cast("bigint").alias("query_id"), "vec_id",
        F.round("distance", 4).alias("distance"), F.col("rank").cast("bigint").alias("rank"))


@query("WITH RECURSIVE " + CENTROID_SQL + """,
centre AS (SELECT label AS query_id, list(m ORDER BY i) AS c FROM mean GROUP BY 1),
near AS (
  SELECT query_id, vec_id, v, c, row_number() OVER (PARTITION BY query_id ORDER BY list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), vec_id) AS rank
  FROM vec, centre),
cand AS (SELECT *, list_cosine_similarity(v, c) AS rel FROM near WHERE rank <= 150),
sim AS (
  SELECT a.query_id, a.vec_id AS a, b.vec_id AS b, list_cosine_similarity(a.v, b.v) AS s
  FROM cand a JOIN cand b ON a.query_id = b.query_id),
state AS (
  SELECT query_id, vec_id, rank, rel, -1e9::DOUBLE AS closest, rel AS score, CAST(NULL AS BIGINT) AS picked, 0::BIGINT AS step FROM cand
  UNION ALL
  SELECT w.query_id, w.vec_id, w.rank, w.rel, greatest(w.closest, s.s), 0.5 * w.rel - 0.5 * greatest(w.closest, s.s),
         CASE WHEN w.vec_id = w.pick THEN w.step + 1 ELSE w.picked END, w.step + 1
  FROM (SELECT *, first_value(vec_id) OVER (PARTITION BY query_id ORDER BY picked IS NOT NULL, score DESC, rank) AS pick
        FROM state WHERE step < 50) w JOIN sim s ON s.query_id = w.query_id AND s.a = w.vec_id AND s.b = w.pick)
SELECT CAST(query_id AS BIGINT) AS query_id, vec_id, picked AS rank FROM state WHERE step = 50 AND picked IS NOT NULL
""")
def mmr(spark: SparkSession, sf: str) -> DataFrame:
    """50 diverse vectors out of the 150 nearest to each label's mean."""
    queries = _centroids(spark, sf)
    vectors = table(spark, sf, "embeddings").select("vec_id", "embedding")
    fetched = nearest(vectors, queries.withColumn("k", F.lit(150)), "vec_id")
    candidates = vectors.join(fetched, "vec_id").join(queries, "query_id").withColumn("k", F.lit(50))
    chosen = diversify(candidates, "vec_id")
    return chosen.select(F.col("query_id").cast("bigint").alias("query_id"), "vec_id", F.col("rank").cast("bigint").alias("rank"))


@query("""
WITH words AS (
  SELECT item_id, 'src' || (item_id % 20) AS source, list_filter(regexp_split_to_array(lower(text), '[\\t\\n\\r ]+'), lambda w: length(w) > 2) AS ws FROM benchmark)
SELECT item_id AS query_id, CAST(doc_id AS VARCHAR) AS doc_id FROM documents JOIN words USING (source)
WHERE lang = 'en' OR len(list_filter(ws, lambda w: contains(lower(text), w))) > 0
""")
def keyword_match(spark: SparkSession, sf: str) -> DataFrame:
    """Sources stand for actors and English documents for events; benchmark texts ask."""
    docs = spread(table(spark, sf, "documents").select("doc_id", "text", "lang", "source")).select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.when(F.col("lang") == "en", "event").otherwise("other").alias("type"),
        F.col("text").alias("content"),
        F.col("source").alias("provider_id"),
        *[F.lit(None).cast("string").alias(c) for c in ("patient_id", "organization_id", "payer_id")],
    )
    asked = table(spark, sf, "benchmark").select(
        F.col("item_id").alias("query_id"),
        F.lit("provider").alias("actor_type"),
        F.concat(F.lit("src"), (F.col("item_id") % 20).cast("string")).alias("actor_id"),
        keywords(F.col("text")).alias("words"),
    )
    return retrieval.keyword_match(docs, asked).select("query_id", "doc_id")


@query("WITH " + SQL_CORPUS + """
, q AS (SELECT 'provider' AS actor_type, CAST(provider_key AS VARCHAR) AS actor_id FROM c_provider
        UNION ALL SELECT 'payer', CAST(payer_key AS VARCHAR) FROM c_payer
        UNION ALL SELECT 'patient', CAST(patient_key AS VARCHAR) FROM c_patient
        UNION ALL SELECT 'organization', CAST(org_key AS VARCHAR) FROM c_org)
SELECT n.actor_type || ':' || n.actor_id AS query_id, doc_id, 1::BIGINT AS rank FROM named n JOIN q USING (actor_type, actor_id)
WHERE type = n.actor_type || '_profile'
""")
def profile_match(spark: SparkSession, sf: str) -> DataFrame:
    """The profiles of every actor that is asked about."""
    asked = with_actor(_actor_questions(spark, sf, tuple(ACTOR_QUESTIONS)))
    return retrieval.profile_match(corpus(spark, sf), asked).withColumn("rank", F.col("rank").cast("bigint"))


@query()
def fuzzy(spark: SparkSession, sf: str) -> DataFrame:
    """Each answer of a conversation scored against the turn before it; best answers first."""
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    asked = turns.filter("role <> 'assistant'").select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("query"))
    pairs = spread(turns.filter("role = 'assistant'")).join(asked, ["conv_id", "turn"])
    score = fuzzy_score(F.col("query"), F.col("text"), retrieval.FUZZY_THRESHOLD)
    scored = pairs.select("conv_id", "turn", score.alias("score"))
    ranked = top_k(scored, ["conv_id"], [F.desc("score"), F.col("turn")], retrieval.FUZZY_K)
    return ranked.withColumn("rank", F.col("rank").cast("bigint"))


# Table, key and question of each kind of actor.
ACTOR_QUESTIONS = {
    "provider": ("dim_provider", "provider_key", "Tell me about provider %s"),
    "payer": ("dim_payer", "payer_key", "Who is covered by payer %s?"),
    "patient": ("dim_patient", "patient_key", "What do you know of patient %s?"),
    "organization": ("dim_organization", "org_key", "Describe organization %s"),
}


def _actor_questions(spark: SparkSession, sf: str, kinds: tuple[str, ...] = ("provider", "payer")) -> DataFrame:
    """A question about every actor of these kinds in the cleaned star."""
    tables = clean_star(spark, sf)
    parts = []
    for kind in kinds:
        name, key, text = ACTOR_QUESTIONS[kind]
        parts.append(
            tables[name].select(
                F.concat_ws(":", F.lit(kind), key).alias("query_id"), F.format_string(text, F.col(key).cast("string")).alias("query")
            )
        )
    return reduce(lambda a, b: a.unionByName(b), parts)


def _all_questions(spark: SparkSession, sf: str) -> DataFrame:
    """Questions about actors, and one general question per kind of event."""
    kinds = clean_star(spark, sf)["fact_patient_events"].select("event_category").distinct()
    general = kinds.select(
        F.concat_ws(":", F.lit("general"), "event_category").alias("query_id"),
        F.concat(F.lit("Show me all "), F.lower("event_category"), F.lit(" records with a test result")).alias("query"),
    )
    return _actor_questions(spark, sf).unionByName(general)


def _retrieved(spark: SparkSession, sf: str, flavour: str) -> tuple[DataFrame, retrieval.Retrieved]:
    asked = retrieval.prepare_questions(_all_questions(spark, sf), flavour)
    return asked, retrieval.search_documents(corpus(spark, sf), asked, flavour, corpus_index(spark, sf))


@query()
def hybrid(spark: SparkSession, sf: str) -> DataFrame:
    """Every document found per question, by all strategies."""
    _, found = _retrieved(spark, sf, "console")
    return found.documents().select("query_id", "doc_id", "is_event", F.col("strategy").cast("bigint").alias("strategy"),
                        F.col("rank").cast("bigint").alias("rank"), "score")


@query()
def hybrid_answers(spark: SparkSession, sf: str) -> DataFrame:
    """One answer row per question: counts, context and first documents."""
    asked, found = _retrieved(spark, sf, "service")
    rows = retrieval.answers(corpus(spark, sf), asked, found)
    return rows.select("query_id", "actor_type", "actor_id", "num_documents_retrieved", "num_events", "context",
                       F.to_json("documents").alias("documents"), "answer")


# Every actor of the cleaned star is asked about.
SQL_ASKED = """
, q AS (SELECT 'provider' AS actor_type, CAST(provider_key AS VARCHAR) AS actor_id FROM c_provider
        UNION ALL SELECT 'payer', CAST(payer_key AS VARCHAR) FROM c_payer
        UNION ALL SELECT 'patient', CAST(patient_key AS VARCHAR) FROM c_patient
        UNION ALL SELECT 'organization', CAST(org_key AS VARCHAR) FROM c_org)
"""


@query("WITH " + SQL_CORPUS + SQL_ASKED + """
SELECT query_id, count(DISTINCT md5(content)) AS num_documents, count(DISTINCT md5(content)) FILTER (WHERE type = 'event') AS num_events
FROM (SELECT actor_type || ':' || actor_id AS query_id, type, content FROM named JOIN q USING (actor_type, actor_id)) GROUP BY 1
""")
def hybrid_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Questions about an actor find each of its texts exactly once."""
    asked = retrieval.prepare_questions(_actor_questions(spark, sf, tuple(ACTOR_QUESTIONS)), "service")
    found = retrieval.search_documents(corpus(spark, sf), asked, "service").documents()
    return found.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("num_documents"), F.count_if("is_event").alias("num_events"))


@query("WITH " + SQL_CORPUS + SQL_ASKED + """
, texts AS (
  SELECT actor_type || ':' || actor_id AS query_id, content, bool_or(type = 'event') AS is_event
  FROM named JOIN q USING (actor_type, actor_id) GROUP BY 1, 2)
SELECT query_id, split_part(query_id, ':', 1) AS actor_type, split_part(query_id, ':', 2) AS actor_id,
  count(*) AS num_documents_retrieved, least(count(*) FILTER (WHERE is_event), 100) AS num_events,
  least(count(*), 100) AS in_context, least(count(*), 20) AS shown FROM texts GROUP BY 1
""")
def answer_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Answers about actors: events come first, 100 documents make the context, 20 are shown."""
    asked = retrieval.prepare_questions(_actor_questions(spark, sf, tuple(ACTOR_QUESTIONS)), "service")
    documents = corpus(spark, sf)
    rows = retrieval.answers(documents, asked, retrieval.search_documents(documents, asked, "service"))
    return rows.select(
        "query_id", "actor_type", "actor_id", "num_documents_retrieved", "num_events",
        F.size(F.split("context", "\n\n")).cast("bigint").alias("in_context"),
        F.size("documents").cast("bigint").alias("shown"))


@query("WITH " + SQL_CORPUS + """
SELECT count(*) AS total_documents, count(DISTINCT patient_id) AS unique_patients, count(DISTINCT provider_id) AS unique_providers,
  count(DISTINCT organization_id) AS unique_organizations, count(DISTINCT payer_id) AS unique_payers,
  count(*) FILTER (WHERE type = 'event') AS total_events FROM corpus
""")
def corpus_stats(spark: SparkSession, sf: str) -> DataFrame:
    return retrieval.corpus_stats(corpus(spark, sf))


@query("WITH " + SQL_CORPUS + """
, counted AS (
  SELECT actor_type, actor_id, count(*) AS total_documents, count(*) FILTER (WHERE type = 'event') AS event_documents,
    count(*) FILTER (WHERE type <> 'event') AS profile_documents FROM named GROUP BY 1, 2),
sampled AS (
  SELECT actor_type, actor_id, string_agg(type || '|' || substr(content, 1, 200), '#' ORDER BY doc_id) AS samples FROM (
    SELECT *, row_number() OVER (PARTITION BY actor_type, actor_id ORDER BY doc_id) AS rn FROM named) WHERE rn <= 5 GROUP BY 1, 2)
SELECT * FROM counted JOIN sampled USING (actor_type, actor_id)
""")
def actor_debug(spark: SparkSession, sf: str) -> DataFrame:
    """Counts and samples for every actor of the corpus."""
    rows = retrieval.actor_debug(corpus(spark, sf))
    shown = F.transform("sample_documents", lambda d: F.concat_ws("|", d["type"], d["content"]))
    return rows.withColumn("samples", F.array_join(shown, "#")).drop("sample_documents")
