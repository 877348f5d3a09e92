"""Scalar expressions, dates, top-k, sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardstar import schemas
from wardstar.functions import scalars, text
from wardstar.operators import dates, dedup, keys
from wardstar.operators.ranking import top_k
from wardstar.plans.registry import query
from wardstar.plans.standins import table
from wardstar.session import fresh_path
from wardstar.sources import sinks, tables


@query("""
SELECT p_partkey AS id, upper(trim(p_name)) AS shouted, lower(p_brand) AS lowered,
  coalesce(nullif(p_type, 'ECONOMY'), 'General Practice') AS specialty,
  concat(p_name, ' / ', p_brand) AS joined, replace(p_brand, 'Brand#', 'No. ') AS replaced,
  starts_with(p_name, 'b') AS prefixed, contains(p_name, 'ring') AS has_ring,
  p_type IN ('SMALL', 'LARGE') AS sized, regexp_matches(p_brand, '[0-9]{2}') AS two_digits,
  coalesce(nullif(p_type, 'PROMO'), '') = '' AS blank, CAST(length(p_name) AS BIGINT) AS name_length,
  length(p_name) < 10 AS short, regexp_replace(p_brand, '[0-9]+', '', 'g') AS no_digits,
  regexp_extract(p_brand, '#([0-9]+)', 1) AS digits, split_part(p_name, ' ', 1) AS first_word,
  CAST(len(string_split(p_name, ' ')) AS BIGINT) AS n_words,
  CASE WHEN p_size < 10 THEN 'S' WHEN p_size < 30 THEN 'M' ELSE 'L' END AS size_class,
  contains(lower(p_name), 'red') OR contains(lower(p_name), 'blue') AS any_colour,
  substr(p_name, 1, 5) AS cut
FROM part
""")
def scalar_strings(spark: SparkSession, sf: str) -> DataFrame:
    name, brand, kind = F.col("p_name"), F.col("p_brand"), F.col("p_type")
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"),
        F.upper(F.trim(name)).alias("shouted"),
        F.lower(brand).alias("lowered"),
        scalars.blank_to(F.nullif(kind, F.lit("ECONOMY")), "General Practice").alias("specialty"),
        F.concat(name, F.lit(" / "), brand).alias("joined"),
        F.replace(brand, F.lit("Brand#"), F.lit("No. ")).alias("replaced"),
        F.startswith(name, F.lit("b")).alias("prefixed"),
        F.contains(name, F.lit("ring")).alias("has_ring"),
        kind.isin("SMALL", "LARGE").alias("sized"),
        brand.rlike("[0-9]{2}").alias("two_digits"),
        scalars.is_blank(F.nullif(kind, F.lit("PROMO"))).alias("blank"),
        F.length(name).cast("bigint").alias("name_length"),
        (F.length(name) < 10).alias("short"),
        F.regexp_replace(brand, "[0-9]+", "").alias("no_digits"),
        F.regexp_extract(brand, "#([0-9]+)", 1).alias("digits"),
        F.split_part(name, F.lit(" "), F.lit(1)).alias("first_word"),
        F.size(F.split(name, " ")).cast("bigint").alias("n_words"),
        F.when(F.col("p_size") < 10, "S").when(F.col("p_size") < 30, "M").otherwise("L").alias("size_class"),
        scalars.any_of(F.lower(name), ["red", "blue"]).alias("any_colour"),
        text.cut(name, 5).alias("cut"),
    )


@query("""
SELECT o_orderkey AS id, CAST(year(o_orderdate) AS BIGINT) AS y, CAST(month(o_orderdate) AS BIGINT) AS m,
  monthname(o_orderdate) AS month_name, dayname(o_orderdate) AS day_name,
  CAST(CAST(o_orderdate AS DATE) + 30 AS VARCHAR) AS due, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS written,
  CAST(o_orderdate AS DATE) < DATE '1997-07-01' AS early
FROM orders
""")
def scalar_dates(spark: SparkSession, sf: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    written = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T23:30:00+05:00"))
    parts = dates.date_attributes(day)
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        parts["year"].cast("bigint").alias("y"),
        parts["month"].cast("bigint").alias("m"),
        parts["month_name"].alias("month_name"),
        parts["day_of_week"].alias("day_name"),
        F.date_add(day, 30).cast("string").alias("due"),
        scalars.date_of(written).cast("string").alias("written"),
        (day < F.lit("1997-07-01").cast("date")).alias("early"),
    )


@query("""
SELECT o_custkey, o_orderkey, o_totalprice, rank FROM (
  SELECT o_custkey, o_orderkey, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders)
WHERE rank <= 3
""")
def topk_per_group(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    best = top_k(orders, ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 3)
    return best.withColumn("rank", F.col("rank").cast("bigint"))


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS "Id", nullif(c_mktsegment, 'BUILDING') AS "NAME", 'customer' AS source,
       CAST(NULL AS VARCHAR) AS "SPECIALITY" FROM customer
UNION ALL
SELECT CAST(s_suppkey AS VARCHAR), s_name, 'supplier', CAST(NULL AS VARCHAR) FROM supplier
""")
def csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Exported as CSV and read back by column name; one file is missing, one column is absent."""
    customer = table(spark, sf, "customer").select(
        F.col("c_acctbal").alias("extra"),
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("NAME"),
        F.col("c_custkey").alias("Id"),
    )
    supplier = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("Id"), F.col("s_name").alias("NAME"))
    schema = schemas.SOURCES["providers"]
    parts = []
    for name, df in {"customer": customer, "supplier": supplier, "nobody": None}.items():
        path = fresh_path(spark, f"csv-{name}")
        if df is not None:
            sinks.export_csv(df, path)
        parts.append(tables.read_csv(spark, path, schema).withColumn("source", F.lit(name)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("""
SELECT c_custkey AS id, c_name AS full_name, nullif(c_mktsegment, 'BUILDING') AS gender, n_name AS city,
  CAST(round(c_acctbal, 2) AS DOUBLE) AS numeric_value
FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def json_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Nested records written as newline JSON and read back with the declared types."""
    customer = table(spark, sf, "customer")
    nation = table(spark, sf, "nation")
    event = F.struct(F.lit("Observation").alias("event_category"), F.col("c_acctbal").alias("numeric_value"))
    records = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").cast("string").alias("record_id"),
        F.struct(
            F.struct(
                F.col("c_name").alias("full_name"),
                F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("gender"),
                F.col("n_name").alias("city"),
            ).alias("dim_patient"),
            F.array(event).alias("fact_patient_events"),
        ).alias("rec"),
    )
    path = fresh_path(spark, "json")
    sinks.write_json(records, path)
    return tables.read_records(spark, path).select(
        F.col("record_id").cast("bigint").alias("id"),
        "rec.dim_patient.full_name",
        "rec.dim_patient.gender",
        "rec.dim_patient.city",
        F.round(F.col("rec.fact_patient_events")[0]["numeric_value"], 2).alias("numeric_value"),
    )


@query("""
SELECT CAST(min(s_suppkey) AS BIGINT) AS provider_key, s_name AS name, n_name AS specialty
FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 2, 3
""")
def append_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """The same providers appended twice with new keys; dedup leaves the first of each."""
    nation = table(spark, sf, "nation")
    rows = table(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    first = rows.select(
        F.col("s_suppkey").alias("provider_key"), F.col("s_name").alias("name"), F.col("n_name").alias("specialty")
    )
    path = fresh_path(spark, "dim_provider")
    sinks.append_table(first, path)
    offset = keys.next_key(first, "provider_key")
    sinks.append_table(first.withColumn("provider_key", F.col("provider_key") + offset), path)
    stored = spark.read.parquet(path)
    replaced = dedup.replaced_keys(stored, "provider_key", ["name", "specialty"])
    return dedup.drop_duplicates(stored, replaced, "provider_key")


@query("""
SELECT vec_id, CAST(label AS VARCHAR) AS type, CAST(len(embedding) AS BIGINT) AS dimensions,
  round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 4) AS total FROM embeddings
""")
def vector_table(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors stored by type and loaded again."""
    path = fresh_path(spark, "vectors")
    vectors = table(spark, sf, "embeddings").select("vec_id", F.col("label").cast("string").alias("type"), "embedding")
    stored = sinks.load_or_build_vectors(spark, path, lambda: vectors)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return stored.select(
        "vec_id",
        F.col("type").cast("string").alias("type"),
        F.size("embedding").cast("bigint").alias("dimensions"),
        F.round(total, 4).alias("total"),
    )


@query("""
SELECT event_id, CASE WHEN ok THEN value END AS parsed,
  CASE WHEN ok THEN CAST(CAST(value AS DECIMAL(10,2)) AS DOUBLE) END AS money FROM (
  SELECT event_id, value, CAST(json_extract_string(props, '$.k') AS INTEGER) >= 40 AS ok FROM events)
""")
def safe_numeric(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers among words, NaN, infinities and blanks."""
    k = F.get_json_object("props", "$.k").cast("int")
    written = (
        F.when(k < 10, "abc").when(k < 20, "NaN").when(k < 25, "-Infinity").when(k < 30, "")
        .when(k < 35, "5d").when(k < 40, None).otherwise(F.concat(F.lit(" "), F.col("value").cast("string")))
    )
    parsed = scalars.safe_double(written)
    return table(spark, sf, "events").select(
        "event_id", parsed.alias("parsed"), scalars.money(parsed).cast("double").alias("money")
    )


@query("""
SELECT event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n,
  CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, CAST(NULL AS VARCHAR) AS missing
FROM events GROUP BY 1, 2
""")
def json_props(spark: SparkSession, sf: str) -> DataFrame:
    """JSON text parsed with a schema; an absent key is null."""
    props = F.from_json("props", "k bigint, absent string")
    return (
        table(spark, sf, "events")
        .withColumn("p", props)
        .groupBy("event_type", F.col("p.k").alias("k"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"),
            F.max("p.absent").alias("missing"),
        )
    )


@query("""
SELECT row_number() OVER (ORDER BY CAST(s_suppkey AS VARCHAR)) AS provider_key, CAST(s_suppkey AS VARCHAR) AS source_id
FROM supplier
""")
def surrogate_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Dense keys and the map from source id to key; a repeated id keeps its last key."""
    ids = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("source_id"))
    keyed = keys.with_dense_key(ids, "provider_key", ["source_id"])
    return keys.key_map(keyed.unionByName(keyed.withColumn("provider_key", F.col("provider_key") - 1)), "source_id", "provider_key")
