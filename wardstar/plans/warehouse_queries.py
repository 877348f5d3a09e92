"""Loading, dates, flattening, cleaning, dedup and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wardstar import schemas
from wardstar.functions import scalars
from wardstar.operators import clean, dates, dedup, flatten, keys, loading, quality
from wardstar.plans import warehouse
from wardstar.plans.registry import query
from wardstar.plans.standins import SQL_CLEAN, SQL_STAR, clean_star, dimensions, sources, sql_bucket, star, table
from wardstar.session import fresh_path
from wardstar.sources import sinks, tables

AS_OF = "2000-01-01"

FACT_OUT = """event_key, patient_key, CAST(date_key AS VARCHAR) AS date_key, provider_key, org_key, payer_key,
  event_category, encounter_id, code, description, CAST(numeric_value AS DOUBLE) AS numeric_value, units,
  CAST(cost AS DOUBLE) AS cost"""


def _plain(df: DataFrame) -> DataFrame:
    """Dates as text and decimals as doubles, so that results print the same everywhere."""
    out: list[Column] = []
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        cast = {"date": "string", "decimal": "double", "integer": "bigint"}.get(kind)
        out.append(F.col(f.name).cast(cast).alias(f.name) if cast else F.col(f.name))
    return df.select(*out)


@query("""
SELECT CAST(year(l_shipdate) AS BIGINT) AS year, l_returnflag AS event_category, count(*) AS events,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_cost
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2
""")
def fact_by_year_category(spark: SparkSession, sf: str) -> DataFrame:
    """Orders joined to their lines and to the date dimension made from them."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", F.to_date("l_shipdate").alias("date_key"), F.col("l_returnflag").alias("event_category"),
        scalars.money(F.col("l_extendedprice")).alias("cost"),
    )
    facts = lines.join(
        table(spark, sf, "orders").select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    dim_date = dates.date_dimension(lines.select("date_key"))
    return _plain(warehouse.fact_summary(facts, dim_date))


@query("""
SELECT 'payer' AS dim, payer_key AS key, name, CAST(NULL AS VARCHAR) AS a, CAST(NULL AS VARCHAR) AS b FROM dim_payer
UNION ALL SELECT 'organization', org_key, name, city, state FROM dim_org
UNION ALL SELECT 'provider', provider_key, name, specialty, NULL FROM dim_provider
""".replace("SELECT", "WITH " + SQL_STAR + " SELECT", 1))
def dim_loads(spark: SparkSession, sf: str) -> DataFrame:
    t = dimensions(spark, sf)
    none = F.lit(None).cast("string")
    payer = t["dim_payer"].select(F.lit("payer").alias("dim"), F.col("payer_key").alias("key"), "name", none.alias("a"), none.alias("b"))
    org = t["dim_organization"].select(F.lit("organization").alias("dim"), F.col("org_key").alias("key"), "name", F.col("city").alias("a"), F.col("state").alias("b"))
    provider = t["dim_provider"].select(F.lit("provider").alias("dim"), F.col("provider_key").alias("key"), "name", F.col("specialty").alias("a"), none.alias("b"))
    return payer.unionByName(org).unionByName(provider)


@query("WITH " + SQL_STAR + """
SELECT patient_key, gender, CAST(birthdate AS VARCHAR) AS birthdate, city, state, zip FROM dim_patient
""")
def dim_patient_load(spark: SparkSession, sf: str) -> DataFrame:
    """Patients loaded, then without their names."""
    return _plain(dimensions(spark, sf)["dim_patient"].drop("full_name"))


@query("WITH " + SQL_STAR + "SELECT patient_key, full_name FROM dim_patient")
def patient_names(spark: SparkSession, sf: str) -> DataFrame:
    return dimensions(spark, sf)["dim_patient"].select("patient_key", "full_name")


@query("WITH " + SQL_STAR + f"SELECT {FACT_OUT} FROM fact")
def unified_fact(spark: SparkSession, sf: str) -> DataFrame:
    """Six event sources in one numbered fact table with surrogate keys."""
    return _plain(star(spark, sf)["fact_patient_events"])


@query("""
SELECT l_orderkey, l_linenumber, o_custkey AS patient_key,
  CASE WHEN s_acctbal > 0 THEN s_suppkey END AS provider_key
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey WHERE c_acctbal > 0
""")
def fact_lookup_inner_left(spark: SparkSession, sf: str) -> DataFrame:
    """Facts of unknown patients are dropped; unknown providers become null."""
    patients = table(spark, sf, "customer").filter("c_acctbal > 0").select(
        F.col("c_custkey").cast("string").alias("source_id"), F.col("c_custkey").alias("patient_key"))
    providers = table(spark, sf, "supplier").filter("s_acctbal > 0").select(
        F.col("s_suppkey").cast("string").alias("source_id"), F.col("s_suppkey").alias("provider_key"))
    nobody = providers.limit(0)
    events = table(spark, sf, "lineitem").join(
        table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    ).select(
        "l_orderkey", "l_linenumber",
        F.col("o_custkey").cast("string").alias("patient_id"),
        F.col("l_suppkey").cast("string").alias("provider_id"),
        F.lit(None).cast("string").alias("org_id"),
        F.lit(None).cast("string").alias("payer_id"),
    )
    maps = {
        "patient_key": patients,
        "provider_key": providers,
        "org_key": nobody.select("source_id", F.col("provider_key").alias("org_key")),
        "payer_key": nobody.select("source_id", F.col("provider_key").alias("payer_key")),
    }
    return loading.replace_ids(events, maps).select("l_orderkey", "l_linenumber", "patient_key", "provider_key")


@query("""
SELECT CAST(date_key AS VARCHAR) AS date_key, CAST(year(date_key) AS BIGINT) AS year,
  CAST(month(date_key) AS BIGINT) AS month, monthname(date_key) AS month_name, dayname(date_key) AS day_of_week
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date_key FROM orders)
""")
def date_dimension(spark: SparkSession, sf: str) -> DataFrame:
    """Derived columns of some rows are spoilt first and repaired then."""
    dim = dates.date_dimension(table(spark, sf, "orders").select(F.to_date("o_orderdate")))
    spoilt = dim.withColumns(
        {
            "year": F.when(F.col("month") > 6, 0).otherwise(F.col("year")),
            "day_of_week": F.when(F.col("month") > 3, F.col("day_of_week")),
        }
    )
    return _plain(dates.repair_dates(spoilt))


@query("""
SELECT CAST(d AS VARCHAR) AS date_key, count(*) AS stored FROM (
  SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem) GROUP BY 1
""")
def date_insert_if_absent(spark: SparkSession, sf: str) -> DataFrame:
    """Order dates stored first; of the ship dates only the new ones are added, also when they come twice."""
    path = fresh_path(spark, "dim_date")
    ordered = dates.date_dimension(table(spark, sf, "orders").select(F.to_date("o_orderdate")))
    shipped = dates.date_dimension(table(spark, sf, "lineitem").select(F.to_date("l_shipdate")))
    sinks.insert_if_absent(ordered, path, "date_key", "orders")
    for _ in range(2):
        sinks.insert_if_absent(shipped, path, "date_key", "lines")
    stored = sinks.read_batches(spark, path)
    return _plain(stored.groupBy("date_key").agg(F.count(F.lit(1)).alias("stored")))


@query(f"""
SELECT o_orderkey, CAST(CASE WHEN o_orderstatus = 'P' THEN DATE '2020-01-01' + CAST({sql_bucket('o_orderkey', 'date', 1000)} AS INTEGER)
  ELSE CAST(o_orderdate AS DATE) END AS VARCHAR) AS date_key FROM orders
""")
def null_date_impute(spark: SparkSession, sf: str) -> DataFrame:
    given = F.when(F.col("o_orderstatus") != "P", F.to_date("o_orderdate"))
    return table(spark, sf, "orders").select(
        "o_orderkey", dates.impute_date(given, F.col("o_orderkey")).cast("string").alias("date_key")
    )


RECORDS_SQL = """
rec AS (
  SELECT row_number() OVER (ORDER BY o_orderkey) AS n, * FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
ev AS (
  SELECT n, 0 AS pos, 'Observation' AS event_category, CAST(o_orderdate AS DATE) AS date_key, NULL AS code,
         'total "price" \\ checked' AS description, o_totalprice AS numeric_value, 'usd' AS units, NULL AS cost FROM rec
  WHERE o_orderstatus <> 'F'
  UNION ALL
  SELECT n, 1, 'Diagnosis', CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) END, o_orderstatus,
         o_orderpriority, NULL, NULL, o_totalprice FROM rec WHERE o_orderstatus <> 'F')
"""


def _records(spark: SparkSession, sf: str) -> DataFrame:
    """One nested record per order; finished orders have no events array, and some objects are absent."""
    def t(name: str) -> DataFrame:
        return table(spark, sf, name)

    rows = (
        t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    none = F.lit(None).cast("string")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")

    def event(category: str, date: Column, code: Column, description: Column, value: Column, units: Column, cost: Column) -> Column:
        return F.struct(
            F.lit(category).alias("event_category"), date.alias("event_date"), none.alias("encounter_id"),
            code.alias("code"), description.alias("description"), value.cast("double").alias("numeric_value"),
            units.alias("units"), cost.cast("double").alias("cost"),
        )

    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    events = F.array(
        event("Observation", day, none, F.lit('total "price" \\ checked'), price, F.lit("usd"), F.lit(None)),
        event("Diagnosis", F.when(status != "P", day), status, F.col("o_orderpriority"), F.lit(None), none, price),
    )
    return rows.select(
        F.col("o_orderkey").cast("string").alias("record_id"),
        F.to_json(
            F.struct(
                F.struct(F.col("c_name").alias("full_name"), F.col("n_name").alias("city")).alias("dim_patient"),
                F.when(status != "O", F.struct(F.col("o_orderpriority").alias("name"))).alias("dim_provider"),
                F.struct(F.col("c_mktsegment").alias("name"), F.lit("TX").alias("state")).alias("dim_organization"),
                F.struct(F.col("r_name").alias("name")).alias("dim_payer"),
                F.when(status != "F", events).alias("fact_patient_events"),
            )
        ).alias("json"),
    )


@query("WITH " + RECORDS_SQL + """
SELECT 'patient' AS t, n AS key, c_name AS a, n_name AS b, CAST(NULL AS VARCHAR) AS c, CAST(NULL AS VARCHAR) AS date_key,
  CAST(NULL AS DOUBLE) AS numeric_value, CAST(NULL AS DOUBLE) AS cost FROM rec
UNION ALL SELECT 'provider', n, CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority END, NULL, NULL, NULL, NULL, NULL FROM rec
UNION ALL SELECT 'organization', n, c_mktsegment, NULL, 'TX', NULL, NULL, NULL FROM rec
UNION ALL SELECT 'payer', n, r_name, NULL, NULL, NULL, NULL, NULL FROM rec
UNION ALL SELECT 'date', 0, monthname(d), dayname(d), NULL, CAST(d AS VARCHAR), NULL, NULL FROM (SELECT DISTINCT date_key AS d FROM ev WHERE date_key IS NOT NULL)
UNION ALL SELECT 'event', n, event_category || ':' || row_number() OVER (ORDER BY n, pos), description, code,
  CAST(date_key AS VARCHAR), numeric_value, cost FROM ev
""")
def flatten_records(spark: SparkSession, sf: str) -> DataFrame:
    """Nested JSON parsed and flattened into all six star tables."""
    parsed = tables.parse_records(_records(spark, sf), "json").select("record_id", "rec")
    t = flatten.flatten(parsed)
    none, nothing = F.lit(None).cast("string"), F.lit(None).cast("double")

    def rows(name: str, df: DataFrame, key: Column, a: Column, b: Column = none, c: Column = none,
             date: Column = none, value: Column = nothing, cost: Column = nothing) -> DataFrame:
        return df.select(
            F.lit(name).alias("t"), key.cast("bigint").alias("key"), a.alias("a"), b.alias("b"), c.alias("c"),
            date.cast("string").alias("date_key"), value.cast("double").alias("numeric_value"), cost.cast("double").alias("cost"),
        )

    col = F.col
    parts = [
        rows("patient", t["dim_patient"], col("patient_key"), col("full_name"), col("city"), col("zip")),
        rows("provider", t["dim_provider"], col("provider_key"), col("name"), col("specialty")),
        rows("organization", t["dim_organization"], col("org_key"), col("name"), col("city"), col("state")),
        rows("payer", t["dim_payer"], col("payer_key"), col("name")),
        rows("date", t["dim_date"], F.lit(0), col("month_name"), col("day_of_week"), date=col("date_key")),
        rows("event", t["fact_patient_events"], col("patient_key"), F.concat_ws(":", "event_category", "event_key"),
             col("description"), col("code"), col("date_key"), col("numeric_value"), col("cost")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query("WITH " + SQL_CLEAN + """
SELECT 'patient' AS t, patient_key AS key, CAST(NULL AS VARCHAR) AS name, city, state FROM c_patient
UNION ALL SELECT 'organization', org_key, name, city, state FROM o1
UNION ALL SELECT 'provider', provider_key, trim(name), CASE WHEN coalesce(specialty, '') = '' THEN 'General Practice' ELSE specialty END, NULL FROM dim_provider
""")
def standardise(spark: SparkSession, sf: str) -> DataFrame:
    t = dimensions(spark, sf)
    none = F.lit(None).cast("string")
    patients = clean.standardise_place(t["dim_patient"]).select(
        F.lit("patient").alias("t"), F.col("patient_key").alias("key"), none.alias("name"), "city", "state")
    orgs = clean.standardise_place(t["dim_organization"]).select(
        F.lit("organization").alias("t"), F.col("org_key").alias("key"), "name", "city", "state")
    providers = clean.standardise_provider(t["dim_provider"]).select(
        F.lit("provider").alias("t"), F.col("provider_key").alias("key"), "name", F.col("specialty").alias("city"), none.alias("state"))
    return patients.unionByName(orgs).unionByName(providers)


@query("WITH " + SQL_CLEAN + "SELECT patient_key, gender, CAST(birthdate AS VARCHAR) AS birthdate FROM c_patient")
def impute_gender_birthdate(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("patient_key")
    return dimensions(spark, sf)["dim_patient"].select(
        key,
        clean.impute_gender(F.col("gender"), key).alias("gender"),
        clean.impute_birthdate(F.col("birthdate"), key).cast("string").alias("birthdate"),
    )


@query("""
SELECT s_suppkey, trim(regexp_replace(s_name, '[0-9]+', '', 'g')) AS name,
  trim(regexp_replace(n_name || ' ' || s_suppkey || ' MD ', '[0-9]+', '', 'g')) AS longer
FROM supplier JOIN nation ON s_nationkey = n_nationkey
""")
def strip_digits(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    longer = F.concat(F.col("n_name"), F.lit(" "), F.col("s_suppkey").cast("string"), F.lit(" MD "))
    return rows.select(
        "s_suppkey", clean.without_digits(F.col("s_name")).alias("name"), clean.without_digits(longer).alias("longer")
    )


@query("WITH " + SQL_CLEAN + "SELECT patient_key, city, zip FROM c_patient")
def zip_repair(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("patient_key")
    placed = clean.standardise_place(dimensions(spark, sf)["dim_patient"])
    return placed.select(key, "city", clean.repair_zip(F.col("zip"), F.col("city"), key).alias("zip"))


@query("WITH " + SQL_CLEAN + """
SELECT d2.provider_key, d2.name, d2.specialty,
  coalesce(d1.name, '') = '' OR contains(lower(d1.name), 'unknown') AS filled
FROM d2 JOIN d1 ON d1.provider_key = d2.provider_key
""")
def placeholder_names(spark: SparkSession, sf: str) -> DataFrame:
    """Digits removed, placeholders found and filled from the seeded list."""
    tidy = clean.standardise_provider(dimensions(spark, sf)["dim_provider"]).withColumn(
        "name", clean.without_digits(F.col("name")))
    marked = tidy.withColumn("filled", clean.is_placeholder(F.col("name")))
    return clean.fill_names(marked).select("provider_key", "name", "specialty", "filled")


@query("""
SELECT lower(trim(p_name)) AS name, lower(trim(p_brand)) AS city, lower(trim(p_type)) AS state,
  min(p_partkey) AS key_to_keep, count(*) AS n_rows FROM part GROUP BY 1, 2, 3 HAVING count(*) > 1
""")
def duplicate_groups(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select("p_partkey", F.col("p_name"), F.col("p_brand"), F.col("p_type"))
    groups = dedup.duplicate_groups(part, "p_partkey", ["p_name", "p_brand", "p_type"])
    return groups.withColumnsRenamed({"_k0": "name", "_k1": "city", "_k2": "state"})


@query("""
SELECT min(p_partkey) AS org_key, p_name AS name, p_brand AS city, p_type AS state FROM part GROUP BY 2, 3, 4
""")
def dedup_dimension(spark: SparkSession, sf: str) -> DataFrame:
    dim = table(spark, sf, "part").select(
        F.col("p_partkey").alias("org_key"), F.col("p_name").alias("name"), F.col("p_brand").alias("city"), F.col("p_type").alias("state"))
    replaced = dedup.replaced_keys(dim, "org_key", ["name", "city", "state"])
    return dedup.drop_duplicates(dim, replaced, "org_key")


@query("""
WITH m AS (SELECT p_partkey, min(p_partkey) OVER (PARTITION BY p_name, p_brand, p_type) AS canonical FROM part)
SELECT canonical AS org_key, count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM lineitem JOIN m ON l_partkey = p_partkey GROUP BY 1
""")
def repoint_facts(spark: SparkSession, sf: str) -> DataFrame:
    dim = table(spark, sf, "part").select(F.col("p_partkey").alias("org_key"), "p_name", "p_brand", "p_type")
    facts = table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("org_key"), F.col("l_extendedprice").cast("decimal(18,2)").alias("cost"))
    replaced = dedup.replaced_keys(dim, "org_key", ["p_name", "p_brand", "p_type"])
    moved = dedup.repoint(facts, replaced, "org_key")
    return moved.groupBy("org_key").agg(
        F.count(F.lit(1)).alias("n"), F.sum("cost").cast("double").alias("total"))


@query("WITH " + SQL_CLEAN + """
SELECT 'event' AS t, event_key AS key, provider_key, org_key, payer_key FROM c_fact
UNION ALL SELECT 'organization', org_key, NULL, NULL, NULL FROM c_org
UNION ALL SELECT 'provider', provider_key, NULL, NULL, NULL FROM c_provider
UNION ALL SELECT 'payer', payer_key, NULL, NULL, NULL FROM c_payer
""")
def dedup_star(spark: SparkSession, sf: str) -> DataFrame:
    """All three dimensions de-duplicated and the facts re-pointed, after cleaning."""
    t = clean_star(spark, sf)
    none = F.lit(None).cast("bigint")
    out = t["fact_patient_events"].select(
        F.lit("event").alias("t"), F.col("event_key").alias("key"), "provider_key", "org_key", "payer_key")
    for name, label in (("dim_organization", "organization"), ("dim_provider", "provider"), ("dim_payer", "payer")):
        key = schemas.NATURAL_KEYS[name][0]
        out = out.unionByName(t[name].select(
            F.lit(label).alias("t"), F.col(key).alias("key"), none.alias("provider_key"), none.alias("org_key"), none.alias("payer_key")))
    return out


@query("""
SELECT 'l_orderkey' AS foreign_key, count(DISTINCT l_orderkey) AS orphan_keys, count(*) AS orphan_facts
  FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
UNION ALL
SELECT 'l_suppkey', count(DISTINCT l_suppkey), count(*) FROM lineitem
  WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)
""")
def orphan_check(spark: SparkSession, sf: str) -> DataFrame:
    facts = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey")
    kept_orders = table(spark, sf, "orders").filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    kept_suppliers = table(spark, sf, "supplier").filter("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"))
    return keys.referential_report(facts, {"l_orderkey": kept_orders, "l_suppkey": kept_suppliers})


@query("WITH " + SQL_CLEAN + """
SELECT 'patient_key' AS foreign_key, count(DISTINCT patient_key) AS orphan_keys, count(*) AS orphan_facts FROM c_fact
  WHERE patient_key NOT IN (SELECT patient_key FROM c_patient)
UNION ALL SELECT 'date_key', count(DISTINCT date_key), count(*) FROM c_fact WHERE date_key NOT IN (SELECT date_key FROM fact WHERE date_key IS NOT NULL)
UNION ALL SELECT 'provider_key', count(DISTINCT provider_key), count(*) FROM c_fact WHERE provider_key NOT IN (SELECT provider_key FROM c_provider)
UNION ALL SELECT 'org_key', count(DISTINCT org_key), count(*) FROM c_fact WHERE org_key NOT IN (SELECT org_key FROM c_org)
UNION ALL SELECT 'payer_key', count(DISTINCT payer_key), count(*) FROM c_fact WHERE payer_key NOT IN (SELECT payer_key FROM c_payer)
""")
def star_references(spark: SparkSession, sf: str) -> DataFrame:
    """No fact of the cleaned star points to a missing dimension row."""
    return warehouse.reports(clean_star(spark, sf))["references"]


@query("WITH " + SQL_STAR + """
SELECT 'Total Patients' AS metric, count(*) AS n FROM dim_patient
UNION ALL SELECT 'Patients with Gender', count(*) FROM dim_patient WHERE coalesce(gender, '') <> ''
UNION ALL SELECT 'Patients with Birthdate', count(birthdate) FROM dim_patient
UNION ALL SELECT 'Total Organizations', count(*) FROM dim_org
UNION ALL SELECT 'Total Providers', count(*) FROM dim_provider
UNION ALL SELECT 'Total Payers', count(*) FROM dim_payer
UNION ALL SELECT 'Total Events', count(*) FROM fact
""")
def table_counts(spark: SparkSession, sf: str) -> DataFrame:
    return quality.table_counts(star(spark, sf))


NULL_CHECKS_SQL = """
SELECT "check", n, CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL (' || n || ')' END AS status FROM (
  SELECT 'NULL Genders Remaining' AS "check", count(*) AS n FROM {patient} WHERE coalesce(gender, '') = ''
  UNION ALL SELECT 'NULL Birthdates Remaining', count(*) FROM {patient} WHERE birthdate IS NULL
  UNION ALL SELECT 'NULL Cities (Patients)', count(*) FROM {patient} WHERE coalesce(city, '') = ''
  UNION ALL SELECT 'NULL Cities (Orgs)', count(*) FROM {org} WHERE coalesce(city, '') = ''
  UNION ALL SELECT 'NULL Provider Specialties', count(*) FROM {provider} WHERE coalesce(specialty, '') = '')
"""


@query("WITH " + SQL_STAR + NULL_CHECKS_SQL.format(patient="dim_patient", org="dim_org", provider="dim_provider"))
def null_checks(spark: SparkSession, sf: str) -> DataFrame:
    return quality.null_checks(dimensions(spark, sf))


@query("WITH " + SQL_CLEAN + "SELECT bool_and(n = 0) AS all_clean FROM ("
       + NULL_CHECKS_SQL.format(patient="c_patient", org="c_org", provider="c_provider") + ")")
def all_clean(spark: SparkSession, sf: str) -> DataFrame:
    return quality.all_clean(quality.null_checks(clean_star(spark, sf)))


@query("WITH " + SQL_STAR + """
SELECT *, round(null_gender * 100.0 / total, 1) AS pct_gender, round(null_birthdate * 100.0 / total, 1) AS pct_birthdate,
  round(null_city * 100.0 / total, 1) AS pct_city FROM (
  SELECT count(*) AS total, count(*) FILTER (WHERE coalesce(gender, '') = '') AS null_gender,
    count(*) FILTER (WHERE birthdate IS NULL) AS null_birthdate,
    count(*) FILTER (WHERE coalesce(city, '') = '') AS null_city FROM dim_patient)
""")
def null_profile(spark: SparkSession, sf: str) -> DataFrame:
    return quality.null_profile(dimensions(spark, sf)["dim_patient"])


@query("WITH " + SQL_STAR + """
SELECT 'organization' AS dimension, count(*) - count(DISTINCT (lower(trim(coalesce(name, ''))), lower(trim(coalesce(city, ''))), lower(trim(coalesce(state, ''))))) AS duplicates FROM dim_org
UNION ALL SELECT 'provider', count(*) - count(DISTINCT (lower(trim(coalesce(name, ''))), lower(trim(coalesce(specialty, ''))))) FROM dim_provider
UNION ALL SELECT 'payer', count(*) - count(DISTINCT lower(trim(name))) FROM dim_payer
""")
def duplicate_profile(spark: SparkSession, sf: str) -> DataFrame:
    return quality.duplicate_profile(dimensions(spark, sf))


@query("WITH " + SQL_CLEAN + f"""
SELECT "check", n, CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL (' || n || ')' END AS status FROM (
  SELECT 'Birthdate in Future' AS "check", count(*) AS n FROM c_patient WHERE birthdate > DATE '{AS_OF}'
  UNION ALL SELECT 'Event Before Birth', count(*) FROM c_fact f JOIN c_patient p ON f.patient_key = p.patient_key WHERE f.date_key < p.birthdate
  UNION ALL SELECT 'Invalid Zip Format', count(*) FROM c_patient WHERE NOT regexp_matches(zip, '^[0-9]{{5}}$'))
""")
def validations(spark: SparkSession, sf: str) -> DataFrame:
    return quality.validations(clean_star(spark, sf), F.lit(AS_OF).cast("date"))


@query("WITH " + SQL_CLEAN + """
SELECT "check", n, CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL (' || n || ')' END AS status FROM (
  SELECT 'NS_ALPHA:dim_provider.name' AS "check", count(*) AS n FROM c_provider WHERE NOT regexp_matches(name, '^[a-zA-Z \\-\\.]+$')
  UNION ALL SELECT 'NS_TEXAS:dim_patient.state', count(*) FROM c_patient WHERE NOT regexp_matches(state, '^(TX|Texas)$')
  UNION ALL SELECT 'NS_TEXAS:dim_organization.state', count(*) FROM c_org WHERE NOT regexp_matches(state, '^(TX|Texas)$')
  UNION ALL SELECT 'NS_ZIP:dim_patient.zip', count(*) FROM c_patient WHERE NOT regexp_matches(zip, '^[0-9]{5}$'))
""")
def rule_checks(spark: SparkSession, sf: str) -> DataFrame:
    return quality.rule_checks(clean_star(spark, sf))


@query("WITH " + SQL_STAR + f"""
SELECT {FACT_OUT} FROM fact
""")
def star_sources_csv(spark: SparkSession, sf: str) -> DataFrame:
    """All ten source tables written as CSV, read back by name and loaded."""
    folder = fresh_path(spark, "sources")
    for name, df in sources(spark, sf).items():
        sinks.export_csv(df, f"{folder}/{name}.csv")
    loaded = warehouse.load_star(warehouse.read_sources(spark, folder))
    stored = fresh_path(spark, "warehouse")
    sinks.reset_star(spark, stored)
    sinks.write_star(loaded, stored, mode="append")
    back = tables.read_star(spark, stored)
    return _plain(back["fact_patient_events"].select(*schemas.STAR["fact_patient_events"].names))


@query("WITH " + SQL_STAR + "," + RECORDS_SQL + """
SELECT event_key, patient_key, provider_key, org_key, payer_key, event_category, CAST(date_key AS VARCHAR) AS date_key FROM fact
UNION ALL
SELECT (SELECT max(event_key) FROM fact) + row_number() OVER (ORDER BY n, pos), (SELECT max(patient_key) FROM dim_patient) + n,
  (SELECT max(provider_key) FROM dim_provider) + n, (SELECT max(org_key) FROM dim_org) + n, (SELECT max(payer_key) FROM dim_payer) + n,
  event_category, CAST(date_key AS VARCHAR) FROM ev
""")
def merged_star(spark: SparkSession, sf: str) -> DataFrame:
    """Facts of a star loaded from tables and of records flattened into it; keys go on after the stored ones."""
    parsed = tables.parse_records(_records(spark, sf), "json").select("record_id", "rec")
    merged = warehouse.merge_star(star(spark, sf), parsed)
    columns = ["event_key", "patient_key", "provider_key", "org_key", "payer_key", "event_category", "date_key"]
    return _plain(merged["fact_patient_events"].select(*columns))


@query("WITH " + SQL_CLEAN + """
SELECT 'organization' AS dimension, org_key AS key, name, city AS place FROM c_org
UNION ALL SELECT 'provider', provider_key, name, specialty FROM c_provider
""")
def extract_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Dimensions exported as quoted CSV and read back as warehouse extracts."""
    folder = fresh_path(spark, "extracts")
    cleaned = clean_star(spark, sf)
    for name in ("dim_organization", "dim_provider"):
        sinks.export_csv(cleaned[name], f"{folder}/{name}.csv")
    organizations = tables.read_extract(spark, folder, "dim_organization")
    providers = tables.read_extract(spark, folder, "dim_provider")
    return organizations.select(
        F.lit("organization").alias("dimension"), F.col("org_key").alias("key"), "name", F.col("city").alias("place")
    ).unionByName(
        providers.select(
            F.lit("provider").alias("dimension"), F.col("provider_key").alias("key"), "name", F.col("specialty").alias("place")
        )
    )


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS record_id, c_name AS full_name, n_name AS city, c_mktsegment AS payer
FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def record_map_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Records kept as JSON objects by id, a few hundred to a file, and read back one row per id."""
    people = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    record = F.struct(
        F.struct(F.col("c_name").alias("full_name"), F.col("n_name").alias("city")).alias("dim_patient"),
        F.struct(F.col("c_mktsegment").alias("name")).alias("dim_payer"),
    )
    entry = F.struct(F.col("c_custkey").cast("string").alias("key"), record.alias("value"))
    objects = people.groupBy(F.floor(F.col("c_custkey") / 500).alias("part")).agg(
        F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value")
    )
    path = fresh_path(spark, "record-map")
    objects.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return tables.read_record_map(spark, path).select(
        "record_id", "rec.dim_patient.full_name", "rec.dim_patient.city", F.col("rec.dim_payer.name").alias("payer")
    )
