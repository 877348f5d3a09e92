import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from wardstar import session
from wardstar.operators import joins
from wardstar.operators import keys
from wardstar.operators.keys import key_map, orphans, referential_report, with_dense_key
from wardstar.operators.ranking import first_seen_list, top_k


def facts_with_hot_key(spark):
    """A third of the rows share one key, a quarter have none."""
    return spark.range(6000).select(
        F.col("id").alias("event_key"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 4 == 1, None)
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 2500).cast("string"))).alias("k"),
    )


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(spark, no_broadcast, how):
    facts = facts_with_hot_key(spark)
    dim = facts.filter("k is not null and k <> 'k7'").select("k").distinct().withColumn("v", F.length("k"))
    got = joins.lookup_join(facts, dim, "k", how)
    assert not joins.fits_broadcast(dim)
    assert values(got, "event_key", "k", "v") == values(facts.join(dim, "k", how), "event_key", "k", "v")


def test_salted_join_spreads_hot_and_null_keys(spark, no_broadcast, monkeypatch):
    monkeypatch.setattr(joins, "PIECE_ROWS", 100)
    facts = facts_with_hot_key(spark)
    hot = [r["k"] for r in joins.hot_keys(facts, ["k"], 100).collect()]
    assert hot == ["hot"]
    plan = joins.lookup_join(facts, facts.select("k").distinct(), "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "_join_salt" in plan


def test_broadcast_side_needs_no_salt(spark):
    dim = spark.range(1).select(F.lit("hot").alias("k"), F.lit(1).alias("v"))
    joined = joins.lookup_join(facts_with_hot_key(spark), dim, "k")
    assert "_join_salt" not in joined._jdf.queryExecution().optimizedPlan().toString()
    assert joined.filter("v = 1").count() == 2000


def test_join_with_several_rows_per_key(spark, no_broadcast):
    facts = facts_with_hot_key(spark)
    other = spark.createDataFrame([("hot", 1), ("hot", 2), ("k7", 3)], "k string, v int")
    got = joins.lookup_join(facts, other, ["k"], "inner")
    assert values(got, "event_key", "v") == values(facts.join(other, "k"), "event_key", "v")


def test_dense_keys_follow_the_order(spark):
    df = spark.range(1000).select(F.md5(F.col("id").cast("string")).alias("s")).repartition(7)
    keyed = with_dense_key(df, "key", ["s"], start=5)
    rows = sorted(r["s"] for r in df.collect())
    assert [(r["key"], r["s"]) for r in keyed.orderBy("key").collect()] == list(enumerate(rows, 5))
    assert values(keyed) == values(keyed)
    assert with_dense_key(df.limit(0), "key", ["s"]).count() == 0
    assert keys._reads_files_in_place(keyed.select("s")) and not keys._reads_files_in_place(df)


def test_expanded_keys_follow_the_rows(spark, monkeypatch):
    """Rows of many files, some without parts: their parts are numbered in order, without another sort."""
    df = spark.range(3000).select("id", (F.col("id") * 7 % 4).alias("n")).repartition(5)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        placed = with_dense_key(df, "row", ["id"], 0, places=True)
        parts = keys.with_expanded_key(
            placed,
            lambda d: d.select("row", "n", F.explode(F.slice(F.array(*[F.lit(i) for i in range(3)]), 1, F.col("n").cast("int"))).alias("i"), *d.columns[-2:]),
            "key", 10,
        )
        assert parts.columns == ["key", "row", "n", "i"]
        expected = [(i, j) for i in range(3000) for j in range(i * 7 % 4)]
        assert [(r["key"], (r["row"], r["i"])) for r in parts.orderBy("key").collect()] == list(enumerate(expected, 10))
        plan = parts._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in plan
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_key_map_keeps_the_last_row(spark):
    dim = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3), (None, 4)], "source_id string, key bigint")
    assert values(key_map(dim, "source_id", "key"), "source_id", "key") == [("a", 3), ("b", 2)]


def test_orphans(spark):
    facts = spark.createDataFrame([(1,), (1,), (2,), (9,), (9,), (None,)], "k bigint")
    dim = spark.createDataFrame([(1,), (2,)], "k bigint")
    assert values(orphans(facts, dim, "k")) == [(9, 2)]
    assert values(referential_report(facts, {"k": dim})) == [("k", 1, 2)]


def test_top_k_of_a_hot_group(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 2 == 0, "big").otherwise(F.col("id").cast("string")).alias("g"))
    got = top_k(df, ["g"], [F.desc("id")], 3).filter("g = 'big'")
    assert values(got, "id", "rank") == [(4994, 3), (4996, 2), (4998, 1)]


def test_first_seen_list(spark):
    rows = [(1, "b", 5), (1, "a", 2), (1, "b", 1), (1, None, 0), (2, None, 1)] + [(3, f"v{i:02d}", 20 - i) for i in range(15)]
    df = spark.createDataFrame(rows, "p int, c string, e int")
    got = dict(values(first_seen_list(df, "p", "c", "e", 10, "out")))
    assert got == {1: "b, a", 3: ", ".join(f"v{i:02d}" for i in range(14, 4, -1))}


def test_hot_keys_are_cut_by_their_rows(spark, no_broadcast, monkeypatch):
    """One key with 40 % of the rows: no task gets more than a set share."""
    monkeypatch.setattr(joins, "PIECE_ROWS", 500)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        key = F.when(F.col("id") % 10 < 4, "hot").when(F.col("id") % 10 == 4, None).otherwise(F.concat(F.lit("k"), F.col("id")))
        facts = spark.range(40_000).select("id", key.alias("k"))
        dim = facts.select("k").dropna().distinct().withColumn("v", F.length("k"))
        pieces = {r["k"]: r["_join_pieces"] for r in joins.hot_keys(facts, ["k"], 500).collect()}
        assert pieces == {"hot": 32}
        got = joins.lookup_join(facts, dim, "k", "left", spread=["id"])
        sizes = got.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) <= 0.25 * 40_000
        assert got.filter("v is not null").count() == 36_000 and got.count() == 40_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_may_match(spark, monkeypatch):
    """No match is lost, and most other rows are gone before any shuffle."""
    facts = spark.range(20_000).selectExpr("if(id % 97 = 0, null, id) as k", "cast(id as string) as t")
    keys = spark.range(0, 20_000, 40).selectExpr("id as k")
    exact = {r["k"] for r in facts.join(keys, "k").collect()}
    found = joins.may_match(facts, keys, "k")
    assert found.columns == ["k", "t"]
    passed = {r["k"] for r in found.collect()}
    assert exact <= passed and len(passed) < len(exact) + 20
    monkeypatch.setattr(joins, "FILTER_WORDS", 2)
    assert exact <= {r["k"] for r in joins.may_match(facts, keys, ["k"]).collect()}
    assert joins.may_match(facts, keys.limit(0), "k").count() == 0
    assert joins.may_match(facts.limit(0), keys, "k").count() == 0


def test_files_that_are_small_only_on_disk_are_not_broadcast(spark):
    ids = session.stage(spark.range(400_000).select(F.xxhash64("id").alias("k"), "id"), "many-ids")
    assert joins.BROADCAST_FILE_BYTES < session.plan_bytes(ids) < joins.broadcast_limit(ids)
    assert not joins.fits_broadcast(ids)
    facts = spark.range(1000).select(F.xxhash64(F.col("id") * 3).alias("k"), F.col("id").alias("n"))
    for joined in (joins.lookup_join(facts, ids, "k", "inner"), facts.join(joins.bounded(ids), "k")):
        assert "rightHint=(strategy=merge)" in joined._jdf.queryExecution().optimizedPlan().toString()
        assert joined.filter("id = 3 * n").count() == 1000
    few = session.stage(spark.range(1000).withColumnRenamed("id", "k"), "few-ids")
    assert joins.fits_broadcast(few) and "strategy" not in joins.bounded(few)._jdf.queryExecution().logical().toString()
