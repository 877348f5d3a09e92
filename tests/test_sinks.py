"""Inserting rows whose key is not stored yet."""

from tests.conftest import values
from wardstar.sources import sinks


def table(spark, rows):
    return spark.createDataFrame(rows, "k string, v int")


def test_insert_if_absent(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.insert_if_absent(table(spark, [("a", 1), ("b", 2), (None, 3), ("a", 1)]), path, "k")
    for _ in range(2):
        sinks.insert_if_absent(table(spark, [("b", 9), ("c", 4), (None, 9), ("c", 4)]), path, "k")
    assert values(spark.read.parquet(path)) == sorted([("a", 1), ("b", 2), ("c", 4), (None, 3)], key=repr)


def test_batches_replace_their_own_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.insert_if_absent(table(spark, [("a", 1)]), path, "k", "first")
    # an attempt that broke off left some of its rows
    table(spark, [("b", 2)]).write.parquet(f"{path}/{sinks.BATCH}=second")
    for _ in range(2):
        sinks.insert_if_absent(table(spark, [("a", 9), ("b", 2), ("c", 3)]), path, "k", "second")
    sinks.insert_if_absent(table(spark, [("c", 9), ("d", 4)]), path, "k", "third")
    assert values(sinks.read_batches(spark, path)) == [("a", 1), ("b", 2), ("c", 3), ("d", 4)]


def test_stored_keys_are_filtered_before_they_are_shuffled(spark, tmp_path, no_broadcast, monkeypatch):
    """Of a large stored table only keys that can be among the new ones reach the exchange."""
    path = str(tmp_path / "t")
    spark.range(50_000).selectExpr("cast(id as string) k", "1 v").write.parquet(path)
    seen = []
    monkeypatch.setattr(sinks, "may_match", lambda *a: seen.append(kept(*a)) or seen[-1])
    sinks.insert_if_absent(table(spark, [("7", 1), ("x", 2)]), path, "k")
    assert seen[0].count() < 10
    assert spark.read.parquet(path).count() == 50_001


kept = sinks.may_match
