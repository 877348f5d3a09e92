"""The Feistel shuffle: a bijection that gives even shards, gapless slots and computable places."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wardstar.llm import sharding

SCHEMA = "doc_id bigint, text string, k int, size string, row int, slot int, shard int"


def table(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 1, "s", 2, 3, 4) for r in rows], SCHEMA).repartition(parts)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 3000), st.integers(0, 10**6))
def test_permutation(rows, seed):
    permutation = sharding.Permutation(rows, seed)
    places = permutation.places(np.arange(rows))
    assert sorted(places.tolist()) == list(range(rows))
    assert (permutation.rows_at(places) == np.arange(rows)).all()


def test_large_numbers_round_trip():
    rows = 10**13 + 7
    some = np.array([0, 1, rows - 1, rows // 2, 12345678901])
    permutation = sharding.Permutation(rows)
    places = permutation.places(some)
    assert ((places >= 0) & (places < rows)).all() and (permutation.rows_at(places) == some).all()
    shard, slot = sharding.shard_and_slot(some, rows)
    assert (sharding.row_of(shard, slot, rows) == some).all()


def test_order_is_mixed():
    """Neighbours go apart: their places differ by a third of the rows on average."""
    places = sharding.Permutation(10_000).places(np.arange(10_000))
    assert 3000 < np.abs(np.diff(places)).mean() < 3700
    shards = Counter(zip((places % 24).tolist(), (np.arange(10_000) // 1000).tolist()))
    assert 20 < min(shards.values()) and max(shards.values()) < 70


ROWS = [(i, f"text {i % 7} ü") for i in range(100)] + [(5, None), (None, "x"), (None, None), (200, ""), (None, "x")]
ROWS += [(300, "same")] * 60


@pytest.mark.parametrize("rows", [ROWS, [], [(1, "a")], [(None, None)] * 30, [(1, "x" * 200_000)] * 25])
def test_assigned(spark, rows):
    found = sharding.assigned(table(spark, rows)).collect()
    assert Counter((r["k"], r["size"], r["text_crc32"]) for r in found) == Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows
    )
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
        assert sharding.row_of(r["shard"], r["slot"], len(rows)) == r["row"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots[s]) for s in range(sharding.SHARDS)]
    assert set(slots) <= set(range(sharding.SHARDS)) and max(counts) - min(counts) <= 1


def test_reruns_agree_on_other_partitions(spark):
    a, b = (sorted(map(repr, sharding.assigned(table(spark, ROWS, parts)).collect())) for parts in (1, 9))
    assert a == b
    assert a != sorted(map(repr, sharding.assigned(table(spark, ROWS), seed=1).collect()))


def test_written_shards(spark, tmp_path):
    sharding.write_shards(table(spark, ROWS), str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.columns == ["doc_id", "text", "k", "size", "row", "slot", "shard", "_slot", "_shard"]
    kept = back.collect()
    assert Counter((r["doc_id"], r["text"]) for r in kept) == Counter(ROWS)
    by_place = {(r["shard"], r["slot"]): (r["k"], r["size"]) for r in sharding.assigned(table(spark, ROWS), shards=4).collect()}
    assert {(r["_shard"], r["_slot"]): (r["doc_id"], len((r["text"] or "").encode()) + 8) for r in kept} == by_place
