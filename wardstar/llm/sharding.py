"""A reproducible shuffle of all documents into shards of equal row counts.

Rows are numbered once in a fixed order; a keyed Feistel permutation of these numbers is the
shuffle. The place p of row r gives shard p mod shards and slot p div shards, so that row counts
of shards differ by one at most, slots have no gaps, and both are computed from the row number
alone. The permutation is inverted as easily: ``row_of`` names the row of any shard and slot.

The network works on two digits of base ceil(sqrt(rows)), a domain that is little larger than
the number of rows; a value beyond the last row walks on along its cycle until it lies inside.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstar.operators.keys import with_dense_key
from wardstar.session import stage

SHARDS = 24
ROUNDS = 6
ORDER = ["k", "size", "text_crc32", "text_hash"]

# Odd multipliers of the round function, modulo 2^32.
MULTIPLIERS = (0x9E3779B1, 0x85EBCA77)
LOW32 = 0xFFFFFFFF


def base(rows: int) -> int:
    """Digits of the domain: the least base whose square holds all rows."""
    return math.isqrt(max(rows, 1) - 1) + 1


def round_key(seed: int, number: int) -> int:
    """The key of one round, from the seed."""
    return ((seed + 1) * MULTIPLIERS[0] + (number + 1) * MULTIPLIERS[1]) & LOW32


def _mixed(digit: np.ndarray, key: int) -> np.ndarray:
    x = digit.astype(np.uint64) & np.uint64(LOW32)
    x = ((x ^ np.uint64(key)) * np.uint64(MULTIPLIERS[0])) & np.uint64(LOW32)
    x = ((x ^ (x >> np.uint64(15))) * np.uint64(MULTIPLIERS[1])) & np.uint64(LOW32)
    return (x ^ (x >> np.uint64(13))).astype(np.int64)


class Permutation:
    """A bijection of 0 .. rows - 1, the same for equal rows and seed."""

    def __init__(self, rows: int, seed: int = 0):
        self.rows, self.base = rows, base(rows)
        self.keys = [round_key(seed, n) for n in range(ROUNDS)]

    def _step(self, x: np.ndarray) -> np.ndarray:
        left, right = x // self.base, x % self.base
        for key in self.keys:
            left, right = right, (left + _mixed(right, key)) % self.base
        return left * self.base + right

    def _step_back(self, x: np.ndarray) -> np.ndarray:
        left, right = x // self.base, x % self.base
        for key in reversed(self.keys):
            left, right = (right - _mixed(left, key)) % self.base, left
        return left * self.base + right

    def _walk(self, values, step) -> np.ndarray:
        out = step(np.array(values, np.int64, ndmin=1))
        while (beyond := out >= self.rows).any():
            out[beyond] = step(out[beyond])
        return out

    def places(self, rows) -> np.ndarray:
        """The place of each row number."""
        return self._walk(rows, self._step)

    def rows_at(self, places) -> np.ndarray:
        """The row number at each place."""
        return self._walk(places, self._step_back)


def shard_and_slot(row, rows: int, shards: int = SHARDS, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Shard and slot of row numbers of a table with ``rows`` rows."""
    place = Permutation(rows, seed).places(row)
    return place % shards, place // shards


def row_of(shard, slot, rows: int, shards: int = SHARDS, seed: int = 0) -> np.ndarray:
    """Row numbers that lie in the given slots of the given shards."""
    return Permutation(rows, seed).rows_at(np.asarray(slot, np.int64) * shards + np.asarray(shard, np.int64))


def _placed(numbered: DataFrame, row: str, shards: int, seed: int, shard: str, slot: str) -> DataFrame:
    """Adds shard and slot to stored rows with dense numbers from 0 in column ``row``."""
    permutation = Permutation(numbered.count(), seed)

    @F.pandas_udf("bigint")
    def place(rows: pd.Series) -> pd.Series:
        return pd.Series(permutation.places(rows.to_numpy()))

    return (
        numbered.withColumn(slot, place(row))
        .withColumn(shard, (F.col(slot) % shards).cast("int"))
        .withColumn(slot, F.expr(f"`{slot}` div {shards}"))
    )


def _measures(doc_id: str, text: str) -> list:
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return [
        F.col(f"`{doc_id}`").alias("k"),
        (F.octet_length(content) + 8).cast("bigint").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
        F.xxhash64(F.col(f"`{text}`")).alias("text_hash"),
    ]


def assigned(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS, seed: int = 0
) -> DataFrame:
    """Columns k (id), size, text_crc32, row, shard, slot: one row for every row of ``docs``.

    Rows are numbered by id (null first), then by size and checksum of the text, so the numbers
    do not depend on files or partitions: rows that agree in all of these give equal rows. Null
    and empty texts have size 8. Any number of rows may share an id or a text; an empty table
    gives none. Only ids and numbers of fixed length are shuffled.
    """
    rows = with_dense_key(docs.select(*_measures(doc_id, text)), "row", ORDER, start=0, label="shard-rows")
    return _placed(rows, "row", shards, seed, "shard", "slot").drop("text_hash")


def write_shards(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS, seed: int = 0
) -> None:
    """Writes whole rows as Parquet below ``path``, a folder per shard, in the order of their slots.

    Files hold the columns of ``docs`` and ``slot`` (``_slot``, ... where that name is taken). A
    shard is split over files by ranges of slots, so no task holds a whole shard.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.select(*_measures(doc_id, text), *[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names)])
    rows = with_dense_key(plain, "row", ORDER, start=0, label="shard-rows")
    slot, shard = "slot", "shard"
    while {slot, shard} & set(docs.columns):
        slot, shard = f"_{slot}", f"_{shard}"
    placed = stage(_placed(rows, "row", shards, seed, "_shard", "_slot").drop("row", *ORDER), "shard-places")
    ordered = placed.repartitionByRange("_shard", "_slot").sortWithinPartitions("_shard", "_slot")
    ordered.select(
        *[F.col(n).alias(c) for c, n in zip(docs.columns, names)],
        F.col("_slot").alias(slot),
        F.col("_shard").alias(shard),
    ).write.partitionBy(shard).parquet(path)
