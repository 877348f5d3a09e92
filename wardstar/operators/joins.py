"""Equi-joins of a large table with a smaller one that stay balanced on hot keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from wardstar.session import plan_bytes

# A key with more rows than this is cut into pieces of about this size. In tables so large
# that more than HOT_KEYS keys could be hot, pieces are 1/HOT_KEYS of the table instead, which
# bounds the broadcast of the hot keys.
PIECE_ROWS = 1_000_000
HOT_KEYS = 100_000

# The planner measures a stored table by its files, and ids take a few bytes a row there but some hundred in the driver,
# which holds the hash table of a broadcast: files beyond this size are not broadcast, whatever the planner's limit.
BROADCAST_FILE_BYTES = 2 << 20

# Words of 64 bits in the filter of ``may_match``: 16 MB, however many keys there are.
FILTER_WORDS = 1 << 20

_SALT = "_join_salt"
_PIECES = "_join_pieces"


def broadcast_limit(df: DataFrame) -> int:
    return int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def fits_broadcast(df: DataFrame) -> bool:
    """True when the planner's estimate of ``df`` is below its limit and below BROADCAST_FILE_BYTES."""
    limit = broadcast_limit(df)
    return limit > 0 and plan_bytes(df) <= min(limit, BROADCAST_FILE_BYTES)


def _must_shuffle(df: DataFrame) -> bool:
    """True when the planner could broadcast ``df`` by the size of its files, which a join of few of its columns
    makes smaller, although it does not fit. Estimates far beyond are left to the sizes found at run time."""
    return plan_bytes(df) <= 8 * broadcast_limit(df) and not fits_broadcast(df)


def bounded(df: DataFrame) -> DataFrame:
    """``df`` as a side of a plain join: shuffled where only its files are small."""
    return df.hint("merge") if _must_shuffle(df) else df


def spread_hash(df: DataFrame, columns: list[str] | None = None) -> Column:
    """A hash of the row that is the same when a lost task is run again."""
    chosen = columns or [
        f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]
    return F.xxhash64(*[F.col(f"`{c}`") for c in chosen])


def hot_keys(df: DataFrame, on: list[str], piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Keys with more rows than one piece should have, and the number of their pieces.

    At most HOT_KEYS keys, whatever the size of the table.
    """
    counts = df.dropna(subset=on).groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    total = df.agg(F.count(F.lit(1)).alias("_total")).scalar()
    piece = F.greatest(F.lit(piece_rows).cast("bigint"), F.ceil(total / HOT_KEYS))
    return counts.filter(F.col("_n") > piece).select(*on, F.ceil(F.col("_n") / piece).alias(_PIECES))


def may_match(facts: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows of ``facts`` that can have an equal in ``keys``, and few others, without a shuffle of ``facts``.

    Hashes of the keys set bits of a table of FILTER_WORDS words, which is small enough to
    broadcast for any number of keys; a join afterwards drops what only shares a bit. With as
    many keys as bits about two thirds of the other rows pass, with a hundredth as many 1 %.
    Null keys match nothing.
    """
    names = [on] if isinstance(on, str) else list(on)
    hashed = F.xxhash64(*names)
    word = F.pmod(hashed, F.lit(FILTER_WORDS)).alias("_word")
    bit = F.shiftright(hashed, 40).bitwiseAND(F.lit(63)).cast("int").alias("_bit")
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_bit"))
    table = keys.dropna(subset=names).select(word, bit).groupBy("_word").agg(F.bit_or(one).alias("_bits"))
    marked = facts.dropna(subset=names).withColumns({"_word": word, "_bit": bit})
    kept = marked.join(F.broadcast(table), "_word").filter(F.getbit("_bits", "_bit") == 1)
    return kept.select(*[F.col(f"`{c}`") for c in facts.columns])


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    on: str | list[str],
    how: str = "left",
    spread: list[str] | None = None,
    keys_from: DataFrame | None = None,
    broadcast: bool = True,
) -> DataFrame:
    """``facts`` joined to ``dim`` with equal names ``on`` (``how``: inner or left).

    A side that fits the driver's memory (:func:`fits_broadcast`) is broadcast, so no key is hot.
    Beyond that, a key with many rows is cut into pieces by the number of its rows, and
    its few ``dim`` rows are repeated once per piece; rows with a null key, which match nothing,
    are spread by a hash of the row. Hot keys are counted in ``keys_from``, by default ``facts``: in a chain of joins,
    pass the stored table at its start, so that counting reads one column of it. ``broadcast=False`` shuffles a ``dim`` of
    any size, for plans that should be the same at every scale.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    if broadcast and fits_broadcast(dim):
        return facts.join(dim, keys, how)

    hot = hot_keys(facts if keys_from is None else keys_from, keys, PIECE_ROWS)
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    row_hash = spread_hash(facts, spread)
    salted_facts = facts.join(F.broadcast(hot), keys, "left").withColumn(
        _SALT,
        F.when(any_null, row_hash)
        .when(F.col(_PIECES).isNotNull(), F.pmod(row_hash, F.col(_PIECES)))
        .otherwise(F.lit(0).cast("bigint")),
    ).drop(_PIECES)
    zero = F.lit(0).cast("bigint")
    copies = F.when(F.col(_PIECES).isNotNull(), F.sequence(zero, F.col(_PIECES) - 1)).otherwise(F.array(zero))
    salted_dim = (
        dim.join(F.broadcast(hot), keys, "left").withColumn(_SALT, F.explode(copies)).drop(_PIECES)
    )
    side = salted_dim.hint("merge") if not broadcast or _must_shuffle(dim) else salted_dim
    return salted_facts.join(side, [*keys, _SALT], how).drop(_SALT)
