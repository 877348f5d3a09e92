"""Surrogate keys, source-id maps and referential checks."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, Window, functions as F

from wardstar.session import stage


_FILE, _ROW = "_dense_file", "_dense_row"

# Sampled rows that the driver looks at to find the bounds of a sort, about, for any number of partitions.
BOUNDS_ROWS = 20_000
BOUNDS_SAMPLE = "spark.sql.execution.rangeExchange.sampleSizePerPartition"


def _reads_files_in_place(df: DataFrame) -> bool:
    """True if ``df`` is made of files by steps inside their partitions, broadcast joins among them: read
    again, it gives the same rows in the same places."""
    execution = df._jdf.queryExecution()
    open_nodes = [execution.executedPlan()]
    while open_nodes:
        node = open_nodes.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            open_nodes.append(node.initialPlan())
            continue
        if name == "BroadcastExchange":
            continue
        children = node.children()
        below = [children.apply(i) for i in range(children.size())]
        if name == "Exchange" or re.search("RDD|Python|Arrow|Pandas", name) or not (below or name.startswith("Scan ")):
            return False
        open_nodes += below
    return execution.optimizedPlan().deterministic()


def _before(pieces: DataFrame, rows: str) -> DataFrame:
    """Adds ``_before``, the number of rows in earlier pieces: files in the order of their part numbers."""
    number = F.regexp_extract(_FILE, "part-([0-9]+)", 1).cast("bigint")
    order = Window.partitionBy(F.lit(0)).orderBy(number, _FILE, _ROW).rowsBetween(Window.unboundedPreceding, -1)
    return pieces.withColumn("_before", F.coalesce(F.sum(rows).over(order), F.lit(0)))


def with_dense_key(
    df: DataFrame,
    key: str,
    order_by: list[str],
    start: int = 1,
    label: str = "keyed",
    stored: bool = False,
    places: bool = False,
) -> DataFrame:
    """Add consecutive numbers from ``start`` in the order of ``order_by``.

    The rows are range-partitioned, sorted and written once: a key is the place of a row in its
    file and the number of rows in earlier files. Only the row counts of the files are summed up
    in order, a small table that every reader joins. Writing fixes the partition bounds, so a
    lost executor cannot change a key.

    Range partitioning looks at its input twice. Input that reads files without a shuffle on the
    way is read again; other input is written first, unless it reads ``stored`` files already.
    Rows that are equal in ``order_by`` are told apart by their place in the files: copies of one
    row spread over many tasks. With ``places`` the rows keep their file and place, for
    :func:`with_expanded_key`.
    """
    source = df if stored or _reads_files_in_place(df) else stage(df, f"{label}-input")
    order = [*order_by, "_place"]
    placed = source.withColumn("_place", F.monotonically_increasing_id())
    ordered = placed.repartitionByRange(*order).sortWithinPartitions(*order).drop("_place")
    conf = df.sparkSession.conf
    before = conf.get(BOUNDS_SAMPLE)
    partitions = max(1, int(conf.get("spark.sql.shuffle.partitions")))
    conf.set(BOUNDS_SAMPLE, str(max(10, min(int(before), BOUNDS_ROWS // partitions))))
    try:
        written = stage(ordered, label)
    finally:
        conf.set(BOUNDS_SAMPLE, before)
    numbered = written.select("*", F.col("_metadata.file_name").alias(_FILE), F.col("_metadata.row_index").alias(_ROW))
    files = numbered.groupBy(_FILE).agg(F.count(F.lit(1)).alias("_rows"), F.min(_ROW).alias(_ROW))
    offsets = _before(files, "_rows").select(_FILE, "_before")
    keyed = numbered.join(F.broadcast(offsets), _FILE)
    kept = [*df.columns, *([_FILE, _ROW] if places else [])]
    return keyed.select((F.col("_before") + F.col(_ROW) + start).alias(key), *[F.col(f"`{c}`") for c in kept])


def with_expanded_key(
    placed: DataFrame, expand: Callable[[DataFrame], DataFrame], key: str, start: int = 1, label: str = "expanded"
) -> DataFrame:
    """Consecutive numbers for the rows that ``expand`` makes of each row of ``placed``, in its order.

    ``placed`` comes from :func:`with_dense_key` with ``places``; ``expand`` is free of shuffles
    and passes on its last two columns. Every task numbers what it makes of its pieces of files;
    the rows are written once, not sorted again, and the counts of the pieces, a row each, are
    summed up in order.
    """
    made = expand(placed)
    names = [c for c in made.columns if c not in (_FILE, _ROW)]
    written = stage(
        made.withColumns({"_number": F.monotonically_increasing_id(), "_task": F.spark_partition_id()}), label
    )
    pieces = written.groupBy("_task", _FILE).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_number").alias("_first"), F.min(_ROW).alias(_ROW)
    )
    offsets = _before(pieces, "_rows").select("_task", _FILE, "_before", "_first")
    keyed = written.join(F.broadcast(offsets), ["_task", _FILE])
    place = F.col("_before") + F.col("_number") - F.col("_first") + start
    return keyed.select(place.alias(key), *[F.col(f"`{c}`") for c in names])


def next_key(dim: DataFrame, key: str) -> int:
    """First unused key of an existing dimension."""
    return (dim.agg(F.max(key).alias("m")).first()["m"] or 0) + 1


def key_map(dim: DataFrame, source_id: str, key: str) -> DataFrame:
    """``source_id`` to key; a repeated id keeps its last (highest) key."""
    return (
        dim.filter(F.col(source_id).isNotNull())
        .groupBy(source_id)
        .agg(F.max(key).alias(key))
    )


def orphans(facts: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Distinct non-null fact keys without a dimension row, with their fact counts.

    Facts are counted per key before the anti-join, so a hot key is one row in it.
    """
    used = (
        facts.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_facts"))
    )
    return used.join(dim.select(key), key, "left_anti")


def referential_report(facts: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """One row per foreign key: orphaned key values and orphaned fact rows."""
    parts = [
        orphans(facts, dim, key).agg(
            F.lit(key).alias("foreign_key"),
            F.count(F.lit(1)).alias("orphan_keys"),
            F.coalesce(F.sum("n_facts"), F.lit(0)).alias("orphan_facts"),
        )
        for key, dim in dims.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
