"""Writing star tables, records, vector tables and exports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from wardstar import schemas
from wardstar.operators.joins import may_match
from wardstar.operators.vectors import as_arrays

FACT_PARTITION = "event_year"
BATCH = "_insert_batch"
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
OPEN_TYPES = 8


def _fact_layout(df: DataFrame) -> DataFrame:
    """Rows of a year together, large years in several parts: few files per year, of bounded size."""
    return df.withColumn(FACT_PARTITION, F.year("date_key")).hint("rebalance", FACT_PARTITION)


def append_table(df: DataFrame, path: str) -> None:
    """Add rows as one job: either all of them become visible or none."""
    df.write.mode("append").parquet(path)


def insert_if_absent(new: DataFrame, path: str, key: str, batch: str | None = None) -> None:
    """Append only rows whose key is not stored yet; of new rows that share a key, one.

    The stored keys are filtered on their scan by a table of hashed bits of the new keys, of
    fixed size, so that only keys that can be among the new ones are shuffled. Null is a key
    like any other.

    With ``batch`` the rows go to a folder of that name, which a rerun of the batch replaces: it
    adds nothing twice even where the first attempt broke off while it was committed. A table is
    filled with batches from the start, or without; :func:`read_batches` reads the former.
    """
    spark = new.sparkSession
    rows = new.dropDuplicates([key])
    try:
        stored = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        stored = None
    if stored is not None:
        if batch is not None:
            stored = stored.filter(F.col(BATCH) != batch)
        known = stored.select(key)
        fresh = rows.join(may_match(known, rows.select(key), key), key, "left_anti")
        one = F.lit(1).alias("_null")
        null = known.filter(F.col(key).isNull()).select(one).limit(1)
        marked = fresh.withColumn("_null", F.when(F.col(key).isNull(), 1))
        rows = marked.join(null, "_null", "left_anti").select(*[F.col(f"`{c}`") for c in new.columns])
    if batch is None:
        append_table(rows, path)
    else:
        rows.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch}")


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a table that was filled in batches."""
    return spark.read.parquet(path).drop(BATCH)


def reset_star(spark: SparkSession, folder: str) -> None:
    """Replace all star tables by empty ones with the declared columns."""
    write_star({n: spark.createDataFrame([], s) for n, s in schemas.STAR.items()}, folder)


def write_star(tables: dict[str, DataFrame], folder: str, mode: str = "overwrite") -> None:
    """Write star tables; facts are split by year so that date filters skip files."""
    for name, df in tables.items():
        path = f"{folder.rstrip('/')}/{name}"
        if name == "fact_patient_events":
            laid_out = _fact_layout(df)
            laid_out.write.mode(mode).partitionBy(FACT_PARTITION).parquet(path)
        else:
            df.write.mode(mode).parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Newline JSON."""
    df.write.mode(mode).json(path)


def write_vectors(corpus: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Documents with their vectors, split by document type.

    Rows are written by the tasks that make them, neither shuffled nor sorted: a task has few types,
    each with an open file. A task with more than OPEN_TYPES types sorts its rows by type.
    """
    conf = corpus.sparkSession.conf
    before = conf.get(OPEN_FILES)
    conf.set(OPEN_FILES, str(OPEN_TYPES))
    try:
        corpus.write.mode(mode).option("compression", "zstd").partitionBy("type").parquet(path)
    finally:
        conf.set(OPEN_FILES, before)


def load_or_build_vectors(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], rebuild: bool = False
) -> DataFrame:
    """The stored corpus, built and stored first when it is absent; sparse vectors are read as arrays."""
    if not rebuild:
        try:
            return as_arrays(spark.read.parquet(path))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    write_vectors(build(), path)
    return as_arrays(spark.read.parquet(path))


def export_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Headed CSV with all cells quoted; null is the word NULL, which the readers take as null."""
    df.write.mode(mode).option("header", True).option("quoteAll", True).option(
        "nullValue", "NULL"
    ).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
