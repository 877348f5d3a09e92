"""A training corpus from raw documents: five stages, each over all that the one before kept.

run() writes every stage as Parquet to the shared folder and reads it back, so a lost executor
costs one task of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardstar.llm import decontamination, jaccard, mixing, packing, quality_rules
from wardstar.session import stage


# Whole texts are long rows: fewer of them in one Arrow batch bound the memory of a worker.
BATCH_ROWS = "2000"


def _settings(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    # Every stage writes what it makes: what it shuffled goes with the end of each query, not whenever the
    # driver collects its garbage, so that the shuffles of several stages do not lie on the disks at once.
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules accept."""
    _settings(spark)
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near copies."""
    _settings(spark)
    return jaccard.one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    _settings(spark)
    return decontamination.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask for."""
    _settings(spark)
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed token files, as read back: one row per document and copy."""
    _settings(spark)
    return packing.packed(docs, remember=False)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("mixing sources to target weights", mix),
    ("token-ID output", tokens),
]

# Tokenizer ids cannot be computed in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.split()[0].lower())
    return docs
