"""One registered query per operator, over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstar.llm import (
    alignment,
    chat,
    decontamination,
    jaccard,
    mixing,
    packing,
    pii,
    quality_classifier,
    quality_rules,
    sharding,
    toxicity,
    warc,
    whitening,
)
from wardstar.llm.sql import SQL as SQL
from wardstar.session import stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held = stage(quality_rules.measured(docs).select("doc_id", "measures"), "op2-measures")
    judged = quality_rules.judged(held, quality_rules.fit(held))
    return judged.select(
        "doc_id",
        *[F.col(f"measures.{n}") for n in quality_rules.MEASURES],
        "base_failed",
        "quality_probability",
        "kept",
    )


@query
def op10_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"))


@query
def op4_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    made = mixing.mix(table(spark, folder, "documents"))
    return mixing.mixed_rows(made).select(
        F.col("k").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


@query
def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    index = decontamination.build_index(table(spark, folder, "documents"))
    found = decontamination.search(index, table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        decontamination.n_hit(F.col("spans")).alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
        F.size("near_items").cast("bigint").alias("n_near_items"),
    )


@query
def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    found = jaccard.classes(table(spark, folder, "documents"))
    return found.select(F.col("k").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


@query
def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages"))


@query
def op3_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality_classifier.train(docs, table(spark, folder, "labels"))
    return quality_classifier.scored(docs, model).select(
        "doc_id",
        (quality_classifier.fold("doc_id") == quality_classifier.HELD_OUT_FOLD).alias("held_out"),
        "score",
        (F.col("score") >= quality_classifier.KEEP_FROM).cast("int").alias("predicted"),
    )


@query
def op8_chat_roles(spark: SparkSession, folder: str) -> DataFrame:
    return chat.repaired(table(spark, folder, "conversations"))


@query
def op6_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.read_documents(table(spark, folder, "documents"))
    done = pii.accepted(found, pii.fit(found))
    base = F.col("base")
    every = F.concat(
        F.transform(base, lambda s: F.struct(s.kind, s.start, s.stop)),
        F.transform("added", lambda s: F.struct(s.kind, s.start, s.stop)),
    )
    return done.select(
        F.col("k").alias("doc_id"),
        *[pii.count_of(base, kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(pii.joined(base).cast("binary"), 256).alias("base_sha256"),
        pii.joined(every).alias("spans"),
        F.size("added").cast("bigint").alias("n_added"),
    )


@query
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    chain = toxicity.train(docs, table(spark, folder, "labels"))
    held = toxicity.scored(docs, chain).select("doc_id", "toxicity.*")
    return held.select(
        "doc_id",
        *[F.col(c).alias(f"p_{c}") for c in toxicity.CATEGORIES],
        (F.col("toxic") >= toxicity.TOXIC_FROM).alias("is_toxic"),
    )


@query
def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.token_alignment(table(spark, folder, "documents")).withColumnRenamed("k", "doc_id")


@query
def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings")).withColumnRenamed("k", "vec_id")


@query
def op13_feistel_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.assigned(table(spark, folder, "documents"))
    return placed.select(
        F.col("k").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
