"""Calls of a slow function that may fail: several at a time, in order, recorded so that none is repeated."""

from __future__ import annotations

import math
import time
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor

import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from wardstar.operators.joins import lookup_join
from wardstar.session import fresh_path, stage

# Fixed value: calls that one task has under way.
PARALLEL = 15

WAITING = 4  # texts read ahead, for each call under way
ROUND_TEXTS = 100_000
OUT_ROWS = 500
KEY = "_call_key"
ROUND = "_call_round"
LOG = f"{KEY} string, response string, error string"


def _guarded(fn: Callable[[pd.Series], pd.Series], attempts: int, pause: float) -> Callable[[list], list[tuple]]:
    """``fn`` on a list of texts, giving (response, error) of each; a failure concerns its own call."""

    def call(texts: list) -> list[tuple]:
        for attempt in range(1, attempts + 1):
            try:
                found = list(fn(pd.Series(texts, dtype=object)))
                if len(found) != len(texts):
                    raise ValueError(f"{len(found)} answers to {len(texts)} texts")
                return [(None if r is None or r is pd.NA else str(r), None) for r in found]
            except Exception as error:
                if attempt == attempts:
                    return [(None, f"{type(error).__name__}: {error}")] * len(texts)
                time.sleep(pause * 2 ** (attempt - 1))
        return []

    return call


def _caller(fn: Callable, parallel: int, attempts: int, pause: float, texts_per_call: int):
    """Texts of a partition through a bounded window of calls; answers come in the order of the texts."""
    call = _guarded(fn, attempts, pause)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
        for batch in batches:
            for at in range(0, batch.num_rows, texts_per_call):
                keys, texts = batch.slice(at, texts_per_call).columns
                yield keys.to_pylist(), texts.to_pylist()

    def rows(done: list[tuple]) -> pa.RecordBatch:
        columns = zip(*done) if done else ([], [], [])
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], [KEY, "response", "error"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool = ThreadPoolExecutor(parallel)
        under_way: deque[tuple[list, Future]] = deque()
        done: list[tuple] = []

        def take() -> None:
            keys, future = under_way.popleft()
            done.extend((k, *answer) for k, answer in zip(keys, future.result(), strict=True))

        try:
            for keys, texts in chunks(batches):
                under_way.append((keys, pool.submit(call, texts)))
                if len(under_way) >= WAITING * parallel:
                    take()
                if len(done) >= OUT_ROWS:
                    yield rows(done)
                    done.clear()
            while under_way:
                take()
            yield rows(done)
        finally:
            pool.shutdown(wait=False, cancel_futures=True)

    return run


def _recorded(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(LOG).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG)


def answered(
    df: DataFrame,
    text: str,
    fn: Callable[[pd.Series], pd.Series],
    log: str | None = None,
    parallel: int = PARALLEL,
    tasks: int | None = None,
    attempts: int = 1,
    pause: float = 1.0,
    texts_per_call: int = 1,
    round_texts: int = ROUND_TEXTS,
    per: list[str] | None = None,
) -> DataFrame:
    """``df`` with ``response``, what ``fn`` makes of each text, and ``error``, why there is none.

    Each distinct text is sent once, or once for each value of the columns ``per``; null is a
    text too. A task has ``parallel`` calls under way,
    of ``texts_per_call`` texts each, and ``tasks`` tasks work at the same time (by default all
    cores). A call that fails is tried ``attempts`` times, after pauses that double.

    Answers are written to ``log`` (Parquet, in the shared folder; a fresh one by default), keyed
    by the hash of the text, in rounds of about ``round_texts``. With the same log a later run
    sends only what has no answer yet, so a run that was stopped goes on after its last full
    round, and failures are sent again. Within a round, a task that is lost is run again.
    """
    spark = df.sparkSession
    path = log or fresh_path(spark, "answers")
    key = F.sha2(F.to_json(F.struct(text, *(per or [])), {"ignoreNullFields": "false"}), 256)
    held = stage(df.withColumn(KEY, key), "calls-rows")
    known = _recorded(spark, path).filter("error is null").select(KEY)
    asked = held.groupBy(KEY).agg(F.any_value(F.col(text).cast("string")).alias("text"))
    pending = stage(asked.join(known, KEY, "left_anti"), "calls-texts")
    rounds = math.ceil(pending.count() / round_texts)
    if rounds > 1:
        # A round reads its own folder only: all rounds together read the texts once.
        of_round = pending.withColumn(ROUND, F.pmod(F.xxhash64(KEY), F.lit(rounds)).cast("int"))
        pending = stage(of_round.repartition(ROUND), "calls-rounds", [ROUND])
    for number in range(rounds):
        now = pending.filter(F.col(ROUND) == number).drop(ROUND) if rounds > 1 else pending
        dealt = now.repartition(tasks or spark.sparkContext.defaultParallelism, KEY)
        sent = dealt.mapInArrow(_caller(fn, parallel, attempts, pause, texts_per_call), LOG)
        sent.write.mode("append").parquet(path)
    best = F.max_by(F.struct("response", "error"), F.col("error").isNull())
    answers = _recorded(spark, path).groupBy(KEY).agg(best.alias("_a")).select(KEY, "_a.*")
    kept = [c for c in df.columns if c not in ("response", "error")]
    return lookup_join(held.select(*[F.col(f"`{c}`") for c in kept], KEY), answers, KEY, "left", kept[:1]).drop(KEY)
