"""Spark session defaults and the shared folder that staged tables go to."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

_local_dirs: dict[str, str] = {}

# Folders of the open ``scratch`` blocks of this thread, the innermost last.
_scratch: ContextVar[tuple[str, ...]] = ContextVar("scratch", default=())


def build_session(app: str = "wardstar", master: str | None = None, cores: int | None = None) -> SparkSession:
    """A session with the settings the jobs are written for.

    On a cluster leave ``master`` unset and pass sizes with spark-submit; the
    ``cores`` argument only sizes local test runs.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = (
                builder.config("spark.sql.shuffle.partitions", str(cores or 8))
                .config("spark.ui.enabled", "false")
                .config("spark.ui.showConsoleProgress", "false")
                .config("spark.driver.memory", "8g")
            )
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a fresh temporary folder:
    on a cluster the executors would not all see it.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="wardstar-")
        atexit.register(shutil.rmtree, _local_dirs[app], ignore_errors=True)
    return _local_dirs[app]


def run_dir(spark: SparkSession) -> str:
    """The folder of this application in the shared folder: all staged tables go there."""
    return f"{shared_dir(spark)}/run-{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{(_scratch.get() or (run_dir(spark),))[-1]}/{label}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Delete all staged tables of this application; call it when their results were read."""
    _delete(spark, run_dir(spark))


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables staged inside the block are deleted at its end.

    Yields a function like ``stage`` for the tables that outlive the block; all that is read
    later has to be one of them.
    """
    outer = _scratch.get()
    folder = fresh_path(spark, "scratch")

    def keep(df: DataFrame, label: str) -> DataFrame:
        inner = _scratch.set(outer)
        try:
            return stage(df, label)
        finally:
            _scratch.reset(inner)

    inner = _scratch.set((*outer, folder))
    try:
        yield keep
    finally:
        _scratch.reset(inner)
        _delete(spark, folder)


def stage(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, and gives the
    planner true file sizes for later join choices.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df``."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread(df: DataFrame) -> DataFrame:
    """Rows of a scan that has fewer parts than there are cores over all cores, before costly work per row."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = df._jdf.queryExecution().toRdd().getNumPartitions()
    return df.repartition(cores) if parts < cores else df
