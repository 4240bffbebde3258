"""Session helpers: the shared folder and stage tables written into it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "emberlog", master: str | None = None, **conf: object) -> SparkSession:
    """A session with adaptive execution on; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # text work is heavy per byte: do not merge shuffle partitions down to a few tasks
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
        # window chunks are collected per (source, chunk): many small groups per task
        .config("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "4096")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="emberlog-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


#: Stage tables of this process, by application.
_STAGES: dict[str, list[str]] = {}


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    path = f"{shared_dir(spark)}/emberlog-{name}-{uuid.uuid4().hex}"
    _STAGES.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def drop_stages(spark: SparkSession) -> None:
    """Remove all stage tables of this application. For the end of a job, when no table that was
    read back from a stage is needed any more."""
    for name in _STAGES.pop(spark.sparkContext.applicationId, []):
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession, size: str = "2m") -> None:
    """From now on Python workers get rows in batches of about ``size`` bytes, unless the session names a size itself.

    Spark's own bound is 64 MB. Executor and worker hold a batch several times over, and workers that are kept
    do not give back all of it, so an executor's memory would follow the length of the texts.
    """
    if BATCH_BYTES not in spark.conf.getAll:
        spark.conf.set(BATCH_BYTES, size)


def pin(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a stage table and read it back.

    Cuts the lineage where several passes follow: they scan a columnar table, prune it,
    and see the same rows even when executors are lost in between.
    """
    path = stage_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
