"""Cutting lineage by writing a table to the cluster's shared folder."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext
from contextvars import ContextVar
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from orderlake.contracts import OrderlakeError

_SETTING = "spark.checkpoint.dir"
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_OPEN: ContextVar[list[str] | None] = ContextVar("staged", default=None)


def staging_root(spark: SparkSession) -> str:
    """The shared folder the session names; a local session without one gets its own."""
    root = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise OrderlakeError(f"set {_SETTING} to a folder all executors share")
    spark.conf.set(_SETTING, tempfile.mkdtemp(prefix="orderlake-"))
    return spark.conf.get(_SETTING)


@contextmanager
def batches_of(spark: SparkSession, most: int) -> Iterator[None]:
    """What is written inside goes to Python in batches of about ``most`` bytes, so a
    task holds no thousands of texts at once, in the JVM's buffers and in Python."""
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(most))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def stage(df: DataFrame, name: str, batch_bytes: int | None = None) -> DataFrame:
    """Write once, read back: later steps neither recompute the plan nor lose it
    with an executor, still prune columns, and know the real size. ``batch_bytes``
    bounds the batches that go to Python on the way (:func:`batches_of`)."""
    spark = df.sparkSession
    path = f"{staging_root(spark)}/{name}-{uuid4().hex}"
    if (paths := _OPEN.get()) is not None:
        paths.append(path)
    with batches_of(spark, batch_bytes) if batch_bytes else nullcontext():
        df.write.parquet(path)
    return spark.read.parquet(path)


def observed(df: DataFrame, counters: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """Count while the rows pass through the next action, without a pass of its own.

    Put it above the last shuffle: a map stage that is run again for a lost
    executor would count twice. ``rows`` and ``columns`` are always counted."""
    seen = Observation(uuid4().hex)
    size = [F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).cast("bigint").alias("columns")]
    return df.observe(seen, *size, *[c.alias(name) for name, c in counters.items()]), seen


def stage_counted(df: DataFrame, name: str, **counters: Column) -> tuple[DataFrame, dict]:
    """``stage``, with the size and the counters seen by the write itself. Columns
    that begin with ``_`` are there for counters and are not written."""
    counted, seen = observed(df, counters)
    staged = stage(counted.select([c for c in df.columns if not c.startswith("_")]), name)
    return staged, {k: v or 0 for k, v in seen.get.items()}


def delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def staged_run(spark: SparkSession) -> Iterator[None]:
    """Delete what is staged inside when the run ends, whether it was published
    or failed. Nothing read from those folders may be used afterwards."""
    paths: list[str] = []
    token = _OPEN.set(paths)
    try:
        yield
    finally:
        _OPEN.reset(token)
        for path in paths:
            delete_folder(spark, path)
