"""Session settings the operators rely on, and the shared folder of the cluster."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_SETTINGS = {
    # Timestamps are UTC days; the business calendar is applied explicitly.
    "spark.sql.session.timeZone": "UTC",
    # Overflow and division by a zero rate are errors, never silent NULLs.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when a later stage must then shuffle again.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Skip the sort of a join when every partition of one side is known to be small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the session settings and return the session."""
    for key, value in _SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


# Ledger bytes per shuffle partition before AQE merges small ones.
_PARTITION_BYTES = 512 * 1024 ** 2
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

# What the optimizer assumes about a source that cannot tell its size.
_UNKNOWN_BYTES = 2 ** 63 - 1


def input_bytes(df: DataFrame, unknown: int = 0) -> int:
    """Size of the tables a frame reads, by the optimizer's statistics; runs no job.

    Each source of unknown size counts as ``unknown`` bytes.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(size if size < _UNKNOWN_BYTES else unknown for size in sizes)


@contextmanager
def sized_shuffles(spark: SparkSession, *inputs: DataFrame, unknown: int = 0) -> Iterator[int]:
    """Start the shuffles of the actions inside with enough partitions for these inputs.

    Never fewer than configured.  Sources that cannot tell their size count as ``unknown``
    bytes.  The session's setting is as before afterwards.
    """
    needed = math.ceil(sum(input_bytes(df, unknown) for df in inputs) / _PARTITION_BYTES)
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), needed)
    before = spark.conf.get(_INITIAL, None)
    spark.conf.set(_INITIAL, partitions)
    try:
        yield partitions
    finally:
        if before is None:
            spark.conf.unset(_INITIAL)
        else:
            spark.conf.set(_INITIAL, before)


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as the cluster names it in spark.checkpoint.dir.

    Only a local session without that setting gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="clientele-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/clientele/{name}-{uuid.uuid4().hex}"


# Folders that `written` has made for the job that is running, if it cleans up after itself.
_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder.

    Cuts the lineage for good: later jobs, and executors that replace lost ones,
    read the table instead of the ledger.  Inside ``intermediates`` it goes with the rest.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    made = _MADE.get()
    if made is not None:
        made.append(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Delete what ``written`` makes inside, at the end; results must lie elsewhere by then."""
    made: list[str] = []
    token = _MADE.set(made)
    try:
        yield
    finally:
        _MADE.reset(token)
        for path in made:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
