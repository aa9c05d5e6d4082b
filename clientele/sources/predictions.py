"""Prediction batches (CSV or parquet) and the published prediction table."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.functions.labels import without_nan
from clientele.operators.segments import sketch_of
from clientele.schemas import PREDICTION, SEGMENTED

_COMMIT = T.StructType([
    T.StructField("version", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("published_at", T.TimestampType()),
    T.StructField("number", T.LongType()),
    # Quantile sketch of the version's values; NULL in logs from before there were any.
    T.StructField("sketch", T.BinaryType()),
])


class StaleBase(RuntimeError):
    """Another refresh was published since this one read the table."""


def export_name(as_of: dt.date, prefix: str = "daily_predictions") -> str:
    """Date-stamped name of an export."""
    return f"{prefix}_{as_of:%Y%m%d}"


def observed(df: DataFrame, write, **aggregates: Column) -> dict:
    """Run ``write`` on the frame and return aggregates of what it wrote, without a second pass."""
    seen = Observation()
    write(df.observe(seen, *[a.alias(n) for n, a in aggregates.items()]))
    return seen.get


def counted(df: DataFrame, write) -> int:
    """Run ``write`` on the frame and return how many rows it wrote."""
    return observed(df, write, rows=F.count(F.lit(1)))["rows"]


def write_csv(predictions: DataFrame, path: str) -> int:
    """Export as UTF-8 CSV with a header; NaN becomes an empty field.  Returns the row count."""
    plain = predictions.select(*[
        without_nan(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.DoubleType)
        else F.col(f.name) for f in predictions.schema.fields])
    return counted(plain, lambda df: df.write.option("header", True).option("encoding", "UTF-8")
                   .mode("overwrite").csv(path))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = PREDICTION) -> DataFrame:
    """Read a CSV export; ``schema=None`` detects the types from the text."""
    reader = spark.read.option("header", True).option("encoding", "UTF-8")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def stage(predictions: DataFrame, path: str) -> int:
    """Replace the staging table by this batch.  Returns the row count."""
    return counted(predictions, lambda df: df.write.mode("overwrite").parquet(path))


def read_staged(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PREDICTION).parquet(path)


class PredictionTable:
    """The segmented table, as immutable versions and a log of published ones.

    A refresh may read the table it replaces: it writes a new version beside the
    old one, and the row added to the log is the switch.  A version whose job
    died before that is never seen.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self._versions = f"{root.rstrip('/')}/versions"
        self._log = f"{root.rstrip('/')}/log"

    def published(self) -> DataFrame:
        """The log: (version, rows, published_at, number, sketch), numbered in order of publication."""
        try:
            return self.spark.read.schema(_COMMIT).parquet(f"{self._log}/*")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _COMMIT)

    def has(self, version: str) -> bool:
        return not self.published().where(F.col("version") == version).isEmpty()

    def newest(self) -> tuple[str | None, int]:
        """Name and number of the newest published version; (None, 0) before the first one."""
        version, number = self.published().agg(F.max_by("version", "number"), F.max("number")).first()
        return version, number or 0

    def current(self) -> DataFrame:
        """The newest published version; empty before the first one."""
        newest, _ = self.newest()
        if newest is None:
            return self.spark.createDataFrame([], SEGMENTED)
        return self.spark.read.schema(SEGMENTED).parquet(f"{self._versions}/{newest}")

    def sketch(self, version: str) -> DataFrame:
        """The quantile sketch of a version's values, as one row; none for a version that has none."""
        return self.published().where(F.col("version") == version).select("sketch")

    def publish(self, segmented: DataFrame, version: str, base: int | None = None,
                view: str | None = None) -> int:
        """Write a version clustered by customer and switch to it.  Returns the row count.

        ``base`` is the number of the version that the rows derive from; if another one has been
        published since, nothing is switched and StaleBase is raised.  Each number is a
        folder of the log, so of two publishers of one number the second fails.  ``view`` names a
        session view that is then set to the new version.
        """
        number = self._next(base)
        clustered = segmented.repartitionByRange("userId").sortWithinPartitions("userId")
        seen = observed(clustered, lambda df: df.write.mode("overwrite").parquet(f"{self._versions}/{version}"),
                        rows=F.count(F.lit(1)), sketch=sketch_of(F.col("clv")))
        rows = seen["rows"]
        if self._next(base) != number:
            raise StaleBase(f"{version} was made from a table that is no longer the current one")
        (self.spark.range(1)
         .select(F.lit(version).alias("version"), F.lit(rows).cast("long").alias("rows"),
                 F.current_timestamp().alias("published_at"), F.lit(number).cast("long").alias("number"),
                 F.lit(bytes(seen["sketch"])).alias("sketch"))
         .write.mode("error").parquet(f"{self._log}/{number:010d}"))
        if view is not None:
            self.current().createOrReplaceTempView(view)
        return rows

    def _next(self, base: int | None) -> int:
        _, number = self.newest()
        if base is not None and number != base:
            raise StaleBase(f"the table is at version {number}, not at {base}")
        return number + 1
