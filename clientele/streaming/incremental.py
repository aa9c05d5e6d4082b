"""Incremental scoring: each micro-batch of document versions rescores the customers it touches.

A late version can change which version of an order is first or last, so the
touched customers are recomputed from the ledger; no state is kept between
batches.  A batch is published under the ids of its checkpoint and of itself, so replaying it
changes nothing; under a new checkpoint it is scored again, with the same rows as result.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clientele.config import ScoringConfig
from clientele.operators.cohort import customer_profiles
from clientele.operators.orders import order_values
from clientele.plans.jobs import score_and_merge
from clientele.schemas import DOCUMENT
from clientele.session import intermediates, written
from clientele.sources.ledger import Ledger
from clientele.sources.predictions import PredictionTable


def document_stream(spark: SparkSession, path: str,
                    files_per_batch: int | None = None) -> DataFrame:
    """Document versions as they arrive in a parquet folder."""
    reader = spark.readStream.schema(DOCUMENT)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def score_batch(batch: DataFrame, batch_id: int, stream: str, ledger: Callable[[], Ledger],
                registry: str, table: PredictionTable, staging: str, cfg: ScoringConfig = ScoringConfig(),
                as_of: dt.date | None = None, observation_end: dt.date | None = None) -> None:
    """Rescore the customers named in one batch and merge them into the table.

    ``ledger`` opens the ledger anew, so that it includes the files of this batch.  ``stream`` is the id
    of the checkpoint: only a replay of the same batch of the same checkpoint is skipped.
    """
    version = f"stream-{stream}-{batch_id:010d}"
    if table.has(version):
        return
    spark = batch.sparkSession
    with intermediates(spark):
        touched = written(batch.select(F.col("BillToEmail").alias("userId")).distinct(), "touched")
        values = order_values(*ledger(), returns=cfg.returns, customers=touched)
        profiles = written(customer_profiles(values, cfg.frequency, as_of, cfg), "profiles")
        score_and_merge(spark, profiles, registry, table, staging, version, cfg, observation_end)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gives a stream when it makes the checkpoint; a new checkpoint has a new one."""
    text = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
    return json.loads(text)["id"]


def start_scoring(documents: DataFrame, ledger: Callable[[], Ledger], registry: str,
                  table: PredictionTable, staging: str, checkpoint: str, cfg: ScoringConfig = ScoringConfig(),
                  as_of: dt.date | None = None,
                  observation_end: dt.date | None = None) -> StreamingQuery:
    """Process all document versions that have arrived, and stop."""
    spark = documents.sparkSession
    return (documents.writeStream
            .foreachBatch(lambda batch, batch_id: score_batch(
                batch, batch_id, stream_id(spark, checkpoint), ledger, registry, table, staging, cfg,
                as_of, observation_end))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())
