"""Ledger tables: order and return lines, documents, exchange rates."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from clientele import schemas


class Ledger(NamedTuple):
    lines: DataFrame
    documents: DataFrame
    rates: DataFrame


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to a fixed schema (also turns zone-less timestamps into UTC ones)."""
    return df.selectExpr(*[f"CAST({f.name} AS {f.dataType.simpleString()})" for f in schema.fields])


def read_ledger(spark: SparkSession, lines: str, documents: str, rates: str,
                fmt: str = "parquet") -> Ledger:
    """Ledger from three paths, or from three catalog tables with ``fmt='table'``."""
    def read(source: str, schema: T.StructType) -> DataFrame:
        if fmt == "table":
            return conform(spark.table(source), schema)
        # Parquet and ORC carry their types; text formats need the schema.
        reader = spark.read if fmt in ("parquet", "orc") else spark.read.schema(schema)
        return conform(reader.format(fmt).load(source), schema)

    return Ledger(read(lines, schemas.DOCUMENT_LINE), read(documents, schemas.DOCUMENT),
                  read(rates, schemas.EXCHANGE_RATES))
