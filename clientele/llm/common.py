"""Helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.session import shared_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the cluster's shared folder.

    Later steps, and tasks that replace lost ones, read the table; row numbers and other
    values that depend on the order of rows are the same for all of them.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_of_id(doc_id: Column) -> Column:
    """crc32 of the id written as text; NULL ids count as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def whole_text(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def partitions_for(rows: int, per_partition: int, spark: SparkSession) -> int:
    """Enough partitions for so many rows, and never fewer than the session's shuffles have."""
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(configured, -(-rows // per_partition))


def fresh(columns: list[str], name: str) -> str:
    """The name, or one made from it that no column has (Spark does not tell cases apart)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def joined_by_row(docs: DataFrame, keys: DataFrame, how: str, id_col: str, text_col: str) -> DataFrame:
    """Semi or anti join of documents with (id, hash of the text); NULL ids are equal."""
    id_, text = fresh(docs.columns, "key_id"), fresh(docs.columns, "key_text")
    keys = keys.select(F.col("id").alias(id_), F.col("text_key").alias(text))
    same = F.col(f"`{id_col}`").eqNullSafe(F.col(id_)) & (F.xxhash64(f"`{text_col}`") == F.col(text))
    return docs.join(keys, same, how)


def one_row_each(docs: DataFrame, keys: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of `docs` whose key is not said to go, and only one of those whose key occurs repeatedly.

    `keys` has a row for each (id, text_key) with `kept` and `rows`.  What goes is the smaller part, so the
    documents are joined with that; rows equal in id and text are copies, so any of them may stay.
    """
    stays = joined_by_row(docs, keys.where("NOT kept"), "left_anti", id_col, text_col)
    twice = keys.where("kept AND rows > 1")
    if twice.isEmpty():
        return stays
    return joined_by_row(stays, twice, "left_anti", id_col, text_col).unionByName(
        joined_by_row(stays, twice, "left_semi", id_col, text_col).dropDuplicates([id_col, text_col]))
