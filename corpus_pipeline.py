"""From raw documents to tokens: quality, exact copies, near copies, test leaks, subword ids.

Each stage takes (spark, docs, sf_dir), works on every document that the one before it kept, and returns the
columns of the documents; the last adds ids, their number and the decoded text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.llm.common import fresh, saved, table
from clientele.llm.decontamination import without_leaks
from clientele.llm.exact_dedup import without_copies
from clientele.llm.jaccard import one_of_each_group
from clientele.llm.pieces import encode_pieces
from clientele.llm.quality import learn_quality, quality_scores

#: Score of the quality classifier below which a document goes.
QUALITY_FLOOR = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a classifier learnt from the labels of these documents does not reject."""
    weights = learn_quality(docs, table(spark, sf_dir, "labels"))
    name = fresh(docs.columns, "score")
    return quality_scores(docs, weights, to=name).where(F.col(name) >= QUALITY_FLOOR).drop(name)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: that of the largest id."""
    return without_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked near copies: that of the smallest id."""
    return one_of_each_group(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a benchmark item."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their SentencePiece ids, and the text decoded from them."""
    return encode_pieces(docs)


STAGES = [("quality classifier", quality), ("exact dedup", exact_copies), ("n-gram Jaccard join", near_copies),
          ("benchmark decontamination", leaks), ("SentencePiece encoding and decoding", pieces)]

#: Learning and alignment have no SQL; tests/llm compares the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = saved(docs, f"pipeline-{place}")
    return docs
