"""Exact duplicates by deterministic block naming."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.llm.common import one_row_each, saved, whole_text

BLOCK_BYTES = 4096


def _digests(size: int, seed: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shas, firsts, seconds = [], [], []
            for text in batch.column("text").to_pylist():
                data = text.encode().lower()
                blocks = [data[i:i + size] for i in range(0, len(data), size)] or [b""]
                both = [xxhash.xxh3_128_digest(b, seed) for b in blocks]
                shas.append(hashlib.sha256(data).hexdigest())
                firsts.append([int.from_bytes(d[:8], "big", signed=True) for d in both])
                seconds.append([int.from_bytes(d[8:], "big", signed=True) for d in both])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_key"), pa.array(shas, pa.string()),
                 pa.array(firsts, pa.list_(pa.int64())), pa.array(seconds, pa.list_(pa.int64()))],
                ["id", "text_key", "sha", "firsts", "seconds"])
    return rows


def _contents(size: int, seed: int):
    """Blocks with their hashes; those a task has just seen are left out."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[bytes, bytes] = {}
            out: list[tuple[bytes, bytes]] = []
            for text in batch.column("text").to_pylist():
                data = text.encode().lower()
                for i in range(0, len(data) or 1, size):
                    block = data[i:i + size]
                    digest = xxhash.xxh3_128_digest(block, seed)
                    if seen.setdefault(digest, block) is block or seen[digest] != block:
                        out.append((digest, block))
            yield pa.RecordBatch.from_arrays(
                [pa.array([int.from_bytes(d[:8], "big", signed=True) for d, _ in out], pa.int64()),
                 pa.array([int.from_bytes(d[8:], "big", signed=True) for d, _ in out], pa.int64()),
                 pa.array([b for _, b in out], pa.binary())], ["first", "second", "block"])
    return rows


def _named(keys: DataFrame, *columns: str) -> DataFrame:
    """Distinct keys in sorted runs with an integer each, written so that a name never changes."""
    distinct = keys.select(*columns).distinct().sortWithinPartitions(*columns)
    return saved(distinct.withColumn("name", F.monotonically_increasing_id()), "block-names")


def text_identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: `row`, `id`, `text_key`, `sha`, `blocks` and `name`; equal (blocks, name)
    stand for texts that are equal when A-Z are lower-cased, and for no others.

    Texts are cut into blocks of fixed size.  Distinct blocks are sorted and get integer names; then
    adjacent pairs of names are sorted and named, over and over, until a text has one name.  As the names
    of a round stand for different contents, so do the pairs', and no name can clash.

    Blocks are sorted by a 128-bit hash.  Blocks that occur more than once are then
    compared byte by byte (the only ones that could clash); were two blocks to share a hash, all would be
    hashed anew with another seed.
    """
    texts = docs.select(F.col(id_col).alias("id"), whole_text(F.col(text_col)).alias("text"),
                        F.xxhash64(text_col).alias("text_key"))
    schema = T.StructType([
        T.StructField("id", texts.schema["id"].dataType), T.StructField("text_key", T.LongType()),
        T.StructField("sha", T.StringType()), T.StructField("firsts", T.ArrayType(T.LongType())),
        T.StructField("seconds", T.ArrayType(T.LongType()))])
    seed = 0
    while True:
        rows = saved(texts.mapInArrow(_digests(block_bytes, seed), schema)
                     .withColumn("row", F.monotonically_increasing_id()), "block-hashes")
        blocks = rows.select("row", F.size("firsts").alias("blocks"),
                             F.posexplode(F.arrays_zip("firsts", "seconds")).alias("place", "h")).select(
            "row", "blocks", "place", F.col("h.firsts").alias("first"), F.col("h.seconds").alias("second"))
        repeated = blocks.groupBy("first", "second").count().where("count > 1").select("first", "second")
        contents = texts.select("text").mapInArrow(
            _contents(block_bytes, seed), "first long, second long, block binary")
        clashes = (contents.join(repeated, ["first", "second"], "left_semi").distinct()
                   .groupBy("first", "second").count().where("count > 1"))
        if clashes.isEmpty():
            break
        seed += 1

    names = _named(blocks, "first", "second")
    level = saved(blocks.join(names, ["first", "second"]).select("row", "blocks", "place", "name"),
                  "block-level")
    whole = level.where("blocks = 1").select("row", "blocks", "name")
    width = rows.agg(F.max(F.size("firsts"))).first()[0] or 1
    covered = 1
    while covered < width:
        pairs = (level.where(F.col("blocks") > covered)
                 .groupBy("row", "blocks", F.shiftright("place", 1).alias("place"))
                 .agg(F.max(F.when(F.col("place") % 2 == 0, F.col("name"))).alias("left"),
                      # A last block without a neighbour is paired with -1, which is no name.
                      F.coalesce(F.max(F.when(F.col("place") % 2 == 1, F.col("name"))), F.lit(-1))
                      .alias("right")))
        pairs = saved(pairs, "block-pairs")
        names = _named(pairs, "left", "right")
        level = saved(pairs.join(names, ["left", "right"]).select("row", "blocks", "place", "name"),
                      "block-level")
        covered *= 2
        whole = whole.union(level.where(F.col("blocks").between(covered // 2 + 1, covered))
                            .select("row", "blocks", "name"))
    return whole.join(rows.select("row", "id", "text_key", "sha"), "row")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document with its group of equal texts (A-Z lower-cased; NULL counts as empty).

    Columns: the id, `keep_id` (the largest id of the group, whose row stays; NULL only if all ids
    are), `group_size`, `kept`, `text_sha256`, `text_key`.  Of repeated rows with that id one stays,
    so every group has exactly one kept row.  An empty table gives no rows; columns other than id and
    text are ignored, whatever their names.
    """
    rows = saved(text_identities(docs, id_col, text_col, block_bytes), "block-identities")
    groups = rows.groupBy("blocks", "name").agg(
        F.max(F.struct("id", "row")).alias("keeper"), F.count("*").alias("group_size"))
    return (rows.join(groups, ["blocks", "name"])
            .select(F.col("id").alias(id_col), F.col("keeper.id").alias("keep_id"), "group_size",
                    (F.col("row") == F.col("keeper.row")).alias("kept"),
                    F.col("sha").alias("text_sha256"), "text_key"))


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all their columns.

    Rows are found again by id and a hash of the text; rows equal in both are copies anyway.
    """
    keys = (exact_groups(docs, id_col, text_col)
            .groupBy(F.col(id_col).alias("id"), "text_key")
            .agg(F.count("*").alias("rows"), F.max("kept").alias("kept")))
    return one_row_each(docs, saved(keys, "kept-keys"), id_col, text_col)
