"""Uniform shuffles into shards of exact size, dealt by a hypergeometric communication matrix."""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from clientele.llm.common import saved

#: Rows that one task of the second permutation orders, and the most such blocks of a shard: their
#: first slots travel in the plan (a number each), so larger tables get larger blocks.
BLOCK_ROWS = 1_000
MAX_BLOCKS = 4_096


def draw_hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of `draws` rows are good, by inversion over the values within 12 deviations."""
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    total = good + bad
    share = good / total
    width = 30 + 12 * int(math.sqrt(draws * share * (1 - share) * (total - draws) / max(1, total - 1)))
    mode = (draws + 1) * (good + 1) // (total + 2)
    k = np.arange(max(low, mode - width), min(high, mode + width) + 1, dtype=np.float64)
    step = (np.log(good - k[:-1]) + np.log(draws - k[:-1])
            - np.log(k[1:]) - np.log(bad - draws + k[1:]))
    logs = np.concatenate([[0.0], np.cumsum(step)])
    cumulated = np.cumsum(np.exp(logs - logs.max()))
    return int(k[np.searchsorted(cumulated, rng.random() * cumulated[-1], side="right")])


def communication_matrix(sources: list[int], shards: list[int], seed: int) -> list[list[int]]:
    """Rows that each source sends to each shard, as a uniform shuffle of all rows would send them.

    The margins are exact: row i adds up to sources[i] and column j to shards[j].
    """
    if sum(sources) != sum(shards):
        raise ValueError("the shards must hold exactly the rows of the sources")
    rng = np.random.default_rng(seed)
    room = list(shards)
    matrix = []
    for rows in sources:
        left, total, sent = rows, sum(room), []
        for j, capacity in enumerate(room):
            n = draw_hypergeometric(rng, capacity, total - capacity, left)
            sent.append(n)
            left -= n
            total -= capacity
        room = [r - n for r, n in zip(room, sent)]
        matrix.append(sent)
    return matrix


def _lookup(values: object, kind: str) -> Column:
    """A constant of the plan."""
    return F.from_json(F.lit(json.dumps(values, separators=(",", ":"))), kind)


def shuffle_into_shards(docs: DataFrame, shards: int = 24, seed: int = 20_240_607,
                        settled: bool = False, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """All rows with `shard` (0 to shards - 1) and `slot` (0, 1, ... in each shard), in random order.

    Shard sizes differ by one row at most, and every order of the rows over all slots is equally likely:

    1. count the rows of each source partition;
    2. draw how many of them go to each shard (`communication_matrix`);
    3. permute each source locally and cut it by those counts;
    4. exchange; rows of a shard are then ordered by a second random number, which also says
       in which of its blocks a row lies, so a shard is permuted by many tasks.

    The driver sees one count for each source partition and each block of a shard, never a row; a
    source costs it a row of the matrix, so give inputs of over 100,000 partitions larger ones.

    `settled` says that the frame reads files, so that a partition has the same rows in the same
    order in every job; otherwise it is first written to the shared folder.  Should partitions
    differ between jobs all the same, the result fails with an error rather than break the sizes.

    NULLs, empty texts, ties and repeated rows are rows like any other.  An empty table gives no
    rows.  Columns named `shard` or `slot` are replaced, all others are kept.
    """
    if shards < 1:
        raise ValueError("shards must be 1 at least")
    if not settled:
        docs = saved(docs, "shard-input")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.rand(seed).alias("cut"), F.rand(seed + 1).alias("order"))
    counted = docs.groupBy(F.spark_partition_id().alias("source")).count().collect()
    counts = {r["source"]: r["count"] for r in counted}
    total = sum(counts.values())
    sizes = [total // shards + (j < total % shards) for j in range(shards)]
    sources = [counts.get(i, 0) for i in range(max(counts, default=-1) + 1)]
    matrix = communication_matrix(sources, sizes, seed)
    ends = [np.cumsum(sent).tolist() for sent in matrix] or [[0] * shards]
    blocks = min(MAX_BLOCKS, max(1, -(-total // (shards * block_rows))))

    # The upper bits of the number are the partition, the lower 33 the place in its permuted rows.
    number = F.monotonically_increasing_id()
    dealt = (rows.sortWithinPartitions("cut").withColumn("number", number)
             .withColumn("source", F.shiftright("number", 33).cast("int"))
             .withColumn("place", F.col("number").bitwiseAND(F.lit((1 << 33) - 1)))
             .withColumn("ends", F.get(_lookup(ends, "array<array<bigint>>"), F.col("source")))
             .withColumn("ends", F.when(F.get("ends", F.lit(shards - 1)) > F.col("place"), F.col("ends"))
                         .otherwise(F.raise_error(F.lit(
                             "a partition has other rows than when it was counted; write the table first"))))
             .withColumn("shard", F.size(F.filter("ends", lambda e: e <= F.col("place"))))
             .withColumn("block", F.floor(F.col("order") * blocks).cast("int")))

    filled = {(r["shard"], r["block"]): r["count"]
              for r in dealt.groupBy("shard", "block").count().collect()}
    starts = [np.cumsum([0] + [filled.get((j, b), 0) for b in range(blocks - 1)]).tolist()
              for j in range(shards)]
    first = F.get(F.get(_lookup(starts, "array<array<bigint>>"), F.col("shard")), F.col("block"))
    within = F.row_number().over(Window.partitionBy("shard", "block").orderBy("order"))
    return (dealt.withColumn("slot", first + within - 1)
            .select(*[F.col("row")[c].alias(c) for c in docs.columns if c not in ("shard", "slot")],
                    "shard", "slot"))
