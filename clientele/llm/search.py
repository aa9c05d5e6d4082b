"""Ranked lexical search: documents grouped by the mask of an item's terms that they hold, best masks first.

A term is a maximal run of ASCII letters, digits and characters beyond ASCII; A-Z count as a-z.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.llm.common import saved, whole_text
from clientele.llm.words import bytes_of, slices

#: Bytes of item terms that a task holds at a time; more items are searched for in several passes.
BLOCK_BYTES = 1 << 25
#: Cells (terms of an item times documents) of the presence matrix that a task builds at a time.
CELLS = 1 << 24
#: Documents evaluated before the threshold is looked at again; doubled each time.
FIRST_LOOK = 64
#: Bytes of a text that are split into terms at a time.
PIECE = 1 << 20

_SEPARATOR = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
_PLAIN = bytes(32 if _SEPARATOR.match(bytes([b])) else b + 32 if 65 <= b <= 90 else b for b in range(256))


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order, a piece of the text at a time; no term is cut."""
    low = 0
    while low < len(text):
        high = low + PIECE
        if high < len(text):
            end = _SEPARATOR.search(text, high)
            high = end.start() if end else len(text)
        yield text[low:high].translate(_PLAIN).split()
        low = high


def weight(documents: int, holding: int) -> int:
    """Weight of a term that so many of the documents hold."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def _counts(column: pa.Array) -> Iterator[Counter]:
    data, offsets = bytes_of(column)
    view = memoryview(data)
    for a, b in zip(offsets.tolist(), offsets[1:].tolist()):
        counts: Counter = Counter()
        for words in terms_of(bytes(view[a:b])):
            counts.update(words)
        yield counts


def _item_terms(schema: T.StructType):
    """(item, term) of a batch of items."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 0):
                own = [(i, term) for i, counts in enumerate(_counts(batch.column(0))) for term in counts]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).take(pa.array([i for i, _ in own], pa.int64())),
                     pa.array([term for _, term in own], pa.binary())], schema.names)
    return rows


def _postings(vocabulary: dict[bytes, int]):
    """(id, number of terms, numbers and occurrences of the item terms it holds) of each document with a term."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 0):
                kept, sizes, ends = [], [], [0]
                terms: list[int] = []
                times: list[int] = []
                for i, counts in enumerate(_counts(batch.column(0))):
                    if not counts:
                        continue
                    for term in counts.keys() & vocabulary.keys():
                        terms.append(vocabulary[term])
                        times.append(counts[term])
                    kept.append(i)
                    sizes.append(counts.total())
                    ends.append(len(terms))
                offsets = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).take(pa.array(kept, pa.int64())), pa.array(sizes, pa.int64()),
                     pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                     pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64()))],
                    ["id", "n", "terms", "times"])
    return rows


def _blocks(pairs: DataFrame, most: int, seed: int = 0) -> Iterator[DataFrame]:
    """The (item, term) pairs in parts of whole items, each of at most so many bytes or one item."""
    size, items = pairs.agg(F.sum(F.octet_length("term") + 16), F.countDistinct(F.struct("item"))).first()
    if not size:
        return
    if size <= most or items == 1:
        yield pairs
        return
    parts = -(-2 * size // most)
    for part in range(parts):
        yield from _blocks(pairs.where(F.pmod(F.xxhash64(F.lit(seed), "item"), F.lit(parts)) == part), most, seed + 1)


def masks(presence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Columns of a matrix (terms x documents) ordered by their bits, and where each distinct mask begins."""
    bits = np.packbits(presence, axis=0)
    words = np.zeros((presence.shape[1], -(-len(bits) // 8) * 8), np.uint8)
    words[:, :len(bits)] = bits.T
    words = words.view(np.uint64)
    order = np.lexsort(words.T)
    ordered = words[order]
    return order, np.flatnonzero(np.r_[True, (ordered[1:] != ordered[:-1]).any(axis=1)])


class _Block:
    """Item terms of some documents: for each term its documents and what it adds to their scores."""

    def __init__(self, batch: pa.RecordBatch, weights: np.ndarray, documents: int, occurrences: int):
        self.ids = batch.column(0)
        terms, times = batch.column(2), batch.column(3)
        number = terms.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        terms = terms.flatten().to_numpy(zero_copy_only=False)
        times = times.flatten().to_numpy(zero_copy_only=False)
        # Python's integers: the product may pass 64 bits.
        length = np.array([10 + 90 * n * documents // occurrences for n in batch.column(1).to_pylist()], np.int64)
        doc = np.repeat(np.arange(batch.num_rows), number)
        order = np.argsort(terms, kind="stable")
        terms, self.doc, times = terms[order], doc[order], times[order]
        self.adds = weights[terms] * ((1_000_000_000 * times) // (1000 * times + 8 * length[self.doc]))
        starts = np.flatnonzero(np.r_[True, terms[1:] != terms[:-1]]) if len(terms) else np.empty(0, np.int64)
        self.terms, self.starts, self.ends = terms[starts], starts, np.r_[starts[1:], len(terms)]
        self.most = np.maximum.reduceat(self.adds, starts) if len(starts) else np.empty(0, np.int64)

    def search(self, item: np.ndarray, best: list[tuple], top: int) -> list[tuple]:
        """The `top` best (-score, id is not NULL, id) of an item: those known so far and this block's."""
        place = np.searchsorted(self.terms, item)
        place[place == len(self.terms)] = 0
        own = place[self.terms[place] == item] if len(self.terms) else place[:0]
        own = own[self.most[own] > 0]
        if not len(own) or self.most[own].sum() < least(best, top):
            return best
        width = max(FIRST_LOOK, CELLS // len(own))
        for low in range(0, len(self.ids), width):
            best = self._search(own, low, min(low + width, len(self.ids)), best, top)
        return best

    def _search(self, own: np.ndarray, low: int, high: int, best: list[tuple], top: int) -> list[tuple]:
        presence = np.zeros((len(own), high - low), bool)
        holders, adds = [], []
        for row, o in enumerate(own):
            a, b = self.starts[o], self.ends[o]
            cut = a + np.searchsorted(self.doc[a:b], (low, high))
            holders.append(self.doc[cut[0]:cut[1]] - low)
            adds.append(self.adds[cut[0]:cut[1]])
            presence[row, holders[row]] = True
        order, first = masks(presence)
        ends = np.r_[first[1:], len(order)]
        bound = self.most[own] @ presence[:, order[first]]
        visit = np.argsort(-bound, kind="stable")
        at, look = 0, FIRST_LOOK
        while at < len(visit):
            # No document of a mask scores more than its bound; equal scores may still win by their id.
            live = visit[at:][bound[visit[at:]] >= least(best, top)]
            if not len(live):
                break
            take = int(np.searchsorted(np.cumsum(ends[live] - first[live]), look)) + 1
            docs = np.sort(np.concatenate([order[first[m]:ends[m]] for m in live[:take]]))
            scores = np.zeros(len(docs), np.int64)
            for row in range(len(own)):
                held = presence[row, docs]
                scores[held] += adds[row][np.searchsorted(holders[row], docs[held])]
            best = self._merged(docs + low, scores, best, top)
            at, look = at + take, 2 * look
        return best

    def _merged(self, docs: np.ndarray, scores: np.ndarray, best: list[tuple], top: int) -> list[tuple]:
        good = scores >= least(best, top)
        docs, scores = docs[good], scores[good]
        if len(docs) > top:
            good = scores >= np.partition(scores, -top)[-top]
            docs, scores = docs[good], scores[good]
        ids = self.ids.take(pa.array(docs, pa.int64())).to_pylist()
        return sorted(best + [(-s, i is not None, i) for s, i in zip(scores.tolist(), ids)])[:top]


def least(best: list[tuple], top: int) -> int:
    """Lowest score that can still be among the best."""
    return -best[-1][0] if len(best) == top else 1


def _ranked(items: list[np.ndarray], weights: np.ndarray, documents: int, occurrences: int, top: int):
    """(item number, id, score) of the best documents of a task for each item."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in items]
        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            block = _Block(batch, weights, documents, occurrences)
            best = [block.search(item, known, top) for item, known in zip(items, best)]
        out = [(i, *row) for i, known in enumerate(best) for row in known]
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int32()), pa.array([o[3] for o in out], kind),
                 pa.array([-o[1] for o in out], pa.int64())], ["item", "id", "score"])
    return rows


def ranked_search(docs: DataFrame, items: DataFrame, top: int = 10, block_bytes: int = BLOCK_BYTES,
                  id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """The `top` documents of every item by summed weights of its terms, saturated by occurrences and length.

    One pass over the texts writes, for every document with a term, the item terms it holds; from that
    table come the counts and, block by block in each task, the ranking.  A block's documents are grouped by the mask of an
    item's terms that they hold; masks are evaluated by descending maximum (the sum over its terms of the most that the term
    adds in the block) until the next maximum is below the score of the task's `top`-th best document.  A
    window keeps the best of all tasks.  Columns: the item's id, `rank` (from 1), the document's id, `score`.

    Equal scores rank by ascending id, NULL first.  Repeated documents are documents of their own.  Items of equal id
    (NULL is one) are one item with the terms of all; each term counts once.  NULL and empty texts and those without a term
    are no documents, and rank nothing as items.  Texts of any length are read whole, a piece at a time.
    Empty tables give no rows.  Other columns are not read.  Items of any number are searched for in blocks
    of bounded size, each against all documents.
    """
    spark = docs.sparkSession
    texts = docs.select(whole_text(F.col(f"`{text_col}`")).alias("text"), F.col(f"`{id_col}`").alias("id"))
    tests = items.select(whole_text(F.col(f"`{text_col}`")).alias("text"), F.col(f"`{item_col}`").alias("item"))
    id_type, item_type = texts.schema["id"].dataType, tests.schema["item"].dataType
    pair = T.StructType([T.StructField("item", item_type), T.StructField("term", T.BinaryType())])
    posting = T.StructType([
        T.StructField("id", id_type), T.StructField("n", T.LongType()),
        T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("times", T.ArrayType(T.LongType()))])
    scored = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("id", id_type),
                           T.StructField("score", T.LongType())])
    pairs = saved(tests.mapInArrow(_item_terms(pair), pair).distinct(), "search-terms")
    found = []
    for block in _blocks(pairs, block_bytes):
        own: dict = {}
        vocabulary: dict[bytes, int] = {}
        for row in block.collect():
            own.setdefault(row["item"], []).append(vocabulary.setdefault(bytes(row["term"]), len(vocabulary)))
        postings = saved(texts.mapInArrow(_postings(vocabulary), posting), "search-postings")
        documents, occurrences = postings.agg(F.count(F.lit(1)), F.sum("n")).first()
        holding = (postings.select(F.explode("terms").alias("term")).groupBy("term")
                   .agg(F.count(F.lit(1)).alias("documents")).collect())
        weights = np.zeros(len(vocabulary), np.int64)
        for row in holding:
            weights[row["term"]] = weight(documents, row["documents"])
        ranked = postings.mapInArrow(
            _ranked([np.sort(np.array(t, np.int32)) for t in own.values()], weights, documents, occurrences or 1, top),
            scored)
        names = spark.createDataFrame(list(enumerate(own)), T.StructType([
            T.StructField("item", T.IntegerType()), T.StructField("name", item_type)]))
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc("id"))
        ranked = ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        found.append(ranked.join(names, "item"))
    if not found:
        return spark.createDataFrame([], T.StructType([
            T.StructField(item_col, item_type), T.StructField("rank", T.IntegerType()),
            T.StructField(id_col, id_type), T.StructField("score", T.LongType())]))
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out.select(F.col("name").alias(item_col), "rank", F.col("id").alias(id_col), "score")
