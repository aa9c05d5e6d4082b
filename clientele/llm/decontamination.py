"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.llm.common import fresh, whole_text
from clientele.llm.words import WordHasher, bytes_of, ngrams, slices

SEED_WORDS = 2
#: Alignment score over the item's number of words from which a passage is a copy.
THRESHOLD = 0.5
#: Words of test items that a task holds at a time; a larger benchmark is searched for in several passes.
BLOCK_WORDS = 1_000_000

#: Hits of seeds that a task spreads over the items at a time, one text's at least.
MOST_HITS = 1_000_000

MATCH, MISMATCH, GAP = 1, -1, -1


def least_score(words, threshold: float):
    """Lowest score of a copy of an item of so many words."""
    return np.ceil(threshold * words - 1e-9).astype(np.int64)


def fewest_shared(words, threshold: float):
    """Fewest places of an item of so many words whose seed a passage at the threshold shares, at least 0.

    m matches and e edits score m - e >= t.  The matches form e + 1 runs at most, and a run shares all but one of its
    words as beginnings of pairs: m - (e + 1) >= t - 1 places in all, whatever the edits are.
    """
    return np.maximum(0, least_score(words, threshold) - 1)


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Score of the best local alignment of two word sequences, and where it lies in the passage [from, to)."""
    columns = np.arange(len(passage) + 1)
    row = np.zeros(len(passage) + 1, np.int64)
    begin = columns.copy()  # where the alignment that ends in a cell begins
    best, span = 0, (0, 0)
    for word in item:
        diagonal = row[:-1] + np.where(passage == word, MATCH, MISMATCH)
        above = row[1:] + GAP
        cell = np.concatenate([[0], np.maximum(np.maximum(diagonal, above), 0)])
        start = np.concatenate([[0], np.where(diagonal >= above, begin[:-1], begin[1:])])
        start = np.where(cell > 0, start, columns)
        # A run of gaps costs the same each step, so the best cell to the left is a running maximum.
        raised = cell - GAP * columns
        top = np.maximum.accumulate(raised)
        source = np.maximum.accumulate(np.where(raised == top, columns, 0))
        row = top + GAP * columns
        begin = np.where(row > 0, start[source], columns)
        end = int(np.argmax(row))
        if row[end] > best:
            best, span = int(row[end]), (int(begin[end]), end)
    return best, *span


class Items:
    """Words of some test items, and which item and place has each seed."""

    def __init__(self, hasher: WordHasher, ids: list, texts: list[str]):
        data, offsets = bytes_of(pa.array(texts, pa.string()))
        hashes, owner, *_ = hasher.all_words(data, offsets)
        self.ids = ids
        cuts = np.searchsorted(owner, np.arange(len(ids) + 1))
        self.words = [hashes[a:b] for a, b in zip(cuts, cuts[1:])]
        seeds, item, start = ngrams(hashes, owner, SEED_WORDS)
        order = np.argsort(seeds, kind="stable")
        self.seeds, self.item, self.place = seeds[order], item[order], (start - cuts[item])[order]
        self.distinct = np.unique(self.seeds)

    def rare(self, counts: dict[int, int], threshold: float) -> None:
        """Keep as many places of each item as it needs, those with the rarest seeds in the documents.

        Seeds of no document are shared with none.  Of f places with other seeds a copy shares m at least, so it
        meets any f - m + 1 of them, and an item with f < m has no copy.  Of equally rare places the first stay.
        """
        number = np.array([counts.get(i, 0) for i in range(len(self.distinct))], np.int64)
        number = number[np.searchsorted(self.distinct, self.seeds)]
        length = np.array([len(w) for w in self.words], np.int64)
        found = np.bincount(self.item[number > 0], minlength=len(self.ids))
        needed = found - np.maximum(fewest_shared(length, threshold), 1) + 1
        order = np.lexsort((self.place, number, number == 0, self.item))
        first = np.searchsorted(self.item[order], np.arange(len(self.ids)))
        rank = np.arange(len(order)) - first[self.item[order]]
        keep = np.sort(order[rank < needed[self.item[order]]])
        self.seeds, self.item, self.place = self.seeds[keep], self.item[keep], self.place[keep]


def _counted(items: Items):
    """How many texts of a task have each seed."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, total = WordHasher(), np.zeros(len(items.distinct), np.int64)
        for whole in batches:
            for batch in slices(whole, 0):
                hashes, owner, *_ = hasher.all_words(*bytes_of(batch.column(0)))
                seeds, text, _ = ngrams(hashes, owner, SEED_WORDS)
                place = np.searchsorted(items.distinct, seeds)
                place[place == len(items.distinct)] = 0
                hit = items.distinct[place] == seeds
                pairs = np.unique(text[hit] * len(items.distinct) + place[hit])
                total += np.bincount(pairs % len(items.distinct), minlength=len(total))
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found], pa.int64())],
                                         ["seed", "texts"])
    return rows


def _passages(doc: np.ndarray, item: np.ndarray, place: np.ndarray, length: np.ndarray, least: np.ndarray):
    """(item, from, to) of the stretches of a text around its seeds; those of an item that overlap are one.

    A copy has no more words put in than its item's words less its score.
    """
    order = np.lexsort((doc - place, item))
    doc, item, place = doc[order], item[order], place[order]
    slack = length[item] - least[item] + 1
    low, high = doc - place - slack, doc - place + length[item] + slack
    fresh = np.r_[True, (item[1:] != item[:-1]) | (low[1:] > high[:-1])]
    first = np.flatnonzero(fresh)
    return zip(item[first], low[first], np.maximum.reduceat(high, first) if len(first) else high)


def _runs(times: np.ndarray, text: np.ndarray):
    """(from, to) of runs of hits that spread to about MOST_HITS; a text is cut only where it alone has more."""
    total, low = np.r_[0, np.cumsum(times)], 0
    while low < len(times):
        high = max(low + 1, int(np.searchsorted(total, total[low] + MOST_HITS, side="right")) - 1)
        if high < len(times) and text[high] != text[low]:
            high = int(np.searchsorted(text, text[high]))
        yield low, high
        low = high


def find_copies(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD,
                block_words: int = BLOCK_WORDS, id_col: str = "doc_id",
                text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """Documents with a copy, also an edited one, of a test item: a row for each pair.

    Words are compared in lower case (A-Z).  An item's seeds are its pairs of neighbouring words; the rarest in the
    documents (counted over all of them) lead to the stretches of text around them, and each stretch is aligned with
    the item by Smith-Waterman (match 1, other word or gap -1).  A pair is a copy if the best score is at least
    `threshold` times the item's words and it shares a seed.  As many seeds are used as no copy can miss
    (`fewest_shared`): from a score of two matches up, the result is that of aligning every document with every item.

    Columns: the ids, `item_words`, `score` (share of the item's words), `first_word` and `end_word` (the best
    passage in the document, counted in words; of equal scores the first).  Items of under two words, NULL or
    empty, and texts without two words, match nothing; without documents or items there are no rows.  Long texts are
    read whole, hits are spread over items a bounded number at a time.  Repeated documents give repeated rows; repeated
    items and NULL ids give a row each; other columns, whatever their names, are not read.  Benchmarks of any size are
    searched for in blocks of bounded size, each against all documents.
    """
    spark = docs.sparkSession
    texts = docs.select(whole_text(F.col(text_col)).alias("text"), F.col(id_col).alias("id"))
    tests = benchmark.select(F.col(item_col).alias("item"), whole_text(F.col(text_col)).alias("text"))
    # A word has two bytes at least with its space.
    total = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // (2 * block_words)))
    schema = T.StructType([
        T.StructField(id_col, texts.schema["id"].dataType), T.StructField(item_col, tests.schema["item"].dataType),
        T.StructField("item_words", T.LongType()), T.StructField("score", T.DoubleType()),
        T.StructField("first_word", T.LongType()), T.StructField("end_word", T.LongType())])
    found = []
    for block in range(blocks):
        own = tests.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).collect()
        items = Items(WordHasher(), [r["item"] for r in own], [r["text"] for r in own])
        if not len(items.seeds):
            continue
        counts = (texts.select("text").mapInArrow(_counted(items), "seed long, texts long")
                  .groupBy("seed").agg(F.sum("texts").alias("texts")).collect())
        items.rare({r["seed"]: r["texts"] for r in counts}, threshold)
        if not len(items.seeds):
            continue
        found.append(texts.mapInArrow(_aligned(items, threshold, schema), schema))
    if not found:
        return spark.createDataFrame([], schema)
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def _aligned(items: Items, threshold: float, schema: T.StructType):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        length = np.array([len(w) for w in items.words])
        least = least_score(length, threshold)
        own = [np.unique(w, return_counts=True) for w in items.words]

        def within_reach(item: int, passage: np.ndarray) -> bool:
            """Whether enough of the item's words, in any order, are in the passage; less cannot score enough."""
            words, times = own[item]
            place = np.minimum(np.searchsorted(words, passage), len(words) - 1)
            held = np.bincount(place[words[place] == passage], minlength=len(words))
            return int(np.minimum(held, times).sum()) >= least[item]

        distinct, first = np.unique(items.seeds, return_index=True)
        many = np.diff(np.r_[first, len(items.seeds)])
        for whole in batches:
            for batch in slices(whole, 0):
                hashes, owner, *_ = hasher.all_words(*bytes_of(batch.column(0)))
                cuts = np.searchsorted(owner, np.arange(batch.num_rows + 1))
                seeds, text, start = ngrams(hashes, owner, SEED_WORDS)
                place = np.searchsorted(distinct, seeds)
                place[place == len(distinct)] = 0
                hit = np.flatnonzero(distinct[place] == seeds)
                place = place[hit]
                best: dict[tuple[int, int], tuple[int, int, int]] = {}
                for low, high in _runs(many[place], text[hit]):
                    # Each hit once for every item and place that has the seed.
                    times = many[place[low:high]]
                    hits = np.repeat(hit[low:high], times)
                    which = np.repeat(first[place[low:high]], times) + (
                        np.arange(len(hits)) - np.repeat(np.cumsum(times) - times, times))
                    borders = np.searchsorted(text[hits], np.arange(batch.num_rows + 1))
                    for i in np.flatnonzero(np.diff(borders)):
                        a, b = borders[i], borders[i + 1]
                        words = hashes[cuts[i]:cuts[i + 1]]
                        for item, begin, end in _passages(start[hits[a:b]] - cuts[i], items.item[which[a:b]],
                                                          items.place[which[a:b]], length, least):
                            begin = max(0, int(begin))
                            if not within_reach(item, words[begin:int(end)]):
                                continue
                            score, left, right = align(items.words[item], words[begin:int(end)])
                            copy = score, -begin - left, -begin - right
                            if score >= least[item] and copy > best.get((int(i), int(item)), (0,)):
                                best[int(i), int(item)] = copy
                out = [(*pair, score, -low, -high) for pair, (score, low, high) in sorted(best.items())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).take(pa.array([o[0] for o in out], pa.int64())),
                     pa.array([items.ids[o[1]] for o in out], _arrow(schema[1].dataType)),
                     pa.array([int(length[o[1]]) for o in out], pa.int64()),
                     pa.array([o[2] / int(length[o[1]]) for o in out], pa.float64()),
                     pa.array([o[3] for o in out], pa.int64()), pa.array([o[4] for o in out], pa.int64())],
                    schema.names)
    return rows


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(kind)


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of `docs`, with all columns, whose id has no copy of a test item."""
    key = fresh(docs.columns, "key_id")
    leaked = find_copies(docs, benchmark, id_col=id_col).select(F.col(id_col).alias(key)).distinct()
    return docs.join(leaked, F.col(f"`{id_col}`").eqNullSafe(F.col(key)), "left_anti")
