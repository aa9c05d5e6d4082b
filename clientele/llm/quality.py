"""Quality classifier: logistic regression on hashed word n-grams, learnt by FTRL."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.llm.common import crc_of_id, fresh, whole_text
from clientele.llm.words import WordHasher, bytes_of, mixed, ngrams, slices

BITS = 18
#: The most labelled rows (expected number) that a model learns from; larger label tables are thinned
#: by a hash of the id.  They are dealt to `LEARNERS` tasks, whose models are averaged.
MAX_LABELS = 40_000
LEARNERS = 8
#: Weights that are averaged together.
BLOCK = 1 << 12
#: Families of features are means over a text's n-grams; this spreads them to learnable sizes.
SCALE = 8.0


@dataclass(frozen=True)
class Ftrl:
    """Rates and penalties of follow-the-regularised-leader."""
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 1e-4
    l2: float = 1e-4
    passes: int = 5


def _shapes(hashes, owner, starts, ends, data) -> np.ndarray:
    """A number for each word's look: its ends, length, case, and whether it repeats the word before."""
    kind = np.full(256, 1, np.uint64)  # punctuation
    kind[ord("a"):ord("z") + 1] = 2
    kind[ord("A"):ord("Z") + 1] = 3
    kind[ord("0"):ord("9") + 1] = 4
    kind[128:] = 5
    for i, mark in enumerate(b".,;:!?"):
        kind[mark] = 6 + i
    if not len(starts):
        return np.empty(0, np.uint64)
    low = int(starts[0])
    lower = np.concatenate([[0], np.cumsum(kind[data[low:int(ends[-1])]] == 2)])
    no_lower = lower[ends - low] == lower[starts - low]
    length = np.minimum(np.log2(ends - starts).astype(np.uint64), np.uint64(6))
    again = np.r_[False, (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])]
    before_last = np.maximum(ends - 2, starts)
    shape = kind[data[starts]]
    for part, size in ((kind[data[ends - 1]], 16), (kind[data[before_last]], 16), (length, 8),
                       (no_lower.astype(np.uint64), 2), (again.astype(np.uint64), 2)):
        shape = shape * np.uint64(size) + part
    return mixed(shape + np.uint64(1 << 40))


def features(hasher: WordHasher, batch: pa.RecordBatch, text: int, bits: int = BITS):
    """(slot, value, row of the batch) of all features, each occurrence by itself.

    N-grams of one and two words, and of one to three word shapes; the values of either family add up
    to SCALE in a text.
    """
    data, offsets = bytes_of(batch.column(text))
    hashes, owner, starts, ends = hasher.all_words(data, offsets)
    shapes = _shapes(hashes, owner, starts, ends, data)
    mask = np.uint64((1 << bits) - 1)
    out = []
    for numbers, longest in ((hashes, 2), (shapes, 3)):
        parts = [ngrams(numbers, owner, n)[:2] for n in range(1, longest + 1)]
        slots = np.concatenate([p[0] for p in parts]) & mask
        rows = np.concatenate([p[1] for p in parts])
        counts = np.bincount(rows, minlength=batch.num_rows)
        out.append((slots.astype(np.int64), SCALE / counts[rows], rows))
    return tuple(map(np.concatenate, zip(*out)))


def _learner(rates: Ftrl, bits: int):
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, size = WordHasher(), 1 << bits
        examples = []
        for whole in batches:
            for batch in slices(whole, 0):
                slots, values, rows = features(hasher, batch, 0, bits)
                order = np.argsort(rows, kind="stable")
                slots, values, rows = slots[order], values[order], rows[order]
                cuts = np.searchsorted(rows, np.arange(batch.num_rows + 1))
                for i, label in enumerate(batch.column(1).to_pylist()):
                    own, place = np.unique(slots[cuts[i]:cuts[i + 1]], return_inverse=True)
                    x = np.bincount(place, weights=values[cuts[i]:cuts[i + 1]], minlength=len(own))
                    examples.append((np.r_[own, size].astype(np.int32), np.r_[x, 1.0].astype(np.float32),
                                     label))
        if not examples:
            return
        z, n = np.zeros(size + 1), np.zeros(size + 1)

        def weights(z, n):
            w = -(z - np.sign(z) * rates.l1) / ((rates.beta + np.sqrt(n)) / rates.alpha + rates.l2)
            return np.where(np.abs(z) <= rates.l1, 0.0, w)

        for _ in range(rates.passes):
            for own, x, label in examples:
                w = weights(z[own], n[own])
                p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
                g = (p - label) * x
                s = (np.sqrt(n[own] + g * g) - np.sqrt(n[own])) / rates.alpha
                z[own] += g - s * w
                n[own] += g * g
        model = weights(z, n).astype(np.float32)
        parts = [model[i:i + BLOCK].tobytes() for i in range(0, size + 1, BLOCK)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(parts)), pa.int32()), pa.array([len(examples)] * len(parts), pa.int64()),
             pa.array(parts, pa.binary())], ["block", "examples", "weights"])
    return learn


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From blocks of models, sorted by block: for each block the examples, and weights times examples, summed."""
    def out(block: int, examples: int, sums: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int32()), pa.array([examples], pa.int64()), pa.array([sums.tobytes()], pa.binary())],
            ["block", "examples", "sums"])

    held = None
    for batch in batches:
        for block, examples, part in zip(*(c.to_pylist() for c in batch.columns[:3])):
            sums = np.frombuffer(part, np.float32).astype(np.float64) * examples
            if held and held[0] == block:
                held = block, held[1] + examples, held[2] + sums
            else:
                if held:
                    yield out(*held)
                held = block, examples, sums
    if held:
        yield out(*held)


def learn_quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality",
                  id_col: str = "doc_id", text_col: str = "text", rates: Ftrl = Ftrl(),
                  max_labels: int = MAX_LABELS, bits: int = BITS) -> np.ndarray:
    """Weights of the hashed features, the last one for every text.

    `labels` holds ids and labels 0 or 1; rows without either are left out, and a text with several
    labels is learnt with each.  Without any labelled text all weights are 0.
    """
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("label")).dropna()
    share = min(1.0, max_labels / max(1, marks.count()))
    if share < 1:
        marks = marks.where(F.pmod(F.xxhash64(F.lit("labels"), "id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    # At most max_labels rows of two numbers, so they go to the texts rather than the texts to them.
    examples = (docs.select(F.col(id_col).alias("id"), whole_text(F.col(text_col)).alias("text"))
                .join(F.broadcast(marks), "id")
                .repartition(LEARNERS, F.xxhash64(F.lit("learner"), "id", "text"))
                .sortWithinPartitions(F.xxhash64("id", "text"), "label").select("text", "label"))
    models = (examples.mapInArrow(_learner(rates, bits), "block int, examples long, weights binary")
              .withColumn("learner", F.spark_partition_id()))
    # Models are averaged where they are, a block by itself; the driver gets the mean alone, however many learnt.
    sums = (models.repartition("block").sortWithinPartitions("block", "learner")
            .mapInArrow(_summed, "block int, examples long, sums binary"))
    mean = np.zeros((1 << bits) + 1)
    for row in sums.collect():
        part = np.frombuffer(row["sums"]) / row["examples"]
        mean[row["block"] * BLOCK:][:len(part)] = part
    return mean.astype(np.float32)


def quality_scores(docs: DataFrame, weights: np.ndarray, text_col: str = "text",
                   to: str = "score") -> DataFrame:
    """All rows of `docs` with `to`, the probability of label 1, from the whole text alone.

    NULL and empty texts have the score of the constant.  A column of that name is replaced.
    """
    bits = (len(weights) - 1).bit_length() - 1
    kept = [c for c in docs.columns if c != to]
    numbered = docs.select(whole_text(F.col(f"`{text_col}`")).alias(fresh(docs.columns, "text_read")), *[f"`{c}`" for c in kept])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for whole in batches:
            for batch in slices(whole, 0):
                slots, values, rows = features(hasher, batch, 0, bits)
                logit = weights[-1] + np.bincount(rows, weights=weights[slots] * values,
                                                  minlength=batch.num_rows)
                scores = 1 / (1 + np.exp(-np.clip(logit, -35, 35)))
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(scores, pa.float64())],
                                                 [*kept, to])

    schema = T.StructType([*[docs.schema[c] for c in kept], T.StructField(to, T.DoubleType())])
    return numbered.mapInArrow(score, schema)


def learn_from_fold(docs: DataFrame, labels: DataFrame, label_col: str = "quality") -> np.ndarray:
    """The model of the labels outside the held-out fold, which are the ids of crc32 divisible by 5."""
    return learn_quality(docs, labels.where(crc_of_id(F.col("doc_id")) % 5 != 0), label_col)
