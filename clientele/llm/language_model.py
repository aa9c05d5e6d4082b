"""Log-probabilities of texts under a small causal self-attention model."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.llm.common import crc_of_id, saved, whole_text
from clientele.llm.packing import END_OF_TEXT, PATTERN, RANKS
from clientele.llm.words import WordHasher, bytes_of, slices

#: Classes of next words, and symbols of words read; both have a place for the rest.
CLASSES = 128
SYMBOLS = 256
WIDTH = 32
#: Places that a window scores; it reads as many before them.
BLOCK = 16
#: Words whose counts go to every task; the others' counts are joined.
FREQUENT = 1 << 17
#: Windows of training texts, all of which the weights are fitted to once, that a part holds.
WINDOWS_PER_PART = 64_000
BATCH = 32
RATE = 0.005
#: Blocks scored at a time, so that their logits fit a processor's cache.
CHUNK = 256
#: Distinct words of which a task remembers the subword ids, 16 bytes each.
MEMORY = 1 << 20

#: White space that can stand in a word.
OTHER_SPACE = re.compile(r"[^\S ]")
END_HASH = np.uint64(0x656E64)  # stands for the end of a text; words' hashes are spread over all 64 bits
OUTSIDE = (1 << 32) - 1  # -1 as an unsigned number
PAD, START = SYMBOLS - 1, SYMBOLS - 2  # symbols of places before a text and of its start


@dataclass
class Head:
    """The most frequent words of the training texts, in the order of their hashes, with their pairs and counts."""
    words: np.ndarray
    pairs: np.ndarray
    times: np.ndarray

    def places(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of each word, if it is here, whether it is)."""
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return at, self.words[at] == words


class Subwords:
    """First and last subword id of words, found once for each distinct word of a task.

    Those of `head`, the most frequent words in order, come with it.
    """

    def __init__(self, lines: bytes, head: Head | None = None):
        self.head = head
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines.splitlines())}
        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, special_tokens={}, mergeable_ranks=ranks)
        self.begins = np.zeros(65_536, bool)
        self.begins[[rank for token, rank in ranks.items() if token[:1] == b" "]] = True
        self._forget()

    def _forget(self) -> None:
        self.known = Head(np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0))

    def of(self, words: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """first * 65536 + last for each of some distinct words in order, which lie at these places of the text."""
        out, new = np.empty(len(words), np.int64), np.ones(len(words), bool)
        for memory in (self.head, self.known):
            if memory is not None and len(memory.words):
                at, held = memory.places(words)
                out[held] = memory.pairs[at[held]]
                new &= ~held
        if new.any():
            raw = data.tobytes()
            out[new] = self.split([raw[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist())])
            if len(self.known.words) + new.sum() > MEMORY:
                self._forget()
            at = np.searchsorted(self.known.words, words[new])
            self.known = Head(np.insert(self.known.words, at, words[new]), np.insert(self.known.pairs, at, out[new]),
                              self.known.times)
        return out

    def split(self, words: list[bytes]) -> np.ndarray:
        """The pairs of words, which are encoded in one text: no piece of it reaches over the space before a word.

        Words that hold other white space, which pieces may take together with that space, are encoded alone.
        """
        text = b" ".join(words).lower().decode(errors="replace")
        out = np.empty(len(words), np.int64)
        alone = np.zeros(len(words), bool)
        if OTHER_SPACE.search(text):
            each = text.split(" ")
            alone[:] = [OTHER_SPACE.search(word) is not None for word in each]
            text = " ".join(word for word, odd in zip(each, alone) if not odd)
            for i in np.flatnonzero(alone).tolist():
                ids = self.encoding.encode_ordinary(" " + each[i])
                out[i] = ids[0] * 65_536 + ids[-1]
        if not alone.all():
            ids = np.array(self.encoding.encode_ordinary(" " + text), np.int64)
            first = np.flatnonzero(self.begins[ids])
            out[~alone] = ids[first] * 65_536 + ids[np.append(first[1:], len(ids)) - 1]
        return out


def _read(subwords: Subwords, hasher: WordHasher, batch: pa.RecordBatch):
    """(distinct words, their pairs of ids, which of them each token is, how many tokens each text has).

    The end of each text is its last token.
    """
    data, offsets = bytes_of(batch.column(0))
    base = int(offsets[0])
    data, offsets = data[base:int(offsets[-1])], offsets - base
    hashes, owner, starts, ends = hasher.all_words(data, offsets)
    words, first, place = np.unique(hashes, return_index=True, return_inverse=True)
    pairs = subwords.of(words, data, starts[first], ends[first])
    counts = np.bincount(owner, minlength=batch.num_rows)
    tokens = np.insert(place, np.cumsum(counts), len(words))
    return np.append(words, END_HASH), np.append(pairs, END_OF_TEXT * 65_537), tokens, counts + 1


def _counted(lines: bytes):
    """(word, pair, count) of a task's training texts, and the pairs of each text's tokens as unsigned 32-bit numbers.

    A row has either the first three or the last.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        subwords, hasher = Subwords(lines), WordHasher()
        held: list[tuple[np.ndarray, ...]] = []

        def merged():
            words, pairs, times = map(np.concatenate, zip(*held))
            distinct, first, place = np.unique(words, return_index=True, return_inverse=True)
            return distinct, pairs[first], np.bincount(place, weights=times).astype(np.int64)

        for whole in batches:
            for batch in slices(whole, 0):
                words, pairs, tokens, counts = _read(subwords, hasher, batch)
                held.append((words, pairs, np.bincount(tokens, minlength=len(words))))
                yield tokens_of(pairs[tokens], counts)
                if len(held) >= 8:
                    held = [merged()]
                    if len(held[0][0]) > 300_000:
                        yield out(*held[0])
                        held = []
        if held:
            yield out(*merged())

    names = ["word", "pair", "count", "tokens"]

    def out(words, pairs, times) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(pairs), pa.array(times),
                                           pa.nulls(len(words), pa.binary())], names)

    def tokens_of(pairs, counts) -> pa.RecordBatch:
        places = np.r_[0, np.cumsum(counts)].astype(np.int64) * 4
        tokens = pa.Array.from_buffers(pa.large_binary(), len(counts), [
            None, pa.py_buffer(places.tobytes()), pa.py_buffer(pairs.astype(np.uint32).tobytes())])
        return pa.RecordBatch.from_arrays([*[pa.nulls(len(counts), pa.int64())] * 3, tokens.cast(pa.binary())], names)
    return rows


def _windows(lines: bytes | None = None, head: Head | None = None):
    """All windows of a task's training texts, by the pairs of their tokens; of texts, or (binary) of their pairs.

    A window is 2 * BLOCK tokens and the one before, one byte string of unsigned 32-bit numbers; places outside the
    text are OUTSIDE.  The second half is scored, and each token of a text is in one such half.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        subwords, hasher = lines and Subwords(lines, head), WordHasher()
        for whole in batches:
            for batch in slices(whole, 0):
                if lines is None:
                    data, offsets = bytes_of(batch.column(0))
                    told, counts = data[offsets[0]:offsets[-1]].view(np.uint32).astype(np.int64), np.diff(offsets) // 4
                else:
                    _, pairs, tokens, counts = _read(subwords, hasher, batch)
                    told = pairs[tokens]
                placed, scored, _ = _places(told, counts)
                # The token before a window's first place is read at that place.
                both = np.concatenate([np.where(scored >= 2, placed[scored - 2, -1], -1)[:, None], placed[scored - 1],
                                       placed[scored]], axis=1).astype(np.uint32)
                size = both.shape[1] * 4
                windows = pa.Array.from_buffers(pa.binary(size), len(both), [None, pa.py_buffer(both.tobytes())])
                yield pa.RecordBatch.from_arrays([windows.cast(pa.binary())], ["window"])
    return rows


def _places(pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts as blocks of BLOCK places with a block of padding in front of each: (pair or -1, blocks to score, places)."""
    blocks = -(-counts // BLOCK) + 1
    begin = np.cumsum(blocks) - blocks
    total = int(blocks.sum())
    text = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(len(pairs)) - np.repeat(np.cumsum(counts) - counts, counts)
    place = (begin[text] + 1) * BLOCK + within
    placed = np.full(total * BLOCK, -1, np.int64)
    placed[place] = pairs
    scored = np.ones(total, bool)
    scored[begin] = False
    return placed.reshape(total, BLOCK), np.flatnonzero(scored), place


@dataclass
class Vocabulary:
    """What subword ids stand for in the model; all of it from counts over all training texts.

    The class of a word is its own for the most frequent pairs of first and last id, else its last id's.
    Read words are a symbol for the first id and one for the last.
    """
    pairs: np.ndarray
    class_of_last: np.ndarray
    symbol_of_first: np.ndarray
    symbol_of_last: np.ndarray

    def classes(self, pairs: np.ndarray) -> np.ndarray:
        place = np.minimum(np.searchsorted(self.pairs, pairs), max(0, len(self.pairs) - 1))
        own = self.pairs[place] == pairs if len(self.pairs) else np.zeros(len(pairs), bool)
        return np.where(own, place, self.class_of_last[pairs & 65_535]).astype(np.int16)


def _vocabulary(counts: DataFrame) -> Vocabulary:
    """At most a few hundred rows reach the driver."""
    half = CLASSES // 2
    first, last = F.floor(F.col("pair") / 65_536).cast("long"), F.col("pair") % 65_536
    by = lambda key: counts.groupBy(key.alias("key")).agg(F.sum("count").alias("n")).orderBy(
        F.desc("n"), "key")
    pairs = np.sort(np.array([r["key"] for r in by(F.col("pair")).limit(half).collect()], np.int64))
    rest = counts.where(~F.col("pair").isin([int(p) for p in pairs])) if len(pairs) else counts
    class_of_last = np.full(65_536, CLASSES - 1, np.int16)
    for i, r in enumerate(rest.groupBy(last.alias("key")).agg(F.sum("count").alias("n"))
                          .orderBy(F.desc("n"), "key").limit(half - 1).collect()):
        class_of_last[r["key"]] = half + i
    symbols = []
    for key in (first, last):
        table = np.full(65_536, SYMBOLS - 3, np.int16)
        for i, r in enumerate(by(key).limit(SYMBOLS - 3).collect()):
            table[r["key"]] = i
        symbols.append(table)
    return Vocabulary(pairs, class_of_last, *symbols)


def _symbols(vocabulary: Vocabulary, placed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first symbol read, last symbol read, class told) at each place of rows of tokens.

    A place reads the token before it in the row; the first of a text reads its start.  The row's first
    place is only there to be read.  Places without a token tell -1, and those before a text read padding.
    """
    told, before = placed[:, 1:], placed[:, :-1]
    out = [np.where(told >= 0, vocabulary.classes(np.maximum(told, 0).ravel()).reshape(told.shape), np.int16(-1))]
    for table, ids in ((vocabulary.symbol_of_last, before & 65_535), (vocabulary.symbol_of_first, before >> 16)):
        read = table[np.maximum(ids, 0)]
        out.insert(0, np.where(before >= 0, read, np.where(told >= 0, np.int16(START), np.int16(PAD))))
    return tuple(out)


class Attention:
    """One layer of causal self-attention over the symbols of words, and a softmax over the next word's class.

    Places attend to themselves and to what stands before them in their block and the block before; scores
    have a learnt bias for each distance.  A block's keys and values are computed once for both windows that
    read it, and the windows of a batch are multiplied at once under one mask.
    """

    SHAPES = {"first": (SYMBOLS, WIDTH), "last": (SYMBOLS, WIDTH), "query": (WIDTH, WIDTH), "key": (WIDTH, WIDTH),
              "value": (WIDTH, WIDTH), "distance": (2 * BLOCK,), "out": (WIDTH, CLASSES), "skip": (WIDTH, CLASSES),
              "bias": (CLASSES,)}
    _AGO = BLOCK + np.arange(BLOCK)[:, None] - np.arange(2 * BLOCK)[None, :]
    _PAST = np.maximum(_AGO, 0)
    _FUTURE = np.where(_AGO >= 0, 0, -1e9).astype(np.float32)
    _ROWS = np.arange(SYMBOLS * WIDTH).reshape(SYMBOLS, WIDTH)

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = {k: v.astype(np.float32) for k, v in weights.items()}

    @classmethod
    def start(cls, prior: np.ndarray) -> dict[str, np.ndarray]:
        rng = np.random.default_rng(1)
        small = {"first": 0.3, "last": 0.3, "query": 0.1, "key": 0.1, "value": 0.2, "out": 0.05, "skip": 0.05}
        out = {k: rng.normal(0, small.get(k, 0), s).astype(np.float32) for k, s in cls.SHAPES.items()}
        return out | {"bias": np.log(prior).astype(np.float32)}

    def _forward(self, one, two, scored):
        w = self.w
        x = w["first"][one] + w["last"][two]
        q = x[scored] @ w["query"]
        k, v = x @ w["key"], x @ w["value"]
        keys = np.concatenate([k[scored - 1], k[scored]], axis=1)
        values = np.concatenate([v[scored - 1], v[scored]], axis=1)
        hidden = np.concatenate([one[scored - 1], one[scored]], axis=1) == PAD
        bias = np.where(self._AGO >= 0, w["distance"][np.maximum(self._AGO, 0)], -1e9).astype(np.float32)
        scores = q @ keys.transpose(0, 2, 1) * np.float32(WIDTH ** -0.5) + bias
        scores = np.where(hidden[:, None, :], np.float32(-1e9), scores)
        np.exp(scores - scores.max(axis=2, keepdims=True), out=scores)
        scores /= scores.sum(axis=2, keepdims=True)
        read = scores @ values
        logits = read @ w["out"] + x[scored] @ w["skip"] + w["bias"]
        return x, q, keys, values, scores, read, logits

    def log_probabilities(self, one, two, told, scored) -> np.ndarray:
        """Natural logarithms for the told classes of the scored blocks; 0 where none is told.

        The same as `_forward` and a softmax, in few passes over memory.  Logits beyond what a 32-bit
        exponential holds would give infinity; such blocks take the longer way.
        """
        w, width = self.w, WIDTH
        out = np.zeros(told.shape, np.float64)
        bias = np.where(self._AGO >= 0, w["distance"][np.maximum(self._AGO, 0)], -1e9).astype(np.float32)
        ones = np.ones((CLASSES, 1), np.float32)
        # What each pair of symbols that occurs gives is computed once, and each place takes its row.
        code = one.astype(np.int32) * SYMBOLS + two
        used = np.zeros(SYMBOLS * SYMBOLS, bool)
        used[code.ravel()] = True
        pairs = np.flatnonzero(used)
        code = (np.cumsum(used) - 1)[code]
        x = w["first"][pairs // SYMBOLS] + w["last"][pairs % SYMBOLS]
        stored, asked = x @ np.concatenate([w["key"], w["value"]], axis=1), x @ (w["query"] * np.float32(width ** -0.5))
        skipped = x @ w["skip"] + w["bias"]
        seen = (one != PAD).astype(np.float32)
        for low in range(0, len(scored), CHUNK):
            own = scored[low:low + CHUNK]
            begin, end = int(own[0]), int(own[-1]) + 1
            here, chosen = slice(begin, end), slice(None) if end - begin == len(own) else own - begin
            # A block and the one before lie side by side, so the rows that it reads need no copy.
            both = _with_block_before(stored.take(code[begin - 1:end].ravel(), axis=0).reshape(-1, BLOCK, 2 * width))
            query = asked.take(code[here].ravel(), axis=0).reshape(-1, BLOCK, width)
            scores = query @ both[:, :, :width].transpose(0, 2, 1)
            scores += bias
            with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
                np.exp(scores, out=scores)
                scores *= _with_block_before(seen[begin - 1:end, :, None]).transpose(0, 2, 1)
                read = scores @ both[:, :, width:]
                read /= (scores.reshape(-1, 2 * BLOCK) @ ones[:2 * BLOCK]).reshape(-1, BLOCK, 1)
                logits = read[chosen].reshape(-1, width) @ w["out"]
                logits += skipped.take(code[own].ravel(), axis=0)
                target = told[own]
                picked = logits[np.arange(len(logits)), np.maximum(target, 0).ravel()]
                np.exp(logits, out=logits)
                value = (picked - np.log((logits @ ones)[:, 0])).reshape(target.shape)
            if not np.isfinite(value[target >= 0]).all():
                span = slice(begin - 1, end)
                logits = self._forward(one[span], two[span], own - begin + 1)[-1].astype(np.float64)
                top = logits.max(axis=2, keepdims=True)
                picked = np.take_along_axis(logits - top, np.maximum(target, 0)[:, :, None].astype(np.int64), axis=2)
                value = picked[:, :, 0] - np.log(np.exp(logits - top).sum(axis=2))
            out[own] = np.where(target >= 0, value, 0.0)
        return out

    def gradients(self, one, two, told) -> dict[str, np.ndarray]:
        """Of the mean negative log-probability over windows of two blocks each (even: context, odd: scored).

        Products are of two-dimensional arrays and in few passes over memory, since a batch is small.
        Exponentials beyond 32 bits are taken again relative to their greatest.
        """
        w, width = self.w, WIDTH
        windows, places = len(one) // 2, 2 * BLOCK
        one, two = one.reshape(windows, places), two.reshape(windows, places)
        target = told.reshape(windows, places)[:, BLOCK:].ravel()
        real = np.flatnonzero(target >= 0)
        bias = w["distance"].take(self._PAST) + self._FUTURE
        mix = w["query"] * np.float32(width ** -0.5)
        x = w["first"].take(one.ravel(), axis=0)
        x += w["last"].take(two.ravel(), axis=0)
        # Told from: what attention read, the place's own symbols, and a one for the bias.
        both = np.ones((windows, BLOCK, 2 * width + 1), x.dtype)
        both[:, :, width:2 * width] = x.reshape(windows, places, width)[:, BLOCK:]
        flat_both = both.reshape(-1, 2 * width + 1)
        own = flat_both[:, width:2 * width]
        store = np.concatenate([w["key"], w["value"]], axis=1)
        kept = (x @ store).reshape(windows, places, 2 * width)
        keys, values = kept[:, :, :width], kept[:, :, width:]
        q = (own @ mix).reshape(windows, BLOCK, width)
        scores = q @ keys.transpose(0, 2, 1)
        scores += bias
        attention, sums = self._exponentials(scores, (one != PAD)[:, None, :])
        attention /= sums
        np.matmul(attention, values, out=both[:, :, :width])
        turned = np.concatenate([w["out"], w["skip"], w["bias"][None]])
        d_logits, sums = self._exponentials(flat_both @ turned, np.True_)
        share = np.float32(1 / max(1, len(real)))
        d_logits *= np.where(target >= 0, share, np.float32(0))[:, None] / sums
        d_logits[real, target[real]] -= share
        g_both, d_both = flat_both.T @ d_logits, d_logits @ turned[:-1].T
        g = {"out": g_both[:width], "skip": g_both[width:-1], "bias": g_both[-1]}
        d_read = d_both.reshape(windows, BLOCK, 2 * width)[:, :, :width]
        d_scores = d_read @ values.transpose(0, 2, 1)
        d_kept = np.empty_like(kept)
        np.matmul(attention.transpose(0, 2, 1), d_read, out=d_kept[:, :, width:])
        # Attention times its gradients sums, over the places, to what was read times the gradient of that.
        d_scores -= np.einsum("wpi,wpi->wp", both[:, :, :width], d_read)[:, :, None]
        d_scores *= attention
        by_place = np.ones(windows, d_scores.dtype) @ d_scores.reshape(windows, -1)
        g["distance"] = np.bincount(self._PAST.ravel(), weights=by_place * (self._AGO >= 0).ravel(), minlength=places)
        d_q = (d_scores @ keys).reshape(-1, width)
        np.matmul(d_scores.transpose(0, 2, 1), q, out=d_kept[:, :, :width])
        flat = d_kept.reshape(-1, 2 * width)
        g["query"] = (own.T @ d_q) * np.float32(width ** -0.5)
        g_store = x.T @ flat
        g["key"], g["value"] = g_store[:, :width], g_store[:, width:]
        d_x = flat @ store.T
        d_own = d_q @ mix.T
        d_own += d_both[:, width:]
        d_x.reshape(windows, places, width)[:, BLOCK:] += d_own.reshape(windows, BLOCK, width)
        numbers = d_x.ravel().astype(np.float64)
        for name, symbols in (("first", one), ("last", two)):
            places_of = self._ROWS.take(symbols.ravel(), axis=0).ravel()
            g[name] = np.bincount(places_of, weights=numbers, minlength=SYMBOLS * width).reshape(SYMBOLS, width)
        return g

    @staticmethod
    def _exponentials(rows: np.ndarray, shown: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(exponentials, 0 where not shown, sum of each row); relative to the greatest if 32 bits can't hold them."""
        ones, flat = np.ones((rows.shape[-1], 1), rows.dtype), (-1, rows.shape[-1])
        sizes = (*rows.shape[:-1], 1)
        with np.errstate(over="ignore", under="ignore", invalid="ignore"):
            out = np.exp(rows)
            if not shown.all():
                out *= shown.astype(rows.dtype)
            sums = out.reshape(flat) @ ones
        if not (sums.min() > 1e-20 and sums.max() < 1e30):
            rows = np.where(shown, rows, np.float32(-1e9))
            out = np.exp(rows - rows.max(axis=-1, keepdims=True))
            sums = out.reshape(flat) @ ones
        return out, sums.reshape(sizes)

    def fit(self, one, two, told, rng: np.random.Generator) -> None:
        """One pass in random batches, with Adam's steps, all weights in one row."""
        flat = _flat(self.w)
        self.w = _shaped(flat)
        mean, square, root, new = (np.zeros_like(flat) for _ in range(4))
        order, step = rng.permutation(len(one) // 2), 0
        one, two, told = (a.reshape(-1, 2 * BLOCK) for a in (one, two, told))
        for low in range(0, len(order), BATCH):
            pick = order[low:low + BATCH]
            step += 1
            g = self.gradients(*(a[pick].reshape(-1, BLOCK) for a in (one, two, told)))
            np.concatenate([g[k].ravel() for k in self.SHAPES], out=new, casting="same_kind")
            # Sums in place of means: these are 0.1 and 0.01 of them, which the two numbers below hold.
            mean *= np.float32(0.9)
            mean += new
            np.multiply(new, new, out=new)
            square *= np.float32(0.99)
            square += new
            np.sqrt(square, out=root)
            unit = (0.01 / (1 - 0.99 ** step)) ** 0.5
            root += np.float32(1e-6 / unit)
            np.divide(mean, root, out=root)
            root *= np.float32(0.1 * RATE / (1 - 0.9 ** step) / unit)
            flat -= root


def _with_block_before(blocks: np.ndarray) -> np.ndarray:
    """A view of the places of each block but the first, after those of the block before."""
    n, places, width = blocks.shape
    block, place, number = blocks.strides
    return np.lib.stride_tricks.as_strided(blocks, (n - 1, 2 * places, width), (block, place, number), writeable=False)


def _flat(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([weights[k].ravel() for k in Attention.SHAPES])


def _shaped(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in Attention.SHAPES.items():
        size = int(np.prod(shape))
        out[name] = flat[at:at + size].reshape(shape)
        at += size
    return out


def _fitted(flat: np.ndarray, vocabulary: Vocabulary):
    """A part's weights after a pass over its windows, in pieces, times its number of windows."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, windows = [], 0
        for batch in batches:
            data, offsets = bytes_of(batch.column(0))
            placed = data[offsets[0]:offsets[-1]].view(np.uint32).reshape(-1, 2 * BLOCK + 1).astype(np.int64)
            placed[placed == OUTSIDE] = -1
            symbols.append(_symbols(vocabulary, placed))
            windows += len(placed)
        if not windows:
            return
        one, two, told = (np.concatenate(a).reshape(-1, BLOCK) for a in zip(*symbols))
        model = Attention(_shaped(flat))
        model.fit(one, two, told, np.random.default_rng(0))
        new = _flat(model.w).astype(np.float64) * windows
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(new))), pa.array(new), pa.array(np.full(len(new), windows))],
            ["place", "weight", "windows"])
    return rows


def train(windows: DataFrame, number: int, vocabulary: Vocabulary, prior: np.ndarray) -> np.ndarray:
    """Weights fitted to all windows, about `number`: each part goes on from the same weights, then they are averaged.

    The number of parts grows with the texts; sums are made by Spark, and one set of weights (a fixed number)
    comes to the driver.
    """
    flat = _flat(Attention.start(prior))
    # Dealt by turns, so that copies of a text do not meet in one part.
    sums = (windows.repartition(max(1, -(-number // WINDOWS_PER_PART))).sortWithinPartitions(F.xxhash64("window"))
            .mapInArrow(_fitted(flat, vocabulary), "place long, weight double, windows long")
            .groupBy("place").agg(F.sum("weight").alias("weight"), F.sum("windows").alias("windows")))
    for r in sums.collect():
        flat[r["place"]] = r["weight"] / r["windows"]
    return flat


def _scored(lines: bytes, vocabulary: Vocabulary, flat: np.ndarray, head: Head, share: np.ndarray, names: list[str]):
    """Per text: tokens, what is known of the frequent ones, the model's gain, and the other words with their times."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        subwords, hasher, model = Subwords(lines, head), WordHasher(), Attention(_shaped(flat))
        for whole in batches:
            for batch in slices(whole, 0):
                words, pairs, tokens, counts = _read(subwords, hasher, batch)
                text = np.repeat(np.arange(batch.num_rows), counts)
                placed, scored, place = _places(pairs[tokens], counts)
                before = np.r_[-1, placed[:-1, -1]][:, None]
                one, two, told = _symbols(vocabulary, np.concatenate([before, placed], axis=1))
                logs = model.log_probabilities(one, two, told, scored).ravel()[place] / np.log(10)
                gain = np.bincount(text, weights=logs - share[vocabulary.classes(pairs)][tokens],
                                   minlength=batch.num_rows)
                if len(head.words):
                    at, held = head.places(words)
                    value = np.where(held, np.log10(head.times[at] + 0.5), 0.0)[tokens]
                    known = held[tokens]
                else:
                    known, value = np.zeros(len(tokens), bool), np.zeros(len(tokens))
                tokens = words[tokens]
                order = np.lexsort((tokens[~known], text[~known]))
                word, owner = tokens[~known][order], text[~known][order]
                fresh = np.flatnonzero(np.r_[True, (word[1:] != word[:-1]) | (owner[1:] != owner[:-1])]) if len(
                    word) else np.empty(0, np.int64)
                cuts = np.searchsorted(owner[fresh], np.arange(batch.num_rows + 1)).astype(np.int32)
                often = np.diff(np.r_[fresh, len(word)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[1:], pa.array(counts.astype(np.int64)),
                     pa.array(np.bincount(text, weights=known, minlength=batch.num_rows).astype(np.int64)),
                     pa.array(np.bincount(text, weights=value, minlength=batch.num_rows)), pa.array(gain),
                     pa.ListArray.from_arrays(pa.array(cuts), pa.array(word[fresh].view(np.int64))),
                     pa.ListArray.from_arrays(pa.array(cuts), pa.array(often))], names)
    return rows


def score_texts(docs: DataFrame, held_out, ranks: str = RANKS, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per document: id, `held_out`, `n_tokens`, `n_known`, `train_tokens`, `base_score`, `score`.

    `held_out` is a column expression; texts where it holds are scored but not learnt from.  Tokens are words
    (runs of other bytes than ASCII white space, A-Z in lower case) and one end for each text.

    A word's class follows from its first and last subword id.  The model tells the next word's class from the
    subword ids of up to 31 words before (`Attention`), and the word within its class by counts with 0.5 added to
    each, and to one unknown word for each class.  `score` is the sum of log10 of both, `base_score` that of the
    same counts without classes.  Counts are over all training texts; the most frequent words' go to
    every task (at most FREQUENT), the others' are joined.

    NULL and empty texts are one end.  An empty table gives no rows; without training texts every token is
    unknown.  Other columns are ignored.  Equal texts have equal scores.
    """
    with open(ranks, "rb") as file:
        lines = file.read()
    texts = docs.select(whole_text(F.col(text_col)).alias("text"), F.col(id_col).alias("id"),
                        held_out.alias("held_out"))
    training = texts.where("NOT held_out")
    read = saved(training.select("text").mapInArrow(
        _counted(lines), "word long, pair long, count long, tokens binary"), "lm-read")
    counts = saved(read.where("tokens IS NULL").groupBy("word", "pair").agg(F.sum("count").alias("count")), "lm-counts")
    ended = F.sum(F.when(F.col("word") == int(END_HASH), F.col("count")))
    n, v, ends = counts.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count("*"), F.coalesce(ended, F.lit(0))).first()
    pairs = saved(counts.groupBy("pair").agg(F.sum("count").alias("count"), F.count("*").alias("v")), "lm-pairs")
    vocabulary = _vocabulary(pairs)

    # Sizes of the classes, a row for each.
    inside = pairs.mapInArrow(_by_class(vocabulary), "class int, n long, v long").groupBy("class").agg(
        F.sum("n").alias("n"), F.sum("v").alias("v")).collect()
    size = np.full(CLASSES, 0.5)
    mass = np.full(CLASSES, 0.5)
    for r in inside:
        size[r["class"]] = r["n"] + 0.5 * (r["v"] + 1)
        mass[r["class"]] = r["n"] + 0.5
    head = _head(counts)
    flat = train(read.where("tokens IS NOT NULL").select("tokens").mapInArrow(_windows(), "window binary"), n // BLOCK + ends,
                 vocabulary, mass / mass.sum())

    whole = n + 0.5 * (v + 1)
    names = ["id", "held_out", "n_tokens", "n_known", "logs", "gain", "words", "times"]
    schema = T.StructType([
        texts.schema["id"], T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()), T.StructField("logs", T.DoubleType()),
        T.StructField("gain", T.DoubleType()), T.StructField("words", T.ArrayType(T.LongType())),
        T.StructField("times", T.ArrayType(T.IntegerType()))])
    rows = saved(texts.mapInArrow(_scored(lines, vocabulary, flat, head, np.log10(size / whole), names), schema)
                 .withColumn("row", F.monotonically_increasing_id()), "lm-rows")
    rare = (rows.select("row", F.explode(F.arrays_zip("words", "times")).alias("w"))
            .select("row", F.col("w.words").alias("word"), F.col("w.times").alias("times")))
    joined = (rare.join(counts.select("word", "count"), "word", "left")
              .groupBy("row").agg(F.sum(F.col("times") * F.log10(F.coalesce("count", F.lit(0)) + F.lit(0.5))).alias("more"),
                                  F.sum(F.when(F.col("count") > 0, F.col("times"))).alias("known")))
    logs = F.col("logs") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * F.lit(float(np.log10(whole)))
    return rows.drop("words", "times").join(joined, "row", "left").select(
        F.col("id").alias(id_col), "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).cast("bigint").alias("n_known"),
        F.lit(int(n)).cast("bigint").alias("train_tokens"), logs.alias("base_score"),
        (logs + F.col("gain")).alias("score"))


def _head(counts: DataFrame) -> Head:
    """At most FREQUENT words reach the driver, and how many words have each count."""
    room, least = FREQUENT, None
    for times, number in sorted(map(tuple, counts.groupBy("count").agg(F.count("*")).collect()), reverse=True):
        if number > room:
            least = times
            break
        room -= number
    rows = counts.where(F.lit(True) if least is None else F.col("count") > least).collect()
    if least is not None and room:  # some of the words with this count, the first by their hashes
        rows += counts.where(F.col("count") == least).orderBy("word").limit(room).collect()
    words = np.array([r["word"] for r in rows], np.int64).view(np.uint64)
    order = np.argsort(words)
    return Head(words[order], np.array([r["pair"] for r in rows], np.int64)[order],
                np.array([r["count"] for r in rows], np.float64)[order])


def _by_class(vocabulary: Vocabulary):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = vocabulary.classes(batch.column(0).to_numpy())
            n, v = (np.bincount(found, weights=batch.column(i).to_numpy(), minlength=CLASSES).astype(np.int64)
                    for i in (1, 2))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(CLASSES, dtype=np.int32)), pa.array(n), pa.array(v)], ["class", "n", "v"])
    return rows


def held_out_fold(id_col: str = "doc_id"):
    """Ids whose crc32 leaves 1 when divided by 5."""
    return crc_of_id(F.col(id_col)) % 5 == 1
