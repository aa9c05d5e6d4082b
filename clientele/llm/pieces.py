"""SentencePiece encoding and decoding as shortest paths through a weighted transducer."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2 as proto

from clientele.llm.common import fresh, whole_text
from clientele.llm.words import slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Words, and pairs of pieces, that a task remembers; beyond, it forgets and finds them again.
WORDS_KEPT = 600_000
PAIRS_KEPT = 300_000
_INFINITY = float("inf")
# Numbers of the model format.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: What an unknown character costs over the worst piece, in unigram models.
UNKNOWN_PENALTY = 10.0


class Transducer:
    """The model as a transducer from text to piece ids, over the tropical semiring.

    Three parts are composed.  The *normaliser* writes each space as U+2581, after a dummy one in front if
    the model asks for it (models with a character map are refused).  The *pieces* read a piece's
    characters and write its id.  *Byte fallback* reads a character that is no piece and writes the ids of its
    UTF-8 bytes, or the unknown id where the model has no bytes.

    Weights add up along a path, and the path of least weight is the encoding.  In a unigram model a piece
    weighs its negative score.  In a merge (BPE) model the states are the pieces last read, and the arc from
    piece p to piece q weighs 0 if merging the text of both leaves just p and q, else infinity.
    Merges act on neighbours, best score first and then leftmost, so a sequence is what merging a text leaves
    exactly if each adjacent pair of it is: exactly one path has weight 0.

    No piece has a space mark after another character, so nothing is read across the front of a run of marks:
    the input is composed a word (with the marks before it) at a time, and words met before are remembered.
    """

    def __init__(self, model: bytes):
        spec = proto.ModelProto()
        spec.ParseFromString(model)
        norm = spec.normalizer_spec
        if norm.precompiled_charsmap:
            raise ValueError("models with a character map are not supported")
        kinds = {p.type for p in spec.pieces}
        if spec.trainer_spec.model_type not in (UNIGRAM, BPE) or USER_DEFINED in kinds:
            raise ValueError("only unigram and BPE models without user-defined pieces are supported")
        if spec.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("white space as a suffix is not supported")
        self.merges = spec.trainer_spec.model_type == BPE
        self.dummy = norm.add_dummy_prefix
        self.squeeze = norm.remove_extra_whitespaces
        self.mark = SPACE if norm.escape_whitespaces else " "
        self.texts = [p.piece for p in spec.pieces]
        self.kinds = [p.type for p in spec.pieces]
        self.ids = {p.piece: i for i, p in enumerate(spec.pieces) if p.type == NORMAL}
        self.scores = {p.piece: p.score for p in spec.pieces if p.type == NORMAL}
        self.longest = max(map(len, self.ids), default=1)
        self.unknown = next((i for i, k in enumerate(self.kinds) if k == UNKNOWN), 0)
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(spec.pieces) if p.type == BYTE}
        self.floor = min(self.scores.values(), default=0.0) - UNKNOWN_PENALTY
        # The pieces as a tree of characters; "" leads to the piece that ends there.
        self.tree: dict = {}
        for piece in self.ids:
            node = self.tree
            for character in piece:
                node = node.setdefault(character, {})
            node[""] = piece
        self.by_words = not any(self.mark in p.lstrip(self.mark) for p in self.ids)
        mark = re.escape(self.mark)
        self.word = re.compile(rf"{mark}*[^{mark}]+|{mark}+" if self.by_words else r".+", re.S)
        # What each id stands for when it is read backwards.
        self.written = [bytes([int(t[3:5], 16)]) if k == BYTE else b"" if k == CONTROL
                        else " ⁇ ".encode() if k == UNKNOWN else t.replace(self.mark, " ").encode()
                        for t, k in zip(self.texts, self.kinds)]
        self.known: dict[str, list[int]] = {}
        self.pairs: dict[str, dict[str, bool]] = {}
        self.held = 0

    def normalised(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return ""
        return ((" " if self.dummy else "") + text).replace(" ", self.mark)

    def _merged(self, text: str) -> list[str]:
        """What merging leaves of a short text."""
        symbols, get = list(text), self.scores.get
        scores = [get(a + b, -_INFINITY) for a, b in zip(symbols, symbols[1:])]
        while scores:
            best = max(scores)
            if best == -_INFINITY:
                break
            i = scores.index(best)
            symbols[i:i + 2] = [symbols[i] + symbols[i + 1]]
            del scores[i]
            if i:
                scores[i - 1] = get(symbols[i - 1] + symbols[i], -_INFINITY)
            if i < len(scores):
                scores[i] = get(symbols[i] + symbols[i + 1], -_INFINITY)
        return symbols

    def _follows(self, before: str, piece: str) -> bool:
        """Whether the arc from `before` ('' at the front of a word) to `piece` weighs 0."""
        self.held += 1
        if self.held > PAIRS_KEPT:
            self.pairs.clear()
            self.held = 1
        zero = self._merged(before + piece) == ([before, piece] if before else [piece])
        self.pairs.setdefault(before, {})[piece] = zero
        return zero

    def _readable(self, word: str, start: int) -> list[str]:
        """Pieces that can be read at a place of the word, and its character; the longest last."""
        out = [word[start]]
        node = self.tree.get(word[start])
        for character in word[start + 1:start + self.longest] if node else "":
            node = node.get(character)
            if node is None:
                break
            piece = node.get("")
            if piece is not None:
                out.append(piece)
        return out

    def _merge_path(self, word: str) -> list[str]:
        """The path of weight 0: depth first, long pieces first; states that led nowhere are not tried again."""
        pairs, dead = self.pairs, set()
        path, choices = [], [self._readable(word, 0)]
        place, before, length = 0, "", len(word)
        while place < length:
            options, known = choices[-1], pairs.get(before) or {}
            while options:
                piece = options.pop()
                if dead and (place + len(piece), piece) in dead:
                    continue
                zero = known.get(piece)
                if zero or zero is None and self._follows(before, piece):
                    break
            else:  # back to the piece before
                choices.pop()
                dead.add((place, before))
                place -= len(path.pop())
                before = path[-1] if path else ""
                continue
            path.append(piece)
            place, before = place + len(piece), piece
            if place < length:
                choices.append(self._readable(word, place))
        return path

    def _least_path(self, word: str) -> list[str]:
        """The path of least weight, by the order of places, for weights that do not depend on the piece before."""
        least = [0.0] + [_INFINITY] * len(word)
        back = [""] * (len(word) + 1)
        for start in range(len(word)):
            for piece in self._readable(word, start):
                total = least[start] - self.scores.get(piece, self.floor)
                if total < least[start + len(piece)]:
                    least[start + len(piece)], back[start + len(piece)] = total, piece
        out, place = [], len(word)
        while place:
            out.append(back[place])
            place -= len(back[place])
        return out[::-1]

    def _word_ids(self, word: str) -> list[int]:
        out = []
        for piece in self._merge_path(word) if self.merges else self._least_path(word):
            number = self.ids.get(piece)
            if number is not None:
                out.append(number)
            elif self.bytes:
                out.extend(self.bytes[b] for b in piece.encode())
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return out

    def encode(self, text: str) -> list[int]:
        known, out = self.known, []
        for word in self.word.findall(self.normalised(text)):
            ids = known.get(word)
            if ids is None:
                if len(known) >= WORDS_KEPT:
                    known.clear()
                ids = self._word_ids(word)
                if len(word) < 100:
                    known[word] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        """The transducer read backwards: ids to text, runs of bytes as UTF-8 (U+FFFD for bytes that are none)."""
        text = b"".join(map(self.written.__getitem__, ids)).decode(errors="replace")
        return text[1:] if self.dummy and text.startswith(" ") else text


def encode_pieces(docs: DataFrame, model: str = MODEL, text_col: str = "text") -> DataFrame:
    """All rows and columns of `docs` with `ids`, `n_tokens` and `decoded`, the text that the ids stand for.

    `decoded` is the text itself, but that U+2581 reads as a space.  NULL and empty texts have no ids.
    Columns with one of the three names are replaced.
    """
    with open(model, "rb") as file:
        compiled = file.read()
    new = ("ids", "n_tokens", "decoded")
    kept = [c for c in docs.columns if c not in new]
    source = docs.select(whole_text(F.col(f"`{text_col}`")).alias(fresh(docs.columns, "text_read")), *[f"`{c}`" for c in kept])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = Transducer(compiled)
        for whole in batches:
            for batch in slices(whole, 0):
                ids = [transducer.encode(text) for text in batch.column(0).to_pylist()]
                sizes = np.array([len(i) for i in ids], np.int32)
                flat = np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum()))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(flat))
                decoded = [transducer.decode(i) for i in ids]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[1:], lists, pa.array(sizes), pa.array(decoded, pa.string())],
                    [*kept, *new])

    schema = T.StructType([*[docs.schema[c] for c in kept],
                           T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("n_tokens", T.IntegerType()), T.StructField("decoded", T.StringType())])
    return source.mapInArrow(rows, schema)
