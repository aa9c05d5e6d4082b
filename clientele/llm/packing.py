"""Token ids of documents, packed into matrices of fixed width."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.llm.common import whole_text
from clientele.llm.words import slices

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how this vocabulary cuts text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END_OF_TEXT = 50_256
WIDTH = 2_048
#: Tokens that are packed together; a task holds no more of them.  Bins close with their window.
WINDOW_TOKENS = 1 << 21
MATRIX_ROWS = 64


class Capacities:
    """Open bins by room left: a segment tree over the sizes says which of them have a bin."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(most + 1)]

    def _add(self, room: int, step: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += step
            node >>= 1

    def put(self, room: int, number: int) -> None:
        self.bins[room].append(number)
        self._add(room, 1)

    def take(self, size: int) -> tuple[int, int] | None:
        """The bin with the least room of at least `size`, and that room."""
        node = size + self.leaves
        if not self.count[node]:
            # Climb until a subtree to the right has a bin, then go down to its first.
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node *= 2
                if not self.count[node]:
                    node += 1
        room = node - self.leaves
        self._add(room, -1)
        return self.bins[room].pop(), room


def pack(sizes: list[int], width: int) -> list[list[int]]:
    """Best-fit decreasing: which pieces, by their numbers, each bin holds.  No piece is over the width."""
    bins: list[list[int]] = []
    open_bins = Capacities(width)
    for piece in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        found = open_bins.take(sizes[piece])
        if found is None:
            number, room = len(bins), width
            bins.append([])
        else:
            number, room = found
        bins[number].append(piece)
        if room > sizes[piece]:
            open_bins.put(room - sizes[piece], number)
    return bins


def matrices(documents: list[tuple[object, np.ndarray]], width: int, kind: str, rows: int) -> Iterator[dict]:
    """Pack whole windows; a document over the width is cut into pieces of the width and a rest."""
    pieces = [(doc, part, ids[start:start + width]) for doc, ids in documents
              for part, start in enumerate(range(0, len(ids), width))]
    bins = pack([len(p[2]) for p in pieces], width)
    for low in range(0, len(bins), rows):
        some = bins[low:low + rows]
        ids = np.zeros((len(some), width), kind)
        positions = np.zeros((len(some), width), np.uint16 if width <= 65_536 else np.uint32)
        out = {"segments": [], "docs": [], "parts": []}
        for row, numbers in enumerate(some):
            end, ends = 0, [0]
            for number in numbers:
                piece = pieces[number][2]
                ids[row, end:end + len(piece)] = piece
                positions[row, end:end + len(piece)] = np.arange(len(piece))
                end += len(piece)
                ends.append(end)
            out["segments"].append(ends)
            out["docs"].append([pieces[n][0] for n in numbers])
            out["parts"].append([pieces[n][1] for n in numbers])
        yield out | {"ids": ids.tobytes(), "positions": positions.tobytes(), "rows": len(some)}


def pack_tokens(docs: DataFrame, ranks: str = RANKS, width: int = WIDTH, end_of_text: int = END_OF_TEXT,
                window_tokens: int = WINDOW_TOKENS, matrix_rows: int = MATRIX_ROWS,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Matrices of token ids that hold every token of every document once.

    Each text is encoded (byte-level BPE; special tokens in it are ordinary text) and ends with
    `end_of_text`.  Windows of a partition's documents are packed by best-fit decreasing; a text over the
    width is cut into pieces of the width, and only its rest shares a row.  One row of the result is a
    matrix: `matrix` (its number), `n_rows`, `width`, `id_type` (little-endian uint16, or uint32 where the
    vocabulary needs it), `ids` (row by row, 0 after the last segment), `positions` (uint16 up
    to a width of 65,536, else uint32; restart at 0 in each segment, 0 after the last), and for each row
    the lists `cu_seqlens` (cumulative lengths from 0), `doc_ids` and `parts` (number of the piece in its
    document).  Joining a document's pieces by part gives its tokens back.

    NULL and empty texts are their end token alone.  Repeated rows and NULL ids are packed like others; an
    empty table gives no rows; other columns are ignored.  Nothing is shuffled: memory is bounded by the
    window and the longest document.
    """
    with open(ranks, "rb") as file:
        lines = file.read()
    last = max(int(line.split()[1]) for line in lines.splitlines() if line)
    kind = "<u2" if max(last, end_of_text) < 65_536 else "<u4"
    source = docs.select(F.col(id_col).alias("id"), whole_text(F.col(text_col)).alias("text"),
                         F.spark_partition_id().alias("partition"))
    id_type = source.schema["id"].dataType
    schema = T.StructType([
        T.StructField("matrix", T.LongType()), T.StructField("n_rows", T.IntegerType()),
        T.StructField("width", T.IntegerType()), T.StructField("id_type", T.StringType()),
        T.StructField("ids", T.BinaryType()), T.StructField("positions", T.BinaryType()),
        T.StructField("cu_seqlens", T.ArrayType(T.ArrayType(T.IntegerType()))),
        T.StructField("doc_ids", T.ArrayType(T.ArrayType(id_type))),
        T.StructField("parts", T.ArrayType(T.ArrayType(T.IntegerType())))])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, special_tokens={}, mergeable_ranks={
            base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines.splitlines())})
        held: list[tuple[object, np.ndarray]] = []
        tokens, number, id_kind = 0, 0, None

        def full() -> Iterator[pa.RecordBatch]:
            nonlocal number
            for m in matrices(held, width, kind, matrix_rows):
                nested = pa.list_(pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), pa.array([m["rows"]], pa.int32()),
                     pa.array([width], pa.int32()), pa.array([f"uint{8 * int(kind[2])}"]),
                     pa.array([m["ids"]], pa.binary()), pa.array([m["positions"]], pa.binary()),
                     pa.array([m["segments"]], nested), pa.array([m["docs"]], pa.list_(pa.list_(id_kind))),
                     pa.array([m["parts"]], nested)], schema.names)
                number += 1

        for whole in batches:
            for batch in slices(whole, 1):
                if id_kind is None:
                    id_kind, number = batch.column(0).type, batch.column(2)[0].as_py() << 33
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    ids = np.array(encoding.encode_ordinary(text) + [end_of_text], kind)
                    held.append((doc, ids))
                    tokens += len(ids)
                if tokens >= window_tokens:
                    yield from full()
                    held, tokens = [], 0
        if held:
            yield from full()

    return source.mapInArrow(rows, schema)
