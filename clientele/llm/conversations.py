"""Conversation structure repair: the cheapest edits, by an auction algorithm for shortest paths.

The rows of a conversation, in order, and the kind of the last role that was let stand are the nodes of a lattice; edits are its
arcs, with whole costs.  The auction keeps a price for each node, a lower bound of what is still to pay from it, and a
path from the entry that it extends along arcs that are tight (price = cost + next price) and contracts where it
has to raise a price.  Every cheapest path consists of tight arcs, so the first letters that lead on through
tight arcs give the least string of edits.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.llm.common import saved
from clientele.llm.words import slices

#: Characters that are no content.
SPACE = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: Rows of a conversation whose prices are found together; between blocks only exact prices are kept.
BLOCK = 16

# What was let stand last: nothing, a system, a user or an assistant row.
_NONE, _SYSTEM, _USER, _ASSISTANT = range(4)
_AFTER = {"s": _SYSTEM, "u": _USER, "a": _ASSISTANT}
#: Roles that may follow, the one to insert or change to last.
_MAY_FOLLOW = ("su", "u", "a", "u")
#: What is still to pay after the last row: nothing, or an inserted user and assistant, or an assistant.
_EXITS = (0, 2 * INSERT, INSERT, 0)
_ROLES = {"u": "user", "a": "assistant"}


def _arcs(letter: str, state: int) -> tuple[tuple[str, int, int, int], ...]:
    """(initial, cost, rows read, next state) of the edits at a row, by initial."""
    filled = _MAY_FOLLOW[state][-1]
    arcs = [("D", DELETE, 1, state), ("I", INSERT, 0, _AFTER[filled])]
    if letter not in "bd":
        role, late = letter.lower(), TRUNCATED if letter.isupper() else 0
        if role in _MAY_FOLLOW[state]:
            arcs.append(("K", KEEP + late, 1, _AFTER[role]))
        arcs.append(("R", REROLE + late, 1, _AFTER[filled]))
    return tuple(arcs)


#: By letter of a row and state.  b: blank, d: duplicate (both must go); s, u, a, x: role, in capitals if truncated.
ARCS = {letter: tuple(_arcs(letter, state) for state in range(4)) for letter in "bdsuaxSUAX"}


def auction(letters: str, exits: tuple[int, ...], entries: tuple[int, ...]) -> list[list[int]]:
    """Prices of the nodes of a block, exact for the entries, given exact prices behind it."""
    base = min(exits)
    prices = [[base] * 4 for _ in letters]
    prices.append(list(exits))
    last = len(letters)
    for entry in entries:
        path = [(0, entry)]
        while path[-1][0] < last:
            row, state = path[-1]
            least, to = min((cost + prices[row + read][then], (row + read, then))
                            for _, cost, read, then in ARCS[letters[row]][state])
            if prices[row][state] == least:
                path.append(to)
                continue
            prices[row][state] = least
            if len(path) > 1:
                path.pop()
    return prices


def traced(letters: str, prices: list[list[int]], entry: int) -> tuple[str, int]:
    """The least string of initials along tight arcs from an entry to behind the block, and the state there."""
    last = len(letters)
    # Nodes from which tight arcs lead behind the block; an arc can be tight and lead nowhere.
    through = [[False] * 4 for _ in letters] + [[True] * 4]

    def tight(row: int, state: int) -> Iterator[tuple[str, int, int]]:
        for initial, cost, read, then in ARCS[letters[row]][state]:
            if prices[row][state] == cost + prices[row + read][then] and through[row + read][then]:
                yield initial, row + read, then

    for row in range(last - 1, -1, -1):
        for _ in range(3):  # at most two rows are put in before a row
            for state in range(4):
                through[row][state] = through[row][state] or any(True for _ in tight(row, state))
    row, state, initials = 0, entry, []
    while row < last:
        initial, row, state = next(tight(row, state))
        initials.append(initial)
    return "".join(initials), state


def solved(letters: str) -> tuple[int, str]:
    """Least cost of edits after which the roles fit (s?(ua)+)?, and the least string of their initials."""
    starts = range(0, len(letters), BLOCK)
    exits = array("q", _EXITS)  # those behind the last block, then those before it, and so on
    for low in reversed(starts[1:]):
        block = auction(letters[low:low + BLOCK], tuple(exits[-4:]), (_NONE, _SYSTEM, _USER, _ASSISTANT))
        exits.extend(block[0])
    state, cost, parts = _NONE, 0, []
    for low in starts:
        block = letters[low:low + BLOCK]
        prices = auction(block, tuple(exits[-4:]), (state,))
        del exits[-4:]
        if not low:
            cost = prices[0][state]
        initials, state = traced(block, prices, state)
        parts.append(initials)
    return cost, "".join(parts) + "I" * (_EXITS[state] // INSERT)


def _key(text: Column) -> Column:
    """Half of the SHA-256 of a text: stands for it where texts are compared."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def _rows(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """conv, turn, role and text under fixed names; a NULL role or text is one space."""
    return rows.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"),
                       F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"),
                       F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"))


def _letters(schema: T.StructType):
    """The letters of each conversation in a task's part of the order, and what the next part must know."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, piece, letters = TaskContext.get().partitionId(), None, []
        kind = None
        for batch in batches:
            kind, out = batch.schema.field(0).type, []
            for conv, turn, initial, letter, copies in zip(*(c.to_pylist() for c in batch.columns)):
                if piece is None or conv != piece["conv"]:
                    if piece is not None:
                        out.append([*piece.values(), "".join(letters)])
                    piece, letters = {"conv": conv, "part": part, "first": initial, "last": None, "low": None,
                                      "high": None, "turns": 0, "illegal": 0}, []
                if turn is not None and turn != piece["high"]:
                    piece["low"] = turn if piece["low"] is None else piece["low"]
                    piece["high"] = turn
                    piece["turns"] += 1
                piece["illegal"] += copies - 1 + (piece["last"] is not None and not _legal(piece["last"], initial))
                piece["last"] = initial
                letters.append(letter[0] + letter[1] * (copies - 1))
            yield _batch(out, schema, kind)
        if piece is not None:
            yield _batch([[*piece.values(), "".join(letters)]], schema, kind)
    return rows


def _legal(before: str, after: str) -> bool:
    return (before, after) in (("s", "u"), ("u", "a"), ("a", "u"))


def _batch(out: list, schema: T.StructType, conv: pa.DataType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_type
    kinds = [conv, *(to_arrow_type(f.dataType) for f in schema.fields[1:])]
    return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)], schema.names)


def _judged(schema: T.StructType):
    """Faults and cheapest edits of each conversation, from the pieces of its letters in order."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembered = lru_cache(1 << 16)(solved)  # most short conversations have the letters of another
        for batch in batches:
            out = []
            for conv, pieces in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                letters = "".join(p["letters"] for p in pieces)
                illegal = sum(p["illegal"] for p in pieces) + sum(
                    not _legal(a["last"], b["first"]) for a, b in zip(pieces, pieces[1:]))
                known = [p for p in pieces if p["turns"]]
                # A turn may go on in the next piece.
                turns = sum(p["turns"] for p in known) - sum(a["high"] == b["low"] for a, b in zip(known, known[1:]))
                gaps = known[-1]["high"] - known[0]["low"] + 1 - turns if known else 0
                cost, audit = (remembered if len(letters) <= 4 * BLOCK else solved)(letters)
                out.append([conv, gaps, letters.count("b"), letters.count("d"), sum(map(letters.count, "SUAX")),
                            illegal, cost, audit])
            yield _batch(out, schema, batch.schema.field(0).type)
    return rows


def _repaired(schema: T.StructType):
    """The rows of repaired conversations, in order, from their audits (each before its rows) and their rows."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, last, conv, place = "", 0, _NONE, None, 0

        def put_in() -> list:
            nonlocal at, last, place
            at, role, place = at + 1, _MAY_FOLLOW[last][-1], place + 1
            last = _AFTER[role]
            return [conv, place - 1, "I", _ROLES[role], ""]

        for whole in batches:
            for batch in slices(whole, 3):
                out = []
                for own, is_row, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                    if not is_row:
                        while at < len(audit):
                            out.append(put_in())
                        audit, at, last, conv, place = text, 0, _NONE, own, 0
                        continue
                    while audit[at] == "I":
                        out.append(put_in())
                    edit, at = audit[at], at + 1
                    if edit == "D":
                        continue
                    if edit == "R":
                        role = _ROLES[_MAY_FOLLOW[last][-1]]
                    last = _AFTER[role[:1]]
                    out.append([conv, place, edit, role, text])
                    place += 1
                yield _batch(out, schema, batch.schema.field(0).type)
        out = []
        while at < len(audit):
            out.append(put_in())
        if out:
            yield _batch(out, schema, batch.schema.field(0).type)
    return rows


def _digests(schema: T.StructType, repaired):
    """SHA-256 of the rows of each repaired conversation, read one after the other."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, running, kind = None, None, None
        for batch in repaired(batches):
            kind, out = batch.schema.field(0).type, []
            for own, place, _, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if not place:
                    if running is not None:
                        out.append([conv, running.hexdigest()])
                    conv, running = own, hashlib.sha256()
                running.update(f"{chr(10) if place else ''}{role}:{text}".encode())
            yield _batch(out, schema, kind)
        if running is not None:
            yield _batch([[conv, running.hexdigest()]], schema, kind)
    return rows


def audit_conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                        text: str = "text") -> DataFrame:
    """Faults and the cheapest repair of every conversation.

    The rows of a conversation count by turn (NULL first), then by role and content.  A row's fault is the first of: blank
    (nothing but white space), duplicate (an earlier row has its role and text), truncated (its last
    character that is no white space is none of `.!?`).  Edits: keep a row (free), change its role to user or assistant (2), delete
    it (3; blank and duplicate rows must go), put in an empty user or assistant row (2); a truncated row that stays costs 1
    more.  After the cheapest edits the initials of the roles are `(s?(ua)+)?`; of equally cheap edits those count
    whose initials K, R, D, I make the least string (`audit`).

    Columns: the id, `gaps` (whole numbers between the least and the largest turn that no row has), `blank`, `duplicate`,
    `truncated`, `illegal` (neighbours whose initials are not su, ua or au), `cost`, `audit`.

    A conversation may be of any length: rows that are equal are counted before they are shuffled, the order is
    dealt by ranges, and only a letter for each row, as long as the audit, comes together.  A NULL role
    or text is one space; NULL ids are one conversation; NULL turns leave no gaps.  Repeated rows are duplicates.
    An empty table gives no rows.  Other columns are not read.
    """
    own = _rows(rows, conv, turn, role, text)
    content = F.rtrim(F.col("text"), F.lit(SPACE))
    plain = own.select(
        "conv", "turn", "role", _key(F.col("text")).alias("key"), (content == "").alias("blank"),
        (~F.right(content, F.lit(1)).isin(".", "!", "?")).alias("truncated"))
    counted = saved(plain.groupBy(*plain.columns).agg(F.count(F.lit(1)).alias("copies")), "conversation-rows")
    when = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    first = (counted.groupBy(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("key").alias("k"))
             .agg(F.min(when).alias("when")))
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    letter = F.concat(F.when(F.col("truncated"), F.upper(letter)).otherwise(letter), F.lit("d"))
    letter = (F.when(F.col("blank"), "bb").when(F.col("turn").eqNullSafe(F.col("when.turn")), letter).otherwise("dd"))
    lettered = counted.join(first, F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r"))
                            & (F.col("key") == F.col("k"))).select(
        "conv", "turn", "role", "key", initial.alias("initial"), letter.alias("letter"), "copies")
    order = ["conv", "turn", "role", "key"]
    id_, at = own.schema["conv"], own.schema["turn"].dataType
    piece = T.StructType([
        T.StructField("conv", id_.dataType), T.StructField("part", T.IntegerType()),
        T.StructField("first", T.StringType()), T.StructField("last", T.StringType()), T.StructField("low", at),
        T.StructField("high", at), T.StructField("turns", T.LongType()), T.StructField("illegal", T.LongType()),
        T.StructField("letters", T.StringType())])
    pieces = (lettered.repartitionByRange(*order).sortWithinPartitions(*order)
              .select("conv", "turn", "initial", "letter", "copies").mapInArrow(_letters(piece), piece))
    whole = pieces.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct(*piece.names[1:]))).alias("pieces"))
    schema = T.StructType([T.StructField(conv, id_.dataType), *(
        T.StructField(n, T.LongType()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        T.StructField("audit", T.StringType())])
    return whole.mapInArrow(_judged(schema), schema)


def _in_order(rows: DataFrame, audits: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """The rows of each conversation in one task and in order, each conversation's audit before them."""
    own = _rows(rows, conv, turn, role, text)
    rows_ = own.select("conv", F.lit(True).alias("is_row"), "turn", "role", "text", _key(F.col("text")).alias("key"))
    heads = audits.select(F.col(f"`{conv}`").alias("conv"), F.lit(False).alias("is_row"),
                          F.lit(None).cast(own.schema["turn"].dataType).alias("turn"), F.lit("").alias("role"),
                          F.col("audit").alias("text"), F.lit(None).cast("binary").alias("key"))
    return (heads.unionByName(rows_).repartition("conv")
            .sortWithinPartitions("conv", "is_row", "turn", "role", "key").select("conv", "is_row", "role", "text"))


def _repaired_schema(rows: DataFrame, conv: str) -> T.StructType:
    return T.StructType([T.StructField(conv, rows.schema[conv].dataType), T.StructField("place", T.LongType()),
                         T.StructField("edit", T.StringType()), T.StructField("role", T.StringType()),
                         T.StructField("text", T.StringType())])


def repaired_rows(rows: DataFrame, audits: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text") -> DataFrame:
    """The conversations after the edits of `audit_conversations`: id, `place` (from 0), `edit`, `role`, `text`.

    Conversations without a row left give no rows.  A conversation is read as a stream, a batch at a time.
    """
    schema = _repaired_schema(rows, conv)
    return _in_order(rows, audits, conv, turn, role, text).mapInArrow(_repaired(schema), schema)


def repaired_digests(rows: DataFrame, audits: DataFrame, conv: str = "conv_id", turn: str = "turn",
                     role: str = "role", text: str = "text") -> DataFrame:
    """The id and `repaired_sha256` of each conversation that has rows after its edits: of `role:text`, joined by newlines.

    SHA-256 must read a conversation from its first to its last byte, so one task streams each; it holds a batch of rows.
    """
    schema = T.StructType([T.StructField(conv, rows.schema[conv].dataType),
                           T.StructField("repaired_sha256", T.StringType())])
    return _in_order(rows, audits, conv, turn, role, text).mapInArrow(
        _digests(schema, _repaired(_repaired_schema(rows, conv))), schema)


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults put in by crc32 of `conv_id:turn` modulo 20, a NULL counting as one space.

    0 drops the row, 1 empties its text, 2 removes `.!?` from it, 3 repeats the row, 4 makes its role user.
    """
    space = F.lit(" ")
    name = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space),
                       F.coalesce(F.col("turn").cast("string"), space))
    kind, text = F.crc32(name.cast("binary")) % 20, F.coalesce("text", space)
    return (rows.where(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("copy"))
        .drop("copy"))
