"""N-gram Jaccard join with adaptive multi-match prefixes, and the groups that its links make.

Notation: a text's set has n tokens (its distinct word n-grams, as 64-bit numbers).  A link needs an
overlap of at least o = ceil(threshold * n) with the other set, whichever its size.  In any fixed order of all
tokens, let the l-prefix of a set be its first n - o + l tokens: two linked sets share l tokens of
their l-prefixes at least, and so min(k, l) of a k- and an l-prefix.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientele.llm.common import one_row_each, partitions_for, saved, whole_text
from clientele.llm.words import WordHasher, bytes_of, mixed, ngrams, slices

WORDS = 5
#: Threshold in hundredths, so that sizes are compared as whole numbers.
PERCENT = 75
#: Share of a set, first in the order of token numbers, that the first filter looks at.
FIRST_SHARE = 0.35
#: Minimum hashes by which sets meet before the join proper.
SKETCHES = 6
#: A posting list over this many sets is compared block by block.
LIST_BLOCK = 1_500
#: So is one whose sets have more tokens than this.
BLOCK_TOKENS = 2_000_000
#: Candidates for each set of a list, up to which the pairs are given out; a list with more checks them itself.
PAIRS_A_SET = 4
#: Frequencies above are held to be the same.
MOST_FREQUENT = 100_000
#: What checking a candidate costs, in steps along a posting list.
CHECK_COST = 50.0
#: Bits of the map of sets that survive the first filter, at most (16 MB).
MAP_BITS = 1 << 27


def least_overlap(n, percent: int = PERCENT):
    return -(-percent * n // 100)


def first_length(n, percent: int = PERCENT):
    """How many tokens of a set the first filter looks at, and how many of them must be shared."""
    base = n - least_overlap(n, percent)
    length = np.minimum(n, np.maximum(base + 1, (FIRST_SHARE * n).astype(np.int64)))
    return length, length - base


def _sets(hasher: WordHasher, batch: pa.RecordBatch, words: int) -> Iterator[tuple[int, np.ndarray, int]]:
    """(row, sorted tokens, number that stands for the set) of the texts that have words."""
    hashes, owner, *_ = hasher.all_words(*bytes_of(batch.column(0)))
    tokens, text, _ = ngrams(hashes, owner, words, whole_if_short=True)
    cuts = np.searchsorted(text, np.arange(batch.num_rows + 1))
    for row in np.flatnonzero(np.diff(cuts)):
        own = np.unique(tokens[cuts[row]:cuts[row + 1]])
        yield int(row), own, xxhash.xxh3_64_intdigest(own.tobytes()) - (1 << 63)


def _identified(words: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for whole in batches:
            for batch in slices(whole, 0):
                sizes = np.zeros(batch.num_rows, np.int64)
                names = np.zeros(batch.num_rows, np.int64)
                for row, own, name in _sets(hasher, batch, words):
                    sizes[row], names[row] = len(own), name
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[1:], pa.array(sizes), pa.array(names, mask=sizes == 0)],
                    ["id", "text_key", "n", "set"])
    return rows


def _first_tokens(words: int, percent: int, bits: int):
    """Rows (key, set, kind) for the first filter.

    kind 0: the set has the token `key`; 1: several sets of a task have it, and each of them has counted
    it; over 1: kind - 1 tokens of the set are so counted (the key then only spreads the rows).
    """
    mask = np.uint64((1 << bits) - 1) if bits < 64 else np.uint64(2 ** 64 - 1)

    def emit(held: list[tuple[np.ndarray, int]]) -> pa.RecordBatch:
        tokens = np.concatenate([t for t, _ in held]) & mask
        names = np.array([name for _, name in held], np.int64)
        owner = np.repeat(np.arange(len(held)), [len(t) for t, _ in held])
        _, place, times = np.unique(tokens, return_inverse=True, return_counts=True)
        alone = times[place] == 1
        counted = np.bincount(owner[~alone], minlength=len(held))
        some = np.flatnonzero(counted)
        several = np.unique(tokens[~alone])
        keys = np.concatenate([tokens[alone], several, mixed(names[some].astype(np.uint64)) & mask])
        sets = np.concatenate([names[owner[alone]], np.zeros(len(several), np.int64), names[some]])
        kinds = np.concatenate([np.zeros(alone.sum(), np.int64), np.ones(len(several), np.int64), counted[some] + 1])
        return pa.RecordBatch.from_arrays(
            [pa.array(keys.view(np.int64)), pa.array(sets), pa.array(kinds.astype(np.int32))], ["key", "set", "kind"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        held: list[tuple[np.ndarray, int]] = []
        seen: set[int] = set()
        size = 0
        for whole in batches:
            for batch in slices(whole, 0):
                for _, own, name in _sets(hasher, batch, words):
                    if name not in seen:
                        seen.add(name)
                        length, _ = first_length(np.array(len(own)), percent)
                        held.append((own[:int(length)], name))
                        size += int(length)
                if size > 2_000_000:
                    yield emit(held)
                    held, seen, size = [], set(), 0
        if held:
            yield emit(held)
    return rows


def _shared_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From all rows of some keys: how many of its first tokens a set shares with others."""
    parts = [tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns) for batch in batches]
    if not parts:
        return
    keys, sets, kinds = map(np.concatenate, zip(*parts))
    counted = kinds > 1
    token, name, several = keys[~counted], sets[~counted], kinds[~counted] == 1
    order = np.lexsort((name, several, token))
    token, name, several = token[order], name[order], several[order]
    # Copies of a set in other tasks are the same set.
    fresh = np.r_[True, (token[1:] != token[:-1]) | (name[1:] != name[:-1]) | several[1:] | several[:-1]]
    token, name, several = token[fresh], name[fresh], several[fresh]
    if len(token):
        first = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
        sizes = np.diff(np.r_[first, len(token)])
        marked = np.add.reduceat(several.astype(np.int64), first) > 0
        shared = np.repeat((sizes > 1) | marked, sizes) & ~several
    else:
        shared = np.empty(0, bool)
    names = np.concatenate([name[shared], sets[counted]])
    times = np.concatenate([np.ones(shared.sum(), np.int64), kinds[counted].astype(np.int64) - 1])
    yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(times)], ["set", "shared"])


def _whole_sets(words: int, bitmap: np.ndarray):
    """Sets whose bit is on, with all tokens and the minimum hashes by which they meet."""
    bits = np.uint64(len(bitmap) * 8)
    seeds = mixed(np.arange(1, SKETCHES + 1, dtype=np.uint64))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for whole in batches:
            for batch in slices(whole, 0):
                seen, out = set(), []
                for _, own, name in _sets(hasher, batch, words):
                    bit = int(mixed(np.array([name]).astype(np.uint64))[0] % bits)
                    if bitmap[bit >> 3] >> (bit & 7) & 1 and name not in seen:
                        seen.add(name)
                        least = [int(mixed(own ^ seed).min().astype(np.int64)) for seed in seeds]
                        out.append((name, own.view(np.int64), least))
                sizes = np.array([len(o[1]) for o in out], np.int32)
                tokens = np.concatenate([o[1] for o in out]) if out else np.empty(0, np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)),
                                                 pa.array(tokens))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[0] for o in out], pa.int64()), lists,
                     pa.array([o[2] for o in out], pa.list_(pa.int64()))], ["set", "tokens", "sketch"])
    return rows


def _bitmap(sets: DataFrame, number: int) -> np.ndarray:
    """A bit for each set, at a hash of its number: at most MAP_BITS, of which other sets may share some."""
    bits = 1 << 16
    while bits < min(MAP_BITS, 16 * number):
        bits *= 2

    def bytes_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        on = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            bit = mixed(batch.column(0).to_numpy().astype(np.uint64)) % np.uint64(bits)
            np.bitwise_or.at(on, (bit >> np.uint64(3)).astype(np.int64), (1 << (bit & np.uint64(7))).astype(np.uint8))
        some = np.flatnonzero(on)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(on[some].astype(np.int32))], ["byte", "value"])

    out = np.zeros(bits // 8, np.uint8)
    merged = sets.mapInArrow(bytes_on, "byte long, value int").groupBy("byte").agg(F.bit_or("value").alias("value"))
    for row in merged.toLocalIterator():
        out[row["byte"]] = row["value"]
    return out


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows (token, set) sorted by token: those of tokens that several sets have, with the frequency.

    Frequencies are counted up to MOST_FREQUENT, so no more rows of a token are held.
    """
    def out(token: np.ndarray, name: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(token), pa.array(name), pa.array(times.astype(np.int64))],
                                          ["token", "set", "frequency"])

    token, name = np.empty(0, np.int64), np.empty(0, np.int64)
    saturated: int | None = None  # a token known to be as frequent as counted
    for batch in batches:
        token = np.concatenate([token, batch.column(0).to_numpy()])
        name = np.concatenate([name, batch.column(1).to_numpy()])
        if saturated is not None:
            own = token == saturated
            yield out(token[own], name[own], np.full(own.sum(), MOST_FREQUENT))
            token, name = token[~own], name[~own]
            if len(token):
                saturated = None
        if not len(token):
            continue
        last = int(np.searchsorted(token, token[-1]))
        if len(token) - last >= MOST_FREQUENT:
            saturated, last = int(token[-1]), len(token)
        times = np.unique(token[:last], return_inverse=True, return_counts=True)
        times = np.minimum(times[2][times[1]], MOST_FREQUENT)
        yield out(token[:last][times > 1], name[:last][times > 1], times[times > 1])
        token, name = token[last:], name[last:]
    if len(token):
        times = np.full(len(token), min(len(token), MOST_FREQUENT))
        yield out(token[times > 1], name[times > 1], times[times > 1])


def _prefixes(percent: int):
    """From (set, n, frequencies, tokens), rarest first: the prefix of least estimated cost.

    Tokens that no other set has come first in the order; they take up the prefix and meet nothing.
    With frequencies f of the other tokens in the l-prefix, at most sum(f) / l sets share l of them,
    so going along the posting lists and checking costs at most sum(f) * (1 + CHECK_COST / l).

    A row for each set: the l-prefix, of which linked sets share l, begins with the `meets` tokens of the 1-prefix, by
    which they must meet.  Tokens are cut to 32 bits.  That makes different sets share more; tokens of one prefix that become
    the same number count once, so that many fewer matches are asked for.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, sizes, matches, prefixes, meets = [], [], [], [], []
            lists = batch.column(2)
            items = lists.flatten()
            frequency = items.field(0).to_numpy(zero_copy_only=False)
            token = items.field(1).to_numpy(zero_copy_only=False).astype(np.int32)
            ends = np.cumsum(np.r_[0, lists.value_lengths().to_numpy()])
            for i, (name, n) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                f, t = frequency[ends[i]:ends[i + 1]], token[ends[i]:ends[i + 1]]
                least = len(f) - least_overlap(n, percent) + 1  # shared tokens in the 1-prefix
                if least < 1:
                    continue
                sums = np.cumsum(f)[least - 1:]
                best = int(np.argmin(sums * (1 + CHECK_COST / np.arange(1, len(sums) + 1))))
                names.append(name)
                sizes.append(n)
                prefix = t[:least + best]
                matches.append(max(1, best + 1 - (len(prefix) - len(np.unique(prefix)))))
                prefixes.append(prefix)
                meets.append(least)
            own = pa.ListArray.from_arrays(
                pa.array(np.cumsum([0, *map(len, prefixes)]).astype(np.int32)),
                pa.array(np.concatenate(prefixes) if prefixes else np.empty(0, np.int32)))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in (names, matches, sizes)), own, pa.array(meets, pa.int32())],
                ["set", "matches", "n", "prefix", "meets"])
    return rows


def _common(lists: list[np.ndarray]) -> np.ndarray:
    """How many numbers each two of the lists share, as a matrix product over a few thousand numbers at a time."""
    owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    distinct, place = np.unique(np.concatenate(lists), return_inverse=True)  # a list may name one twice
    counts = np.zeros((len(lists), len(lists)), np.float32)
    for low in range(0, len(distinct), 4096):
        inside = (place >= low) & (place < low + 4096)
        has = np.zeros((len(lists), min(4096, len(distinct) - low)), np.float32)
        has[owner[inside], place[inside] - low] = 1
        counts += has @ has.T
    return counts


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """How many tokens each two of the sets share; tokens that the same sets have are one weighted column."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    tokens = np.concatenate(sets)
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    first = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]])
    times = np.diff(np.r_[first, len(tokens)])
    owners = np.add.reduceat(mixed(owner.astype(np.uint64) + np.uint64(1)), first)
    several = times > 1
    first, times = first[several], times[several]
    _, column, weight = np.unique(owners[several], return_index=True, return_counts=True)
    first, times = first[column], times[column]
    counts = np.zeros((len(sets), len(sets)), np.float32)
    for low in range(0, len(first), 4096):
        f, t = first[low:low + 4096], times[low:low + 4096]
        place = np.arange(t.sum()) + np.repeat(f - np.cumsum(t) + t, t)
        has = np.zeros((len(sets), len(f)), np.float32)
        has[owner[place], np.repeat(np.arange(len(f)), t)] = 1
        counts += (has * weight[low:low + 4096].astype(np.float32)) @ has.T
    return counts


def _forest(links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the links (a symmetric matrix), as many as connect what all of them connect."""
    left = links.any(axis=0)
    one, other = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    while left.any():
        reached = np.flatnonzero(left)[:1]
        left[reached] = False
        while len(reached):
            steps = links[reached] & left
            new = np.flatnonzero(steps.any(axis=0))
            one.append(reached[steps[:, new].argmax(axis=0)])
            other.append(new)
            left[new] = False
            reached = new
    return np.concatenate(one), np.concatenate(other)


def _by_list(work):
    """A task over rows (token, low, high, ...) sorted by these three: `work` on the rows of each list in turn."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            new = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, new]) if held is not None and held.num_rows else new
            if not held.num_rows:
                continue
            token, low, high = (held.column(i).to_numpy() for i in range(3))
            first = np.flatnonzero(np.r_[True, (token[1:] != token[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])])
            for a, b in zip(first, first[1:]):
                found = work(held.slice(a, b - a))
                if found is not None:
                    yield found
            held = held.slice(first[-1])
        if held is not None and held.num_rows:
            found = work(held)
            if found is not None:
                yield found
    return rows


def _list_links(percent: int):
    """From posting lists with whole sets: links that connect what all links between their sets of different groups do.

    Fewer links than sets leave a list, however many of its pairs are linked or refuted.
    """
    def links(rows: pa.Table) -> pa.RecordBatch | None:
        name, group = (rows.column(i).to_numpy() for i in (3, 4))
        lists = rows.column(5).combine_chunks()
        n = lists.value_lengths().to_numpy().astype(np.int64)
        shared = _overlaps(np.split(lists.flatten().to_numpy(), np.cumsum(n)[:-1])).astype(np.int64)
        linked = 100 * shared >= percent * (n[:, None] + n[None, :] - shared)
        linked &= group[:, None] != group[None, :]
        one, other = _forest(linked)
        return pa.RecordBatch.from_arrays([pa.array(name[one]), pa.array(name[other])], ["a", "b"])
    return _by_list(links)


def _list_pairs(percent: int):
    """From posting lists, sorted by list: pairs of sets of different groups that may be linked.

    A pair may be linked by its sizes and by the prefix tokens it shares; it is given in the list of the
    smallest token by which it meets.  A list with more than PAIRS_A_SET pairs for each of its sets names instead,
    with NULL for `b`, the sets that are in a pair.
    """
    def pairs(rows: pa.Table) -> pa.RecordBatch | None:
        token, low, high, block, name, group, matches, n = (rows.column(i).to_numpy() for i in range(8))
        if len(name) < 2 or (group == group[0]).all():
            return None
        lists = rows.column(8).combine_chunks()
        prefix = np.split(lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy())[:-1])
        meets = [p[:k] for p, k in zip(prefix, rows.column(9).to_pylist())]
        fits = np.triu(group[:, None] != group[None, :], 1)
        fits &= percent * np.maximum(n[:, None], n[None, :]) <= 100 * np.minimum(n[:, None], n[None, :])
        if low[0] != high[0]:
            fits &= block[:, None] != block[None, :]
        if fits.any():
            fits &= _common(prefix) >= np.minimum(matches[:, None], matches[None, :])
        if fits.any():
            fits &= _common([np.unique(m[m < token[0]]) for m in meets]) == 0
        number = int(fits.sum())
        if not number:
            return None
        if number > PAIRS_A_SET * len(name):
            one = name[fits.any(axis=0) | fits.any(axis=1)]
            other, at = pa.nulls(len(one), pa.int64()), rows.slice(0, 1).select([0, 1, 2]).to_pylist()[0].values()
        else:
            row, column = np.nonzero(fits)
            one, at = np.minimum(name[row], name[column]), (None, None, None)
            other = pa.array(np.maximum(name[row], name[column]))
        return pa.RecordBatch.from_arrays(
            [pa.array(one), other, *(pa.array([x] * len(one), pa.int32()) for x in at)], ["a", "b", "token", "low", "high"])
    return _by_list(pairs)


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the distinct pairs (a, b) whose sets reach the threshold, by their whole sets."""
    left = sets.select(F.col("set").alias("a"), F.col("tokens").alias("left"))
    right = sets.select(F.col("set").alias("b"), F.col("tokens").alias("right"))
    shared = F.size(F.array_intersect("left", "right"))
    return (pairs.join(right, "b").join(left, "a")
            .withColumn("shared", shared)
            .where(100 * F.col("shared") >= percent * (F.size("left") + F.size("right") - F.col("shared")))
            .select("a", "b"))


def connected(edges: DataFrame) -> DataFrame:
    """(node, group) for every node of the edges (a, b); a group is named by its smallest node.

    Rounds of large and small stars: each node's neighbours are hung on the smallest one, until every node
    is either a centre or hangs on one.  Minima are combined before they are shuffled, and no neighbourhood
    is ever collected.
    """
    def hung(directed: DataFrame, larger: bool) -> DataFrame:
        least = directed.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Written, so that the join can split a node of many neighbours.
        least = saved(least, "edges")
        joined = directed.join(least, "u")
        if larger:
            return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return (joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                .union(least.select("u", F.col("m").alias("v"))))

    current = saved(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .where("u <> v").distinct(), "edges")
    while not _stars(current):
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = saved(hung(both, True).where("u <> v").distinct(), "edges")
        current = saved(hung(large, False).where("u <> v").distinct(), "edges")
    return current.select(F.col("u").alias("node"), F.col("v").alias("group")).union(
        current.select(F.col("v").alias("node"), F.col("v").alias("group")).distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether every node of the edges (u, v) hangs on exactly one node, or is one on which others hang."""
    ends = (edges.select(F.col("u").alias("node"), F.lit(1).alias("hangs"))
            .union(edges.select(F.col("v").alias("node"), F.lit(0).alias("hangs"))))
    return (ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.count("*").alias("edges"))
            .where("hangs > 0 AND edges > 1").isEmpty())


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                percent: int = PERCENT) -> DataFrame:
    """One row per document: the id, `n_shingles` (size of its set) and `component_id`.

    A text's words are runs of other bytes than ASCII white space, A-Z in lower case; its set are the distinct
    runs of `words` words, or all its words as one run if it has fewer.  Documents whose sets have a Jaccard
    similarity of at least percent / 100 are linked, and `component_id` is the smallest id that can be reached
    over links.  Texts without words (NULL, empty, white space) have no set and are linked with nothing.

    NULL ids are never the smallest unless a group has no other; repeated rows are documents of equal sets;
    an empty table gives no rows; other columns are ignored.

    1. Documents of equal sets are one set from here on, however many.
    2. First filter: in the order of token numbers (hashes), a set that shares too few of its first tokens with
       any other set links with none.  Most sets go.
    3. Sets that meet in a minimum hash are checked against the first of them; connected ones start as one group.
    4. Tokens of the remaining sets are ordered by frequency, rarest first; each set takes the prefix of least
       estimated cost (`_prefixes`), and pairs of different groups that share enough of its tokens are checked.
       Posting lists within one group are left out, long ones compared in blocks.  Pairs inside a group are
       reachable from each other already, so no component is lost.  Lists where many pairs are left to check
       are checked in place, on whole sets, and give only the links that connect their sets.
    5. The links found so are between groups, so only the groups are connected again.
    """
    return (_grouped(docs, id_col, text_col, words, percent)
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id"))


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                      percent: int = PERCENT) -> DataFrame:
    """The rows of `docs`, with all columns, of which one stays for each group of `near_groups`: the smallest id.

    Rows without a set (no words) are in no group and all stay.  Ids that are NULL count as the largest; of rows of
    one id the smaller hash of the text stays, of rows equal in both any one.
    """
    rows = saved(_grouped(docs, id_col, text_col, words, percent).where("n > 0"), "jaccard-groups")
    keepers = saved(rows.groupBy("group").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key"))
                                              .alias("keeper")), "jaccard-keepers")
    keys = (rows.join(keepers, "group")
            .withColumn("kept", F.col("id").eqNullSafe(F.col("keeper.id"))
                        & (F.col("text_key") == F.col("keeper.text_key")))
            .groupBy("id", "text_key").agg(F.max("kept").alias("kept"), F.count("*").alias("rows")))
    return one_row_each(docs, saved(keys, "jaccard-kept"), id_col, text_col)


def _grouped(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    """Rows (id, text_key, n, component_id, group); the group is NULL for texts without words."""
    texts = docs.select(whole_text(F.col(text_col)).alias("text"), F.col(id_col).alias("id"),
                        F.xxhash64(text_col).alias("text_key"))
    rows = saved(texts.mapInArrow(_identified(words), T.StructType([
        texts.schema["id"], T.StructField("text_key", T.LongType()), T.StructField("n", T.LongType()),
        T.StructField("set", T.LongType())])), "jaccard-sets")
    classes = saved(rows.where("set IS NOT NULL").groupBy("set")
                    .agg(F.first("n").alias("n"), F.min("id").alias("first_id")), "jaccard-classes")
    groups = _set_groups(texts.select("text"), classes, words, percent)
    named = (classes.join(groups, F.col("set") == F.col("node"), "left")
             .select("set", "first_id", F.coalesce("group", "set").alias("group")))
    smallest = named.groupBy("group").agg(F.min("first_id").alias("component_id"))
    of_set = saved(named.join(smallest, "group").select("set", "component_id", "group"), "jaccard-components")
    empty = rows.where("set IS NULL").select("id", "text_key", "n", F.col("id").alias("component_id"),
                                             F.lit(None).cast("bigint").alias("group"))
    return (rows.where("set IS NOT NULL").join(of_set, "set")
            .select("id", "text_key", "n", "component_id", "group").union(empty))


def _set_groups(texts: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    spark = texts.sparkSession
    total = int(classes.agg(F.sum("n")).first()[0] or 0)
    # Cutting token numbers can only make sets seem to share more; 8 bits over the count keep that rare.
    bits = min(64, 8 * (-(-(total.bit_length() + 8) // 8)))
    partitions = partitions_for(int(FIRST_SHARE * total), 1_000_000, spark)
    counts = (texts.mapInArrow(_first_tokens(words, percent, bits), "key long, set long, kind int")
              .repartition(partitions, "key").mapInArrow(_shared_counts, "set long, shared long")
              .groupBy("set").agg(F.sum("shared").alias("shared")))
    base = F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100).cast("bigint")
    length = F.least("n", F.greatest(base + 1, F.floor(F.lit(FIRST_SHARE) * F.col("n")).cast("bigint")))
    # A float product may be a token off the exact one; asking for one match less is on the safe side.
    alive = saved(counts.join(classes, "set").where(F.col("shared") >= F.greatest(length - base - 1, F.lit(1)))
                  .select("set", "n"), "jaccard-alive")
    number = alive.count()
    bitmap = _bitmap(alive.select("set"), number)
    sets = saved(texts.mapInArrow(_whole_sets(words, bitmap),
                                  "set long, tokens array<long>, sketch array<long>")
                 .join(alive, "set").dropDuplicates(["set"]), "jaccard-alive-sets")

    met = sets.select("set", F.posexplode("sketch").alias("k", "least"))
    heads = met.groupBy("k", "least").agg(F.min("set").alias("a"), F.count("*").alias("size")).where("size > 1")
    # Written, so that the join can split a key that many sets share.
    heads = saved(heads, "jaccard-heads")
    starred = (met.join(heads, ["k", "least"]).where(F.col("set") != F.col("a"))
               .select("a", F.col("set").alias("b")).distinct())
    near = saved(_links(starred, sets, percent), "jaccard-links")
    start = saved(connected(near), "jaccard-start").select(F.col("node").alias("set"), "group")

    postings = (sets.select(F.explode("tokens").alias("token"), "set")
                .repartition(partitions_for(total // 8, 1_000_000, spark), "token").sortWithinPartitions("token")
                .mapInArrow(_frequent, "token long, set long, frequency long"))
    ordered = (postings.groupBy("set").agg(F.sort_array(F.collect_list(F.struct("frequency", "token"))).alias("list"))
               .join(alive, "set").select("set", "n", "list"))
    prefixes = saved(ordered.mapInArrow(
        _prefixes(percent), "set long, matches long, n long, prefix array<int>, meets int"), "jaccard-prefixes")
    postings = (prefixes.select("set", "n", F.explode(F.array_distinct(F.slice("prefix", F.lit(1), F.col("meets")))).alias("token"))
                .join(start, "set", "left").withColumn("group", F.coalesce("group", "set")))
    postings = saved(postings, "jaccard-postings")
    lists = (postings.groupBy("token").agg(F.count("*").alias("size"), F.sum("n").alias("tokens"),
                                           F.min("group").alias("low_group"), F.max("group").alias("high_group"))
             .where("low_group <> high_group").select("token", "size", "tokens"))
    lists = saved(lists, "jaccard-lists")
    parts = F.greatest(F.ceil(F.col("size") / LIST_BLOCK), F.ceil(F.col("tokens") / BLOCK_TOKENS)).cast("int")
    # Prefixes join only the rows of lists with several groups.
    blocks = (postings.drop("n").join(lists, "token").withColumn("block", F.pmod(F.xxhash64("set"), parts).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1))).join(prefixes, "set")
              .select("token", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                      "block", "set", "group", "matches", "n", "prefix", "meets"))
    at = ["token", "low", "high"]
    offered = saved(blocks.repartition(*at).sortWithinPartitions(*at).mapInArrow(
        _list_pairs(percent), "a long, b long, token int, low int, high int"), "jaccard-pairs")
    full = (offered.where("b IS NULL").select(*at, F.col("a").alias("set")).join(start, "set", "left")
            .join(sets, "set").select(*at, "set", F.coalesce("group", "set").alias("group"), "tokens"))
    inside = full.repartition(*at).sortWithinPartitions(*at).mapInArrow(_list_links(percent), "a long, b long")
    pairs = offered.where("b IS NOT NULL").select("a", "b").distinct()
    far = saved(_links(pairs, sets, percent).union(inside), "jaccard-links")

    ends = saved(far.select(F.col("a").alias("set")).union(far.select("b")).distinct().join(start, "set", "left")
                 .select("set", F.coalesce("group", "set").alias("group")), "jaccard-ends")
    bridges = (far.join(ends.select(F.col("set").alias("a"), F.col("group").alias("from")), "a")
               .join(ends.select(F.col("set").alias("b"), F.col("group").alias("to")), "b")
               .select(F.col("from").alias("a"), F.col("to").alias("b")))
    merged = connected(bridges).withColumnRenamed("group", "final")
    return (start.union(ends).distinct().join(merged, F.col("group") == F.col("node"), "left")
            .select(F.col("set").alias("node"), F.coalesce("final", "group").alias("group")))
