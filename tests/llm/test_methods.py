"""Each operator against a plain version of itself, a library, a round trip or held-out rows."""

import collections
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as proto

from clientele.llm import decontamination, jaccard, language_model, licenses, pieces, quality
from clientele.llm.decontamination import align, find_copies
from clientele.llm.html import main_text
from clientele.llm.packing import pack, pack_tokens
from clientele.llm.queries import QUERIES
from clientele.llm.sharding import communication_matrix, shuffle_into_shards
from clientele.llm.words import WordHasher, bytes_of, ngrams


SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return dict(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())


def _words(text):
    return (text or "").encode().lower().split()


# Words

def test_words_and_ngrams_across_pieces(monkeypatch):
    monkeypatch.setattr("clientele.llm.words.PIECE", 16)
    texts = ["Hello  world\tfoo", "", None, "hello WORLD", "x" * 70 + " y", "a b c d e f", " lead ", "é Ü\x1c\xa0z"]
    data, offsets = bytes_of(pa.array(texts))
    hashes, owner, starts, ends = WordHasher().all_words(data, offsets)
    expected = [(i, w) for i, t in enumerate(texts) for w in _words(t)]
    assert [(o, bytes(data[a:b]).lower()) for o, a, b in zip(owner, starts, ends)] == expected
    by_word = {}
    assert all(by_word.setdefault(w, h) == h for (_, w), h in zip(expected, hashes))
    assert len(set(by_word.values())) == len(by_word)
    _, of, _ = ngrams(hashes, owner, 5, whole_if_short=True)
    assert of.tolist() == [0, 3, 4, 5, 5, 6, 7]


# 1: packing

@pytest.mark.parametrize("width", [1, 7, 64])
def test_best_fit_decreasing(width):
    rng = random.Random(width)
    for _ in range(40):
        sizes = [rng.randint(1, width) for _ in range(rng.randint(0, 60))]
        bins = pack(sizes, width)
        assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
        rooms = []
        for size in sorted(sizes, reverse=True):
            fit = min((r, k) for k, r in enumerate(rooms) if r >= size) if any(r >= size for r in rooms) else None
            if fit is None:
                rooms.append(width - size)
            else:
                rooms[fit[1]] -= size
        assert sorted(rooms) == sorted(width - sum(sizes[i] for i in b) for b in bins)


def test_packed_ids_give_every_text_back(spark, texts):
    import base64

    import tiktoken

    from clientele.llm.packing import END_OF_TEXT, PATTERN, RANKS
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = collections.defaultdict(dict)
    for m in pack_tokens(docs, width=128, window_tokens=20_000).collect():
        ids = np.frombuffer(m["ids"], m["id_type"]).reshape(m["n_rows"], m["width"])
        positions = np.frombuffer(m["positions"], "uint16").reshape(ids.shape)
        for row, (ends, names, parts) in enumerate(zip(m["cu_seqlens"], m["doc_ids"], m["parts"])):
            assert ends[0] == 0 and not ids[row, ends[-1]:].any()
            for a, b, name, part in zip(ends, ends[1:], names, parts):
                assert positions[row, a:b].tolist() == list(range(b - a)) and part not in found[name]
                found[name][part] = ids[row, a:b].tolist()
    lines = open(RANKS, "rb").read().splitlines()
    coder = tiktoken.Encoding("t", pat_str=PATTERN, special_tokens={}, mergeable_ranks={
        base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})
    for name, text in texts.items():
        ids = [i for part in sorted(found[name]) for i in found[name][part]]
        assert ids.pop() == END_OF_TEXT and coder.decode(ids) == text


# 2: licenses

def test_license_scan_equals_comparing_everything(spark):
    notices = dict(licenses.NOTICES)
    rng = random.Random(5)
    lines = []
    for name, text in notices.items():
        words = text.split()
        for rate in (0.0, 0.1, 0.25, 0.5):
            lines.append(" ".join(w if rng.random() >= rate else "other" for w in words))
    lines += ["the of and", "", "license", "permission software license warranty"]
    docs = spark.createDataFrame([(i, f"Some line.\n{t.upper() if i % 2 else t}\nEnd.") for i, t in enumerate(lines)],
                                 "doc_id long, text string")
    got = {(r["doc_id"], r["passage"], r["passage_no"]): (r["license"], round(r["dice"], 9))
           for r in licenses.license_scan(docs).collect()}
    sets = {n: set(licenses._template_bigrams(t)) for n, t in notices.items()}
    expected = {}
    for i, text in docs.collect():
        parts = [("line", k, p) for k, p in enumerate(text.split("\n"))]
        # Without an empty line the text is one paragraph.
        parts += [("paragraph", k, p) for k, p in enumerate(__import__("re").split(r"\n[ \t\r]*\n", text)) if "\n" in p.strip()]
        for kind, k, part in parts:
            own = set(licenses._template_bigrams(part))
            best = max(((2 * len(own & b) / (len(own) + len(b)), n) for n, b in sorted(sets.items(), reverse=True)),
                       key=lambda x: x[0]) if own else (0, "")
            if best[0] >= licenses.THRESHOLD:
                top = min(n for n, b in sets.items() if 2 * len(own & b) / (len(own) + len(b)) == best[0])
                expected[i, kind, k] = (top, round(best[0], 9))
    assert {k: v for k, v in got.items() if k[1] not in ("text", "words")} == expected and expected


def _best_run(words, notice, threshold):
    """(dice, first word, bigrams, shared) of the most similar run of words, all of them compared; None below threshold."""
    pairs, best = [f"{a} {b}" for a, b in zip(words, words[1:])], None
    template = set(licenses._template_bigrams(notice))
    most = int((len(licenses._template_words(notice)) - 1) * (2 - threshold) / threshold + 1e-9)
    for first in range(len(pairs)):
        for end in range(first + 1, min(len(pairs), first + most) + 1):
            shared = len(set(pairs[first:end]) & template)
            size = shared + sum(pair not in template for pair in pairs[first:end])
            dice = 2 * shared / (size + len(template))
            if dice >= threshold and (best is None or dice > best[0]):
                best = (dice, first, size, shared)
    return best


def test_runs_of_words_equal_all_runs(spark):
    """The best of a text's runs for each template, among notices cut, edited, repeated and put into prose."""
    rng = random.Random(9)
    notices = {n: t for n, t in licenses.NOTICES.items() if len(t) < 260}
    bits = [w for t in notices.values() for w in t.split()]
    texts = []
    for i in range(60):
        words = []
        for _ in range(rng.randint(1, 3)):
            words += [rng.choice(bits if i % 3 else ["some", "prose", "of", "the"]) for _ in range(rng.randint(0, 12))]
            words += [w if rng.random() >= 0.08 else rng.choice(bits) for w in rng.choice(list(notices.values())).split()]
            words += words[-4:] if i % 5 == 0 else []
        marks = [" ", "\n * ", "\n# ", "\n\n"]
        texts.append("".join(w + rng.choice(marks if i % 2 else marks[:1]) for w in words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in licenses.license_scan(docs, notices).where("passage = 'words'").collect():
        got.setdefault((r["doc_id"], r["license"]), []).append(
            (r["dice"], r["passage_no"], r["passage_bigrams"], r["shared"]))
    expected = {}
    for i, text in enumerate(texts):
        words = __import__("re").sub(r"[\W_]+", " ", text.lower()).split()
        for name, notice in notices.items():
            best = _best_run(words, notice, licenses.THRESHOLD)
            if best:
                expected[i, name] = best
    assert {k: max(v, key=lambda r: (r[0], -r[1], -r[2])) for k, v in got.items()} == expected and len(expected) > 40


def test_notices_inside_other_words(spark):
    header = licenses.NOTICES["GPL-3.0-header"].split()
    comment = "/*\n" + "".join(f" * {' '.join(header[i:i + 9])}\n" for i in range(0, len(header), 9)) + " */\nint x;"
    texts = ["Copyright (c) 2020 Foo Inc. Licensed under the Apache License, Version 2.0.",
             "Released under the MIT License. See LICENSE for details.", comment,
             "Released under the MIT License. " + "Then much other prose follows here. " * 5 + "Released under the MIT License.",
             "The license of the house and the version of the story that they released."]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1, texts[1]), (None, texts[1]), (None, texts[1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = licenses.license_scan(docs).where("passage = 'words'").collect()
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["license"], r["passage_no"], r["dice"]) for r in found)
    mit = [g for g in got if g[1] == "MIT"]
    assert (0, "Apache-2.0", 5, 1.0) in got and (2, "GPL-3.0-header", 0, 1.0) in got
    assert mit == [(-1, "MIT", 0, 1.0), (-1, "MIT", 0, 1.0), (1, "MIT", 0, 1.0), (1, "MIT", 0, 1.0), (3, "MIT", 0, 1.0),
                   (3, "MIT", 35, 1.0)]
    assert not [g for g in got if g[0] == 4]


def test_runs_of_words_in_a_long_text(spark):
    text = "word " * 100_000 + (licenses.NOTICES["MIT-grant"] + " ") * 50 + "license " * 100_000
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = licenses.license_scan(docs).where("passage = 'words' AND license = 'MIT-grant'").collect()
    assert [(r["passage_no"], r["dice"]) for r in found] == [(100_000, 1.0)]


# 3: pieces

@pytest.fixture(scope="module")
def transducer():
    return pieces.Transducer(open(pieces.MODEL, "rb").read())


def test_pieces_equal_the_library(transducer, texts):
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    rng = random.Random(3)
    odd = ["", " ", "   a", " " * 50 + "b", "x" * 300, "日本語 🙂 é", "<s> </s> <0x41>", "a\tb\r\n", "=" * 70, "12345" * 9]
    odd += ["".join(rng.choice("  abcdethinr\n.,#é▁0123日") for _ in range(rng.randint(0, 30))) for _ in range(800)]
    for text in [*odd, *list(texts.values())[:100]]:
        ids = transducer.encode(text)
        assert ids == library.encode(text) and transducer.decode(ids) == library.decode(ids)
        assert transducer.decode(ids) == text.replace("▁", " ")


def test_unigram_models_take_the_heaviest_path():
    model = proto.ModelProto()
    model.trainer_spec.model_type = 1
    model.normalizer_spec.name, model.normalizer_spec.add_dummy_prefix = "identity", True
    model.normalizer_spec.remove_extra_whitespaces = False
    for piece, score, kind in [("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3), ("▁", -3, 1), ("a", -2, 1), ("b", -2.5, 1),
                               ("ab", -3.9, 1), ("▁a", -4.2, 1), ("ba", -4.1, 1), ("bab", -5.5, 1)]:
        model.pieces.add(piece=piece, score=score, type=kind)
    data = model.SerializeToString()
    library = sentencepiece.SentencePieceProcessor(model_proto=data)
    ours = pieces.Transducer(data)
    for text in ("ab", "abab", "babab a", "aabb ba", "acb", "ccc", "b  a"):
        assert ours.encode(text) == library.encode(text), text


# 4: near copies

def _near(docs, percent=75):
    sets = {}
    for name, text in docs.items():
        w = _words(text)
        sets[name] = frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    group = {d: d for d in sets}

    def top(x):
        while group[x] != x:
            x = group[x]
        return x
    names = sorted(sets)
    for i, a in enumerate(names):
        for b in names[:i]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                low, high = sorted((top(a), top(b)))
                group[high] = low
    return {(d, len(s), top(d)) for d, s in sets.items()}


def test_near_groups_equal_all_pairs(spark, texts):
    got = {tuple(r) for r in QUERIES["op4_jaccard_join"](spark, SF_DIR).collect()}
    assert got == _near(texts)


@pytest.mark.parametrize("pairs_a_set, block, tokens", [(4, 20, 10 ** 6), (0, 1_500, 2_000), (10 ** 6, 1_500, 10 ** 6)])
def test_near_groups_of_one_large_cluster_in_blocks(spark, monkeypatch, pairs_a_set, block, tokens):
    """Copies edited more and more: links, near misses and chains, over posting lists of several blocks.

    Lists give out their pairs or check them in place; blocks end by sets or by tokens.
    """
    monkeypatch.setattr(jaccard, "LIST_BLOCK", block)
    monkeypatch.setattr(jaccard, "BLOCK_TOKENS", tokens)
    monkeypatch.setattr(jaccard, "PAIRS_A_SET", pairs_a_set)
    rng = random.Random(8)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    docs = {}
    for i in range(160):
        words = list(base)
        for _ in range(rng.randrange(0, 9)):
            words[rng.randrange(len(words))] = f"edit{rng.randrange(10 ** 6)}"
        docs[i] = " ".join(words)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    assert {tuple(r) for r in jaccard.near_groups(df).collect()} == _near(docs)


def test_lists_of_refuted_pairs_give_few_rows():
    """300 sets that share two thirds: every pair is a candidate, none a link but those of one chain."""
    rng = np.random.default_rng(3)
    sets = [np.r_[np.arange(200), rng.integers(10 ** 6, 10 ** 9, 100)] for _ in range(300)]
    sets[7], sets[8] = sets[5].copy(), sets[5].copy()
    sets[7][-10:] += 1
    sets[8][-20:] += 1
    n, one = len(sets), np.ones(300, np.int32)
    prefixes = pa.RecordBatch.from_arrays(
        [pa.array(one), pa.array(0 * one), pa.array(0 * one), pa.array(0 * one), pa.array(np.arange(n)),
         pa.array(np.arange(n)), pa.array([1] * n), pa.array([300] * n), pa.array([[1, 2]] * n, pa.list_(pa.int32())),
         pa.array(one)], [f"c{i}" for i in range(10)])
    offered = list(jaccard._list_pairs(75)(iter([prefixes])))
    assert sum(b.num_rows for b in offered) == n and offered[0].column("b").null_count == n
    whole = pa.RecordBatch.from_arrays(
        [*prefixes.columns[:3], pa.array(np.arange(n)), pa.array(np.arange(n)), pa.array(sets, pa.list_(pa.int64()))],
        [f"c{i}" for i in range(6)])
    found = pa.Table.from_batches(jaccard._list_links(75)(iter([whole])))
    assert found.num_rows == 2 and {*found["a"].to_pylist(), *found["b"].to_pylist()} == {5, 7, 8}


def test_overlaps_and_forest_against_sets():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50))) for _ in range(40)]
    shared = jaccard._overlaps(sets)
    assert all(shared[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(40) for j in range(40) if i != j)
    links = rng.random((40, 40)) < 0.03
    links |= links.T
    np.fill_diagonal(links, False)

    def parts(pairs):
        group = list(range(40))
        for a, b in pairs:
            group = [group[a] if g == group[b] else g for g in group]
        return [group.index(g) for g in group]

    one, other = jaccard._forest(links)
    assert parts(zip(one, other)) == parts(zip(*np.nonzero(links)))
    assert len(one) == 40 - len(set(parts(zip(one, other))))


@pytest.mark.parametrize("edges", [[], [(1, 0), (2, 0)], [(i + 1, i) for i in range(9)],
                                   [(5, 1), (5, 2), (2, 3), (7, 8), (8, 8)]])
def test_connected_equals_a_plain_search(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    want = {x: x for e in edges if e[0] != e[1] for x in e}
    for _ in want:
        for a, b in edges:
            if a != b:
                want[a] = want[b] = min(want[a], want[b])
    assert {tuple(r) for r in jaccard.connected(df).collect()} == set(want.items())


def test_prefix_tokens_that_become_one_number_ask_for_fewer_matches():
    number, high = 40, 1 << 32
    tokens = np.arange(1, number + 1)
    asked = []
    for same in (0, 3):
        own = tokens.copy()
        own[1:1 + same] = own[0] + high * np.arange(1, same + 1)
        items = pa.StructArray.from_arrays([pa.array(np.full(number, 2)), pa.array(own)], ["frequency", "token"])
        batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([number]), pa.ListArray.from_arrays(
            pa.array([0, number], pa.int32()), items)], ["set", "n", "list"])
        out = next(jaccard._prefixes(75)(iter([batch])))
        asked.append((out.column(1)[0].as_py(), len(out.column(3)[0])))
    assert asked[1][1] == asked[0][1] and asked[0][0] > 3 and asked[1][0] == asked[0][0] - 3


# 5: language model

def test_attention_gradients():
    rng = np.random.default_rng(0)
    lm = language_model
    model = lm.Attention(lm.Attention.start(np.full(lm.CLASSES, 1 / lm.CLASSES)))
    model.w = {k: v.astype(np.float64) + rng.normal(0, 0.1, v.shape) for k, v in model.w.items()}
    one, two = (rng.integers(0, 20, (6, lm.BLOCK)).astype(np.int16) for _ in range(2))
    one[0] = two[0] = lm.PAD
    told = rng.integers(-1, lm.CLASSES, (6, lm.BLOCK)).astype(np.int16)

    def loss():
        logits, t = model._forward(one, two, np.arange(1, 6, 2))[-1], told[1::2]
        logs = logits - np.log(np.exp(logits).sum(2, keepdims=True))
        return -np.take_along_axis(logs, np.maximum(t, 0)[:, :, None].astype(int), 2)[:, :, 0][t >= 0].mean()

    for name, gradient in model.gradients(one, two, told).items():
        for _ in range(3):
            at = tuple(rng.integers(0, min(s, 20)) for s in model.w[name].shape)
            old, change = model.w[name][at], []
            for step in (1e-4, -1e-4):
                model.w[name][at] = old + step
                change.append(loss())
            model.w[name][at] = old
            assert gradient[at] == pytest.approx((change[0] - change[1]) / 2e-4, rel=1e-3, abs=1e-6), name


def test_weights_are_fitted_to_every_token():
    lm, rng = language_model, random.Random(3)
    with open(lm.RANKS, "rb") as file:
        lines = file.read()
    texts = [" ".join(f"w{rng.randrange(50)}" for _ in range(n)) for n in (0, 1, 15, 16, 17, 31, 32, 200, 1000)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    _, pairs, tokens, counts = lm._read(lm.Subwords(lines), WordHasher(), batch)
    windows = [np.frombuffer(w, np.uint32) for out in lm._windows(lines)(iter([batch])) for w in out.column(0).to_pylist()]
    told = np.concatenate([w[-lm.BLOCK:] for w in windows])
    assert told[told != lm.OUTSIDE].tolist() == pairs[tokens].tolist() and len(windows) == sum(-(-counts // lm.BLOCK))


def test_frequent_words_are_not_split_into_subwords_again():
    lm = language_model
    with open(lm.RANKS, "rb") as file:
        lines = file.read()
    batch = pa.RecordBatch.from_arrays([pa.array(["The house, the HOUSE and a tree", "", None, "tree house"])], ["text"])
    words, pairs, tokens, counts = lm._read(lm.Subwords(lines), WordHasher(), batch)
    order = np.argsort(words)
    head = lm.Head(words[order], pairs[order], np.ones(len(words)))
    known = lm.Subwords(lines, head)
    known.encoding = None
    again = lm._read(known, WordHasher(), batch)
    assert all((a == b).all() for a, b in zip(again, (words, pairs, tokens, counts)))
    some = lm.Head(head.words[::2], head.pairs[::2], head.times[::2])
    plain, quick = ([w for out in lm._windows(lines, h)(iter([batch])) for w in out.column(0).to_pylist()]
                    for h in (None, some))
    assert plain == quick


def test_words_encoded_in_one_text_have_the_ids_of_words_encoded_alone():
    lm = language_model
    with open(lm.RANKS, "rb") as file:
        subwords = lm.Subwords(file.read())
    rng = random.Random(4)
    words = ["The", "it's", "'s", "'LL", "1a2,b..", "&&&", "a_b-c", "d\u3000e", "x\x1cy", "\u0085zz", "f\xa0", "\xa0", "É", "…", "😀a",
             "<|endoftext|>", *("".join(rng.choice("abÉ1,.'_\xa0\u2003 "[:-1]) for _ in range(rng.randrange(1, 9))) for _ in range(300))]
    alone = [subwords.encoding.encode_ordinary(" " + w.encode().lower().decode()) for w in words]
    pairs = subwords.split([w.encode() for w in words])
    assert pairs.tolist() == [ids[0] * 65_536 + ids[-1] for ids in alone]


def test_each_distinct_word_of_a_task_is_encoded_once():
    lm, rng = language_model, random.Random(6)
    with open(lm.RANKS, "rb") as file:
        subwords = lm.Subwords(file.read())
    split, asked = subwords.split, []
    subwords.split = lambda words: asked.extend(words) or split(words)
    for _ in range(3):
        batch = pa.RecordBatch.from_arrays([pa.array([" ".join(f"w{rng.randrange(400)}" for _ in range(2000))])], ["text"])
        words, pairs, _, _ = lm._read(subwords, WordHasher(), batch)
    assert len(asked) == len(set(asked)) <= 400 and len(asked) >= 390
    assert (subwords.known.words[1:] > subwords.known.words[:-1]).all()


def test_windows_of_kept_tokens_are_those_of_the_texts():
    lm, rng = language_model, random.Random(5)
    with open(lm.RANKS, "rb") as file:
        lines = file.read()
    texts = [None, "", *(" ".join(f"W{rng.randrange(90)}" for _ in range(n)) for n in (1, 15, 16, 31, 300)), " "]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    out = list(lm._counted(lines)(iter([batch])))
    kept = [o.select(["tokens"]) for o in out if not o.column(3).null_count]
    counts = collections.Counter()
    for o in out:
        if o.column(3).null_count:
            counts.update({w: n for w, _, n, _ in zip(*(c.to_pylist() for c in o.columns))})
    assert sum(counts.values()) == sum(len(t) // 4 for o in kept for t in o.column(0).to_pylist()) == 363 + len(texts)
    texts, tokens = ([w for o in lm._windows(*args)(iter(rows)) for w in o.column(0).to_pylist()]
                     for args, rows in (((lines,), [batch]), ((), kept)))
    assert texts == tokens


@pytest.mark.parametrize("frequent", [1, 3, 5, 6, 99])
def test_frequent_words_are_those_that_sorting_all_words_gives(spark, monkeypatch, frequent):
    monkeypatch.setattr(language_model, "FREQUENT", frequent)
    rows = [(5, 50, 7), (4, 40, 2), (-3, 30, 2), (2, 20, 2), (1, 10, 9), (0, 60, 1)]
    head = language_model._head(spark.createDataFrame(rows, "word long, pair long, count long").repartition(3))
    want = sorted(sorted(rows, key=lambda r: (-r[2], r[0]))[:frequent], key=lambda r: r[0] % 2 ** 64)
    assert [(w, p, n) for w, p, n in zip(head.words.view(np.int64).tolist(), head.pairs, head.times)] == want


@pytest.mark.parametrize("size", [1, 60])
def test_scores_sum_a_plain_softmax_over_windows(size):
    lm, rng = language_model, np.random.default_rng(1)
    model = lm.Attention(lm.Attention.start(np.full(lm.CLASSES, 1 / lm.CLASSES)))
    model.w = {k: (v + rng.normal(0, 0.2, v.shape) * size).astype(np.float32) for k, v in model.w.items()}
    counts = np.array([1, 15, 16, 17, 700, 1, 1, 64])
    told = rng.integers(0, lm.CLASSES, counts.sum())
    placed, scored, _ = lm._places(told, counts)
    one, two = (np.where(placed >= 0, rng.integers(0, lm.SYMBOLS - 2, placed.shape), lm.PAD).astype(np.int16) for _ in range(2))
    got = model.log_probabilities(one, two, placed.astype(np.int16), scored)
    logits = model._forward(one, two, scored)[-1].astype(np.float64)
    top = logits.max(axis=2, keepdims=True)
    logs = logits - top - np.log(np.exp(logits - top).sum(axis=2, keepdims=True))
    want = np.take_along_axis(logs, np.maximum(placed[scored], 0)[:, :, None], axis=2)[:, :, 0]
    assert np.allclose(got[scored], np.where(placed[scored] >= 0, want, 0), rtol=1e-3, atol=1e-3 * size)


def test_language_model_counts_and_held_out_texts(spark, texts):
    counts = collections.Counter()
    for name, text in texts.items():
        if zlib.crc32(str(name).encode()) % 5 != 1:
            counts.update([*_words(text), "end"])
    total, whole = sum(counts.values()), sum(counts.values()) + 0.5 * (len(counts) + 1)
    better = 0.0
    for r in QUERIES["op5_language_model"](spark, SF_DIR).collect():
        tokens = [*_words(texts[r["doc_id"]]), "end"]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(counts[t] > 0 for t in tokens), total)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[t] + 0.5) / whole) for t in tokens))
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1)
        better += (r["score"] - r["base_score"]) * r["held_out"]
    assert better > 0


# 6: quality

def test_quality_of_held_out_labels(spark):
    scored = QUERIES["op6_quality"](spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").where("held_out")
    rows = scored.select("score", "quality", "predicted").collect()
    good, bad = ([r["score"] for r in rows if r["quality"] == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    assert all(r["predicted"] == 1 for r in rows if r["quality"] == 1)


# 7: exact duplicates

def test_exact_groups_equal_sql(spark):
    import duckdb

    from clientele.llm.queries import ORACLES
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    got = QUERIES["op7_exact_dedup"](spark, SF_DIR).toPandas()
    want = con.execute(ORACLES["op7_exact_dedup"]).df()[got.columns]
    assert got.sort_values("doc_id").values.tolist() == want.sort_values("doc_id").values.tolist()


def test_block_names_of_short_blocks(spark):
    from clientele.llm.exact_dedup import exact_groups
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(0, 40))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    last = {t: i for i, t in enumerate(texts)}
    sizes = collections.Counter(texts)
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_groups(df, block_bytes=3).collect()}
    assert got == {i: (last[t], sizes[t], last[t] == i) for i, t in enumerate(texts)}


# 8: shards

def test_communication_matrix_has_exact_margins_and_means():
    sources, shards = [5, 0, 17, 1, 30], [11, 11, 11, 10, 10]
    sums = np.zeros((5, 5))
    for seed in range(300):
        m = np.array(communication_matrix(sources, shards, seed))
        assert m.sum(1).tolist() == sources and m.sum(0).tolist() == shards and m.min() >= 0
        sums += m
    assert np.abs(sums / 300 - np.outer(sources, shards) / 53).max() < 0.6


@pytest.mark.parametrize("settled", [True, False])
def test_shards_hold_every_row_once(spark, settled):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = shuffle_into_shards(docs, 7, settled=settled, block_rows=5).select("doc_id", "shard", "slot").collect()
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert sorted(r["doc_id"] for r in rows) == sorted(r[0] for r in docs.select("doc_id").collect())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


# 9: pages

@pytest.mark.parametrize("page, text", [
    ("", ""), ("plain &lt; text", "plain < text"), ("<p>unclosed <b", "unclosed <b"),
    ("<html><body><nav><ul><li><a>x</a></ul></nav><article><h1>T &amp; t</h1><p>A  <b>b</b>\n c.<p>D&#101;.<div class=ad>Buy</div>"
     "<ul><li>one<li>two</ul></article><section id='comments'><p>Nice.</p></section><footer>&copy;</footer>"
     "<script>var a='<p>no</p>';</script></body></html>", "T & t\nA b c.\nDe.\none\ntwo"),
    ("<body><div class='cookie-notice'>We use cookies.</div><div><h2>Head</h2><p>Long text, with points. More of it.</p>"
     "<p>Short.</p></div><div class=sidebar><p>Links, more.</p></div><form><label>Mail</label></form></body>",
     "Head\nLong text, with points. More of it.\nShort.")])
def test_main_text(page, text):
    assert main_text(page) == text


STORY = "The council met on Monday, and it voted. Nobody left early, said the mayor; the vote was close."


@pytest.mark.parametrize("page, text", [
    (f"<body><div id=content><p>{STORY}</p><p>{STORY}</p></div><article class='teaser'><h3>More</h3><a href=x>Read</a></article>"
     "<article class='comment'><p>I was there, too. It was long.</p></article></body>", f"{STORY}\n{STORY}"),
    # Smoothing reaches two blocks, so the list is three away from the story.
    ("<body><article><ul><li>Home</li><li>News</li></ul><h1>Council</h1><h2>Vote</h2>" + f"<p>{STORY}</p>" * 3
     + "</article></body>", "Council\nVote" + f"\n{STORY}" * 3)])
def test_ratios_decide_beside_and_within_articles(page, text):
    assert main_text(page) == text



# 10: leaks

def test_alignment_equals_the_full_table():
    rng = random.Random(2)
    for _ in range(300):
        a, b = ([rng.randint(0, 4) for _ in range(rng.randint(lo, 14))] for lo in (1, 0))

        def best(x, y):
            cell, top = [[0] * (len(y) + 1) for _ in range(len(x) + 1)], 0
            for i in range(1, len(x) + 1):
                for j in range(1, len(y) + 1):
                    cell[i][j] = max(0, cell[i - 1][j - 1] + (1 if x[i - 1] == y[j - 1] else -1), cell[i - 1][j] - 1, cell[i][j - 1] - 1)
                    top = max(top, cell[i][j])
            return top
        score, begin, end = align(np.array(a, np.uint64), np.array(b, np.uint64))
        assert score == best(a, b) and (not score or best(a, b[begin:end]) == score)


@pytest.mark.parametrize("block_words", [1_000_000, 40])
def test_edited_copies_are_found_and_others_are_not(spark, block_words):
    rng = random.Random(4)
    item = lambda k: [f"i{k}w{rng.randrange(300)}" if rng.random() < 0.6 else "the" for _ in range(40)]
    items = {k: item(k) for k in range(6)}
    docs, planted = {}, set()
    for i in range(60):
        words = [f"d{rng.randrange(3000)}" if rng.random() < 0.6 else "the" for _ in range(200)]
        if i % 3 == 0:
            k, copy = i % 6, []
            for w in items[i % 6]:
                roll = rng.random()
                copy += [] if roll < 0.04 else [w, "new"] if roll < 0.08 else ["other"] if roll < 0.14 else [w]
            words[100:100] = copy
            planted.add((i, k))
        docs[i] = " ".join(words)
    found = find_copies(spark.createDataFrame(list(docs.items()), "doc_id long, text string"),
                        spark.createDataFrame([(k, " ".join(w).upper()) for k, w in items.items()], "item_id long, text string"),
                        block_words=block_words).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == planted
    assert all(90 <= r["first_word"] <= 110 and r["score"] >= 0.5 for r in found)


@pytest.mark.parametrize("threshold, most_hits", [(0.3, 1_000_000), (0.5, 1_000_000), (0.5, 7), (0.8, 1_000_000)])
def test_copies_equal_aligning_every_document_with_every_item(spark, monkeypatch, threshold, most_hits):
    monkeypatch.setattr(decontamination, "MOST_HITS", most_hits)
    rng = random.Random(6)
    items = {k: [f"i{k}w{j}" if rng.random() < 0.7 else rng.choice(["the", "of", "and"]) for j in range(rng.randint(3, 40))]
             for k in range(40)}
    docs = {}
    for i in range(100):  # an edited copy of each item twice, and an exact one of half of them
        around = [[rng.choice(["the", "of", "and", f"d{rng.randrange(500)}"]) for _ in range(60)] for _ in range(2)]
        copy = list(items[i % 40])
        if i < 40:
            for at in rng.sample(range(len(copy)), int(len(copy) * rng.choice([0.2, 0.25]))):
                copy[at] = f"new{rng.randrange(500)}" if i % 2 else f"{copy[at]} new{rng.randrange(500)}"
        elif i < 80:  # a word put in after every second one: no three words in a row are left
            copy = " ".join(w if j % 2 else f"{w} {copy[j + 1]} new{j}" for j, w in enumerate(copy[:-1]) if j % 2 == 0).split()
        docs[i] = " ".join(around[0] + copy + around[1]).split()
    number = {w: n for n, w in enumerate(sorted({w for words in [*docs.values(), *items.values()] for w in words}))}
    coded = lambda words: np.array([number[w] for w in words])
    expected = {}
    for i, words in docs.items():
        for k, item in items.items():
            score, *span = align(coded(item), coded(words))
            if score >= threshold * len(item):
                expected[i, k] = round(score / len(item), 9)
    frame = lambda rows, names: spark.createDataFrame([(k, " ".join(w)) for k, w in rows.items()], names)
    found = find_copies(frame(docs, "doc_id long, text string"), frame(items, "item_id long, text string"), threshold)
    least = {k: max(2, np.ceil(threshold * len(item) - 1e-9)) for k, item in items.items()}
    # A score of one is one word alone, which is no seed.
    expected = {pair: score for pair, score in expected.items() if score * len(items[pair[1]]) > least[pair[1]] - 0.5}
    got = {(r["doc_id"], r["item_id"]): round(r["score"], 9) for r in found.collect() if r["score"] * r["item_words"] > 1.5}
    assert got == expected
    assert {(i, i % 40) for i in range(80, 100)} < set(expected)
    three = lambda words: {tuple(words[j:j + 3]) for j in range(len(words) - 2)}
    alone = {(i, k) for i, k in expected if not three(docs[i]) & three(items[k])}
    assert threshold > 0.5 or alone  # copies that only pairs of words find


def test_fewest_shared_seeds_hold_for_random_edits():
    rng = random.Random(8)
    for _ in range(3000):
        n = rng.randint(3, 30)
        copy = []
        for w in range(n):
            roll = rng.random()
            copy += [] if roll < 0.1 else [w, 100 + w] if roll < 0.3 else [100 + w] if roll < 0.4 else [w]
        if not copy:
            continue
        score = align(np.arange(n), np.array(copy))[0]
        shared = {(a, a + 1) for a, b in zip(copy, copy[1:]) if b == a + 1 and b < n}
        if score >= 0.5 * n:
            assert len(shared) >= decontamination.fewest_shared(n, 0.5)


def test_registered_names():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in QUERIES}


def test_averaged_model_is_the_mean_of_the_learners(spark, monkeypatch):
    """Blocks of models come from their tasks as they are, or cut over batches; weights count by examples."""
    rng = np.random.default_rng(5)
    models = [(int(rng.integers(1, 9)), rng.normal(size=70).astype(np.float32)) for _ in range(4)]
    rows = [(b, e, m[b * 32:b * 32 + 32].tobytes()) for b in range(3) for e, m in models]
    whole = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["block", "examples", "weights"])
    got = [r for b in quality._summed(iter([whole.slice(0, 5), whole.slice(5, 0), whole.slice(5)])) for r in b.to_pylist()]
    assert [r["block"] for r in got] == [0, 1, 2]
    mean = np.concatenate([np.frombuffer(r["sums"]) / r["examples"] for r in got])
    assert np.allclose(mean, np.average([m for _, m in models], axis=0, weights=[e for e, _ in models]))

    docs = spark.createDataFrame([(i, f"{'good' if i % 3 else 'bad'} text {i}") for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(60)], "doc_id long, quality int")
    one = quality.learn_quality(docs, labels, bits=10)
    monkeypatch.setattr(quality, "BLOCK", 100)
    assert np.array_equal(one, quality.learn_quality(docs, labels, bits=10))
    assert len(one) == 1025 and one.any()
