"""Ranked search, conversation repair and URL filter against plain versions of themselves, and on awkward rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from clientele.llm import search, urls
from clientele.llm.conversations import audit_conversations, auction, damaged, repaired_digests, repaired_rows, solved
from clientele.llm.html import main_text
from clientele.llm.queries import QUERIES, URL_RULES
from clientele.llm.search import masks, ranked_search, terms_of

SF_DIR = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# 11: ranked search

def _terms(text):
    return TERM.findall((text or "").translate(LOWER))


def _plain_ranking(docs, items, top=10):
    held = [(i, collections.Counter(_terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, total = len(held), sum(c.total() for _, c in held)
    holding = collections.Counter(t for _, c in held for t in c)
    wanted = collections.defaultdict(set)
    for i, text in items:
        wanted[i] |= set(_terms(text))
    out = []
    for item, terms in wanted.items():
        scores = []
        for doc, counts in held:
            long = 10 + 90 * counts.total() * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[t] + 1)))
                        * (10 ** 9 * counts[t] // (1000 * counts[t] + 8 * long)) for t in terms if counts[t])
            if score > 0:
                scores.append((-score, doc is not None, doc))
        out += [(item, rank, doc, -score) for rank, (score, _, doc) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=repr)


def test_terms_are_never_cut(monkeypatch):
    monkeypatch.setattr(search, "PIECE", 5)
    text = "Ab-cd 12ÄÖ_xyz\x00q" + "w" * 40 + " é"
    assert [t for piece in terms_of(text.encode()) for t in piece] == [t.encode() for t in _terms(text)]


def test_masks_group_equal_columns():
    rng = np.random.default_rng(3)
    presence = rng.random((70, 300)) < 0.02
    order, first = masks(presence)
    groups = [{presence[:, d].tobytes() for d in g} for g in np.split(order, first[1:])]
    assert all(len(g) == 1 for g in groups)
    assert len(set().union(*groups)) == len(groups)


def test_ranked_search_equals_scoring_everything(spark, monkeypatch):
    # Small blocks, steps and matrices, so that masks are pruned and cut in many ways.
    monkeypatch.setattr(search, "CELLS", 1 << 10)
    monkeypatch.setattr(search, "FIRST_LOOK", 2)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text")
    got = sorted(map(tuple, ranked_search(docs, items, block_bytes=1 << 11).collect()), key=repr)
    assert got == _plain_ranking(docs.collect(), items.collect())


def test_ranked_search_awkward_rows(spark):
    docs = spark.createDataFrame(
        [(5, "red fox"), (3, "Red, FOX!"), (None, "red fox"), (3, "red fox"), (7, None), (8, " .,;"), (9, "blue " * 50_000),
         (1, "red")], "doc_id long, text string").withColumn("rank", docs_col()).withColumn("score", docs_col())
    items = spark.createDataFrame([(1, "RED fox red"), (1, "blue"), (None, "fox"), (2, None), (3, "absent"), (4, "")],
                                  "item_id long, text string")
    plain = _plain_ranking([(r[0], r[1]) for r in docs.collect()], [tuple(r) for r in items.collect()], 4)
    got = ranked_search(docs, items, top=4)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain
    assert [r["doc_id"] for r in got.where("item_id IS NULL").orderBy("rank").collect()] == [None, 3, 3, 5]
    assert ranked_search(docs.limit(0), items).count() == 0
    assert ranked_search(docs, items.limit(0)).count() == 0


def docs_col():
    from pyspark.sql import functions as F
    return F.lit(0)


# 12: conversation repair

def _plain_edits(letters):
    """Least (cost, initials) from the end to the beginning, state by state."""
    insert, wanted, after = {0: 2, 1: 2, 2: 3, 3: 2}, {0: "u", 1: "u", 2: "a", 3: "u"}, {"s": 1, "u": 2, "a": 3}
    best = [(0, ""), (4, "II"), (2, "I"), (0, "")]
    for letter in reversed(letters):
        role, late, now = letter.lower(), letter.isupper(), []
        for state in range(4):
            ways = [(3 + best[state][0], "D" + best[state][1])]
            if letter not in "bd":
                if role == wanted[state] or (role == "s" and state == 0):
                    ways.append((late + best[after[role]][0], "K" + best[after[role]][1]))
                ways.append((2 + late + best[insert[state]][0], "R" + best[insert[state]][1]))
            now.append(min(ways))
        for _ in range(4):
            for state in range(4):
                cost, initials = now[insert[state]]
                now[state] = min(now[state], (2 + cost, "I" + initials))
        best = now
    return best[0]


def _plain_repair(rows):
    out, kept = {}, {}
    conversations = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        conversations[conv].append((turn, " " if role is None else role, " " if text is None else text))
    for conv, own in conversations.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()[:16]))
        turns = {t for t, _, _ in own if t is not None}
        seen, letters = set(), ""
        for _, role, text in own:
            content = text.rstrip(" \t\n\x0b\x0c\r")
            letter = role[:1] if role[:1] in ("s", "u", "a") else "x"
            letters += ("b" if not content else "d" if (role, text) in seen
                        else letter if content[-1] in ".!?" else letter.upper())
            seen.add((role, text))
        illegal = sum((a[1][:1], b[1][:1]) not in (("s", "u"), ("u", "a"), ("a", "u")) for a, b in zip(own, own[1:]))
        cost, audit = _plain_edits(letters)
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, letters.count("b"), letters.count("d"),
                     sum(map(letters.count, "SUAX")), illegal, cost, audit)
        rest, state, done = iter(own), 0, []
        wanted, after = {0: "user", 1: "user", 2: "assistant", 3: "user"}, {"s": 1, "u": 2, "a": 3}
        for edit in audit:
            role, text = (wanted[state], "") if edit == "I" else next(rest)[1:]
            if edit == "D":
                continue
            role = wanted[state] if edit == "R" else role
            state = after[role[0]]
            done.append((edit, role, text))
        kept[conv] = done
    return out, kept


def test_auction_prices_are_exact_for_the_entries():
    rng = random.Random(5)
    for _ in range(200):
        letters = "".join(rng.choice("bdsuaxSUAX") for _ in range(rng.randint(1, 9)))
        prices = auction(letters, (0, 4, 2, 0), (0, 1, 2, 3))
        for row in range(len(letters)):
            for state in range(4):  # a lower bound everywhere
                assert prices[row][state] <= prices[row + 1][state] + 3
        assert prices[0][0] == _plain_edits(letters)[0]


@pytest.mark.parametrize("size", [0, 1, 2, 5, 15, 16, 17, 33, 64, 65, 130])
def test_edits_are_cheapest_and_least(size):
    rng = random.Random(size)
    for _ in range(60):
        letters = "".join(rng.choice("bdsuaxSUAXuauaua") for _ in range(size))
        assert solved(letters) == _plain_edits(letters)


def _messy(seed, conversations, longest):
    rng, rows = random.Random(seed), []
    for conv in range(conversations):
        for turn in range(rng.randint(1, longest)):
            rows.append((conv, rng.choice([turn, turn, turn, turn + 3, None]),
                         rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None]),
                         rng.choice(["Yes.", "no", "Well!  ", " \t", "", None, "What?\n", f"Number {turn}", f"It is {turn}."])))
    return rows


def test_conversations_equal_plain_repair(spark):
    # One conversation holds most rows: it is dealt over several tasks.
    rows = _messy(1, 60, 9) + [(None, *r[1:]) for r in _messy(2, 1, 9)]
    long = random.Random(4)
    rows += [(1000, t // 2, long.choice(["user", "assistant"]), long.choice(["Yes.", f"Say {t}.", f"Say {t}"])) for t in range(1500)]
    rows += [(1000, 7, "user", "again")] * 40
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    expected, kept = _plain_repair(rows)
    audits = audit_conversations(df).cache()
    assert {r[0]: tuple(r[1:]) for r in audits.collect()} == expected
    got = collections.defaultdict(list)
    for r in sorted(repaired_rows(df, audits).collect(), key=lambda r: r["place"]):
        assert r["place"] == len(got[r["conv_id"]])
        got[r["conv_id"]].append((r["edit"], r["role"], r["text"]))
    assert dict(got) == {c: k for c, k in kept.items() if k}
    hashes = {r[0]: r[1] for r in repaired_digests(df, audits).collect()}
    assert hashes == {c: hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t in k).encode()).hexdigest()
                      for c, k in kept.items() if k}
    for audit in kept.values():
        assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for _, role, _ in audit))


def test_conversations_empty_and_clashing(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert audit_conversations(empty).count() == 0
    odd = spark.createDataFrame([("a", 1, "user", "Hi.", "x"), ("a", 2, "assistant", "y" * 200_000 + ".", "x")],
                                "conv_id string, turn int, role string, text string, key string")
    audits = audit_conversations(odd)
    assert [tuple(r) for r in audits.collect()] == [("a", 0, 0, 0, 0, 0, 0, "KK")]
    assert repaired_rows(odd, audits).count() == 2


def test_damage_follows_the_crc(spark):
    rows = _messy(9, 120, 8) + [(None, None, None, None)]
    got = collections.Counter(map(tuple, damaged(spark.createDataFrame(
        rows, "conv_id long, turn long, role string, text string")).collect()))
    expected = collections.Counter()
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind:
            expected[(conv, turn, "user" if kind == 4 else role,
                      "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)] += 1 + (kind == 3)
    assert got == expected


def test_conversation_query_has_every_conversation(spark):
    """Also those of which the damage leaves nothing."""
    rows = spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text")
    expected, kept = _plain_repair([tuple(r) for r in damaged(rows).collect()])
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    got = {r[0]: tuple(r[1:]) for r in QUERIES["op12_conversation_repair"](spark, SF_DIR).collect()}
    assert set(got) == {r[0] for r in rows.select("conv_id").distinct().collect()}
    for conv, row in got.items():
        if conv in expected:
            text = "\n".join(f"{r}:{t}" for _, r, t in kept[conv])
            assert row == (*expected[conv], hashlib.sha256(text.encode()).hexdigest())
        else:
            assert row == nothing


# 13: URL filter

def _plain_models(texts):
    """Log-likelihood of a text by the model of each class, by the recursion itself."""
    models = {}
    for name in ("allow", "block"):
        grams, total = collections.Counter(), 0
        for text, own, weight in texts:
            if own == name and hashlib.md5(text.encode()).hexdigest()[0] not in urls.APART:
                marked = f"\x02{text}\x03"
                total += weight * len(marked)
                for i in range(len(marked)):
                    for k in range(1, min(urls.ORDER + 1, i + 1) + 1):
                        grams[marked[i + 1 - k:i + 1]] += weight
        grams = {g: n for g, n in grams.items() if n * urls.MOST_GRAMS >= total}
        follows = collections.defaultdict(list)
        for g, n in grams.items():
            follows[g[:-1]].append(n)
        models[name] = (grams, follows)

    def probability(name, context, char):
        grams, follows = models[name]
        shorter = probability(name, context[1:], char) if context else urls.UNIFORM
        if context not in follows:
            return shorter
        n, distinct = sum(follows[context]), len(follows[context])
        return (grams.get(context + char, 0) + distinct * shorter) / (n + distinct)

    def ratio(text):
        marked = f"\x02{text}\x03"
        return sum(math.log(probability("allow", marked[max(0, i - urls.ORDER):i], c)
                            / probability("block", marked[max(0, i - urls.ORDER):i], c))
                   for i, c in enumerate(marked)) / len(marked)
    return ratio


def test_ratio_equals_the_recursion(spark, monkeypatch):
    """Texts longer than a piece, and substrings too rare to count on, included."""
    monkeypatch.setattr(urls, "PIECE", 7)
    monkeypatch.setattr(urls, "MOST_GRAMS", 300)
    rng, texts = random.Random(2), []
    for i in range(160):
        name = ("allow", "block", None)[i % 3]
        chars = {"allow": "abc./", "block": "xyz./"}.get(name, "abxy./é")
        texts.append(("".join(rng.choice(chars) for _ in range(rng.randint(0, 30))) + str(i), name, rng.randint(1, 4)))
    scored, cut = urls.text_ratios(spark.createDataFrame(texts, "text string, class string, weight long"))
    got, ratio = dict(map(tuple, scored.collect())), _plain_models(texts)
    assert set(got) == {t for t, name, _ in texts if name is None}
    assert all(abs(value - ratio(text)) < 1e-8 for text, value in got.items())
    apart = [(ratio(t), name, w) for t, name, w in texts
             if name and hashlib.md5(t.encode()).hexdigest()[0] in urls.APART]
    right = sum(w for r, name, w in apart if (math.floor(r * 100) >= cut) == (name == "allow"))
    assert right / sum(w for _, _, w in apart) > 0.9


def test_rules_and_hosts(spark):
    cases = {
        "https://shop.Example.COM/en/1?x=/de/": ("shop.example.com", "/en/1", "example.com/en/"),
        "https://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/"),
        "https://a.www.example.com/en/2#t": ("a.www.example.com", "/en/2", "www.example.com/en/"),
        "https://notexample.com/en/": ("notexample.com", "/en/", "com/"),
        "http://example.com": ("example.com", "", None),
        "http://example.com?/en/": ("example.com", "", None),
        "ftp://x.net/es/a": ("x.net", "/es/a", "net/es/"),
        "http://x.net/de/http://y.com/": ("x.net", "/de/http://y.com/", None),
        "no scheme.com/": ("", "", None), "": ("", "", None), None: ("", "", None),
        "a\nb://h.com/x\ny": ("h.com", "/x\ny", "com/"),
    }
    pages = spark.createDataFrame([(u, "kept", "kept") for u in cases for _ in range(2)],
                                  "url string, host string, verdict string")
    out = urls.judge_urls(pages, URL_RULES).collect()
    assert len(out) == 2 * len(cases)
    for r in out:
        assert (r["_host"], r["path"], r["rule"]) == cases[r["url"]]
        assert r["host"] == r["verdict"] == "kept"
        if r["rule"]:
            assert r["_verdict"] == ("block" if r["rule"] in ("example.com/en/", "net/es/") else "allow")
        assert r["_verdict"] in ("allow", "block")
    assert urls.judge_urls(pages.limit(0), URL_RULES).count() == 0


def test_one_kind_of_examples_decides(spark):
    pages = spark.createDataFrame([("http://a.com/x",), ("http://b.org/" + "y" * 30_000,)], "url string")
    for verdict in ("allow", "block"):
        out = urls.judge_urls(pages, [(verdict, "com", "/")])
        assert {r["verdict"] for r in out.collect()} == {verdict}


def test_urls_like_blocked_ones_are_blocked(spark):
    """Held out: URLs whose rule is taken away get their rule's verdict from the models."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url")
    full = {r["page_id"]: r for r in urls.judge_urls(pages, URL_RULES).collect()}
    fewer = [("allow", "com", "/de/"), ("allow", "com", "/es/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
    out = [r for r in urls.judge_urls(pages, fewer).collect()
           if r["rule"] is None and full[r["page_id"]]["rule"] == "com/"]
    assert len(out) > 5
    assert sum(r["verdict"] == "allow" for r in out) / len(out) > 0.7


# 9: main text, names of classes and time

TALE = "It was a long story, as the men said. They had been there, and so on. Nobody knew why."


@pytest.mark.parametrize("page, text", [
    # What a class says about the state of an element is no mark.
    (f"<body><article class='post has-comments'><h1>T</h1><p>{TALE}</p></article></body>", f"T\n{TALE}"),
    (f"<body><div class='content no-sidebar'><h1>T</h1><p>{TALE}</p></div></body>", f"T\n{TALE}"),
    # Nor is a mark that holds the heart of the page; one around a part of it still counts.
    (f"<body><div class='widget page'><h1>T</h1><p>{TALE}</p><div class=ad><p>{TALE}</p></div></div></body>", f"T\n{TALE}"),
    (f"<body><article><p>{TALE}</p><p>{TALE}</p></article><div class='comments'><p>{TALE}</p><p>{TALE}</p><p>{TALE}</p></div>",
     f"{TALE}\n{TALE}"),
    # A marked inline element leaves its block whole.
    (f"<body><article><p>See the <span class='tags'>x</span> of 1990. {TALE}</p></article></body>", f"See the of 1990. {TALE}"),
    (f"<body><article><p>One <b hidden>two</b>three. {TALE}</p></article></body>", f"One three. {TALE}"),
    # Headings follow their section.
    (f"<body><div><h3>Latest news</h3><ul><li><a>a</a><li><a>b</a></ul></div><article><h1>T</h1><p>{TALE}</p><h2>U</h2>"
     f"<p>{TALE}</p></article></body>", f"T\n{TALE}\nU\n{TALE}"),
    # Quotes belong to attribute values only.
    (f"<body><article><p class=it's>{TALE}</p><p title=\"a>b\">{TALE}</p></article></body>", f"{TALE}\n{TALE}")])
def test_marks_and_headings(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("page", ["<a ", '<a b="', "<b>x", "<div>", "<!x ", "<div class=ad><h1>", "</script "])
def test_time_goes_with_the_length_of_a_page(page):
    import time
    page = "<script>" * (page == "</script ") + page * (400_000 // len(page))
    start = time.process_time()
    main_text(page)
    assert time.process_time() - start < 15
