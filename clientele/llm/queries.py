"""Registered queries of the corpus operators, and the SQL that some are compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.llm.common import crc_of_id, saved, table, whole_text
from clientele.llm.conversations import audit_conversations, damaged, repaired_digests
from clientele.llm.decontamination import find_copies
from clientele.llm.exact_dedup import exact_groups
from clientele.llm.html import extract_text
from clientele.llm.jaccard import near_groups
from clientele.llm.language_model import held_out_fold, score_texts
from clientele.llm.licenses import license_scan
from clientele.llm.packing import pack_tokens
from clientele.llm.pieces import encode_pieces
from clientele.llm.quality import learn_from_fold, quality_scores
from clientele.llm.search import ranked_search
from clientele.llm.sharding import shuffle_into_shards
from clientele.llm.urls import judge_urls

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return add


@register("op2_license_scan")
def op2_license_scan(spark, sf):
    """Every passage of `documents` that is a license notice."""
    return license_scan(table(spark, sf, "documents"))


@register("op8_shard_shuffle")
def op8_shard_shuffle(spark, sf):
    """All documents in 24 shards whose counts differ by one at most (law `rows`).

    The law treats every row alike, so copies are dealt like other rows and have no shard of
    their own; `text_crc32` tells them.  It knows no growth, so `grown_shard` is NULL.
    """
    dealt = shuffle_into_shards(table(spark, sf, "documents"), 24, settled=True)
    text = whole_text(F.col("text"))
    return dealt.select("doc_id", (F.octet_length(text) + 8).cast("bigint").alias("size"),
                        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"),
                        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@register("op7_exact_dedup", """
    WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                        'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
         g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
    FROM d JOIN g USING (t)""")
def op7_exact_dedup(spark, sf):
    """Every document with its group of equal texts."""
    return exact_groups(table(spark, sf, "documents")).drop("text_key")


@register("op6_quality")
def op6_quality(spark, sf):
    """Every document's probability of quality label 1; a fifth of the labels is held out."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    weights = learn_from_fold(docs, table(spark, sf, "labels"))
    return (quality_scores(docs, weights)
            .select("doc_id", (crc_of_id(F.col("doc_id")) % 5 == 0).alias("held_out"), "score",
                    (F.col("score") >= 0.3).cast("int").alias("predicted")))


@register("op1_pack_tokens")
def op1_pack_tokens(spark, sf):
    """All documents as matrices of token ids."""
    return pack_tokens(table(spark, sf, "documents"))


@register("op9_html_text")
def op9_html_text(spark, sf):
    """The main text of every page."""
    pages = table(spark, sf, "pages").select("page_id", "url", "html")
    return extract_text(pages).select("page_id", "url", "text",
                                      F.length("text").cast("bigint").alias("n_chars"))


@register("op3_sentencepiece")
def op3_sentencepiece(spark, sf):
    """The ids of every document's text, and the text decoded from them."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return encode_pieces(docs).select("doc_id", "ids", "n_tokens", "decoded")


@register("op10_decontamination")
def op10_decontamination(spark, sf):
    """Pairs of a document and a benchmark item that it holds a copy of."""
    return find_copies(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@register("op4_jaccard_join")
def op4_jaccard_join(spark, sf):
    """Every document with the group that links of similar word 5-grams make."""
    return near_groups(table(spark, sf, "documents"))


@register("op5_language_model")
def op5_language_model(spark, sf):
    """Every document's log-probability, learnt from four fifths of them."""
    return score_texts(table(spark, sf, "documents"), held_out_fold())


@register("op11_ranked_search", r"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
         i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
         a AS (SELECT count(*) AS big_n, CAST(sum(len(t)) AS BIGINT) AS big_l FROM d WHERE len(t) > 0),
         p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d)
               WHERE term IN (SELECT term FROM i) GROUP BY r, term),
         w AS (SELECT term, CAST(floor(1000 * ln((2 * big_n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
               FROM p, a GROUP BY term, big_n),
         s AS (SELECT i.item_id, d.doc_id, p.r, CAST(sum(w.w * ((1000000000 * tf)
                   // (1000 * tf + 8 * (10 + (90 * len(d.t) * big_n) // big_l)))) AS BIGINT) AS score
               FROM i JOIN p USING (term) JOIN w USING (term) JOIN d ON d.r = p.r, a
               GROUP BY i.item_id, d.doc_id, p.r),
         k AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id
                   ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0)
    SELECT * FROM k WHERE rank <= 10""")
def op11_ranked_search(spark, sf):
    """The ten best documents of every benchmark item."""
    return ranked_search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]


def _level(long: int) -> str:
    return f"""
         l{long} AS (SELECT o.class, o.gram, o.passed, s.p AS shorter, times / (n + d) + o.passed * s.p AS p
                FROM o JOIN l{long - 1} s ON s.class = o.class AND s.gram = substring(o.gram, 2) WHERE long = {long})"""


@register("op13_url_filter", r"""
    WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
         v AS (SELECT *, host || path AS text, CASE
                   WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com'))
                       AND starts_with(path, '/en/') THEN 'www.example.com/en/'
                   WHEN (host = 'example.com' OR ends_with(host, '.example.com'))
                       AND starts_with(path, '/en/') THEN 'example.com/en/'
                   WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
                   WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
                   WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/'
                   END AS rule FROM u),
         t AS (SELECT text, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
                   WHEN rule IS NOT NULL THEN 'block' END AS class, count(*) AS weight,
                   substring(md5(text), 1, 1) IN ('0', '1', '2') AS apart FROM v GROUP BY ALL),
         a AS (SELECT *, unnest(generate_series(1, length(text) + 2)) AS i FROM t),
         b AS (SELECT *, unnest(generate_series(1, least(5, i))) AS k FROM a),
         g AS (SELECT text, class, weight, apart,
                   substring(chr(2) || text || chr(3), i - k + 1, k) AS gram FROM b),
         m AS (SELECT class, sum(weight * (length(text) + 2)) AS total FROM t
               WHERE class IS NOT NULL AND NOT apart GROUP BY class),
         c AS (SELECT class, gram, length(gram) AS long, sum(weight) AS times FROM g JOIN m USING (class)
               WHERE NOT apart GROUP BY class, gram, total HAVING sum(weight) * 32768 >= total),
         x AS (SELECT class, substring(gram, 1, long - 1) AS context, sum(times) AS n, count(*) AS d
               FROM c GROUP BY ALL),
         o AS (SELECT c.*, n, d, d / (n + d) AS passed FROM c
               JOIN x ON x.class = c.class AND x.context = substring(gram, 1, long - 1)),
         l1 AS (SELECT class, gram, passed, 1 / 65536 AS shorter, times / (n + d) + passed / 65536 AS p
                FROM o WHERE long = 1),""" + ",".join(map(_level, range(2, 6))) + r""",
         w AS (SELECT gram, sum(CASE class WHEN 'allow' THEN weight ELSE -weight END) AS weight FROM (
                   SELECT class, gram, ln(p) - ln(shorter) - ln(passed) AS weight FROM (FROM l1 UNION ALL FROM l2
                       UNION ALL FROM l3 UNION ALL FROM l4 UNION ALL FROM l5)
                   UNION ALL SELECT class, context, ln(d / (n + d)) FROM x) GROUP BY gram),
         q AS (SELECT text, class, sum(weight_of) AS s FROM (
                   SELECT text, class, w.weight AS weight_of FROM g JOIN w USING (gram) WHERE class IS NULL OR apart)
               GROUP BY text, class),
         f AS (SELECT t.text, t.class, t.weight, greatest(least(floor(round((coalesce(s, 0)
                   + (length(t.text) + 2) * (SELECT weight FROM w WHERE gram = '')) / (length(t.text) + 2), 9) * 100),
                   2000), -2000) AS bin
               FROM t LEFT JOIN q ON q.text = t.text AND q.class IS NOT DISTINCT FROM t.class
               WHERE t.class IS NULL OR apart),
         z AS (SELECT cut FROM f, (SELECT unnest(generate_series(-2000, 2001)) AS cut) WHERE class IS NOT NULL
               GROUP BY cut ORDER BY round(sum(weight) FILTER (class = 'allow' AND bin >= cut)
                   / sum(weight) FILTER (class = 'allow') + coalesce(sum(weight) FILTER (class = 'block' AND bin < cut), 0)
                   / sum(weight) FILTER (class = 'block'), 12) DESC NULLS LAST, abs(cut), cut LIMIT 1)
    SELECT page_id, host, path, rule, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
               WHEN rule IS NOT NULL OR bin < cut THEN 'block' ELSE 'allow' END AS verdict
    FROM v LEFT JOIN f ON f.text = v.text AND f.class IS NULL AND v.rule IS NULL, z""")
def op13_url_filter(spark, sf):
    """Every page's verdict: by the longest rule that fits its URL, else by the two language models."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    return judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@register("op12_conversation_repair")
def op12_conversation_repair(spark, sf):
    """Faults and the cheapest repair of every conversation, damaged by the contract's rule."""
    conversations = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    rows = damaged(conversations)
    audits = saved(audit_conversations(rows), "conversation-audits")
    hashed = repaired_digests(rows, audits)
    everyone = conversations.select(F.col("conv_id").alias("original")).distinct()
    found = audits.withColumnRenamed("conv_id", "audited").join(
        hashed, F.col("audited").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    counts = [F.coalesce(n, F.lit(0).cast("bigint")).alias(n)
              for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return everyone.join(found, F.col("original").eqNullSafe(F.col("audited")), "left").select(
        F.col("original").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
