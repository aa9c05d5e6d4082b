"""URL filter: rules, and for all other URLs the ratio of two character language models (all native).

The rules also supply the examples: the URLs that they allow and block.  For each of the two classes a Markov
model of variable order is counted, with Witten-Bell smoothing: for a context h with n(h) counted continuations, T(h) of
them distinct, p(c|h) = (count(hc) + T(h) p(c|h')) / (n(h) + T(h)), where h' is h without its first character; a context
that was not counted passes on to h'.  So ln p(c|h) is a sum over the suffixes of h: ln T/(n+T) for each counted
context, and what counting hc adds to it.  Hence the log-likelihood of a text is a sum of one weight for each of its substrings, and
scoring is a join of substrings with weights.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.llm.common import fresh, partitions_for, saved

#: Longest context, in characters.
ORDER = 4
#: A model counts on those substrings that make up at least one in so many of their length, hence on this number at most.
MOST_GRAMS = 1 << 15
#: Labelled texts whose md5 begins with one of these hex digits are kept from the counts, to find the threshold with.
APART = ("0", "1", "2")
#: Bins of the length-normalised ratio, a hundredth of a nat wide, between -BINS / 100 and BINS / 100.
BINS = 2000
#: Characters of a text that are cut into substrings at a time.
PIECE = 512
#: Texts of a task.
TEXTS = 10_000
#: Probability of a character before anything is counted; the same in both models.
UNIFORM = 1 / 65536

_BEGIN, _END = "\x02", "\x03"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (verdict, host, path)
Rules = list[tuple[str, str, str]]


def host_of(url: Column) -> Column:
    """From the first '://' to '/', '?', '#' or the end, A-Z in lower case; empty without '://'."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host to '?', '#' or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(rules: Rules, host: Column, path: Column) -> Column:
    """Number of the longest rule that fits: its host or a subdomain, and the beginning of the path; else NULL.

    Of rules of one length the first wins.
    """
    numbers = sorted(range(len(rules)), key=lambda i: -len("".join(rules[i][1:])))
    fits = [((host == rules[i][1]) | host.endswith(f".{rules[i][1]}")) & path.startswith(rules[i][2]) for i in numbers]
    return F.coalesce(*[F.when(fit, F.lit(i)) for i, fit in zip(numbers, fits)], F.lit(None).cast("int"))


def substrings(texts: DataFrame, keys: list[str]) -> DataFrame:
    """A row for each substring of up to ORDER + 1 characters of `text`, with its beginning and end marked.

    Texts are cut into pieces first, each with the end of the one before it, so that one of any length is read in
    proportion to it.
    """
    cut = F.regexp_extract_all(F.concat(F.lit(_BEGIN), "text", F.lit(_END)), F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    pieces = (texts.select(*keys, cut.alias("pieces"))
              .select(*keys, "pieces", F.posexplode("pieces").alias("place", "piece"))
              .select(*keys, "piece", F.when(F.col("place") > 0, F.expr(f"right(pieces[place - 1], {ORDER})"))
                      .otherwise("").alias("before")))
    pieces = pieces.select(*keys, F.char_length("before").alias("skip"),
                           F.split(F.concat("before", "piece"), "").alias("chars"))
    grams = F.expr(f"""flatten(transform(sequence(skip + 1, size(chars)),
        i -> transform(sequence(1, least({ORDER + 1}, i)), k -> array_join(slice(chars, i - k + 1, k), ''))))""")
    return pieces.select(*keys, F.explode(grams).alias("gram"))


def counted(texts: DataFrame) -> DataFrame:
    """(class, gram, long, times): the substrings of each class that its model counts on.

    Whatever is kept, its beginnings and ends are kept too, because they occur as often at least.
    """
    grams = (substrings(texts, ["class", "weight"]).groupBy("class", "gram").agg(F.sum("weight").alias("times"))
             .withColumn("long", F.char_length("gram")))
    totals = (texts.groupBy("class")
              .agg(F.sum(F.col("weight") * (F.char_length("text") + 2)).alias("total")))
    return (grams.join(F.broadcast(totals), "class").where(F.col("times") * MOST_GRAMS >= F.col("total"))
            .select("class", "gram", "long", "times"))


def gram_weights(grams: DataFrame) -> DataFrame:
    """(gram, weight): what each substring adds to ln p(allowed) - ln p(blocked).

    The empty gram has what every character adds.
    """
    contexts = grams.groupBy("class", F.expr("substring(gram, 1, long - 1)").alias("context")).agg(
        F.sum("times").alias("n"), F.count(F.lit(1)).alias("distinct"))
    contexts = contexts.withColumn("passed", F.col("distinct") / (F.col("n") + F.col("distinct")))
    own = saved(grams.withColumn("context", F.expr("substring(gram, 1, long - 1)"))
                .join(contexts, ["class", "context"]), "url-contexts")
    level = own.where("long = 1").withColumn("shorter", F.lit(UNIFORM))
    levels = []
    for long in range(1, ORDER + 2):
        if long > 1:
            suffixes = levels[-1].select("class", F.col("gram").alias("suffix"), F.col("p").alias("shorter"))
            level = (own.where(F.col("long") == long).withColumn("suffix", F.expr("substring(gram, 2)"))
                     .join(suffixes, ["class", "suffix"]).drop("suffix"))
        p = F.col("times") / (F.col("n") + F.col("distinct")) + F.col("passed") * F.col("shorter")
        levels.append(level.withColumn("p", p).select("class", "gram", "shorter", "passed", "p"))
    seen = reduce(DataFrame.unionByName, levels).select(
        "class", "gram", (F.log("p") - F.log("shorter") - F.log("passed")).alias("weight"))
    as_context = contexts.select("class", F.col("context").alias("gram"), F.log("passed").alias("weight"))
    sign = F.when(F.col("class") == "allow", 1.0).otherwise(-1.0)
    return seen.unionByName(as_context).groupBy("gram").agg(F.sum(sign * F.col("weight")).alias("weight"))


def summed_weights(texts: DataFrame, weights: DataFrame, keys: list[str]) -> DataFrame:
    """`sum` of the weights of all substrings of each row of `texts` (distinct in `keys`), if any has one."""
    # The weights are bounded: two models of ORDER + 1 times MOST_GRAMS substrings at most.
    return (substrings(texts, keys).join(F.broadcast(weights), "gram").groupBy(*keys)
            .agg(F.sum("weight").alias("sum")))


def _per_character(summed: Column, base: Column, text: Column) -> Column:
    """The ratio, rounded so that the order of summation does not matter."""
    long = F.char_length(text) + 2
    return F.round((F.coalesce(summed, F.lit(0.0)) + long * base) / long, 9)


def _bin(ratio: Column) -> Column:
    return F.least(F.greatest(F.floor(ratio * 100).cast("int"), F.lit(-BINS)), F.lit(BINS))


def threshold(histogram: list[tuple[int, str, int]]) -> int:
    """Lowest bin that is allowed: the cut with the best mean share of both classes on its right side.

    Of equal ones that nearest to 0, then the lower.
    """
    total = {name: sum(n for _, c, n in histogram if c == name) for name in ("allow", "block")}
    at: dict[int, dict[str, int]] = {}
    for bin_, name, n in histogram:
        at.setdefault(bin_, {"allow": 0, "block": 0})[name] += n
    right, below = [], {"allow": 0, "block": 0}
    for cut in range(-BINS, BINS + 2):
        share = ((total["allow"] - below["allow"]) / max(1, total["allow"]) + below["block"] / max(1, total["block"]))
        right.append((-round(share, 12), abs(cut), cut))
        for name, n in at.get(cut, {}).items():
            below[name] += n
    return min(right)[2]


def judge_urls(pages: DataFrame, rules: Rules, url_col: str = "url") -> DataFrame:
    """The rows of `pages` with `host`, `path`, `rule`, `verdict` and `ratio`.

    `rule` (like `example.com/en/`) is the longest that fits the URL, else NULL; its verdict holds.  All other URLs are
    allowed if `ratio`, their log-likelihood by the model of allowed less that of blocked URLs for each character of host and path,
    reaches a threshold.  Both models count distinct texts of the URLs that rules decide, weighted by their rows,
    but for three texts in sixteen (by md5), on which the threshold is found: that of the best mean share of right
    verdicts in both classes.

    NULL and URLs without '://' have an empty host and path, fit no rule with a host and are judged as an empty text.  Texts of
    any length are read whole.  Repeated rows are judged alike.  Without blocked examples all other URLs
    are allowed; with blocked ones only, all are blocked.  An empty table gives no rows.  Columns of `pages` that have a new
    column's name keep it; the new column then has underscores before its name.
    """
    columns = list(pages.columns)
    names = {n: fresh(columns, n) for n in ("host", "path", "rule", "verdict", "ratio")}
    number, text, judged = fresh(columns, "number"), fresh(columns, "judged_text"), fresh(columns, "judged")
    url = F.col(f"`{url_col}`")
    rows = pages.select("*", host_of(url).alias(names["host"]), path_of(url).alias(names["path"]))
    rows = rows.select("*", rule_of(rules, F.col(names["host"]), F.col(names["path"])).alias(number),
                       F.concat(names["host"], names["path"]).alias(text))
    named = F.coalesce(*[F.when(F.col(number) == i, F.lit(host + path)) for i, (_, host, path) in enumerate(rules)],
                       F.lit(None).cast("string"))
    given = F.coalesce(*[F.when(F.col(number) == i, F.lit(verdict)) for i, (verdict, _, _) in enumerate(rules)],
                       F.lit(None).cast("string"))
    rows = rows.withColumns({names["rule"]: named, names["verdict"]: given})
    texts = saved(rows.groupBy(F.col(text).alias("text"), F.col(names["verdict"]).alias("class"))
                  .agg(F.count(F.lit(1)).alias("weight")), "url-texts")
    scores, cut = text_ratios(texts)
    scores = scores.select(F.col("text").alias(judged), F.col("ratio").alias(names["ratio"]))
    out = rows.join(scores, F.col(text) == F.col(judged), "left")
    by_model = F.when(_bin(F.col(names["ratio"])) >= cut, "allow").otherwise("block")
    return (out.withColumn(names["verdict"], F.coalesce(names["verdict"], by_model))
            .withColumn(names["ratio"], F.when(F.col(number).isNull(), F.col(names["ratio"])))
            .select(*[F.col(f"`{c}`") for c in columns], *names.values()))


def text_ratios(texts: DataFrame) -> tuple[DataFrame, int]:
    """(text, ratio) of the texts without a class, and the lowest bin that is allowed.

    `texts` has `text`, `class` (allow, block or NULL) and `weight`.  They are dealt out by their number: each gives
    some hundred substrings.
    """
    texts = texts.repartition(partitions_for(texts.count(), TEXTS, texts.sparkSession), "text")
    known = dict(texts.where("class IS NOT NULL").groupBy("class").agg(F.sum("weight")).collect())
    unknown = texts.where("class IS NULL").select("text")
    if len(known) < 2:
        # One kind of examples, or none, decides everything.
        only = 0.0 if "block" not in known else -1.0
        return unknown.withColumn("ratio", F.lit(only)), 0
    apart = F.substring(F.md5(F.col("text").cast("binary")), 1, 1).isin(*APART)
    learnt = texts.where(F.col("class").isNotNull() & ~apart)
    weights = saved(gram_weights(saved(counted(learnt), "url-grams")), "url-weights")
    base = F.lit(weights.where("gram = ''").agg(F.sum("weight")).first()[0] or 0.0)
    weights = weights.where("gram <> ''")
    scored = texts.where(F.col("class").isNull() | apart).select("text", "class", "weight").withColumn(
        "own", F.coalesce("class", F.lit("")))
    sums = summed_weights(scored, weights, ["text", "own"])
    scored = saved(scored.join(sums, ["text", "own"], "left").select(
        "text", "class", "weight", _per_character(F.col("sum"), base, F.col("text")).alias("ratio")), "url-ratios")
    histogram = (scored.where("class IS NOT NULL").groupBy(_bin(F.col("ratio")).alias("bin"), "class")
                 .agg(F.sum("weight").alias("texts")).collect())
    return scored.where("class IS NULL").select("text", "ratio"), threshold([tuple(r) for r in histogram])
