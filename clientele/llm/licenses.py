"""License scans: passages of documents compared with license notices by Dice coefficient."""

from __future__ import annotations

import json
import math
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The notices that public licenses ask for, one passage each.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"),
    "Apache-2.0-warranty": (
        "Unless required by applicable law or agreed to in writing, software distributed under the "
        "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied. See the License for the specific language governing permissions "
        "and limitations under the License."),
    "BSD-2-Clause": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "BSD-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:"),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related or "
        "neighboring rights to this work."),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version "
        "3 of the License, or (at your option) any later version."),
    "GPL-warranty": (
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
        "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
        "See the GNU General Public License for more details."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies."),
    "MIT": "Released under the MIT License.",
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the \"Software\"), to deal in the Software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions:"),
    "MIT-warranty": (
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING "
        "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT."),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
}

# Words of the notices that ordinary prose uses all the time.
COMMON = set("""
    a above additional an and any are at be by copy details either express following for form general
    granted held in including is it later more must not of on only option or other person possible
    provided public publish published related released see source subject that the this to under use
    used version with within without work you your
""".split())

THRESHOLD = 0.75
#: The templates travel in the plan, so their number of bigrams is bounded.
MAX_TEMPLATE_BIGRAMS = 100_000


def _template_words(text: str) -> list[str]:
    return re.sub(r"[\W_]+", " ", text.lower()).split()


def _template_bigrams(text: str) -> list[str]:
    words = _template_words(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def _needed_words(templates: dict[str, list[str]], threshold: float) -> list[str]:
    """Words of which every passage that reaches the threshold has at least one.

    Such a passage shares at least threshold / (2 - threshold) of the template's bigrams, so
    it shares one of any set that holds more than the rest of them.  Words are picked
    until they touch that many bigrams of each template: first rare long words, each time the one
    that helps most.
    """
    left = {name: len(b) - math.ceil(threshold / (2 - threshold) * len(b) - 1e-9) + 1
            for name, b in templates.items()}
    untouched = {name: set(b) for name, b in templates.items()}
    words = sorted({w for b in templates.values() for pair in b for w in pair.split()})
    tiers = [[w for w in words if w not in COMMON and len(w) >= 5],
             [w for w in words if w not in COMMON and len(w) < 5], [w for w in words if w in COMMON]]
    picked: list[str] = []
    for tier in tiers:
        while True:
            gain = {w: sum(min(left[n], sum(w in pair.split() for pair in pairs))
                           for n, pairs in untouched.items() if left[n] > 0) for w in tier}
            word = max(tier, key=lambda w: (gain[w], len(w)), default=None)
            if word is None or not gain[word]:
                break
            picked.append(word)
            for name, pairs in untouched.items():
                touched = {pair for pair in pairs if word in pair.split()}
                left[name] -= len(touched)
                untouched[name] = pairs - touched
    return sorted(picked)


def _mentions(text: Column, words: list[str]) -> Column:
    """Whether lower-case text has one of the words: long ones anywhere, short ones as whole words."""
    found = F.lit(False)
    for word in (w for w in words if len(w) >= 5):
        found = found | text.contains(word)
    short = "|".join(map(re.escape, (w for w in words if len(w) < 5)))
    return found | text.rlike(rf"(?<![\p{{L}}\p{{N}}])({short})(?![\p{{L}}\p{{N}}])") if short else found


def _words(text: Column) -> Column:
    plain = F.trim(F.regexp_replace(text, r"[^\p{L}\p{N}]+", " "))
    return F.filter(F.split(plain, " "), lambda w: w != "")


def _bigrams(words: Column) -> Column:
    firsts = F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0)))
    pairs = F.zip_with(firsts, F.slice(words, F.lit(2), F.size(words)),
                       lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(pairs)


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None,
                 threshold: float = THRESHOLD, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Passages of the documents that are a license notice: one row each, with the best template.

    A passage is a line, a paragraph (lines up to an empty line) of several lines, a whole
    text of several paragraphs, or any run of words, across lines and the marks of source comments (`_stretches`).  Passage and template are lower-cased, runs of anything but letters
    and digits become one space, and they are compared by the Dice coefficient
    2 * |A and B| / (|A| + |B|) over their sets of word bigrams.  A template is a candidate only
    where threshold / (2 - threshold) * |B| <= |A| <= (2 - threshold) / threshold * |B|.

    Columns: the id, `passage` (line, paragraph, text or words), `passage_no` (from 0; of words the number of the
    first one in the text), `license`, `shared`, `passage_bigrams`, `template_bigrams`, `dice`.  A line, paragraph or
    text has the template of the highest score, of equal scores the first license name; a stretch has a row for
    each template that it reaches, with the best of its runs.  NULL and empty texts, and passages of one word, have no
    bigrams and give no rows, nor do empty tables; NULL ids and repeated rows give a row for each passage; other
    columns, whatever their names, are ignored.  Long texts are read whole.  Only places of template bigrams are
    shuffled, by document and template.
    """
    sets = {name: _template_bigrams(text) for name, text in (templates or NOTICES).items()}
    sets = {name: b for name, b in sorted(sets.items()) if b}
    if not sets:
        raise ValueError("no template has two words")
    if sum(map(len, sets.values())) > MAX_TEMPLATE_BIGRAMS:
        raise ValueError("the templates travel in the plan; pass fewer at a time")
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    least = math.ceil(low * min(map(len, sets.values())) - 1e-9)
    most = math.floor(high * max(map(len, sets.values())) + 1e-9)

    longest = {name: math.floor(high * (len(_template_words((templates or NOTICES)[name])) - 1) + 1e-9) for name in sets}

    # An explode gives a value that later steps read; an expression in its place would be
    # evaluated anew wherever it is named.
    lowered = docs.select(F.col(id_col).alias("id"),
                          F.explode(F.array(F.lower(F.coalesce(F.col(text_col), F.lit(""))))).alias("body"))
    needed = _needed_words(sets, threshold)
    named = lowered.where(_mentions(F.col("body"), needed))

    def passages(kind: str, parts: Column) -> Column:
        return F.transform(parts, lambda p, i: F.struct(F.lit(kind).alias("passage"),
                                                        i.cast("int").alias("passage_no"),
                                                        p.alias("body")))

    body = F.col("body")
    blocks = F.split(body, r"\n[ \t\r]*\n")
    paragraphs = F.filter(passages("paragraph", blocks),
                          lambda p: F.trim(p["body"]).contains("\n"))
    whole = F.filter(passages("text", F.array(body)),
                     lambda p: F.size(F.split(F.trim(p["body"]), r"\n[ \t\r]*\n")) > 1)
    units = F.concat(passages("line", F.split(body, "\n")), paragraphs, whole)
    sized = (named.select("id", F.explode(units).alias("p"))
             .where(_mentions(F.col("p.body"), needed))
             .select("id", "p.passage", "p.passage_no",
                     F.explode(F.array(_bigrams(_words(F.col("p.body"))))).alias("bigrams"))
             .withColumn("passage_bigrams", F.size("bigrams"))
             .where(F.col("passage_bigrams").between(least, most)))
    size = F.col("passage_bigrams")
    known = F.from_json(F.lit(json.dumps([
        {"license": name, "least": math.ceil(low * len(b) - 1e-9),
         "most": math.floor(high * len(b) + 1e-9), "bigrams": b} for name, b in sets.items()])),
        "array<struct<license: string, least: int, most: int, bigrams: array<string>>>")
    candidates = F.filter(known, lambda t: size.between(t["least"], t["most"]))
    scored = F.transform(candidates, lambda t: F.struct(
        t["license"].alias("license"),
        F.size(F.array_intersect(F.col("bigrams"), t["bigrams"])).alias("shared"),
        F.size(t["bigrams"]).alias("template_bigrams")))
    dice = lambda t: F.lit(2.0) * t["shared"] / (size + t["template_bigrams"])
    best = F.aggregate(
        scored, F.lit(None).cast("struct<license: string, shared: int, template_bigrams: int>"),
        lambda found, t: F.when((dice(t) >= threshold) & (found.isNull() | (dice(t) > dice(found))), t)
        .otherwise(found))
    units = (sized.select("id", "passage", "passage_no", "passage_bigrams",
                          F.explode(F.array(best)).alias("best"))
             .where(F.col("best").isNotNull())
             .select("id", "passage", "passage_no", "best.license", "best.shared",
                     "passage_bigrams", "best.template_bigrams", dice(F.col("best")).alias("dice")))
    return units.unionByName(_stretches(named, sets, longest, threshold)).withColumnRenamed("id", id_col)


def _stretches(named: DataFrame, sets: dict[str, list[str]], longest: dict[str, int], threshold: float) -> DataFrame:
    """Of each stretch of a text around a template's bigrams the run of words that is most like the template.

    A run has s different ones of the template's b bigrams, and o places with other bigrams; its Dice coefficient
    2s / (s + o + b) reaches t where (2 - t)s - to >= tb.  Runs have at most `longest` places, the size bound times the
    places of the template.  Counting every place of a template bigram, the left side of a run is a difference of
    two running numbers, so one ordered pass cuts a text into stretches, where the other bigrams
    between hits outweigh all hits before, and bounds what a stretch can reach.  The best run of a text has no
    beginning of negative weight, so no cut goes through it.  In the few stretches that can reach the threshold every
    run from hit to hit is compared; of equal ones the first and shortest counts.
    """
    known = named.sparkSession.range(1).select(F.inline(F.from_json(F.lit(json.dumps([
        {"license": name, "size": len(b), "most": longest[name], "no": no, "bigram": pair}
        for name, b in sets.items() for no, pair in enumerate(b)])),
        "array<struct<license: string, size: int, most: int, no: int, bigram: string>>")))
    # Repeated rows are told from others by id and text; their hits are counted.
    row = ["id", "text_key", "bytes"]
    hits = (named.select("id", F.xxhash64("body").alias("text_key"), F.octet_length("body").alias("bytes"),
                         F.explode(F.array(_words(F.col("body")))).alias("words"))
            .select(*row, F.posexplode(F.zip_with(
                "words", F.slice("words", F.lit(2), F.size("words")), lambda a, b: F.concat(a, F.lit(" "), b)))
                .alias("place", "bigram"))
            .join(known, "bigram")
            .groupBy(*row, "license", "size", "most", "no", "place").agg(F.count(F.lit(1)).alias("copies")))
    text = Window.partitionBy(*row, "license").orderBy("place")
    # Weights in millionths, so that equal ones are equal.
    unit = 1_000_000
    cost = round(threshold * unit)
    place = F.col("place").cast("long")
    before = (F.row_number().over(text).cast("long") - 1) * (2 * unit) - place * cost
    weighed = (hits.withColumn("before", before)
               .withColumn("stretch", F.min("before").over(text.rowsBetween(Window.unboundedPreceding, 0)))
               .withColumn("last_place", F.lag("place").over(
                   Window.partitionBy(*row, "license", "no").orderBy("place"))))
    stretches = (weighed.groupBy(*row, "license", "size", "most", "stretch")
                 .agg(F.max(F.col("before") + (2 * unit - cost)).alias("top"), F.max("copies").alias("copies"),
                      F.sort_array(F.collect_list(F.struct("place", "last_place"))).alias("hits"))
                 .where(F.col("top") - F.col("stretch") >= F.col("size").cast("long") * cost - 1))

    run = "struct<dice: double, place: int, bigrams: int, shared: int>"

    def longer(first: Column, found: Column, hit: Column) -> Column:
        """The best run from a hit on, after one more; `seen` counts the different bigrams, `again` the repeats."""
        repeat = F.when(hit["last_place"] >= first, 1).otherwise(0)
        seen, again = found["seen"] + 1 - repeat, found["again"] + repeat
        places = hit["place"] - first + 1
        dice = F.lit(2.0) * seen / (places - again + F.col("size"))
        better = (places <= F.col("most")) & (found["best"].isNull() | (dice > found["best"]["dice"]))
        own = F.struct(dice.alias("dice"), (-first).alias("place"), (again - places).alias("bigrams"),
                       seen.alias("shared"))
        return F.struct(seen.alias("seen"), again.alias("again"),
                        F.when(better, own.cast(run)).otherwise(found["best"]).alias("best"))

    runs = F.transform("hits", lambda first, i: F.aggregate(
        F.slice("hits", i + 1, F.col("most")),
        F.struct(F.lit(0).alias("seen"), F.lit(0).alias("again"), F.lit(None).cast(run).alias("best")),
        lambda found, hit: longer(first["place"], found, hit), lambda found: found["best"]))
    return (stretches.select("id", "license", "size", "copies", F.explode(F.array(F.array_max(runs))).alias("best"))
            .where(F.col("best.dice") >= threshold)
            .select("id", F.lit("words").alias("passage"), (-F.col("best.place")).alias("passage_no"), "license",
                    F.col("best.shared").alias("shared"), (-F.col("best.bigrams")).alias("passage_bigrams"),
                    F.col("size").alias("template_bigrams"), F.col("best.dice").alias("dice"),
                    F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
            .drop("copy"))
