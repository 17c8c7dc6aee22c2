"""License scans: Dice coefficient over word bigrams between texts and licence templates.

Units of a document are its lines and its paragraphs (between blank lines).
A unit is normalised (ASCII letters and digits, lower case, single spaces) and
cut into its set of word bigrams.  A template can only reach the threshold t if the
number of bigrams of the unit lies between t/(2-t) and (2-t)/t times its own; units
outside the bounds of all templates are pruned before any bigram is exploded.
Bigrams of the others meet those of the templates in a broadcast join; the
common ones are counted and 2 * common / (both sizes) decides.

Besides, windows that don't depend on line breaks are compared: as many words as a template has, anywhere
in the text, where one of its rare bigrams puts the template.  A template has so many of these seeds that a window
without any of them is below t.

Defined results: null and empty texts and units of fewer than two words match
nothing; a document without a match has a null licence; several licences in one
document are listed, the best (then the first by name) is ``license``; rows
that repeat a document id share their matches, and each gives a row.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm.common import pinned
from logloom.operators.lookup import fits_broadcast

# Public licence notices and texts.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]

THRESHOLD = 0.8


def _words(text: Column) -> Column:
    """Words of the normalised text."""
    return F.filter(F.split(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "), " "), lambda w: w != "")


def _pairs(words: Column) -> Column:
    n = F.size(words)
    at = F.when(n >= 2, F.sequence(F.lit(0), n - 2)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(at, lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1))))


def templates_table(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """(template, license, size, bigrams) of the templates given."""
    rows = [(i, name, text) for i, (name, text) in enumerate(templates)]
    made = spark.createDataFrame(rows, "template int, license string, _t string")
    cut = pinned(made, ["template", "license"], _w=_words(F.col("_t")))
    made = cut.select("template", "license", _pairs(F.col("_w")).alias("bigrams"), F.col("_w").alias("words"))
    return made.withColumn("size", F.size("bigrams"))


def _seeds(templates: list, threshold: float) -> list[tuple]:
    """(seed, template, offset) of the rarest bigrams of each template: one more than a match can lack."""
    cut = {r.template: list(zip(r.words, r.words[1:])) for r in templates}
    used = Counter(b for pairs in cut.values() for b in set(pairs))
    out = []
    for r in templates:
        lacking = r.size - math.ceil(threshold * r.size / (2 - threshold) - 1e-9)
        rarest = set(sorted(set(cut[r.template]), key=lambda b: (used[b], -len(min(b, key=len)), b))[: lacking + 1])
        out += [(" ".join(b), r.template, at) for at, b in enumerate(cut[r.template]) if b in rarest]
    return out


def _windows(docs: DataFrame, templates: DataFrame, threshold: float) -> DataFrame | None:
    """(doc_id, unit, license, dice) of the windows around seeds that reach the threshold."""
    spark = docs.sparkSession
    seeds = _seeds(templates.select("template", "words", "size").collect(), threshold)  # a few per template
    if not seeds:
        return None
    made = spark.createDataFrame(seeds, "seed string, template int, offset int")
    side = made.join(templates, "template").select("seed", "offset", "license", "size", "bigrams", F.size("words").alias("length"))
    side = F.broadcast(side) if fits_broadcast(side) else side
    reach = templates.agg(F.max(F.size("words"))).first()[0]
    names = sorted({s for s, _, _ in seeds})
    firsts, seconds = (sorted({n.split(" ")[i] for n in names}) for i in (0, 1))
    words = pinned(docs, ["doc_id"], _w=_words(F.col("_t"))).where(F.size("_w") >= 2)
    w = F.col("_w")
    # Word by word first: bigrams are made only where both words belong to seeds.
    at = F.filter(F.sequence(F.lit(0), F.size(w) - 2), lambda i: F.get(w, i).isin(firsts) & F.get(w, i + 1).isin(seconds))

    def around(i):
        begin = F.greatest(i - reach, F.lit(0))
        seed = F.concat_ws(" ", F.get(w, i), F.get(w, i + 1))
        return F.struct(i.alias("at"), begin.alias("begin"), seed.alias("seed"), F.slice(w, begin + 1, i - begin + reach).alias("near"))

    hits = words.select("doc_id", F.explode(F.transform(at, around)).alias("hit")).select("doc_id", "hit.*")
    placed = hits.where(F.col("seed").isin(names)).join(side, "seed")
    start = F.greatest(F.col("at") - F.col("offset"), F.lit(0))
    window = F.slice("near", start - F.col("begin") + 1, F.col("at") - F.col("offset") + F.col("length") - start)
    cut = pinned(placed.withColumn("unit", window), ["doc_id", "unit", "license", "size", "bigrams"], _p=_pairs(F.col("unit")))
    dice = F.lit(2.0) * F.size(F.array_intersect("_p", "bigrams")) / (F.size("_p") + F.col("size"))
    found = cut.select("doc_id", F.xxhash64("unit").alias("unit"), "license", dice.alias("dice")).where(F.col("dice") >= threshold)
    return found.distinct()


def matches(
    docs: DataFrame, templates: DataFrame, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, unit, license, dice) of every unit and window that reaches the threshold."""
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    size = F.col("size")
    bounds = templates.select(F.ceil(size * low).cast("int").alias("a"), F.floor(size * high).cast("int").alias("b"))
    ranges = [(r.a, r.b) for r in bounds.distinct().collect()]  # one per template at most
    docs = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    paragraphs = F.when(F.col("_t").rlike(r"\n[ \t\r]*\n"), F.split("_t", r"\n[ \t\r]*\n")).otherwise(F.array().cast("array<string>"))
    whole = F.when(F.col("_t").contains("\n"), F.array("_t")).otherwise(F.array().cast("array<string>"))
    units = docs.select("doc_id", F.explode(F.array_distinct(F.concat(F.split("_t", "\n"), paragraphs, whole))).alias("unit"))
    words = pinned(units, ["doc_id", "unit"], _w=_words(F.col("unit")))
    # The set of bigrams is at most one smaller than the words: too few words are pruned at once.
    words = words.where(F.size("_w") > min([a for a, _ in ranges], default=0))
    sized = pinned(words, ["doc_id", "unit"], _p=_pairs(F.col("_w"))).withColumn("n", F.size("_p"))
    inside = F.lit(False)
    for a, b in ranges:
        inside = inside | F.col("n").between(a, b)
    side = templates.select("template", "license", "size", F.explode("bigrams").alias("pair"))
    side = F.broadcast(side) if fits_broadcast(side) else side
    pairs = sized.where(inside).select("doc_id", F.xxhash64("unit").alias("unit"), "n", F.explode("_p").alias("pair"))
    common = pairs.join(side, "pair").where((F.col("n") >= size * low) & (F.col("n") <= size * high))
    # Repeated rows bring a unit twice; its bigrams count once.
    counted = common.distinct().groupBy("doc_id", "unit", "n", "template", "license", "size").agg(F.count("*").alias("common"))
    dice = F.lit(2.0) * F.col("common") / (F.col("n") + size)
    found = counted.withColumn("dice", dice).where(F.col("dice") >= threshold).select("doc_id", "unit", "license", "dice")
    windows = _windows(docs, templates, threshold)
    return found if windows is None else found.unionByName(windows)


def scan(docs: DataFrame, templates: DataFrame | None = None, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document: best licence, its coefficient, and all licences found."""
    templates = templates_table(docs.sparkSession) if templates is None else templates
    found = matches(docs, templates, threshold, key, text).groupBy("doc_id", "license").agg(F.max("dice").alias("dice"))
    best = found.groupBy("doc_id").agg(
        F.min(F.struct((-F.col("dice")).alias("d"), "license")).alias("b"),
        F.array_join(F.sort_array(F.collect_set("license")), ",").alias("licenses"),
    )
    best = best.select(F.col("doc_id").alias("_id"), F.col("b.license").alias("license"), (-F.col("b.d")).alias("dice"), "licenses")
    ids = docs.select(F.col(key).alias("doc_id"))
    out = ids.join(best, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    return out.select("doc_id", "license", F.coalesce("dice", F.lit(0.0)).alias("dice"), F.coalesce("licenses", F.lit("")).alias("licenses"))
