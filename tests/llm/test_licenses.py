"""License scan against comparing every unit with every template."""

import re

import pytest

from logloom.llm import licenses

MIT = licenses.TEMPLATES[10][1]
TEXTS = [
    None,
    "",
    "Released under the MIT License.",
    "A text.\nLICENSED UNDER the apache license version 2.0\nMore text of another kind.",
    "Released under the MIT License.\n\nLicensed under CC BY-NC 4.0.",
    "prose " * 20_000,
    MIT[:300] + "\n" + MIT[300:],
    "We like the Apache License very much, but this is not a notice of it.",
    "Licensed",
    "Intro line here.\n\n" + MIT.replace("sell", "rent") + "\n\nOutro",
]


def pairs(text):
    w = re.sub("[^a-z0-9]+", " ", text.lower()).split()
    return set(zip(w, w[1:]))


def plain(text, threshold):
    text = text or ""
    units = {*text.split("\n"), *re.split(r"\n[ \t\r]*\n", text), text}
    best = {}
    for u in units:
        for name, t in licenses.TEMPLATES:
            a, b = pairs(u), pairs(t)
            d = 2 * len(a & b) / (len(a) + len(b)) if a else 0
            if d >= threshold:
                best[name] = max(d, best.get(name, 0))
    top = min(((-d, n) for n, d in best.items()), default=(0, None))
    return top[1], -top[0], ",".join(sorted(best))


@pytest.mark.parametrize("threshold", [0.8, 0.5])
def test_matches_all_comparisons(spark, threshold):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(2, TEXTS[2], "x"), (None, TEXTS[4], "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, license string")
    got = sorted((str(r.doc_id), r.license, round(r.dice, 9), r.licenses) for r in licenses.scan(docs, threshold=threshold).collect())
    want = []
    for i, t, _ in rows:
        name, dice, names = plain(t, threshold)
        want.append((str(i), name, round(dice, 9), names))
    assert got == sorted(want)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert licenses.scan(docs).count() == 0
    one = spark.createDataFrame([(1, "Released under the MIT License.")], "doc_id bigint, text string")
    assert licenses.scan(one, licenses.templates_table(spark).where("false")).first().license is None


def test_notices_do_not_depend_on_line_breaks(spark):
    long = "some prose about ships and harbours " * 40
    rows = [
        (1, "Copyright 2021 X. Released under the MIT License.", "MIT"),
        (2, f"{long}Licensed under the Apache License, Version 2.0. {long}", "Apache-2.0"),
        (3, f"/*\n * {long}\n * Licensed under the Apache License,\n * Version 2.0.\n * {long}\n */", "Apache-2.0"),
        (4, long + MIT.replace("sell", "rent") + " " + long, "MIT"),
        (5, long + "licensed for the apache people, version two " + long, None),
        (6, "Under the MIT License.", "MIT"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, want string")
    got = {r.doc_id: r.license for r in licenses.scan(docs).collect()}
    assert got == {i: want for i, _, want in rows}
