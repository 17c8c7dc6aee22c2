"""Quality rules against a plain version of the same rules."""

import re
from collections import Counter

import pytest

from logloom.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    triples = Counter(zip(words, words[1:], words[2:]))
    hit = set()
    for i, t in enumerate(zip(words, words[1:], words[2:])):
        if triples[t] > 1:
            hit |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    lost, left = 0, []
    for x in text.split("\n"):
        n = len(WORD.findall(x))
        symbols, bars = len(re.findall(quality.SYMBOLS, x)), len(re.findall("[|•»>]", x))
        bad = n > 0 and (
            not any(c.isalnum() for c in x)
            or symbols * 2 > n
            or (bars >= 2 and bars * 4 >= n)
            or any(p in x.lower() for p in quality.BOILERPLATE)
            or (n < 3 and not re.search(r"[.!?:;,…。！？\"')\]»”’][\x20\x09-\x0D]*\Z", x))
        )
        lost += n * bad
        left += [] if bad else [x]
    n = len(words)
    failed = n < 50 or 100 * len(hit) > 50 * n
    return (
        n, sum(map(len, words)), len(re.findall(quality.SYMBOLS, text)), len(lines) - len(set(lines)),
        len(hit), lost, failed, not failed and 100 * lost <= 50 * n, "\n".join(left),
    )


def test_odd_rows_match_plain_rules(odd):
    rows = odd.collect()
    got = sorted((str(tuple(r)) for r in quality.assess(odd).collect()))
    assert got == sorted(str((r.doc_id, *plain(r.text))) for r in rows)


def test_given_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: tuple(r)[1:] for r in quality.assess(docs).collect()}
    assert got == {r.doc_id: plain(r.text) for r in docs.collect()}


@pytest.mark.parametrize(
    "line, bad",
    [
        ("home | news | about", True),
        ("*** $$$ ###", True),
        ("Read our Privacy Policy before you go on.", True),
        ("Menu", True),
        ("Yes.", False),
        ("A plain sentence, with a | bar and an & sign.", False),
    ],
)
def test_lines(spark, line, bad):
    text = line + "\n" + " ".join(f"w{i}" for i in range(60)) + "."
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    assert (line not in quality.assess(docs).first().clean_text) == bad


def test_clean_keeps_columns_and_good_documents(odd):
    out = quality.clean(odd)
    assert out.columns == odd.columns
    assert {r.doc_id for r in out.collect()} == {r.doc_id for r in odd.collect() if plain(r.text)[7]}
    assert quality.clean(odd.where("false")).count() == 0
