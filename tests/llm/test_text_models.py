"""URL filter and language identification: rules by a plain reading, models by held-out accuracy."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from logloom.llm import langid, urls
from logloom.llm.queries_models import URL_RULES, op1_url_filter, op3_language_id


def plain_parts(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if c.isascii() else c for c in host), path


def plain_rule(host, path):
    fits = [(v, h + p) for v, (h, p) in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    v, rule = max(fits, key=lambda r: len(r[1]), default=(None, None))
    return rule, v


ODD = [None, "", "no scheme/at/all", "http://", "HTTP://A.EXAMPLE.NET/en/x?q#f", "http://xnet/", "http://net/a://b/", "https://É.org/fr/#x",
       "http://example.com/de/?a/b", "http://example.com?/de/", "http://a.b.example.com/de/" + "y" * 30_000, "ftp://org#/fr/"]


def test_url_rules_and_odd_rows(spark):
    rng = random.Random(2)
    rows = [*ODD, *ODD[:5]]
    rows += [f"http://{rng.choice(['good', 'fine'])}{rng.randrange(99)}.org/fr/{rng.choice(['news', 'science'])}/{i}" for i in range(200)]
    rows += [f"http://{rng.choice(['spam', 'pills'])}{rng.randrange(99)}.net/xx/{rng.choice(['cheap', 'casino'])}/{i}" for i in range(200)]
    rows += ["http://good.com/science/news", "http://spam.com/cheap/casino"]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(rows)], "page_id bigint, url string, host string")
    got = {r.page_id: r for r in urls.judge(pages, URL_RULES).collect()}
    assert len(got) == len(rows)
    for i, u in enumerate(rows):
        host, path = plain_parts(u)
        rule, said = plain_rule(host, path)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict in ({said} if said else {"allow", "block"})
    assert got[len(rows) - 2].verdict == "allow" and got[len(rows) - 1].verdict == "block"
    assert urls.judge(pages.where("false"), URL_RULES).count() == 0
    assert {r.verdict for r in urls.judge(pages.where("page_id < 2"), URL_RULES).collect()} == {"allow"}


def test_url_model_on_held_out_labels(spark, sf):
    sf = sf.replace("sf0.001", "sf0.1")  # a few labelled pages don't make a rate
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    assert op1_url_filter(spark, sf).count() == pages.count()
    rule, said = urls.rule_of(URL_RULES)
    rows = urls.parts(pages).select(F.col("_url").alias("url"), said.alias("label")).where("label IS NOT NULL")
    ratio, cut = urls.fit(rows.where("crc32(url) % 3 != 0"))
    # The sample is bounded in URLs and characters; its URLs are whole.
    few = urls.sampled(rows, 7, 10**6)
    assert len(few) == 7 and urls.sampled(rows, 10**6, 300) and sum(map(len, urls.sampled(rows, 10**6, 300))) <= 300
    assert set(few) <= {r.url for r in rows.collect()}
    other = rows.where("crc32(url) % 3 = 0").collect()
    right = sum((ratio.score(r.url) >= cut) == (r.label == "allow") for r in other)
    assert right >= 0.9 * len(other)


def test_markov_models_are_distributions():
    model = urls.MarkovModel(["abcabc", "abd", "xyz"] * 5)
    for context in ("", "ab", "\x02" * 5, "zzzzz"):
        seen = sum(np.exp(model.log_prob(context, c)) for c in "abcdxyz\x03")
        assert 0.9 < seen <= 1.0001


def test_gradients_match_differences():
    net = langid.BiGru(["a", "b"], hidden=3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, y = langid.as_bytes([b"ab", b"cd", b"aa"]), np.array([0, 1, 1])
    _, g = net.gradients(x, y)
    for name, at in (("wf", (97, 2)), ("ub", (1, 4)), ("cf", (2, 0)), ("out", (4, 1)), ("wb", (100, 8)), ("bias", (0,))):
        keep = net.p[name][at]
        net.p[name][at] = keep + 1e-4
        up, _ = net.gradients(x, y)
        net.p[name][at] = keep - 1e-4
        down, _ = net.gradients(x, y)
        net.p[name][at] = keep
        assert abs((up - down) / 2e-4 - g[name][at]) < 1e-4


def test_language_of_held_out_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = op3_language_id(spark, sf).join(docs.select("doc_id", "lang"), "doc_id").where("held_out AND lang IS NOT NULL").collect()
    assert sum(r.lang_pred == r.lang for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(odd):
    net = langid.train({"en": [b"word", b"page", b"the"] * 50, "fr": [b"les", b"voil\xc3\xa0", b"nous"] * 50}, epochs=1)
    got = langid.predict(odd, net, keep=("doc_id", "words")).collect()
    assert len(got) == odd.count()
    by_id = {r.doc_id: r for r in got}
    assert {by_id[i].lang_pred for i in (0, 1, 2)} == {"und"} and by_id[3].lang_pred != "und"
    assert langid.predict(odd.where("false"), net).count() == 0
    assert langid.fit(odd.where("false")) is None
    assert {r.lang_pred for r in langid.predict(odd, None).collect()} == {"und"}


def test_every_language_is_sampled_from_distinct_texts(spark):
    rows = [(f"l{k:02d}", f"text {i} of {k}") for k in range(70) for i in range(3)]
    rows += [("hot", f"hot {i % 5}") for i in range(2000)] + [("big", f"big {i}") for i in range(900)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = {}
    for r in langid.sample(docs, per_language=20).collect():
        got.setdefault(r["lang"], []).append(r["text"])
    assert len(got) == 72 and all(len(got[f"l{k:02d}"]) == 3 for k in range(70))
    assert sorted(got["hot"]) == [f"hot {i}" for i in range(5)]
    assert len(set(got["big"])) == 20
    net = langid.fit(docs, per_language=2)
    assert len(net.languages) == 72


def test_long_words_are_cut_between_characters():
    word = ("a" + "語" * 100 + "é" * 40).encode()
    pieces = langid.words_of(word)
    assert b"".join(pieces) == word and all(0 < len(p) <= langid.MOST and p.decode() for p in pieces)
    junk = b"\x80" * 100
    assert b"".join(langid.words_of(junk)) == junk


def test_block_wins_a_tie(spark):
    """Two rules of the same length and place: block decides, whichever comes first."""
    pages = spark.createDataFrame([(1, "http://a.org/x/1"), (2, "http://a.org/y/1")], "page_id bigint, url string")
    rules = [("allow", ("a.org", "/x/")), ("block", ("a.org", "/x/")), ("block", ("a.org", "/y/")), ("allow", ("a.org", "/y/"))]
    assert {r.verdict for r in urls.judge(pages, rules).collect()} == {"block"}
    assert {r.verdict for r in urls.judge(pages, rules[::-1]).collect()} == {"block"}
