"""Scoring against a plain count of words and pairs."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from logloom.llm import lm
from logloom.llm.queries_corpus import op5_lm_scoring


def tokens(text):
    return (text or "").encode().lower().split() + [None]


def plain(rows, train):
    """Base figures and the model with exact pair counts."""
    words, pairs = Counter(), Counter()
    for r, t in zip(rows, train):
        if t:
            w = tokens(r[1])
            words.update(w)
            pairs.update(zip(["start", *w], w))
    n_docs = words[None]
    n, v = sum(words.values()), len(words)

    def seen(context):
        return n_docs if context == "start" else words[context]

    out = []
    for doc, text in rows:
        w = tokens(text)
        base = score = 0.0
        for a, b in zip(["start", *w], w):
            uni = (words[b] + 1) / (n + v + 1)
            c = pairs[a, b]
            c = float(lm.count_of(lm.level_of(np.array([c])))[0]) if c else 0.0
            c = min(c, words[b], seen(a))
            p = uni if not seen(a) else lm.DISCOUNT * c / seen(a) + (1 - lm.DISCOUNT) * uni
            base, score = base + math.log10(uni), score + math.log10(p)
        out.append((doc, len(w), sum(words[x] > 0 for x in w), n, base, score))
    return out


@pytest.mark.parametrize("size", [300, 10**7])
def test_odd_rows(odd, size):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    train = [bool(i is not None and i % 3) for i, _ in rows]
    got = lm.score(odd, F.col("doc_id") % 3 != 0, block_bytes=size).collect()
    show = lambda rs: sorted(str((*r[:4], round(r[4], 4), round(r[5], 4))) for r in rs)
    assert show(tuple(r) for r in got) == show(plain(rows, train))


def test_no_training_and_empty(odd):
    got = lm.score(odd, F.lit(False)).collect()
    assert {(r.n_known, r.train_tokens, r.score) for r in got} == {(0, 0, 0.0)}
    assert lm.score(odd.where("false"), F.lit(True)).count() == 0


def test_levels():
    c = np.arange(1, 5000)
    q = lm.level_of(c)
    assert q[0] == 1 and (np.diff(q) >= 0).all()
    assert (np.abs(lm.count_of(q) - c) <= 0.26 * c).all() and lm.count_of(np.array([0]))[0] == 0


def test_both_ways_probe_the_same_bits(spark, sf):
    """Broadcast, or probed where it was built: the same scores, false positives included."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 60")
    shared, stayed = (
        {r.doc_id: r.score for r in lm.score(docs, F.col("doc_id") % 3 != 0, filter_bytes=b).collect()} for b in (lm.FILTER_BYTES, 0)
    )
    assert shared == stayed


@pytest.mark.parametrize("size", [300, 10**7])
def test_no_pair_is_left_out_of_a_filter_too_large_to_broadcast(odd, size):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    train = [bool(i is not None and i % 3) for i, _ in rows]
    got = lm.score(odd, F.col("doc_id") % 3 != 0, filter_bytes=0, block_bytes=size).collect()
    show = lambda rs: sorted(str((*r[:4], round(r[4], 4), round(r[5], 4))) for r in rs)
    assert show(tuple(r) for r in got) == show(plain(rows, train))


def test_a_pair_seen_once_counts(spark):
    docs = spark.createDataFrame([(1, "red green"), (2, "blue blue"), (3, "red green"), (4, "green red")], "doc_id int, text string")
    got = {r.doc_id: r.score for r in lm.score(docs, F.col("doc_id") < 3).collect()}
    assert got[3] > got[4] + 1


def test_the_filter_grows_with_the_pairs():
    for n in (10, 10**4, 10**5):
        keys = np.random.default_rng(n).integers(2**63, size=n).astype(np.uint64)
        levels = np.ones(n, np.int64)
        bits = lm.LogFrequencyFilter.shard(keys, levels)
        assert len(bits) == max(lm.LEAST_SHARD_BYTES, -(-n * lm.BITS_PER_ENTRY // 8))
        assert (lm.LogFrequencyFilter([bits]).levels(keys) >= 1).all()
        assert (lm.LogFrequencyFilter([bits]).levels(keys + np.uint64(1)) > 0).mean() < 0.001
    assert lm.shard_count(10) == lm.SHARDS and lm.shard_count(lm.SHARDS * lm.SHARD_PAIRS * 2) == 2 * lm.SHARDS


def test_packed_keys():
    keys = np.unique(np.random.default_rng(0).integers(2**63, size=5000).astype(np.uint64) * np.uint64(2))
    for shard, at in lm._by_shard(keys, 64):
        assert (lm.unpack_keys(lm.pack_keys(keys[at], 64), shard, 64) == keys[at]).all()


def test_given_documents(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    train = [zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in rows]
    want = {r[0]: r for r in plain(rows, train)}
    got = op5_lm_scoring(spark, sf).collect()
    assert len(got) == len(rows)
    better = worse = 0.0
    for r in got:
        w = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == w[1:4]
        assert abs(r.base_score - w[4]) < 1e-6 * abs(w[4]) + 1e-6
        assert abs(r.score - w[5]) < 0.01 * abs(w[5])  # false positives of the filter
        if r.held_out:
            better, worse = better + r.score, worse + r.base_score
    assert better > worse
