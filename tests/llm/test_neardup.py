"""Near-duplicates against comparing all pairs of sets."""

import random

import numpy as np
import pytest

from logloom.llm import neardup
from logloom.llm.components import UnionFind, components


def plain_sets(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + k]) for i in range(max(len(w) - k, 0) + 1)} if w else set()


def plain(rows, k, percent=80):
    found = {i: plain_sets(t, k) for i, t in rows}
    joined = UnionFind()
    ids = sorted(found)
    for i in ids:
        joined.root(i)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            both = len(found[i] & found[j])
            if both and 100 * both >= percent * len(found[i] | found[j]):
                joined.union(i, j)
    return {i: (len(found[i]), joined.root(i)) for i in ids}


def family(rng, base, n, edits):
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(edits):
            words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def test_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    for n, shared in ((1000, 800), (60, 48), (10, 8)):
        got = []
        for _ in range(40):
            x = rng.integers(0, 2**63, n + (n - shared), dtype=np.uint64)
            a, b = neardup.signature(x[:n]), neardup.signature(x[n - shared :])
            got.append((a == b).mean())
        assert abs(np.mean(got) - shared / (2 * n - shared)) < 0.05


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(300, 500)] + [(rng.randrange(200), rng.randrange(200)) for _ in range(90)] + [(7, 7)]
    joined = UnionFind()
    for a, b in edges:
        joined.union(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: joined.root(x) for x in list(joined)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("k, block", [(4, 256), (5, 8)])
def test_matches_all_pairs(spark, monkeypatch, k, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    rng = random.Random(k)
    texts = [None, "", " \n", "one", "ONE ", "one two", "one two three four five six", "word " * 30_000]
    for size, edits in ((120, 2), (120, 5), (60, 2), (300, 9), (25, 1)):
        base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        texts += family(rng, base, 25, edits)
    texts += texts[8:12] * 3
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, bands string")
    got = {r["key"]: (r.n_shingles, r.component_id) for r in neardup.groups(docs, k=k).collect()}
    assert got == plain(rows, k)
    assert {r.doc_id for r in neardup.keep_one(docs, k=k).collect()} == {i for i, (_, c) in plain(rows, k).items() if i == c}


def test_repeated_and_missing_keys(odd):
    got = neardup.groups(odd).collect()
    assert len(got) == odd.where("doc_id IS NOT NULL").select("doc_id").distinct().count()
    assert neardup.groups(odd.where("false")).count() == 0
    out = neardup.keep_one(odd)
    assert out.columns == odd.columns and out.where("doc_id IS NULL").count() == 1


def test_given_documents(spark, sf):
    from logloom.llm.queries_corpus import op8_minhash_neardup

    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op8_minhash_neardup(spark, sf).collect()}
    assert got == plain([tuple(r) for r in docs], 4)
