"""Line de-duplication against plain counting, and the perfect hash by itself."""

from collections import Counter

import numpy as np
import pytest

from logloom.llm import linededup
from logloom.llm.linehash import PerfectHash


def plain(rows, min_docs, min_chars=1):
    def key(line):
        return line.encode().strip().lower()

    seen = Counter()
    for _, text in rows:
        seen.update({key(x) for x in (text or "").split("\n")})
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        left = [x for x in lines if len(key(x).decode()) < min_chars or seen[key(x)] < min_docs]
        out.append((doc, len(lines), len(lines) - len(left), "\n".join(left)))
    return out


@pytest.mark.parametrize("n", [0, 1, 7, 5000])
def test_perfect_hash(n):
    rng = np.random.default_rng(n)
    low, high = rng.integers(0, 2**63, n, dtype=np.uint64), rng.integers(0, 2**63, n, dtype=np.uint64)
    built = PerfectHash.build(low, high)
    built = PerfectHash.load(**built.dump())
    assert sorted(built.index(low, high)) == list(range(n))
    assert (built.index(low + np.uint64(1), high) < n).all()


def test_keys_that_agree_in_all_levels_are_listed(monkeypatch):
    monkeypatch.setattr("logloom.llm.linehash.LEVELS", 1)
    low = np.arange(1000, dtype=np.uint64)
    built = PerfectHash.build(low, low)
    assert len(built.rest) and sorted(built.index(low, low)) == list(range(1000))


@pytest.mark.parametrize("min_docs, min_chars", [(2, 1), (3, 5)])
def test_matches_plain_counting(odd, min_docs, min_chars):
    more = odd.unionByName(odd.where("doc_id in (3, 10)")).unionByName(odd.where("doc_id = 8"))
    rows = [(r.doc_id, r.text) for r in more.select("doc_id", "text").collect()]
    got = [tuple(r) for r in linededup.dedup_lines(more, min_docs=min_docs, min_chars=min_chars).collect()]
    assert sorted(map(str, got)) == sorted(map(str, plain(rows, min_docs, min_chars)))


def test_hot_shards_are_copied(spark, monkeypatch):
    monkeypatch.setattr(linededup, "PROBES", 20)
    monkeypatch.setattr(linededup, "SHARD_KEYS", 30)
    rows = [(i, f"Shared line \n own {i}\n\tshared LINE") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(tuple(r) for r in linededup.dedup_lines(docs).collect())
    assert got == sorted(plain(rows, 10))
    assert {g[2] for g in got} == {2}


def test_clean_keeps_columns(odd):
    out = linededup.clean(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    assert linededup.clean(odd.where("false")).count() == 0
