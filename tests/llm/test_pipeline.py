"""The pipeline against plain versions of its stages, one after the other."""

from collections import Counter

import public_tokenizers
import tiktoken
from test_decontaminate import plain as plain_hits
from test_linededup import plain as plain_lines
from test_neardup import plain as plain_groups
from test_quality_rules import plain as plain_quality

import corpus_pipeline
from logloom.llm import bytebpe


def test_run_matches_plain_stages(spark, sf):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    judged = {i: plain_quality(t) for i, t in rows.items()}
    rows = [(i, q[8]) for i, q in judged.items() if q[7]]
    rows = [(i, t) for i, _, _, t in plain_lines(rows, 10)]
    groups = plain_groups(rows, 5)
    rows = [(i, t) for i, t in rows if groups[i][1] == i]
    rows = [(i, t) for i, t in rows if not plain_hits(t, items)[3]]
    whole = tiktoken.Encoding(
        "whole",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=bytebpe.read_ranks(public_tokenizers.path(corpus_pipeline.VOCABULARY)),
        special_tokens={},
    )
    got = {r.doc_id: (list(r.ids), r.round_trip) for r in corpus_pipeline.run(spark, sf).collect()}
    assert got == {i: (whole.encode_ordinary(t), True) for i, t in rows}


def test_stages_keep_the_columns(odd, spark, sf):
    docs = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == odd.columns, name
    last = corpus_pipeline.STAGES[-1][1](spark, odd, sf).collect()
    assert Counter(r.round_trip for r in last) == {True: odd.count()}


def test_empty_tables(spark, sf, tmp_path):
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{sf}/{name}.parquet").where("false").write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
