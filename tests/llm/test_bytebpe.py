"""Byte-level BPE against the tokenizer library on whole texts, and the round trip."""

import hashlib
import random
import struct

import public_tokenizers
import pytest
import tiktoken

from logloom.llm import blocks, bytebpe
from logloom.llm.queries_tokens import VOCABULARY, op6_byte_bpe, token_digests

PATH = public_tokenizers.path(VOCABULARY)
WHOLE = tiktoken.Encoding(
    "whole", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bytebpe.read_ranks(PATH), special_tokens={}
)


def test_odd_rows(odd):
    rows = bytebpe.decode(bytebpe.encode(odd, PATH, public_tokenizers.PATTERN, keep=("doc_id", "words")), PATH).collect()
    want = [(r.doc_id, r.text or "") for r in odd.collect()]
    got = [(r.doc_id, list(r.ids), bytes(r.decoded)) for r in rows]
    assert sorted(map(str, got)) == sorted(str((i, WHOLE.encode_ordinary(t), t.encode())) for i, t in want)
    assert bytebpe.encode(odd.where("false"), PATH, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("size", [50, 10_000])
def test_any_white_space_in_blocks_of_any_size(spark, monkeypatch, size):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", size)
    rng = random.Random(size)
    alphabet = [" ", " ", "\n", "\t", "a", "B", "'s", "1", "!", "é", "\x1c", "\x85", "\xa0", "　", "漢", "²", "😀", "t", "<|endoftext|>"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(30))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: list(r.ids) for r in bytebpe.encode(docs, PATH, public_tokenizers.PATTERN).collect()}
    assert got == {i: WHOLE.encode_ordinary(t) for i, t in enumerate(texts)}


def test_packed_ids_are_the_ids(odd):
    plain = bytebpe.decode(bytebpe.encode(odd, PATH, public_tokenizers.PATTERN), PATH).collect()
    packed = bytebpe.decode(bytebpe.encode(odd, PATH, public_tokenizers.PATTERN, packed_ids=True), PATH).collect()
    want = sorted(str((r.doc_id, struct.pack(f"<{len(r.ids)}i", *r.ids), bytes(r.decoded))) for r in plain)
    assert sorted(str((r.doc_id, bytes(r.ids), bytes(r.decoded))) for r in packed) == want


def test_million_spaces(spark):
    docs = spark.createDataFrame([(1, " " * 1_200_000 + "b")], "doc_id bigint, text string")
    row = bytebpe.decode(bytebpe.encode(docs, PATH, public_tokenizers.PATTERN), PATH).first()
    assert bytes(row.decoded) == b" " * 1_200_000 + b"b" and list(row.ids[-1:]) == WHOLE.encode_ordinary(" b")


def test_decoding_null_and_unknown(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [72])], "doc_id int, ids array<int>")
    got = {r.doc_id: bytes(r.decoded) for r in bytebpe.decode(rows, PATH).collect()}
    assert got[1] == got[2] == b"" and got[3] == WHOLE.decode_bytes([72])
    assert bytebpe.token_bytes(spark, PATH).count() == len(bytebpe.read_ranks(PATH))
    with pytest.raises(Exception, match="out of bounds|token-byte"):
        bytebpe.decode(spark.createDataFrame([(1, [10**6])], "doc_id int, ids array<int>"), PATH).collect()


def test_given_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = set()
    for r in docs.collect():
        ids = WHOLE.encode_ordinary(r.text or "")
        sha = [hashlib.sha256(x).hexdigest() for x in (struct.pack(f"<{len(ids)}I", *ids), (r.text or "").encode())]
        want.add((r.doc_id, len(ids), *sha))
    assert {tuple(r) for r in op6_byte_bpe(spark, sf).collect()} == want
    assert token_digests(docs.where("false")).count() == 0
