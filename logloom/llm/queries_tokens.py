"""Queries of the tokenizing and formatting operators."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm import bytebpe, chat
from logloom.llm.common import query, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def token_digests(docs: DataFrame) -> DataFrame:
    """Encode, decode, and the digests of both."""
    path = public_tokenizers.path(VOCABULARY)
    tokens = bytebpe.decode(bytebpe.encode(docs, path, public_tokenizers.PATTERN, packed_ids=True), path)
    return tokens.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded bytes of every document."""
    return token_digests(table(spark, sf_dir, "documents"))


CHAT_TOKENIZER = "byte_bpe_50k.tiktoken"
# Fixed value of the contract: a conversation whose texts hold control strings.
PLANTED = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation out of its pieces in order, from the rendered text and the mask only."""
    import numpy as np

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    current, open_, rows = None, False, []
    n = loss_chars = chars = 0
    turns_sha, loss_sha, kind = hashlib.sha256(), hashlib.sha256(), pa.int64()

    def done():
        return (current, n, turns_sha.hexdigest(), loss_chars, loss_sha.hexdigest(), chars)

    def packed():
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), [kind, *kinds])], names=names)

    for batch in batches:
        kind = batch.schema.field(0).type
        spans = []
        for lists in (batch.column(2), batch.column(3)):
            flat, ends = lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy())
            spans.append(np.split(flat, ends[:-1]))
        for conv, text, starts, ends in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), *spans):
            if open_ and conv != current:
                rows.append(done())
                n = loss_chars = chars = 0
                turns_sha, loss_sha = hashlib.sha256(), hashlib.sha256()
            current, open_ = conv, True
            for role, said in chat.parse(text):
                n += 1
                turns_sha.update(f"{role}\n{said}\n".encode())
            loss = chat.unguarded(chat.masked_text(text, np.stack([starts, ends], axis=1)))
            loss_chars += len(loss)
            loss_sha.update(loss.encode())
            chars += len(text)
        if rows:
            yield packed()
            rows = []
    if open_:
        rows.append(done())
        yield packed()


def chat_digests(turns: DataFrame, segment: int | None = None) -> DataFrame:
    kind = turns.schema["conv_id"].dataType.simpleString()
    pieces = chat.format_chats(turns, public_tokenizers.path(CHAT_TOKENIZER), segment)
    # The pieces of a conversation leave the operator in order and in one partition.
    return pieces.select("conv_id", "formatted", "starts", "ends").mapInArrow(
        _read_back,
        f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    )


_OP2 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), r AS (
  SELECT *, length(regexp_replace(text, '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\2\\\3', 'g'))
            + length(regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\2\\\3', 'g'))
            + CASE WHEN role = 'assistant' THEN 9 ELSE 15 END AS size
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(size) AS BIGINT) AS formatted_chars
FROM r GROUP BY conv_id
"""


@query(_OP2)
def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of turns and of the loss text of every conversation, read back from the rendering."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_digests(turns.unionByName(spark.createDataFrame(PLANTED, "conv_id bigint, turn bigint, role string, text string")))
