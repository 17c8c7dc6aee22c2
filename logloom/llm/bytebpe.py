"""Byte-level BPE encoding and decoding, with every distinct word encoded once.

1. Texts are cut by the pre-token pattern into words with positions, block by
   block (blocks.py): a block lists its distinct words, and its documents hold word numbers by position.
2. Global distinct-word shuffle: the words of all blocks meet by word, sorted, so
   that equal words follow each other; each distinct word is encoded once.
3. The ids go back to the blocks that asked, are joined by word number, and
   every document is put together again by position.
4. Decoding joins ids with the token-byte table (one row per id, bounded by the vocabulary).

The vocabulary file is a parameter; the driver reads it and broadcasts its
ranks (tens of thousands of rows, fixed by the file).

Defined results: null and empty texts have no ids and decode to no bytes; a row
per input row, also for repeated rows and null keys; columns not named are not
read; an unknown id in decoding is an error; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.llm.blocks import block_table, documents_of, packed, unpacked
from logloom.llm.common import prepare

FLUSH_WORDS, RUN_TOKENS = 200_000, 500_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}


class PieceNumbers:
    """Numbers the pattern's matches of a block.

    No match of the pattern holds white space after another character, so a text may be cut
    before any space that follows a non-space; each distinct cut is matched once.
    """

    def __init__(self, pattern: str):
        self.match = regex.compile(pattern).findall
        self.unsafe = regex.compile(r"\s ").search
        self.numbers: dict[str, int] = {}
        self.cuts: dict[str, tuple[int, ...]] = {}

    def _cut(self, cut: str) -> tuple[int, ...]:
        numbers = self.numbers
        pieces = self.match(cut)
        pieces = [cut] if len(pieces) == 1 else pieces  # one string for both tables
        found = tuple([numbers.setdefault(w, len(numbers)) for w in pieces])
        if len(cut) < 48:
            self.cuts[cut] = found
        return found

    def of(self, text: bytes) -> np.ndarray:
        text = text.decode("utf-8")
        if not text:
            return np.zeros(0, np.uint32)
        if self.unsafe(text) or text[0] == " ":
            return np.array(self._cut(text), np.uint32)
        first, *rest = text.split(" ")
        known = self.cuts.get
        parts = [known(first) or self._cut(first)]
        parts += [known(c) or self._cut(c) for c in (" " + x for x in rest)]
        return np.fromiter(chain.from_iterable(parts), np.uint32)

    def words(self) -> list[bytes]:
        return [w.encode("utf-8") for w in self.numbers]


def rank_encoding(ranks: dict[bytes, int], pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _encoded(batches: Iterator[pa.RecordBatch], shared, pattern: str) -> Iterator[pa.RecordBatch]:
    """Sorted (word, block, no) rows in; packed (block, nos, sizes, ids) rows out, encoding each run of equal words once."""
    encode = rank_encoding(shared.value, pattern)._encode_single_piece  # a word is one match already
    last, ids = None, []
    waiting: dict[int, list] = {}
    n = 0
    for batch in batches:
        for word, block, no in zip(*(c.to_pylist() for c in batch.columns)):
            if word != last:
                last, ids = word, encode(word)
            waiting.setdefault(block, []).append((no, ids))
            n += 1
        if n >= FLUSH_WORDS:
            yield _flushed(waiting)
            waiting, n = {}, 0
    if n:
        yield _flushed(waiting)


def _flushed(waiting: dict[int, list]) -> pa.RecordBatch:
    rows = []
    for block, words in waiting.items():
        words.sort(key=lambda x: x[0])
        nos = np.array([no for no, _ in words], np.uint32)
        sizes = np.array([len(ids) for _, ids in words], np.uint32)
        ids = np.fromiter(chain.from_iterable(ids for _, ids in words), np.uint32)
        rows.append((block, packed(np.diff(nos, prepend=np.uint32(0))), packed(sizes), packed(ids)))
    kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["block", "nos", "sizes", "ids"])


def _gathered(starts: np.ndarray, sizes: np.ndarray, values: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """values[starts[c] : starts[c] + sizes[c]] of every code, one after the other."""
    n = sizes[codes]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.arange(total) + np.repeat(starts[codes] - (ends - n), n)]


def _reassembled(batches: Iterator[pa.RecordBatch], packed_ids: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            rows, codes = documents_of(batch, i)
            parts = batch.column(batch.schema.get_field_index("parts")).slice(i, 1).flatten()
            nos, sizes, ids = [], [], []
            for a, b, c in zip(*(parts.field(k).to_pylist() for k in ("nos", "sizes", "ids"))):
                nos.append(np.cumsum(unpacked(a), dtype=np.int64))
                sizes.append(unpacked(b).astype(np.int64))
                ids.append(unpacked(c))
            nos, sizes, ids = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (nos, sizes, ids))
            at, size = np.zeros(len(nos), np.int64), np.zeros(len(nos), np.int64)
            at[nos], size[nos] = np.cumsum(sizes) - sizes, sizes
            # Documents go out in runs, so that a block is never one huge batch.
            for first, last in _runs(codes, size):
                out = [_gathered(at, size, ids, c) for c in codes[first:last]]
                ends = np.cumsum([0] + [len(x) for x in out])
                flat = np.concatenate(out).astype("<i4")
                if packed_ids:
                    places = pa.py_buffer((4 * ends).astype(np.int32))
                    column = pa.Array.from_buffers(pa.binary(), len(out), [None, places, pa.py_buffer(flat)])
                else:
                    column = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays([rows.slice(first, last - first), column], names=["row", "ids"])


def _runs(codes: list[np.ndarray], size: np.ndarray, most: int = RUN_TOKENS) -> Iterator[tuple[int, int]]:
    """Runs of documents of about ``most`` tokens together; a longer document is a run by itself."""
    first = total = 0
    for i, code in enumerate(codes):
        n = int(size[code].sum())
        if i > first and total + n > most:
            yield first, i
            first, total = i, 0
        total += n
    if first < len(codes):
        yield first, len(codes)


def encode(
    docs: DataFrame, path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text", packed_ids: bool = False
) -> DataFrame:
    """``keep`` and ``ids`` of every row, by the ranks in ``path``.

    ``ids`` is an array of int or, with ``packed_ids``, binary: little-endian 32-bit integers, as training shards hold them.
    """
    spark = docs.sparkSession
    prepare(spark)
    blocks = block_table(docs, lambda: PieceNumbers(pattern), keep, text)
    words = blocks.select("block", F.posexplode("words").alias("no", "word"))
    shared = spark.sparkContext.broadcast(read_ranks(path))
    sorted_words = words.select("word", "block", "no").repartition("word").sortWithinPartitions("word")
    found = sorted_words.mapInArrow(
        lambda b: _encoded(b, shared, pattern), "block bigint, nos binary, sizes binary, ids binary"
    )
    parts = found.groupBy("block").agg(F.collect_list(F.struct("nos", "sizes", "ids")).alias("parts"))
    back = blocks.select("block", "docs", "runs").join(parts, "block", "left")
    row_type = T.StructType([docs.schema[c] for c in keep])
    schema = T.StructType([T.StructField("row", row_type), T.StructField("ids", T.BinaryType() if packed_ids else T.ArrayType(T.IntegerType()))])
    out = back.select("docs", "runs", "parts").mapInArrow(lambda b: _reassembled(b, packed_ids), schema)
    return out.select(*[F.col("row")[c].alias(c) for c in keep], "ids")


def token_bytes(spark: SparkSession, path: str) -> DataFrame:
    """The token-byte table: (id, bytes)."""
    rows = [(rank, bytearray(word)) for word, rank in read_ranks(path).items()]
    return spark.createDataFrame(rows, "id int, bytes binary")


def _unpacked_ids(column: pa.BinaryArray) -> pa.Array:
    """All ids of a column of little-endian 32-bit integers."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1] if len(column) else [0, 0]
    first, last = int(ends[0]), int(ends[-1])
    data = column.buffers()[2] or pa.py_buffer(b"")
    return pa.array(np.frombuffer(data, "<i4", (last - first) // 4, first))


def _decoded(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """The ids are dense, so the join with the broadcast table is a take; its buffer holds the bytes in order."""
    table = pa.array(shared.value, pa.binary())
    for batch in batches:
        lists = batch.column(batch.num_columns - 1)
        packed_ids = pa.types.is_binary(lists.type)
        lists = lists.fill_null(b"" if packed_ids else [])
        flat = _unpacked_ids(lists) if packed_ids else lists.flatten()
        taken = table.take(flat)
        if taken.null_count:
            raise ValueError("an id is not in the token-byte table")
        joined = taken.buffers()[2]
        ends = np.frombuffer(taken.buffers()[1], np.int32)[taken.offset : taken.offset + len(taken) + 1] if len(taken) else np.zeros(1, np.int32)
        sizes = pc.binary_length(lists).to_numpy() // 4 if packed_ids else lists.value_lengths().to_numpy()
        bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        whole = pa.Array.from_buffers(
            pa.binary(), len(lists), [None, pa.py_buffer(ends[bounds].astype(np.int32)), joined or pa.py_buffer(b"")]
        )
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists, whole], names=[*batch.schema.names[:-1], "ids", "decoded"])


def decode(tokens: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """The rows with ``decoded``, the bytes of their ids (binary; they need not be whole characters).

    ``ids`` is an array of int, or binary as ``encode(packed_ids=True)`` gives it.
    """
    spark = tokens.sparkSession
    prepare(spark)
    ranks = read_ranks(path)
    by_id: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
    for word, rank in ranks.items():
        by_id[rank] = word
    shared = spark.sparkContext.broadcast(by_id)
    rest = [c for c in tokens.columns if c != ids]
    rows = tokens.select(*rest, F.col(ids).alias("ids"))
    schema = T.StructType([*[tokens.schema[c] for c in rest], T.StructField("ids", tokens.schema[ids].dataType), T.StructField("decoded", T.BinaryType())])
    return rows.mapInArrow(lambda b: _decoded(b, shared), schema)
