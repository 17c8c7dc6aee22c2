"""Blocks: documents cut into words, each distinct word of a block named once.

A block is a run of documents of about ``BLOCK_BYTES`` of text out of one input
partition (a longer document is a block by itself).  Its row holds its distinct
words and, for each document, the numbers of its words in order.  What a global table says about words then travels
once per block and word instead of once per occurrence:

    words of blocks --shuffle by word--> figures --shuffle by block--> documents

A word that every document has reaches the shuffle once per block.  The table is
written bucketed by block, so the way back doesn't move the documents.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.llm.common import prepare, scratch_dir
from logloom.session import note_scratch

BLOCK_BYTES, RUN_DOCS = 16 * 1024 * 1024, 256


class WordNumbers(dict):
    """Numbers words by first use; ``of(text)`` gives those of a text."""

    def __init__(self, split: Callable[[bytes], list[bytes]]):
        super().__init__()
        self.split = split

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n

    def of(self, text: bytes) -> np.ndarray:
        words = self.split(text)
        return np.fromiter(map(self.__getitem__, words), np.uint32, len(words))

    def words(self) -> list[bytes]:
        return list(self)


def packed(numbers: np.ndarray) -> bytes:
    """uint32 numbers by byte planes, compressed: small numbers have empty upper planes."""
    planes = np.ascontiguousarray(numbers.astype("<u4")).view(np.uint8).reshape(-1, 4).T.tobytes()
    return zstandard.compress(planes, 3)


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _row(block: int, words: pa.Array, rows: list[pa.Array], sizes: list[int], runs: list[bytes], counts: np.ndarray) -> pa.RecordBatch:
    docs = pa.StructArray.from_arrays([pa.concat_arrays(rows), pa.array(sizes, pa.int32())], ["row", "size"])
    ends = lambda n: pa.array([0, n], pa.int32())
    columns = (words, pa.array(counts, pa.int64()), docs, pa.array(runs, pa.binary()))
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int64()), *[pa.ListArray.from_arrays(ends(len(c)), c) for c in columns]],
        names=["block", "words", "counts", "docs", "runs"],
    )


class _Block:
    """What a block has gathered: numbers of its words, documents and their codes."""

    def __init__(self, numbers):
        self.numbers, self.rows, self.codes, self.counted, self.bytes = numbers, [], [], [], 0

    def add(self, text: bytes, counted: bool) -> None:
        self.codes.append(self.numbers.of(text))
        self.counted.append(counted)
        self.bytes += len(text)

    def batch(self, block: int) -> pa.RecordBatch:
        """The row of the block.  Words are numbered anew by falling frequency, then by spelling, which packs best."""
        words = self.numbers.words()
        self.numbers = None
        n, none = len(words), np.zeros(0, np.uint32)
        used = np.bincount(np.concatenate([none, *self.codes]), minlength=n)
        named = pa.array(words, pa.binary()).cast(pa.string())
        by = [("used", "descending"), ("word", "ascending")]
        order = pc.sort_indices(pa.table({"used": used, "word": named}), sort_keys=by).to_numpy()
        rank = np.empty(n, np.uint32)
        rank[order] = np.arange(n, dtype=np.uint32)
        counts = np.bincount(np.concatenate([none, *[c for c, t in zip(self.codes, self.counted) if t]]), minlength=n)
        runs = [
            packed(rank[np.concatenate([none, *self.codes[i : i + RUN_DOCS]])]) for i in range(0, len(self.codes), RUN_DOCS)
        ]
        return _row(block, named.take(pa.array(order)), self.rows, [len(c) for c in self.codes], runs, counts[order].astype(np.int64))


def _cut(batches: Iterator[pa.RecordBatch], make: Callable, block_bytes: int) -> Iterator[pa.RecordBatch]:
    """Columns: row (struct), text, counted (its words count)."""
    block = TaskContext.get().partitionId() << 32
    part = _Block(make())
    for batch in batches:
        counted = batch.column(2).to_pylist()
        start = 0
        for i, text in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
            part.add(text or b"", counted[i])
            if part.bytes >= block_bytes:
                part.rows.append(batch.column(0).slice(start, i + 1 - start))
                start = i + 1
                yield part.batch(block)
                block, part = block + 1, _Block(make())
        if start < batch.num_rows:
            part.rows.append(batch.column(0).slice(start))
    if part.codes:
        yield part.batch(block)


def block_table(
    docs: DataFrame,
    make: Callable,
    keep: tuple[str, ...],
    text: str = "text",
    counted=None,
    block_bytes: int | None = None,
) -> DataFrame:
    """(block, words, counts, docs array<struct<row, size>>, runs), one row per block, written and bucketed.

    ``runs`` holds the word numbers of all documents in order, packed for ``RUN_DOCS`` documents together.

    ``make`` gives a fresh numbering for each block; ``counted`` says whose words enter ``counts``.
    """
    spark = docs.sparkSession
    prepare(spark)
    most = block_bytes or BLOCK_BYTES
    flag = F.lit(False) if counted is None else F.coalesce(counted, F.lit(False))
    rows = docs.select(F.struct(*keep).alias("row"), F.col(text).alias("text"), flag.alias("counted"))
    row_type = T.StructType([docs.schema[c] for c in keep])
    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("words", T.ArrayType(T.StringType())),
            T.StructField("counts", T.ArrayType(T.LongType())),
            T.StructField("docs", T.ArrayType(T.StructType([T.StructField("row", row_type), T.StructField("size", T.IntegerType())]))),
            T.StructField("runs", T.ArrayType(T.BinaryType())),
        ]
    )
    made = rows.mapInArrow(lambda b: _cut(b, make, most), schema)
    name = f"llm_blocks_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_dir(spark, "blocks")
    note_scratch(spark, "table", name)
    made.write.bucketBy(buckets, "block").option("path", path).option("compression", "zstd").format("parquet").saveAsTable(name)
    return spark.table(name)


def words_of(blocks: DataFrame) -> DataFrame:
    """(block, no, word, n): every distinct word of every block."""
    rows = blocks.select("block", "counts", F.posexplode("words").alias("no", "word"))
    return rows.select("block", "no", "word", F.get("counts", F.col("no")).alias("n"))


def documents_of(batch: pa.RecordBatch, i: int) -> tuple[pa.StructArray, list[np.ndarray]]:
    """The documents of one block row: their carried columns and word numbers."""
    docs = batch.column(batch.schema.get_field_index("docs")).slice(i, 1).flatten()
    runs = batch.column(batch.schema.get_field_index("runs")).slice(i, 1).flatten()
    codes = [unpacked(r) for r in runs.to_pylist()]
    whole = np.concatenate(codes) if codes else np.zeros(0, np.uint32)
    return docs.field("row"), np.split(whole, np.cumsum(docs.field("size").to_numpy())[:-1])
