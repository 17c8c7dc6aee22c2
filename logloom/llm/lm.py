"""Language-model scoring from a log-frequency Bloom filter.

The model is a bigram model over words and a unigram model below it.

1. Words of the training documents are counted exactly, block by block
   (blocks.py) and then by word.
2. Every block sends its distinct word pairs, as 64-bit hashes with their training counts, packed, to the
   tasks of their shards, once.  A shard so has the exact counts of its pairs.  A pair with count c has the
   level 1 + floor(log(c) / log(BASE)), and enters the filter once for each level up to its own.
3. The filter holds every pair that was seen, at any input size: a shard has ``BITS_PER_ENTRY``
   for each of its entries.  The number of shards follows the tokens, so a task holds a bounded part.
4. A pair's count is read by probing level after level until one is missing.  While the filter of all shards is
   sure to fit ``FILTER_BYTES`` it is broadcast, and blocks probe it.  A larger filter is probed in the task that built it, for
   the pairs that came there, and the levels go back by block.  Both ways probe the same bits.
5. Smoothing interpolates with the unigram model:

    P(w | v) = DISCOUNT * count(v w) / count(v) + (1 - DISCOUNT) * (count(w) + 1) / (N + V + 1)

   The filter holds the pair of every training token, so what the pairs leave over is the same for every context.

Unigram counts are exact, since the words of every block meet their counts anyway.

Defined results: null and empty texts hold only the end token; a row per input
row; without any training document every count is 0 and N = V = 0; null keys
count as held in (their remainder is null).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.llm.blocks import WordNumbers, block_table, documents_of, words_of
from logloom.llm.common import materialize, prepare

# The number of shards is a power of two (SHARDS at least): a shard is the low bits of a key.
# FILTER_BYTES bounds what is broadcast, SHARD_PAIRS what one task receives.
FILTER_BYTES, BITS_PER_ENTRY, PROBES, SHARDS = 48 * 1024 * 1024, 20, 13, 64
SHARD_PAIRS, LEAST_SHARD_BYTES = 2_000_000, 1024
BASE, DISCOUNT = 1.5, 0.85
# All pairs of a block are in a task's memory at once, so blocks are smaller than those of blocks.py.
PAIR_BLOCK_BYTES = 8 * 1024 * 1024
START, END = np.uint64(0x51ED270B35C6D8A1), np.uint64(0xA24BAED4963EE407)


def _split(text: bytes) -> list[bytes]:
    return text.lower().split()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pair_keys(words: np.ndarray) -> np.ndarray:
    """Keys of (context, word) for word hashes that end with END; the first context is START."""
    before = np.concatenate([[START], words[:-1]])
    return _mixed(_mixed(before + np.uint64(0x9E3779B97F4A7C15)) ^ words)


def level_of(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(counts) / np.log(BASE) + 1e-9).astype(np.int64)


def count_of(levels: np.ndarray) -> np.ndarray:
    """The middle of the whole numbers that share a level; 0 for level 0."""
    low = np.ceil(BASE ** (levels - 1.0) - 1e-9)
    high = np.maximum(np.ceil(BASE ** levels.astype(float) - 1e-9) - 1, low)
    return np.where(levels > 0, (low + high) / 2, 0.0)


class LogFrequencyFilter:
    """Bits of (key, level) entries in shards by key; a shard has a size of its own."""

    def __init__(self, shards: list[np.ndarray]):
        self.bits = np.concatenate(shards)
        self.sizes = np.array([8 * len(b) for b in shards], np.uint64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]]).astype(np.int64)

    @staticmethod
    def places(keys: np.ndarray, level: int, probe: int, size) -> np.ndarray:
        x = _mixed(keys + np.uint64((0x9E3779B97F4A7C15 * (level * 64 + probe + 1)) & 0xFFFFFFFFFFFFFFFF))
        return (x % size).astype(np.int64)

    @classmethod
    def shard(cls, keys: np.ndarray, levels: np.ndarray) -> np.ndarray:
        """The bits of one shard."""
        entries = int(levels.sum())
        bits = np.zeros(max(LEAST_SHARD_BYTES, -(-entries * BITS_PER_ENTRY // 8)), np.uint8)
        for level in range(1, int(levels.max(initial=0)) + 1):
            some = keys[levels >= level]
            for probe in range(PROBES):
                at = cls.places(some, level, probe, np.uint64(8 * len(bits)))
                np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
        return bits

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Highest level of each key; 0 if it isn't held."""
        out = np.zeros(len(keys), np.int64)
        open_ = np.arange(len(keys))
        shard = (keys % np.uint64(len(self.sizes))).astype(np.int64)
        size, start = self.sizes[shard], self.starts[shard]
        level = 1
        while len(open_):
            for probe in range(PROBES):
                at = start[open_] + self.places(keys[open_], level, probe, size[open_])
                open_ = open_[(self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]
            out[open_] = level
            level += 1
        return out


def shard_count(pairs: int) -> int:
    """Shards for so many pair occurrences."""
    shards = SHARDS
    while pairs > SHARD_PAIRS * shards:
        shards *= 2
    return shards


def _planes(numbers: np.ndarray) -> bytes:
    """Whole numbers by byte planes, compressed: upper planes of small numbers are empty."""
    numbers = np.ascontiguousarray(numbers)
    return zstandard.compress(numbers.view(np.uint8).reshape(-1, numbers.itemsize).T.tobytes(), 1)


def _from_planes(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(data), np.uint8).reshape(size, -1).T).view(kind).ravel()


def pack_keys(keys: np.ndarray, shards: int) -> bytes:
    """Ascending keys of one shard as differences; the low bits are the shard's number."""
    return _planes(np.diff(keys >> np.uint64(shards.bit_length() - 1), prepend=np.uint64(0)).astype("<u8"))


def unpack_keys(data: bytes, shard: int, shards: int) -> np.ndarray:
    high = np.cumsum(_from_planes(data, "<u8"), dtype=np.uint64)
    return (high << np.uint64(shards.bit_length() - 1)) | np.uint64(shard)


def _word_hashes(words: pa.Array) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.cast(pa.binary()).to_pylist()), np.uint64, len(words))


def _with_end(hashes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return np.append(hashes[codes], END)


def _by_shard(keys: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """Places of the keys of each shard that has any."""
    shard = (keys % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    held, first = np.unique(shard[order], return_index=True)
    for s, at in zip(held.tolist(), np.split(order, first[1:])):
        yield s, at


def _keys_of(hashes: np.ndarray, codes: list[np.ndarray]) -> np.ndarray:
    """Pair keys of all documents of a block, one after the other."""
    keys, at = np.empty(sum(len(c) + 1 for c in codes), np.uint64), 0
    for c in codes:
        keys[at : at + len(c) + 1] = pair_keys(_with_end(hashes, c))
        at += len(c) + 1
    return keys


def _starts(ordered: np.ndarray) -> np.ndarray:
    """Where each distinct value of an ordered array begins."""
    new = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    return np.flatnonzero(new)


def _sent(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """The distinct pairs of each block with their counts in training documents, a row per shard."""
    for batch in batches:
        for i in range(batch.num_rows):
            rows, codes = documents_of(batch, i)
            hashes = _word_hashes(batch.column(batch.schema.get_field_index("words")).slice(i, 1).flatten())
            keys = _keys_of(hashes, codes)
            train = np.repeat(np.array(rows.field("_train").to_pylist(), bool), [len(c) + 1 for c in codes])
            order = np.argsort(keys)
            keys, train = keys[order], train[order]
            del order
            first = _starts(keys)
            counts = np.add.reduceat(train, first, dtype="<u4")
            keys = keys[first]
            block = batch.column(batch.schema.get_field_index("block"))[i].as_py()
            for some in _runs(_by_shard(keys, shards)):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block] * len(some), pa.int64()),
                        pa.array([s for s, _ in some], pa.int64()),
                        pa.array([pack_keys(keys[at], shards) for _, at in some], pa.binary()),
                        pa.array([_planes(counts[at]) for _, at in some], pa.binary()),
                    ],
                    names=["block", "shard", "keys", "counts"],
                )


def _runs(parts: Iterator, most: int = 256) -> Iterator[list]:
    while some := list(islice(parts, most)):
        yield some


_SHARD = pa.schema([("shard", pa.int64()), ("block", pa.int64()), ("bits", pa.binary()), ("levels", pa.binary())])


def _shard(group: pa.Table, shards: int, shared: bool) -> pa.Table:
    """The filter of one shard, or what it says about the pairs that each block sent."""
    shard = group["shard"][0].as_py()
    sent = [unpack_keys(k, shard, shards) for k in group["keys"].to_pylist()]
    counts = [_from_planes(c, "<u4") for c in group["counts"].to_pylist()]
    keys, at = np.unique(np.concatenate(sent), return_inverse=True)
    seen = np.bincount(at, weights=np.concatenate(counts))
    held = seen > 0
    bits = LogFrequencyFilter.shard(keys[held], level_of(seen[held]))
    if shared:
        return pa.Table.from_pylist([{"shard": shard, "block": None, "bits": bits.tobytes(), "levels": None}], _SHARD)
    # A filter of one shard: all of these keys belong to it.
    levels = LogFrequencyFilter([bits]).levels(keys).astype(np.uint8)[at]
    parts = np.split(levels, np.cumsum([len(k) for k in sent])[:-1])
    rows = [
        {"shard": shard, "block": b, "bits": None, "levels": zstandard.compress(x.tobytes(), 1)}
        for b, x in zip(group["block"].to_pylist(), parts)
    ]
    return pa.Table.from_pylist(rows, _SHARD)


def _prober(shared, shards: int, batch: pa.RecordBatch, i: int, hashes: np.ndarray, codes: list[np.ndarray]):
    """Function from pair keys of a block row to their levels."""
    if shared is not None:
        return lambda keys: _levels(shared.value, keys)
    distinct = _keys_of(hashes, codes)
    distinct.sort()
    distinct = distinct[_starts(distinct)]
    came = batch.column(batch.schema.get_field_index("levels")).slice(i, 1).flatten()
    came = dict(zip(came.field("shard").to_pylist(), came.field("levels").to_pylist()))
    levels = np.zeros(len(distinct), np.uint8)
    for s, at in _by_shard(distinct, shards):
        levels[at] = np.frombuffer(zstandard.decompress(came[s]), np.uint8)
    return lambda keys: levels[np.searchsorted(distinct, keys)].astype(np.int64)


def _block_counts(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and training counts of the words of a block row, by number."""
    hashes = _word_hashes(batch.column(batch.schema.get_field_index("words")).slice(i, 1).flatten())
    counts = np.zeros(len(hashes), np.int64)
    figures = batch.column(batch.schema.get_field_index("figures")).slice(i, 1).flatten()
    counts[figures.field("no").to_numpy()] = figures.field("c").to_numpy()
    return hashes, counts


def _chunks(codes: list[np.ndarray], most: int = 100_000) -> Iterator[tuple[int, int]]:
    """Runs of documents of about ``most`` tokens together."""
    first = size = 0
    for i, code in enumerate(codes):
        size += len(code) + 1
        if size >= most:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(codes):
        yield first, len(codes)


def _tokens(codes: list[np.ndarray], hashes: np.ndarray, counts: np.ndarray, n_docs: int):
    """All tokens of some documents: starts, count of token, count of context, pair key."""
    n, sizes = len(hashes), np.array([len(c) for c in codes])
    ends = np.cumsum(sizes + 1) - 1
    token = np.full(int(ends[-1]) + 1, n)
    inside = np.ones(len(token), bool)
    inside[ends] = False
    token[inside] = np.concatenate(codes)
    starts = ends - sizes
    before = np.concatenate([[n + 1], token[:-1]])
    before[starts] = n + 1
    seen = np.concatenate([counts, [n_docs, n_docs]])
    named = np.concatenate([hashes, [END, START]])
    keys = _mixed(_mixed(named[before] + np.uint64(0x9E3779B97F4A7C15)) ^ named[token])
    return starts, seen[token], seen[before], keys


def _levels(filter_: LogFrequencyFilter, keys: np.ndarray) -> np.ndarray:
    """Each distinct pair is probed once."""
    distinct, at = np.unique(keys, return_inverse=True)
    return filter_.levels(distinct)[at]


def _scored(batches: Iterator[pa.RecordBatch], shared, shards: int, model: dict) -> Iterator[pa.RecordBatch]:
    n_docs, tokens, kinds = model["docs"], model["tokens"], model["kinds"]
    for batch in batches:
        for i in range(batch.num_rows):
            rows, codes = documents_of(batch, i)
            hashes, counts = _block_counts(batch, i)
            levels = _prober(shared, shards, batch, i, hashes, codes)
            for first, last in _chunks(codes):
                starts, own, context, keys = _tokens(codes[first:last], hashes, counts, n_docs)
                unigram = (own + 1) / (tokens + kinds + 1)
                # A pair is never seen more often than either of its words.
                seen = np.minimum(count_of(levels(keys)), np.minimum(own, context))
                p = DISCOUNT * seen / np.maximum(context, 1) + (1 - DISCOUNT) * unigram
                p = np.where(context > 0, p, unigram)
                sizes = np.diff(np.append(starts, len(own)))
                sums = [np.add.reduceat(x, starts) for x in ((own > 0).astype(np.int64), np.log10(unigram), np.log10(p))]
                yield pa.RecordBatch.from_arrays(
                    [rows.slice(first, last - first), pa.array(sizes, pa.int64()), *map(pa.array, sums)],
                    names=["row", "n_tokens", "n_known", "base_score", "score"],
                )


def score(docs: DataFrame, train: Column, keep: tuple[str, ...] = ("doc_id",), text: str = "text", filter_bytes: int = FILTER_BYTES, block_bytes: int = PAIR_BLOCK_BYTES) -> DataFrame:
    """``keep``, token counts, N, and log10 probabilities under the unigram base and the model, per input row.

    ``train`` says which rows the model learns from; ``filter_bytes`` is the largest filter that is broadcast.
    """
    spark = docs.sparkSession
    prepare(spark)
    flag = F.coalesce(train, F.lit(False))
    rows = docs.select(*keep, F.col(text).alias("_text"), flag.alias("_train"))
    blocks = block_table(rows, lambda: WordNumbers(_split), (*keep, "_train"), "_text", counted=F.col("_train"), block_bytes=block_bytes)

    # Words: count over all blocks, and the way back.
    by_word = Window.partitionBy("word")
    counted = words_of(blocks).select("block", "no", F.sum("n").over(by_word).alias("c"), F.min("block").over(by_word).alias("b0"))
    figures = materialize(counted.select("block", "no", "c", (F.col("block") == F.col("b0")).alias("lead")), "word-counts")
    words = figures.where("lead").agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
    n_docs = docs.where(flag).count()
    model = {"docs": n_docs, "tokens": words["n"] + n_docs, "kinds": words["v"] + (n_docs > 0)}

    # Pairs: a pair has no more levels than occurrences, so the tokens bound the filter.
    size_of = F.aggregate("docs.size", F.lit(0).cast("bigint"), lambda a, x: a + x + 1)
    pairs = blocks.agg(F.sum(size_of)).first()[0] or 0
    n_shards = shard_count(pairs)
    local = pairs * BITS_PER_ENTRY <= filter_bytes * 8
    sent = blocks.select("block", "words", "docs", "runs").mapInArrow(
        lambda b: _sent(b, n_shards), "block bigint, shard bigint, keys binary, counts binary"
    )
    made = sent.groupBy("shard").applyInArrow(
        lambda g: _shard(g, n_shards, local), "shard bigint, block bigint, bits binary, levels binary"
    )
    back = figures.groupBy("block").agg(F.collect_list(F.struct("no", "c")).alias("figures"))
    joined = blocks.select("block", "words", "docs", "runs").join(back, "block", "left")
    shared = None
    if local:
        parts = [np.zeros(LEAST_SHARD_BYTES, np.uint8)] * n_shards
        # As many rows as shards, at most FILTER_BYTES and the least size of each.
        for row in made.select("shard", "bits").collect():
            parts[row["shard"]] = np.frombuffer(row["bits"], np.uint8)
        shared = spark.sparkContext.broadcast(LogFrequencyFilter(parts))
    else:
        came = made.groupBy("block").agg(F.collect_list(F.struct("shard", "levels")).alias("levels"))
        joined = joined.join(came, "block", "left")
    joined = joined.drop("block")
    row_type = T.StructType([*[docs.schema[c] for c in keep], T.StructField("_train", T.BooleanType())])
    schema = T.StructType(
        [T.StructField("row", row_type), *[T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known")]]
        + [T.StructField(c, T.DoubleType()) for c in ("base_score", "score")]
    )
    out = joined.mapInArrow(lambda b: _scored(b, shared, n_shards, model), schema)
    kept = [F.col("row")[c].alias(c) for c in keep]
    return out.select(*kept, "n_tokens", "n_known", F.lit(model["tokens"]).cast("bigint").alias("train_tokens"), "base_score", "score")
