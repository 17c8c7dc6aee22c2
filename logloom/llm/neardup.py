"""Near-duplicate documents: SuperMinHash, banding, verification, union-find.

1. A document's set is its distinct k-word shingles (64-bit hashes of A-Z
   lower-cased words).  Equal sets form a class; the smallest key stands
   for it, so copies never meet each other again.
2. SuperMinHash signature of each set: every element deals its values to the
   slots along its own random permutation, one slot a step; step j gives values from j
   to j + 1.  As soon as no slot holds more than the next step can give, later
   steps can't change anything and are skipped.
3. 32 bands of 4 slots.  A pair of similarity 0.8 shares no band with
   probability (1 - 0.8^4)^32 = 5e-8.  In a bucket each class is only paired with the smallest
   one (a grouped minimum, then a join), so a bucket of n gives n - 1 candidates.
4. Candidates are confirmed on full sets, and confirmed links joined by
   union-find.
5. Buckets whose classes are still in several components hold pairs not yet compared.
   In each of these the members outside its largest component are compared with all others, on a grid of
   blocks of ``BLOCK``, a cell in one task, across components only, and again on full sets.
   So no link of a bucket is lost and no list of all pairs is ever made.

Defined results: null, empty and wordless texts have an empty set and are
linked with nothing; texts of fewer than k words are one shingle; rows that
repeat a key give one row (of the smallest set print); rows without a key are left out;
an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import materialize, prepare
from logloom.llm.components import UnionFind, components
from logloom.operators.lookup import fits_broadcast, lookup

SLOTS, BANDS = 128, 32
BLOCK = 256
PERCENT = 80
_WORDS_KEPT = 1_000_000

_ODD = np.array([(0x9E3779B97F4A7C15 * (2 * i + 1)) & 0xFFFFFFFFFFFFFFFF for i in range(64)], dtype=np.uint64) | np.uint64(1)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > _WORDS_KEPT:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes | None, k: int, hashes: _WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles."""
    words = (text or b"").lower().split()  # bytes: A-Z and ASCII white space
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    k = min(k, len(h))
    n = len(h) - k + 1
    total = np.full(n, k, np.uint64)
    for j in range(k):
        total += mixed(h[j : j + n] * _ODD[j % 64] + np.uint64(j))
    return np.unique(mixed(total))


def signature(elements: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash of a non-empty set: 16 bits a slot, all elements a step at a time."""
    least = np.full(slots, np.inf)
    order = None
    rows = np.arange(len(elements))
    for j in range(slots):
        draw = mixed(elements + np.uint64((0xD1B54A32D192ED03 * (j + 1)) & 0xFFFFFFFFFFFFFFFF))
        pick = j + (draw & np.uint64(0xFFFFFF)).astype(np.int64) % (slots - j)
        value = j + (draw >> np.uint64(24)).astype(np.float64) / 2.0**40
        if j == 0:
            slot = pick
        else:
            if order is None:
                order = np.tile(np.arange(slots, dtype=np.int16), (len(elements), 1))
                order[rows, first] = 0
                order[:, 0] = first
            slot = order[rows, pick]
            order[rows, pick] = order[:, j]
            order[:, j] = slot
        if j == 0:
            first = pick
        np.minimum.at(least, slot, value)
        if least.max() <= j + 1:
            break
    bits = (least * 2.0**40).astype(np.uint64)
    return (mixed(bits) >> np.uint64(48)).astype(np.uint16)


def _features(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    hashes = _WordHashes()
    for batch in batches:
        sizes, prints, bands = [], [], []
        for text in batch.column(1).cast(pa.binary()).to_pylist():
            found = shingle_set(text, k, hashes)
            sizes.append(len(found))
            prints.append(xxhash.xxh3_128_digest(found.tobytes()))
            bands.append(signature(found).view(np.int64) if len(found) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
            names=["key", "n", "print", "bands"],
        )


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    hashes = _WordHashes()
    for batch in batches:
        found = [shingle_set(t, k, hashes).tobytes() for t in batch.column(1).cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["key", "elements"])


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _confirmed(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        xs, ys = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        good = [_similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in zip(xs, ys)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good, pa.bool_()))


def _across(group: pa.Table, percent: int) -> pa.Table:
    """Links of minor members (left) with members of other components (right) in one cell of a bucket's grid."""
    band = group["band"][0].as_py()
    keys, left, minor = group["key"].to_pylist(), group["left"].to_pylist(), np.array(group["minor"].to_pylist())
    sizes = group["n"].to_numpy()
    bands = np.array(group["bands"].to_pylist(), dtype=np.int64)
    slots = bands.view(np.uint16)
    sets_ = [np.frombuffer(e, np.uint64) for e in group["elements"].to_pylist()]
    joined = UnionFind()
    for key, root in zip(keys, group["root"].to_pylist()):
        joined.union(key, root)
    order = np.argsort(np.argsort(np.array(keys, dtype=object)))
    right = ~np.array(left)
    links = []
    for i in np.flatnonzero(left):
        # Two minor members meet in both directions: one is enough.  A pair counts in the first band that both share.
        fit = right & (~minor | (order > order[i]))
        fit &= (sizes * 100 >= sizes[i] * percent) & (sizes[i] * 100 >= sizes * percent)
        fit &= ~(bands[:, :band] == bands[i, :band]).any(axis=1)
        # Estimates 0.2 under the threshold are over five deviations away.
        fit &= (slots == slots[i]).mean(axis=1) * 100 >= percent - 20
        for j in np.flatnonzero(fit):
            if joined.root(keys[i]) != joined.root(keys[j]) and _similar(sets_[i], sets_[j], percent):
                joined.union(keys[i], keys[j])
                links.append((keys[i], keys[j]))
    kind = group.schema.field("key").type
    return pa.table({"a": pa.array([a for a, _ in links], kind), "b": pa.array([b for _, b in links], kind)})


def groups(
    docs: DataFrame, k: int = 5, percent: int = PERCENT, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, n_shingles, class_id, component_id) of every document."""
    spark = docs.sparkSession
    prepare(spark)
    kind = docs.schema[key].dataType.simpleString()
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).where("key IS NOT NULL")
    made = texts.mapInArrow(lambda b: _features(b, k), f"key {kind}, n bigint, print binary, bands array<bigint>")
    made = materialize(made, "signatures")
    one = made.groupBy("key").agg(F.min(F.struct("print", "n")).alias("s")).select("key", "s.print", "s.n")
    classes = made.where("n > 0").groupBy("print").agg(F.min("key").alias("key"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    classes = materialize(classes, "classes")

    cells = classes.select("key", "n", F.posexplode("bands").alias("band", "value"))
    centers = cells.groupBy("band", "value").agg(F.min(F.struct("key", "n")).alias("c"), F.count("*").alias("members"))
    centers = centers.where("members > 1").select("band", "value", F.col("c.key").alias("b"), F.col("c.n").alias("bn"), "members")
    # Every class meets the center of its bucket; a bucket with many classes is no hot key of that join.
    bucket = ["band", "value"]
    found = lookup(cells, materialize(centers, "centers"), bucket, dict.fromkeys(("b", "bn", "members")), weight="members", row_id="key")
    met = materialize(found.where("members IS NOT NULL"), "buckets")
    close = (F.col("n") * 100 >= F.col("bn") * percent) & (F.col("bn") * 100 >= F.col("n") * percent)
    pairs = materialize(met.where((F.col("key") != F.col("b")) & close).select(F.col("key").alias("a"), "b").distinct(), "candidates")

    # Sets of all classes that share a bucket, made again from their texts.
    named = met.select("key").distinct()
    named = F.broadcast(named) if fits_broadcast(named, limit=1_000_000) else named
    needed = texts.join(named, "key", "left_semi").mapInArrow(lambda b: _sets(b, k), f"key {kind}, elements binary")
    sets_ = materialize(needed.groupBy("key").agg(F.min("elements").alias("elements")), "sets")
    left = sets_.select(F.col("key").alias("a"), F.col("elements").alias("x"))
    right = sets_.select(F.col("key").alias("b"), F.col("elements").alias("y"))
    links = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(
        lambda b: _confirmed(b, percent), f"a {kind}, b {kind}"
    )
    links = materialize(links, "links")
    roots = materialize(components(links), "roots")

    # Buckets of three classes or more that are still in several components.
    placed = met.where("members > 2").join(roots.withColumnRenamed("node", "key"), "key", "left")
    placed = placed.withColumn("root", F.coalesce("root", "key"))
    sizes = placed.groupBy("band", "value", "root").agg(F.count("*").alias("c"))
    largest = sizes.groupBy("band", "value").agg(F.max(F.struct("c", "root")).alias("m"), F.count("*").alias("roots"), F.sum("c").alias("weight"))
    largest = largest.where("roots > 1").select("band", "value", F.col("m.root").alias("main"), F.col("m.c").alias("c"), "weight")
    split = lookup(placed, materialize(largest, "split-buckets"), bucket, dict.fromkeys(("main", "c")), weight="weight", row_id="key")
    split = split.where("main IS NOT NULL").withColumn("minor", F.col("root") != F.col("main"))
    # A grid: minor members by rows of cells, all members by columns.
    wide = F.ceil(F.col("members") / BLOCK).cast("int")
    high = F.ceil((F.col("members") - F.col("c")) / BLOCK).cast("int")
    mine = lambda n: F.pmod(F.xxhash64("key"), n).cast("int")
    carried = ["band", "value", "key", "root", "minor"]
    whole = split.drop("n", "bn", "b").join(classes.select("key", "n", "bands"), "key").join(sets_, "key")
    whole = whole.select(*carried, "n", "bands", "elements", wide.alias("wide"), high.alias("high"))
    figures = [*carried, "n", "bands", "elements"]
    wide, high = F.col("wide"), F.col("high")
    rows = whole.where("minor").select(*figures, F.lit(True).alias("left"), mine(high).alias("i"), F.explode(F.sequence(F.lit(0), wide - 1)).alias("j"))
    columns = whole.select(*figures, F.lit(False).alias("left"), F.explode(F.sequence(F.lit(0), high - 1)).alias("i"), mine(wide).alias("j"))
    dealt = rows.unionByName(columns)
    more = dealt.groupBy("band", "value", "i", "j").applyInArrow(lambda g: _across(g, percent), f"a {kind}, b {kind}")
    more = materialize(more, "more-links")
    # Stars of the first round carry over; only what they now lack is new.
    stars = roots.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    if not more.isEmpty():
        roots = components(stars.unionAll(more))
    of_class = classes.select("print", F.col("key").alias("class_id")).join(
        roots.select(F.col("node").alias("class_id"), "root"), "class_id", "left"
    )
    of_class = of_class.select(F.col("print").alias("_print"), "class_id", F.coalesce("root", "class_id").alias("root"))
    out = one.join(of_class, F.col("print") == F.col("_print"), "left")
    return out.select(
        "key",
        F.col("n").alias("n_shingles"),
        F.coalesce("class_id", "key").alias("class_id"),
        F.coalesce("root", "key").alias("component_id"),
    )


def keep_one(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The documents with one of each group: the one with the smallest key.  Rows without a key stay."""
    lost = groups(docs, key=key, **options).where("key <> component_id").select(F.col("key").alias("_lost"))
    return docs.join(lost, docs[key] == F.col("_lost"), "left_anti")
