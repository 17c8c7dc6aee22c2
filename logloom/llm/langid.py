"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the bytes of a word between two boundary bytes, forwards and
backwards, and labels every position with a distribution over languages; it starts afresh
at every word.  So a distinct word is read once per task and remembered.  A document's
probabilities pool those of all its positions: the mean of their logarithms decides, and the mean
probability of the winner is the score.

Words are runs between ASCII white space; runs of more than ``MOST`` bytes are read in pieces
of at most that length, cut between characters; each piece is read afresh.  Training is plain numpy: backpropagation through time with Adam on batches of
words of equal length.

Fitting takes a bounded sample of the distinct labelled texts of every language, however rare:
the ``PER_LANGUAGE`` of the smallest hashes, and ``WORDS`` words of each language,
drawn from the whole texts of those.  Prediction reads every whole text.

Defined results: null texts and texts without a letter are ``und`` with score 0;
without labelled rows every text is ``und``; ties fall to the first language by name; a row
per input row; language, source and id are never inputs of a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.llm.common import prepare

HIDDEN, MOST = 24, 32
PER_LANGUAGE, WORDS = 300, 20_000
EPOCHS, BATCH, RATE = 4, 128, 0.01
BOUNDARY = 0
REMEMBERED = 400_000

_LETTER = regex.compile(r"\p{L}")


def _pieces(word: bytes) -> list[bytes]:
    out, start = [], 0
    while len(word) - start > MOST:
        end = start + MOST
        # Back to the first byte of a character, which has four bytes at most.
        while end > start + MOST - 4 and word[end] & 0xC0 == 0x80:
            end -= 1
        out.append(word[start:end])
        start = end
    return out + [word[start:]]


def words_of(text: bytes) -> list[bytes]:
    out = []
    for word in text.split():
        out += [word] if len(word) <= MOST else _pieces(word)
    return out


def as_bytes(words: list[bytes]) -> np.ndarray:
    """Words of equal length as rows of bytes between boundaries."""
    rows = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)
    edge = np.full((len(words), 1), BOUNDARY, np.uint8)
    return np.concatenate([edge, rows, edge], axis=1)


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


class BiGru:
    """Two gated recurrent layers over bytes and a softmax at every position."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages, self.hidden = languages, hidden
        n, k = hidden, len(languages)
        self.p = {"out": rng.normal(0, 0.1, (2 * n, k)), "bias": np.zeros(k)}
        for d in "fb":
            # Inputs are single bytes, so the input weights are a row for each byte: update, reset, candidate.
            self.p[f"w{d}"] = rng.normal(0, 0.3, (256, 3 * n))
            self.p[f"u{d}"] = rng.normal(0, 1 / np.sqrt(n), (n, 2 * n))
            self.p[f"c{d}"] = rng.normal(0, 1 / np.sqrt(n), (n, n))
        self.p = {name: v.astype(np.float32) for name, v in self.p.items()}

    def _run(self, x: np.ndarray, d: str):
        """Hidden states in the order read, and what backpropagation needs."""
        n, h, steps = self.hidden, np.zeros((len(x), self.hidden), np.float32), []
        for t in range(x.shape[1]):
            given = self.p[f"w{d}"][x[:, t]]
            gates = _sigmoid(given[:, : 2 * n] + h @ self.p[f"u{d}"])
            z, r = gates[:, :n], gates[:, n:]
            c = np.tanh(given[:, 2 * n :] + (r * h) @ self.p[f"c{d}"])
            steps.append((h, z, r, c))
            h = (1 - z) * h + z * c
        return steps, h

    def _states(self, steps, last):
        return np.stack([s[0] for s in steps[1:]] + [last], axis=1)

    def forward(self, x: np.ndarray):
        f, fl = self._run(x, "f")
        b, bl = self._run(x[:, ::-1], "b")
        states = np.concatenate([self._states(f, fl), self._states(b, bl)[:, ::-1]], axis=2)
        scores = states @ self.p["out"] + self.p["bias"]
        scores -= scores.max(axis=2, keepdims=True)
        e = np.exp(scores)
        return e / e.sum(axis=2, keepdims=True), states, f, b

    def positions(self, x: np.ndarray) -> np.ndarray:
        """Language probabilities of every position."""
        return self.forward(x)[0]

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over all positions, and its gradient by backpropagation through time."""
        probs, states, f, b = self.forward(x)
        n, count = self.hidden, x.shape[0] * x.shape[1]
        rows = np.arange(len(x))
        loss = -np.log(probs[rows, :, y] + 1e-9).sum() / count
        wrong = probs.copy()
        wrong[rows, :, y] -= 1
        wrong /= count
        g = {"out": np.einsum("bth,btk->hk", states, wrong), "bias": wrong.sum((0, 1))}
        to_states = wrong @ self.p["out"].T
        for d, steps, seen, back in (("f", f, x, to_states[:, :, :n]), ("b", b, x[:, ::-1], to_states[:, ::-1, n:])):
            w, u, c_ = np.zeros_like(self.p[f"w{d}"]), np.zeros_like(self.p[f"u{d}"]), np.zeros_like(self.p[f"c{d}"])
            dh = np.zeros((len(x), n), np.float32)
            for t in range(x.shape[1] - 1, -1, -1):
                h, z, r, c = steps[t]
                dh = dh + back[:, t]
                dc = dh * z * (1 - c * c)
                dz = dh * (c - h) * z * (1 - z)
                drh = dc @ self.p[f"c{d}"].T
                dr = drh * h * r * (1 - r)
                gates = np.concatenate([dz, dr], axis=1)
                u += h.T @ gates
                c_ += (r * h).T @ dc
                np.add.at(w, seen[:, t], np.concatenate([gates, dc], axis=1))
                dh = dh * (1 - z) + drh * r + gates @ self.p[f"u{d}"].T
            g |= {f"w{d}": w, f"u{d}": u, f"c{d}": c_}
        return float(loss), g


def train(samples: dict[str, list[bytes]], epochs: int = EPOCHS, seed: int = 7) -> BiGru | None:
    """A network from the words of each language."""
    languages = sorted(samples)
    if not languages:
        return None
    net, rng = BiGru(languages, seed=seed), np.random.default_rng(seed)
    words = [(w, k) for k, name in enumerate(languages) for w in samples[name]]
    by_length: dict[int, list] = {}
    for w, k in words:
        by_length.setdefault(len(w), []).append((w, k))
    m = {name: np.zeros_like(v) for name, v in net.p.items()}
    v2 = {name: np.zeros_like(v) for name, v in net.p.items()}
    step = 0
    for epoch in range(epochs):
        batches = []
        for same in by_length.values():
            order = rng.permutation(len(same))
            batches += [[same[i] for i in order[a : a + BATCH]] for a in range(0, len(same), BATCH)]
        for at in rng.permutation(len(batches)):
            x, y = as_bytes([w for w, _ in batches[at]]), np.array([k for _, k in batches[at]])
            _, g = net.gradients(x, y)
            norm = np.sqrt(sum(float((a * a).sum()) for a in g.values()))
            step += 1
            rate = RATE * (1 - 0.8 * epoch / max(epochs - 1, 1)) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for name, a in g.items():
                a = a / max(1.0, norm)
                m[name] = 0.9 * m[name] + 0.1 * a
                v2[name] = 0.999 * v2[name] + 0.001 * a * a
                net.p[name] = (net.p[name] - rate * m[name] / (np.sqrt(v2[name]) + 1e-8)).astype(np.float32)
    return net


def sample(docs: DataFrame, text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> DataFrame:
    """(lang, text): the distinct texts of the smallest hashes, ``per_language`` at most, of every language."""
    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    # Twice the share that is needed, so that an estimate of the distinct texts will do and few are ranked.
    kinds = rows.groupBy("lang").agg(F.approx_count_distinct("text").alias("kinds"))
    shares = kinds.select("lang", (F.lit(2.0 * per_language + 100) / F.col("kinds")).alias("share"))
    hashed = rows.withColumn("h", F.xxhash64("text"))
    unit = F.shiftrightunsigned("h", 11) / F.lit(float(1 << 53))
    some = hashed.join(F.broadcast(shares), "lang").where(unit < F.col("share")).select("lang", "h", "text").distinct()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.shiftrightunsigned("h", 11), "h", "text"))
    return some.withColumn("rank", rank).where(F.col("rank") <= per_language).select("lang", "rank", "text")


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> BiGru | None:
    """Train on a bounded sample of the labelled rows of every language."""
    rng, samples = np.random.default_rng(11), {}
    # At most per_language texts of each language.
    for r in sample(docs, text, lang, per_language).orderBy("lang", "rank").toLocalIterator():
        samples.setdefault(r["lang"], []).extend(words_of(r["text"].encode()))
    for name, words in samples.items():
        if len(words) > WORDS:
            samples[name] = [words[i] for i in np.sort(rng.choice(len(words), WORDS, replace=False))]
    return train({name: words for name, words in samples.items() if words})


class Reader:
    """Sums over the positions of words, remembered by word."""

    def __init__(self, net: BiGru):
        self.net, self.numbers = net, {}
        self.sums = np.zeros((1024, 2 * len(net.languages) + 1), np.float64)

    def learn(self, words: set[bytes]) -> None:
        fresh: dict[int, list[bytes]] = {}
        for w in words:
            if w not in self.numbers:
                fresh.setdefault(len(w), []).append(w)
        for same in fresh.values():
            for a in range(0, len(same), 4096):
                some = same[a : a + 4096]
                probs = self.net.positions(as_bytes(some)).astype(np.float64)
                first = len(self.numbers)
                while first + len(some) > len(self.sums):
                    self.sums = np.concatenate([self.sums, np.zeros_like(self.sums)])
                self.numbers.update(zip(some, range(first, first + len(some))))
                held = self.sums[first : first + len(some)]
                k = probs.shape[2]
                held[:, :k], held[:, k : 2 * k], held[:, 2 * k] = np.log(probs + 1e-9).sum(1), probs.sum(1), probs.shape[1]

    def read(self, words: list[bytes]) -> tuple[str, float]:
        k = len(self.net.languages)
        total = self.sums[np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))].sum(0)
        best = int(total[:k].argmax())
        return self.net.languages[best], float(min(1.0, max(0.0, total[k + best] / total[2 * k])))


def _predicted(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    reader = Reader(shared.value)
    for batch in batches:
        out = []
        texts = batch.column(1).to_pylist()
        for a in range(0, len(texts), 64):
            lists = [words_of(t.encode()) if t and _LETTER.search(t) else None for t in texts[a : a + 64]]
            if len(reader.numbers) > REMEMBERED:
                reader = Reader(shared.value)
            reader.learn({w for words in lists if words for w in words})
            out += [reader.read(words) if words else ("und", 0.0) for words in lists]
        columns = [batch.column(0), pa.array([x for x, _ in out], pa.string()), pa.array([s for _, s in out], pa.float64())]
        yield pa.RecordBatch.from_arrays(columns, names=["row", "lang_pred", "score"])


def predict(docs: DataFrame, net: BiGru | None, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep``, the language and its pooled probability, for every row."""
    spark = docs.sparkSession
    prepare(spark)
    made = docs.select(F.struct(*keep).alias("row"), F.col(text).alias("text"))
    kept = [F.col("row")[c].alias(c) for c in keep]
    if net is None:
        return made.select(*kept, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = spark.sparkContext.broadcast(net)  # a few hundred kB: by HIDDEN and the number of languages
    schema = T.StructType([made.schema["row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return made.mapInArrow(lambda b: _predicted(b, shared), schema).select(*kept, "lang_pred", "score")
