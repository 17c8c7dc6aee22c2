"""URL filter: ratio of two character language models, behind host and path rules.

Two variable-order Markov models of characters are fitted, one on accepted and
one on rejected URLs.  Contexts grow up to ``ORDER`` characters, but only while they were seen
``MIN_CONTEXT`` times; every order is smoothed with the next lower one (Witten-Bell), the lowest with a
uniform one.  A URL's score is the mean over its characters of
log P(accepted) - log P(rejected); the cut is calibrated on other labelled URLs so
that the mean of both error rates is least.

Fitting takes a bounded sample of the labelled rows: the ``SAMPLE`` smallest by
a hash of the URL, per label, as far as they hold ``SAMPLE_CHARS`` characters together; a fifth of
them calibrate.  URLs are read whole, in fitting as in scoring.

Rules (host suffix/path prefix) decide first; the longest that fits wins (block
wins a tie).  Their verdicts are the labels where no others are given.

Defined results: null URLs and those without ``://`` have an empty host and
path, no rule, and a verdict by the model (null like empty, score 0, which is
allowed if the cut lets it); without labels of both kinds everything is allowed; repeated rows give repeated results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.llm.common import lower_ascii, prepare

ORDER, MIN_CONTEXT = 5, 4
# What the models learn from: so many distinct URLs of each label, and so many characters of them in all.
SAMPLE, SAMPLE_CHARS = 4000, 2_000_000

Rule = tuple[str, str]


def parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """The rows with ``_url``, ``host`` and ``path`` (as in the contract: host in lower case, path as it is)."""
    rows = pages.withColumn("_url", F.coalesce(F.col(url), F.lit("")))
    rest = F.when(F.col("_url").contains("://"), F.expr("substring(_url, instr(_url, '://') + 3)")).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return rows.withColumns({"host": lower_ascii(host), "path": path})


def rule_of(rules: list[tuple[str, Rule]]) -> tuple[Column, Column]:
    """(rule, verdict) columns for rules (verdict, (host, path)); null where none fits."""
    ordered = sorted(rules, key=lambda r: (-len(r[1][0] + r[1][1]), r[0] != "block", r[1]))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, (host, path) in reversed(ordered):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule = F.when(fits, host + path).otherwise(rule)
        verdict = F.when(fits, said).otherwise(verdict)
    return rule, verdict


class MarkovModel:
    """Counts of characters after contexts; P by Witten-Bell from order 0 up."""

    def __init__(self, texts: list[str], order: int = ORDER, min_context: int = MIN_CONTEXT):
        self.order = order
        self.counts: dict[str, dict[str, int]] = {}
        frontier = None
        for k in range(order + 1):
            level: dict[str, dict[str, int]] = {}
            for text in texts:
                shown = "\x02" * order + text + "\x03"
                for i in range(order, len(shown)):
                    context = shown[i - k : i]
                    # A context grows only out of one that was seen often enough.
                    if frontier is None or context[1:] in frontier:
                        after = level.setdefault(context, {})
                        after[shown[i]] = after.get(shown[i], 0) + 1
            frontier = {c for c, after in level.items() if sum(after.values()) >= min_context}
            self.counts.update((c, level[c]) for c in frontier)
        self.sums = {c: (sum(a.values()), len(a)) for c, a in self.counts.items()}

    def log_prob(self, context: str, char: str) -> float:
        p = 1 / 65536
        for k in range(len(context) + 1):
            after = self.counts.get(context[len(context) - k :])
            if after is None:
                break
            n, kinds = self.sums[context[len(context) - k :]]
            p = (after.get(char, 0) + kinds * p) / (n + kinds)
        return float(np.log(p))


class Ratio:
    """Difference of two models with a memory of the contexts met."""

    MEMORY = 500_000

    def __init__(self, good: MarkovModel, bad: MarkovModel):
        self.good, self.bad, self.order = good, bad, good.order
        self.met: dict[str, float] = {}

    def score(self, url: str) -> float:
        shown = "\x02" * self.order + url + "\x03"
        total, met = 0.0, self.met
        for i in range(self.order, len(shown)):
            gram = shown[i - self.order : i + 1]
            value = met.get(gram)
            if value is None:
                if len(met) > self.MEMORY:
                    met.clear()
                value = self.good.log_prob(gram[:-1], gram[-1]) - self.bad.log_prob(gram[:-1], gram[-1])
                met[gram] = value
            total += value
        return total / (len(url) + 1)


def calibrated(good: list[float], bad: list[float]) -> float:
    """The cut with the least mean of both error rates; scores from it on are allowed."""
    if not good or not bad:
        return 0.0
    g, b = np.sort(good), np.sort(bad)
    cuts = np.unique(np.concatenate([g, b]))
    cuts = np.concatenate([cuts, (cuts[:-1] + cuts[1:]) / 2])
    wrong = np.searchsorted(g, cuts, side="left") / len(g) + 1 - np.searchsorted(b, cuts, side="left") / len(b)
    return float(cuts[np.lexsort((np.abs(cuts), wrong))[0]])


def sampled(urls: DataFrame, sample: int, chars: int) -> list[str]:
    """Whole distinct URLs in the order of their hashes: at most ``sample``, and ``chars`` characters together.

    A URL that would not fit is passed over, so lengths are looked at before any text comes to the driver.
    """
    drawn = urls.select("url", F.xxhash64("url").alias("h"), F.length("url").alias("size"))
    drawn = drawn.where(F.col("size") <= chars).groupBy("h").agg(F.min("url").alias("url"), F.min("size").alias("size"))
    left, taken = chars, []
    for row in drawn.select("h", "size").orderBy("h").limit(sample).collect():
        if row["size"] <= left:
            left -= row["size"]
            taken.append(row["h"])
    if not taken:
        return []
    return [r["url"] for r in drawn.where(F.col("h").isin(taken)).select("h", "url").orderBy("h").collect()]


def fit(labelled: DataFrame, sample: int = SAMPLE, chars: int = SAMPLE_CHARS) -> tuple[Ratio, float] | None:
    """Models and cut from (url, label) rows, label ``allow`` or ``block``."""
    texts: dict[str, list[str]] = {}
    for label in ("allow", "block"):
        texts[label] = sampled(labelled.where(F.col("label") == label), sample, chars)
    if not texts["allow"] or not texts["block"]:
        return None
    held = {k: v[:: 5] if len(v) >= 10 else v for k, v in texts.items()}
    rest = {k: [u for i, u in enumerate(v) if i % 5] if len(v) >= 10 else v for k, v in texts.items()}
    ratio = Ratio(MarkovModel(rest["allow"]), MarkovModel(rest["block"]))
    cut = calibrated([ratio.score(u) for u in held["allow"]], [ratio.score(u) for u in held["block"]])
    return ratio, cut


def _scores(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    ratio = Ratio(*shared.value)
    for batch in batches:
        scores = [ratio.score(u) if u else 0.0 for u in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["row", "score"])


def judge(
    pages: DataFrame,
    rules: list[tuple[str, Rule]],
    labels: Column | None = None,
    keep: tuple[str, ...] = ("page_id",),
    url: str = "url",
    sample: int = SAMPLE,
) -> DataFrame:
    """``keep``, host, path, rule, verdict and the model's score of every row.

    ``labels`` may give ``allow`` or ``block`` for rows to learn from; else the rules' verdicts do.
    """
    spark = pages.sparkSession
    prepare(spark)
    rule, verdict = rule_of(rules)
    split = parts(pages, url).withColumns({"_rule": rule, "_said": verdict})
    label = F.col("_said") if labels is None else labels
    fitted = fit(split.where(F.col("_url") != "").select(F.col("_url").alias("url"), label.alias("label")), sample)
    row = F.struct(*[F.col(c) for c in keep], *[F.col(c).alias(f"_{c}_") for c in ("host", "path", "_rule", "_said")])
    made = split.select(row.alias("row"), F.col("_url").alias("url"))
    cut = 0.0
    if fitted is None:
        scored = made.select("row", F.lit(0.0).alias("score"))
    else:
        ratio, cut = fitted
        shared = spark.sparkContext.broadcast((ratio.good, ratio.bad))  # bounded by SAMPLE_CHARS * (ORDER + 1)
        schema = T.StructType([made.schema["row"], T.StructField("score", T.DoubleType())])
        scored = made.mapInArrow(lambda b: _scores(b, shared), schema)
    by_model = F.when(F.col("score") >= cut, "allow").otherwise("block") if fitted else F.lit("allow")
    return scored.select(
        *[F.col("row")[c].alias(c) for c in keep],
        F.col("row")["_host_"].alias("host"),
        F.col("row")["_path_"].alias("path"),
        F.col("row")["__rule_"].alias("rule"),
        F.coalesce(F.col("row")["__said_"], by_model).alias("verdict"),
        "score",
    )
