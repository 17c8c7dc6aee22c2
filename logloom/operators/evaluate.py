"""Evaluation with and without labels, drift, comparison of models."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.functions.kolmogorov import ks_p_value
from logloom.functions.text import safe_divide
from logloom.operators.ordered import cut_points, exact_percentiles, prefix_sums
from logloom.session import materialize, ship_package

# Fixed values.
THRESHOLD_PERCENTILES = [90.0, 95.0, 97.0, 99.0, 99.5]
HISTOGRAM_BINS = 50
DRIFT_P_VALUE = 0.05


def binary_label(c: Column | str, convention: str = "01") -> Column:
    """1 = anomaly.  ``"01"``: 0 normal, 1 anomaly; ``"pm1"``: 1 normal, -1 anomaly."""
    c = F.col(c) if isinstance(c, str) else c
    if convention == "01":
        return c.cast("int")
    if convention == "pm1":
        return F.when(c == -1, 1).when(c.isNotNull(), 0)
    raise ValueError(f"unknown label convention {convention!r}")


def align(labels: DataFrame, predictions: DataFrame, key: str = "row_id") -> DataFrame:
    """Join labels with predictions by row key."""
    return labels.join(predictions, key)


def confusion(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """One row of counts and rates; rows without a label are skipped."""
    t, p = F.col(y_true) == 1, F.col(y_pred) == 1
    n = (
        df.where(F.col(y_true).isNotNull() & F.col(y_pred).isNotNull())
        .agg(
            F.count("*").alias("total_samples"),
            F.count_if(t).alias("true_anomalies"),
            F.count_if(p).alias("predicted_anomalies"),
            F.count_if(~t & ~p).alias("true_negatives"),
            F.count_if(~t & p).alias("false_positives"),
            F.count_if(t & ~p).alias("false_negatives"),
            F.count_if(t & p).alias("true_positives"),
        )
        .withColumn("precision", safe_divide("true_positives", "predicted_anomalies"))
        .withColumn("recall", safe_divide("true_positives", "true_anomalies"))
    )
    return n.withColumn(
        "f1_score",
        safe_divide(
            2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")
        ),
    )


def class_report(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """Rows Normal, Anomaly, accuracy, macro avg, weighted avg."""
    c = confusion(df, y_true, y_pred)
    tn, fp, fn, tp, n = (
        F.col(x)
        for x in (
            "true_negatives",
            "false_positives",
            "false_negatives",
            "true_positives",
            "total_samples",
        )
    )

    def f1(p, r):
        return safe_divide(2 * p * r, p + r)

    p0, r0 = safe_divide(tn, tn + fn), safe_divide(tn, tn + fp)
    p1, r1 = safe_divide(tp, tp + fp), safe_divide(tp, tp + fn)
    figures = c.select(
        p0.alias("p0"), r0.alias("r0"), f1(p0, r0).alias("f0"), (tn + fp).alias("s0"),
        p1.alias("p1"), r1.alias("r1"), f1(p1, r1).alias("f1"), (tp + fn).alias("s1"),
        safe_divide(tp + tn, n).alias("acc"), n.alias("n"),
    )

    def row(name, p, r, f, s):
        return F.struct(
            F.lit(name).alias("class"),
            p.alias("precision"),
            r.alias("recall"),
            f.alias("f1_score"),
            s.alias("support"),
        )

    g = F.col

    def weighted(a, b):
        return safe_divide(g(a) * g("s0") + g(b) * g("s1"), g("n"))

    rows = F.array(
        row("Normal", g("p0"), g("r0"), g("f0"), g("s0")),
        row("Anomaly", g("p1"), g("r1"), g("f1"), g("s1")),
        row("accuracy", g("acc"), g("acc"), g("acc"), g("n")),
        row(
            "macro avg",
            (g("p0") + g("p1")) / 2,
            (g("r0") + g("r1")) / 2,
            (g("f0") + g("f1")) / 2,
            g("n"),
        ),
        row("weighted avg", weighted("p0", "p1"), weighted("r0", "r1"), weighted("f0", "f1"), g("n")),
    )
    return figures.select(F.inline(rows))


def roc_auc(
    df: DataFrame,
    y_true: str = "y_true",
    score: str = "score",
    cuts: Sequence[float] | None = None,
) -> DataFrame:
    """Area under the ROC curve (ties count half); NULL when one class is missing.

    Rows are counted per distinct score first, so the ordered part sees each
    score once.
    """
    rows = df.where(F.col(y_true).isNotNull() & F.col(score).isNotNull()).select(
        F.col(score).cast("double").alias("v"), (F.col(y_true) == 1).alias("t")
    )
    if cuts is None:
        cuts = cut_points(rows, "v")
    counts = rows.groupBy("v").agg(
        F.count_if("t").alias("pos"), F.count_if(~F.col("t")).alias("neg")
    )
    ranked = prefix_sums(counts, "v", ["neg"], cuts)
    below = F.col("cum_neg") - F.col("neg") / 2.0
    sums = ranked.agg(
        F.sum(F.col("pos") * below).alias("wins"),
        F.sum("pos").alias("positives"),
        F.sum("neg").alias("negatives"),
    )
    pairs = F.col("positives").cast("double") * F.col("negatives")
    return sums.select(
        F.coalesce("positives", F.lit(0)).alias("positives"),
        F.coalesce("negatives", F.lit(0)).alias("negatives"),
        F.try_divide("wins", pairs).alias("roc_auc"),
    )


def score_statistics(df: DataFrame, score: str = "score") -> DataFrame:
    """One row: moments in one pass, quartiles by exact distributed selection."""
    moments = df.agg(
        F.count(score).alias("total_samples"),
        F.avg(score).alias("mean"),
        F.stddev_pop(score).alias("std"),
        F.min(score).alias("min"),
        F.max(score).alias("max"),
        F.skewness(score).alias("skewness"),
        F.kurtosis(score).alias("kurtosis"),
    )
    q = exact_percentiles(df, score, [0.25, 0.5, 0.75]).agg(
        F.max(F.when(F.col("p") == 0.5, F.col("percentile"))).alias("median"),
        F.max(F.when(F.col("p") == 0.25, F.col("percentile"))).alias("q25"),
        F.max(F.when(F.col("p") == 0.75, F.col("percentile"))).alias("q75"),
    )
    both = moments.withColumn("_q", q.select(F.struct("median", "q25", "q75").alias("q")).scalar())
    return both.select(
        *moments.columns, "_q.*", (F.col("_q.q75") - F.col("_q.q25")).alias("iqr")
    )


def threshold_table(
    df: DataFrame, score: str = "score", percentiles: Sequence[float] | None = None
) -> DataFrame:
    """Per percentile: threshold, rows at or above it, their share."""
    percentiles = THRESHOLD_PERCENTILES if percentiles is None else list(percentiles)
    fractions = [p / 100.0 for p in percentiles]
    marks = exact_percentiles(df, score, fractions).agg(
        F.map_from_entries(F.collect_list(F.struct("p", "percentile"))).alias("marks")
    )  # one entry per percentile asked for
    rows = df.where(F.col(score).isNotNull()).select(
        F.col(score).alias("v"), marks.scalar().alias("marks")
    )
    limits = [F.col("marks")[F.lit(float(p))] for p in fractions]
    counts = rows.agg(
        F.count("*").alias("n"),
        *[F.max(limit).alias(f"t{i}") for i, limit in enumerate(limits)],
        *[F.count_if(F.col("v") >= limit).alias(f"c{i}") for i, limit in enumerate(limits)],
    )
    cells = [
        F.struct(
            F.lit(float(p)).alias("percentile"),
            F.col(f"t{i}").alias("threshold"),
            F.col(f"c{i}").alias("anomalies_detected"),
            (F.col(f"c{i}") / F.col("n")).alias("anomaly_rate"),
        )
        for i, p in enumerate(percentiles)
    ]
    return counts.where("n > 0").select(F.inline(F.array(*cells)))


def histogram(df: DataFrame, score: str = "score", bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins, the last one closed; a constant input gets a range of 1.

    Rows ``(bin, low, high, n)``, empty bins included.
    """
    rows = df.select(F.col(score).cast("double").alias("v")).where("v IS NOT NULL")
    ends = rows.agg(F.min("v").alias("a"), F.max("v").alias("b")).select(
        F.when(F.col("a") == F.col("b"), F.col("a") - 0.5).otherwise(F.col("a")).alias("lo"),
        F.when(F.col("a") == F.col("b"), F.col("b") + 0.5).otherwise(F.col("b")).alias("hi"),
    )
    placed = rows.withColumn("e", ends.select(F.struct("lo", "hi").alias("e")).scalar())
    width = (F.col("e.hi") - F.col("e.lo")) / bins
    bin_ = F.least(F.floor((F.col("v") - F.col("e.lo")) / width), F.lit(bins - 1)).cast("int")
    counts = placed.groupBy(bin_.alias("bin")).agg(F.count("*").alias("n"))
    step = (F.col("hi") - F.col("lo")) / bins
    spine = ends.where("lo IS NOT NULL").select(
        "lo", step.alias("step"), F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    )
    return spine.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (F.col("lo") + F.col("bin") * F.col("step")).alias("low"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("step")).alias("high"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
    )


def ks_drift(
    reference: DataFrame,
    current: DataFrame,
    score: str = "score",
    threshold: float = DRIFT_P_VALUE,
    cuts: Sequence[float] | None = None,
) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov test of two score columns, one row.

    Both sides are counted per distinct score in one aggregate, which is written once: cuts,
    totals and running counts are taken from that table.  The largest
    gap of the two distribution functions comes from bucketed running counts.
    """
    return ks_of_counts(materialize(score_counts(reference, current, score), "score-counts"), threshold, cuts)


def score_counts(reference: DataFrame, current: DataFrame, score: str = "score") -> DataFrame:
    """``(v, n, m)``: rows of either side per distinct score."""

    def side(df, flag):
        return df.select(F.col(score).cast("double").alias("v"), F.lit(flag).alias("cur"))

    rows = side(reference, 0).unionByName(side(current, 1)).where("v IS NOT NULL")
    return rows.groupBy("v").agg(
        F.count_if(F.col("cur") == 0).alias("n"), F.count_if(F.col("cur") == 1).alias("m")
    )


def ks_of_counts(counts: DataFrame, threshold: float = DRIFT_P_VALUE, cuts: Sequence[float] | None = None) -> DataFrame:
    """The test from a table of ``(v, n, m)``, read several times."""
    ship_package(counts.sparkSession)
    if cuts is None:
        cuts = cut_points(counts, "v")
    totals = counts.agg(
        F.struct(
            F.sum("n").alias("n"),
            F.sum("m").alias("m"),
            F.sum(F.col("v") * F.col("n")).alias("sn"),
            F.sum(F.col("v") * F.col("m")).alias("sm"),
        ).alias("t")
    )
    cum = prefix_sums(counts, "v", ["n", "m"], cuts).withColumn("t", totals.scalar())
    gap = F.abs(
        F.try_divide("cum_n", F.col("t.n")) - F.try_divide("cum_m", F.col("t.m"))
    )
    worst = cum.agg(F.max(gap).alias("statistic"), F.first("t").alias("t")).withColumn(
        "p", ks_p_value(F.col("statistic"), F.col("t.n"), F.col("t.m"))
    )
    p = F.col("p")
    ref_mean = F.try_divide("t.sn", F.col("t.n"))
    cur_mean = F.try_divide("t.sm", F.col("t.m"))
    return worst.select(
        F.col("t.n").alias("reference_n"),
        F.col("t.m").alias("current_n"),
        "statistic",
        p.alias("p_value"),
        (p < threshold).alias("drift_detected"),
        ref_mean.alias("reference_mean"),
        cur_mean.alias("current_mean"),
        (cur_mean - ref_mean).alias("mean_shift"),
    )


@dataclass
class ScoreReference:
    """Reference scores as a written table of ``(v, n)`` with cut points taken once.

    A test against it reads distinct scores, never the raw reference rows.
    """

    counts: DataFrame
    cuts: list[float]

    @classmethod
    def build(cls, scores: DataFrame, path: str, score: str = "score") -> "ScoreReference":
        spark = scores.sparkSession
        rows = scores.select(F.col(score).cast("double").alias("v")).where("v IS NOT NULL")
        rows.groupBy("v").agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{path}/counts")
        saved = spark.read.parquet(f"{path}/counts")
        cuts = cut_points(saved, "v")
        spark.createDataFrame([(cuts,)], "cuts array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/cuts")
        return cls(saved, cuts)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "ScoreReference":
        return cls(spark.read.parquet(f"{path}/counts"), list(spark.read.parquet(f"{path}/cuts").first()["cuts"]))

    def drift(self, current: DataFrame, score: str = "score", threshold: float = DRIFT_P_VALUE) -> DataFrame:
        """The two-sample test of ``current`` against this reference, one row."""
        rows = current.select(F.col(score).cast("double").alias("v")).where("v IS NOT NULL")
        new = rows.groupBy("v").agg(F.lit(0).cast("bigint").alias("n"), F.count("*").alias("m"))
        both = self.counts.select("v", "n", F.lit(0).cast("bigint").alias("m")).unionByName(new)
        counts = both.groupBy("v").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
        return ks_of_counts(materialize(counts, "score-counts"), threshold, self.cuts)


def evaluate_labeled(
    df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred", score: str | None = "score"
) -> dict[str, DataFrame]:
    """Confusion row, per-class rows and, with a score, the area under the curve."""
    out = {
        "confusion": confusion(df, y_true, y_pred),
        "class_report": class_report(df, y_true, y_pred),
    }
    if score is not None:
        out["roc_auc"] = roc_auc(df, y_true, score)
    return out


def evaluate_unlabeled(
    df: DataFrame, score: str = "score", percentiles: Sequence[float] | None = None
) -> dict[str, DataFrame]:
    """Score statistics, threshold table and histogram."""
    return {
        "score_statistics": score_statistics(df, score),
        "threshold_table": threshold_table(df, score, percentiles),
        "histogram": histogram(df, score),
    }


def compare_models(
    evaluations: DataFrame, name: str = "model_name", f1: str = "f1_score", order: str = "position"
) -> DataFrame:
    """Best model by F1; the earliest wins a tie; none when no F1 is above 0."""
    best = F.max_by(name, F.struct(F.col(f1), -F.col(order)))
    return evaluations.where(F.col(f1) > 0).agg(
        best.alias("best_model"), F.coalesce(F.max(f1), F.lit(0.0)).alias("best_f1")
    )
