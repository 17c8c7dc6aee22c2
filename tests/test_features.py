import math
import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from logloom.functions.tokens import STOP_WORDS
from logloom.operators import features as ft
from logloom.operators import tfidf
from logloom.operators.assemble import FeatureModel
from logloom.plans import inputs as src
from logloom.session import materialize

TEXTS = ["disk full on node seven", "disk ok", "node seven rebooted and node seven ok", "", "The disk"]


def grams(text):
    words = [w for w in re.findall(r"\w{2,}", text.lower()) if w not in STOP_WORDS]
    return [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def test_tfidf_against_brute_force(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "row_id bigint, message string")
    n, docs = len(TEXTS), [Counter(grams(t)) for t in TEXTS]
    df_count = Counter(t for d in docs for t in d)
    corpus = sum(docs, Counter())
    kept = sorted(t for t in corpus if df_count[t] >= 2)
    vocabulary = tfidf.fit_vocabulary(df)
    got = {r.term: r for r in vocabulary.collect()}
    assert sorted(got) == kept
    assert [t for t, _ in sorted(got.items(), key=lambda kv: kv[1].term_index)] == kept
    idf = {t: math.log((1 + n) / (1 + df_count[t])) + 1 for t in kept}
    for t in kept:
        assert got[t].idf == pytest.approx(idf[t]) and got[t].corpus_count == corpus[t]
    weights = {(r.row_id, r.term): r.weight for r in tfidf.tfidf_weights(df, vocabulary).collect()}
    for i, d in enumerate(docs):
        raw = {t: (1 + math.log(c)) * idf[t] for t, c in d.items() if t in idf}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        for t, w in raw.items():
            assert weights.pop((i, t)) == pytest.approx(w / norm)
    assert not weights


def test_vocabulary_limits(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "row_id bigint, message string")
    top = [r.term for r in tfidf.fit_vocabulary(df, max_features=2).collect()]
    assert top == ["disk", "node"]
    two = df.where("row_id < 2")
    assert tfidf.fit_vocabulary(two, max_df=0.5).count() > 0  # min_df is 1 for two rows


@pytest.mark.parametrize("buckets, candidates", [(1, 1), (16, 1), (1 << 20, 1), (1 << 20, 4)])
def test_vocabulary_from_heavy_buckets(spark, monkeypatch, buckets, candidates):
    """Terms that share buckets, ties at the limit, and too few terms: always the choice of all terms."""
    monkeypatch.setattr(tfidf, "BUCKETS", buckets)
    monkeypatch.setattr(tfidf, "CANDIDATES", candidates)
    rng = random.Random(5)
    texts = [" ".join(f"w{min(int(rng.expovariate(0.2)), 30)}" for _ in range(12)) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "row_id bigint, message string")
    docs = [Counter(grams(t)) for t in texts]
    seen, corpus = Counter(t for d in docs for t in d), sum(docs, Counter())
    order = sorted((t for t in corpus if 2 <= seen[t] <= 0.6 * 60), key=lambda t: (-corpus[t], t))
    for limit in (3, 40, 5000):
        got = tfidf.fit_vocabulary(df, max_features=limit, max_df=0.6).collect()
        assert {r.term: (r.df, r.corpus_count) for r in got} == {t: (seen[t], corpus[t]) for t in order[:limit]}


def test_equal_rows_have_equal_weights(spark):
    """To the last bit, alone or in a table: a cut of a forest between two sums of the same weights would tell them apart."""
    words = " ".join(f"t{i}" for i in range(40))
    df = spark.createDataFrame([(i, f"{words} t{i % 7}") for i in range(140)], "row_id bigint, message string")
    vocabulary = materialize(tfidf.fit_vocabulary(df, max_df=1.0))
    whole = {r.row_id: (r.indices, r.values) for r in tfidf.weight_rows(df.repartition(5), vocabulary).collect()}
    for i in range(7):
        some = {r.row_id: (r.indices, r.values) for r in tfidf.weight_rows(df.where(f"row_id % 7 = {i}"), vocabulary).collect()}
        assert all(v == whole[i] == whole[k] for k, v in some.items()) and len(some) == 20


def test_template_ids(spark):
    msgs = ["a 1", "a 2", "b", "c", "c", "c"]
    df = spark.createDataFrame(list(enumerate(msgs)), "row_id bigint, message string")
    got = {r.row_id: (r.template_id, r.template_rarity) for r in ft.template_features(df, max_templates=2).collect()}
    assert got[0] == (0, pytest.approx(4 / 6)) and got[3] == (1, pytest.approx(0.5))
    assert got[2] == (-1, pytest.approx(5 / 6))


def test_window_counts_of_other_sizes(spark):
    df = spark.createDataFrame([(i, i * 60) for i in range(20)] + [(99, None)], "row_id bigint, s bigint")
    df = df.select("row_id", F.timestamp_seconds("s").alias("timestamp"))
    got = {r.row_id: (r.log_count_4min, r.log_count_6min) for r in ft.time_features(df, [4, 6]).collect()}
    assert got[0] == (4, 6) and got[19] == (4, 2) and got[99] == (0, 0)


def test_unseen_values_in_fitted_mode(spark):
    old = spark.createDataFrame([(1, "a", "INFO"), (2, "a", "ERROR")], "row_id bigint, service string, level string")
    new = spark.createDataFrame([(5, "a", "INFO"), (6, "b", "INFO")], "row_id bigint, service string, level string")
    got = {r.row_id: r[1] for r in ft.level_rarity(new, ft.service_level_counts(old)).collect()}
    assert got == {5: 0.5, 6: 0.5}
    freq = {r.row_id: r[1] for r in ft.service_frequency(new, ft.service_counts(old)).collect()}
    assert freq == {5: 1.0, 6: 0.0}


def test_feature_model(spark, sf, tmp_path):
    rows = src.logs(spark, sf)
    model = FeatureModel.fit(rows, str(tmp_path / "f"), max_features=50)
    assert len(model.names) == model.n_terms + 19 and model.n_terms == 50
    batch = model.transform(rows).orderBy("row_id").collect()
    again = FeatureModel.load(spark, str(tmp_path / "f"))
    fitted = again.transform(rows, stats="fitted").orderBy("row_id").collect()
    assert again.names == model.names and len(batch) == rows.count()
    for a, b in zip(batch, fitted):
        assert a.features.indices == b.features.indices
        assert a.features["values"] == pytest.approx(b.features["values"])
        assert list(a.features.indices) == sorted(set(a.features.indices))


def test_windows_of_rows_later_than_training(spark, sf, tmp_path):
    rows = src.logs(spark, sf)
    halfway = F.lit("2024-01-16").cast("timestamp")
    model = FeatureModel.fit(rows.where(F.col("timestamp") < halfway), str(tmp_path / "f"), max_features=20)
    later = rows.where(F.col("timestamp") >= halfway)
    want = {r.row_id: r for r in ft.time_features(later, model.sizes).collect()}
    names = [n for n in model.dense_names if n.startswith("log_count_")]
    got = model.dense(later, stats="fitted").collect()
    assert len(got) == len(want) > 0
    for r in got:
        assert [r[n] for n in names] == [want[r.row_id][n] for n in names] and r[names[0]] >= 1


def test_weights_of_more_rows_take_more_tasks(spark, monkeypatch):
    rows = spark.range(200).select(
        F.col("id").alias("row_id"), F.concat(F.lit("disk failure on node"), (F.col("id") % 9).cast("string")).alias("message")
    )
    vocabulary = tfidf.fit_vocabulary(rows)
    plain = sorted(tuple(r) for r in tfidf.weight_rows(rows, vocabulary).collect())
    monkeypatch.setattr(tfidf, "ROWS_PER_TASK", 10, raising=False)
    spread = tfidf.weight_rows(rows, vocabulary)
    assert spread.rdd.getNumPartitions() == 20
    assert sorted(tuple(r) for r in spread.collect()) == plain


def test_weights_are_found_without_a_row_per_term(spark):
    rows = spark.createDataFrame([(1, "disk disk failure"), (2, "disk failure"), (3, "other words"), (4, None)], "row_id bigint, message string")
    vocabulary = spark.createDataFrame([("disk", 0, 1.5), ("disk failure", 1, 2.0), ("failure", 2, 1.25)], "term string, term_index int, idf double")
    weights = tfidf.weight_rows(rows, vocabulary)
    plan = weights._jdf.queryExecution().toString()
    assert "Generate" not in plan and "Aggregate" not in plan
    got = {r.row_id: (r.indices, r.values) for r in weights.collect()}
    assert sorted(got) == [1, 2] and got[1][0] == got[2][0] == [0, 1, 2]
    for row, raw in ((1, [1.5 * (1 + math.log(2)), 2.0, 1.25]), (2, [1.5, 2.0, 1.25])):
        norm = math.sqrt(sum(w * w for w in raw))
        assert got[row][1] == pytest.approx([w / norm for w in raw], abs=1e-15)


@pytest.mark.parametrize("piece", [1, 30, 1 << 20])
def test_terms_are_counted_in_pieces(monkeypatch, piece):
    """Each term once a piece, whatever is cut; a bucket is the same in any piece."""
    monkeypatch.setattr(tfidf, "PIECE_BYTES", piece)
    texts = ["disk full disk full disk", "", None, "full disk", "node disk full disk", "node"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    want = [Counter(" ".join(w[i : i + n]) for n in (2, 3) for i in range(len(w) - n + 1)) for w in ((t or "").split() for t in texts)]
    seen, corpus = Counter(), Counter()
    for part in tfidf._count_terms(2, 3, 16, None)([batch]):
        for r in part.to_pylist():
            seen[r["term"]] += r["df"]
            corpus[r["term"]] += r["corpus_count"]
    assert corpus == sum(want, Counter()) and seen == Counter(t for c in want for t in c)
    buckets = [r for part in tfidf._count_buckets(2, 3, 16)([batch]) for r in part.to_pylist()]
    monkeypatch.setattr(tfidf, "PIECE_BYTES", 1 << 30)
    assert buckets == [r for part in tfidf._count_buckets(2, 3, 16)([batch]) for r in part.to_pylist()]
    assert sum(r["n"] for r in buckets) == sum(corpus.values())


def test_kept_words_are_not_found_again(spark):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "row_id bigint, message string")
    kept = materialize(tfidf.with_words(rows))
    vocabulary = materialize(tfidf.fit_vocabulary(kept))
    assert sorted(vocabulary.collect()) == sorted(tfidf.fit_vocabulary(rows).collect())
    weights = tfidf.weight_rows(kept, vocabulary)
    assert "regexp" not in weights._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(tuple(r) for r in weights.collect()) == sorted(tuple(r) for r in tfidf.weight_rows(rows, vocabulary).collect())
