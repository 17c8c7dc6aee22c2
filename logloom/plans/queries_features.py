"""Feature queries: TF-IDF, templates, time windows, frequencies."""

from __future__ import annotations

from pyspark.sql import functions as F

from logloom.functions.templates import SUBSTITUTIONS
from logloom.functions.tokens import STOP_WORDS, TOKEN, ngrams, tokens
from logloom.operators import features as ft
from logloom.operators import ordered, tfidf
from logloom.operators.assemble import FeatureModel
from logloom.plans import inputs as src
from logloom.plans.catalog import query
from logloom.plans.queries_ingest import (
    CALENDAR,
    HAS_IP,
    LEVEL_CODE,
    nested_sql,
    sql_text,
    text_stats_sql,
)

STOP = ", ".join(sql_text(w) for w in STOP_WORDS)


def terms_sql(source: str, row_id: str, text: str) -> str:
    """CTE ``terms(row_id, term)``: one row per occurrence of a 1- to 3-gram."""
    return f"""
words AS (SELECT {row_id} AS row_id, list_filter(regexp_extract_all(lower(coalesce({text}, '')),
    {sql_text(TOKEN)}), lambda w: w NOT IN ({STOP})) AS w FROM {source}),
terms AS (SELECT row_id, array_to_string(w[i:i + n - 1], ' ') AS term FROM (
    SELECT row_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, range(1, 4) AS g(n)))
"""


DOC_TERMS = terms_sql("documents", "doc_id", "text")
LOG_TERMS = terms_sql("logs", "row_id", "message")


def vocabulary_sql(max_features: int) -> str:
    return f"""
per_term AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS corpus_count FROM (
    SELECT row_id, term, count(*) AS tf FROM terms GROUP BY 1, 2) GROUP BY 1),
size AS (SELECT count(*) AS n FROM words),
top AS (SELECT p.*, n FROM per_term p, size
    WHERE df >= CASE WHEN n > 2 THEN 2 ELSE 1 END AND df <= 0.95 * n
    ORDER BY corpus_count DESC, term LIMIT {max_features}),
vocabulary AS (SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS term_index,
    df, corpus_count, ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf FROM top)
"""


def documents(spark, sf):
    return src.table(spark, sf, "documents").select(
        F.col("doc_id").alias("row_id"), F.col("text").alias("message")
    )


@query(
    f"""WITH {src.LOGS}, {LOG_TERMS} SELECT w.row_id, array_to_string(w.w, ' ') AS tokens,
    CAST((SELECT count(*) FROM terms t WHERE t.row_id = w.row_id) AS INTEGER) AS n_terms FROM words w"""
)
def ngram_terms(spark, sf):
    words = src.logs(spark, sf, heavy=True).select("row_id", tokens("message").alias("w"))
    return words.select(
        "row_id", F.array_join("w", " ").alias("tokens"), F.size(ngrams(F.col("w"))).alias("n_terms")
    )


@query(
    f"""WITH {DOC_TERMS}, {vocabulary_sql(5000)} SELECT term, term_index, df, corpus_count,
    round(idf, 6) AS idf FROM vocabulary"""
)
def tfidf_vocabulary(spark, sf):
    vocabulary = tfidf.fit_vocabulary(documents(spark, sf))
    return vocabulary.withColumn("idf", F.round("idf", 6))


@query(
    f"""WITH {DOC_TERMS}, {vocabulary_sql(5000)},
    raw AS (SELECT t.row_id, t.term, (1 + ln(count(*))) * v.idf AS w FROM terms t
      JOIN vocabulary v ON t.term = v.term GROUP BY t.row_id, t.term, v.idf)
    SELECT row_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY row_id)), 6) AS weight FROM raw"""
)
def tfidf_weights(spark, sf):
    rows = documents(spark, sf)
    weights = tfidf.tfidf_weights(rows, tfidf.fit_vocabulary(rows))
    return weights.select("row_id", "term", F.round("weight", 6).alias("weight"))


TEMPLATES = f"""
t AS (SELECT row_id, {nested_sql('message', SUBSTITUTIONS)} AS template FROM logs),
counts AS (SELECT template, count(*) AS n FROM t GROUP BY 1)
"""


@query(
    f"""WITH d AS (SELECT {nested_sql('text', SUBSTITUTIONS)} AS template FROM documents),
    top AS (SELECT template, count(*) AS n FROM d GROUP BY 1 ORDER BY n DESC, template LIMIT 500)
    SELECT template, CAST(row_number() OVER (ORDER BY template) - 1 AS INTEGER) AS template_id, n FROM top"""
)
def template_vocabulary(spark, sf):
    return ft.template_vocabulary(ft.template_counts(documents(spark, sf)))


@query(
    f"""WITH {src.LOGS}, {TEMPLATES},
    vocabulary AS (SELECT template, CAST(row_number() OVER (ORDER BY template) - 1 AS INTEGER) AS template_id
      FROM (SELECT * FROM counts ORDER BY n DESC, template LIMIT 500))
    SELECT t.row_id, coalesce(v.template_id, -1) AS template_id,
      round(1 - c.n / (SELECT count(*) FROM t), 6) AS template_rarity
    FROM t JOIN counts c USING (template) LEFT JOIN vocabulary v USING (template)"""
)
def template_features(spark, sf):
    rows = ft.template_features(src.logs(spark, sf, heavy=True))
    return rows.withColumn("template_rarity", F.round("template_rarity", 6))


@query(
    f"""WITH {src.LOGS} SELECT row_id, CAST(length(message) AS INTEGER) AS message_length,
    {LEVEL_CODE} AS level_numeric, {CALENDAR}, {HAS_IP}, {text_stats_sql('message')} FROM logs"""
)
def statistical_block(spark, sf):
    from logloom.operators.clean import derive

    rows = ft.statistical_features(derive(src.logs(spark, sf, heavy=True)))
    return rows.withColumns(
        {c: F.round(c, 6) for c in ("special_char_ratio", "uppercase_ratio")}
    )


WINDOWS = ", ".join(
    f"""count(*) OVER (PARTITION BY time_bucket(INTERVAL {m} MINUTE, "timestamp")) AS log_count_{m}min"""
    for m in ft.WINDOW_MINUTES
)


@query(f"WITH {src.LOGS} SELECT row_id, {WINDOWS} FROM logs")
def window_counts(spark, sf):
    rows = ft.time_features(src.logs(spark, sf, heavy=True))
    return rows.drop("inter_arrival_seconds")


@query(
    f"""WITH {src.LOGS} SELECT row_id, round(coalesce(epoch_us("timestamp") - epoch_us(
    lag("timestamp") OVER (ORDER BY "timestamp", row_id)), 0) / 1000000.0, 6) AS inter_arrival_seconds
    FROM logs"""
)
def inter_arrival(spark, sf):
    rows = ordered.time_gaps(src.logs(spark, sf))
    return rows.withColumn("inter_arrival_seconds", F.round("inter_arrival_seconds", 6))


@query(
    f"""WITH {src.LOGS} SELECT strftime(time_bucket(INTERVAL 60 MINUTE, "timestamp"),
      '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n,
      round(avg(length(message)), 6) AS message_length_mean,
      round(stddev_pop(length(message)), 6) AS message_length_std,
      CAST(max(length(message)) AS INTEGER) AS message_length_max,
      round(avg({LEVEL_CODE}), 6) AS level_numeric_mean,
      round(stddev_pop({LEVEL_CODE}), 6) AS level_numeric_std, max({LEVEL_CODE}) AS level_numeric_max
    FROM logs GROUP BY 1"""
)
def window_stats(spark, sf):
    from logloom.operators.clean import derive

    rows = ft.window_statistics(
        derive(src.logs(spark, sf)), 60, ["message_length", "level_numeric"]
    )
    rounded = {c: F.round(c, 6) for c in rows.columns if c.endswith(("_mean", "_std"))}
    return rows.withColumns(
        {**rounded, "window_start": F.date_format("window_start", "yyyy-MM-dd HH:mm:ss")}
    )


@query(
    f"""WITH {src.LOGS}, f AS (SELECT row_id, count(*) OVER (PARTITION BY service)
      / (SELECT count(*) FROM logs) AS f FROM logs)
    SELECT row_id, round(f, 6) AS service_frequency, round(1 - f, 6) AS service_rarity FROM f"""
)
def service_frequency(spark, sf):
    rows = ft.service_frequency(src.logs(spark, sf, heavy=True))
    return rows.withColumns({c: F.round(c, 6) for c in ("service_frequency", "service_rarity")})


@query(
    f"""WITH {src.LOGS} SELECT row_id, round(1 - count(*) OVER (PARTITION BY service, level)
      / count(*) OVER (PARTITION BY service), 6) AS level_rarity_in_service FROM logs"""
)
def level_rarity(spark, sf):
    rows = ft.level_rarity(src.logs(spark, sf, heavy=True))
    return rows.withColumn("level_rarity_in_service", F.round("level_rarity_in_service", 6))


@query(
    f"""WITH {src.LOGS} SELECT service, level, count(*) AS n,
    CAST(sum(count(*)) OVER (PARTITION BY service) AS BIGINT) AS service_n FROM logs GROUP BY 1, 2"""
)
def service_level_totals(spark, sf):
    return ft.service_level_counts(src.logs(spark, sf))


@query(
    f"""WITH {src.LOGS} SELECT row_id, round(count(*) OVER (PARTITION BY source_ip)
      / (SELECT count(*) FROM logs), 6) AS ip_frequency FROM logs"""
)
def ip_frequency(spark, sf):
    rows = ft.ip_frequency(src.logs(spark, sf, heavy=True))
    return rows.withColumn("ip_frequency", F.round("ip_frequency", 6))


ALL_FEATURES = f"""WITH {src.LOGS}, {TEMPLATES},
    vocabulary AS (SELECT template, row_number() OVER (ORDER BY template) - 1 AS template_id
      FROM (SELECT * FROM counts ORDER BY n DESC, template LIMIT 500)),
    f AS (SELECT l.row_id, length(message) AS message_length, {LEVEL_CODE} AS level_numeric,
      {CALENDAR}, 0 AS has_ip, {text_stats_sql('message')}, {WINDOWS},
      coalesce(epoch_us("timestamp") - epoch_us(lag("timestamp") OVER (ORDER BY "timestamp", l.row_id)), 0)
        / 1000000.0 AS inter_arrival_seconds,
      count(*) OVER (PARTITION BY service) / (SELECT count(*) FROM logs) AS service_frequency,
      1 - count(*) OVER (PARTITION BY service, level) / count(*) OVER (PARTITION BY service)
        AS level_rarity_in_service,
      count(*) OVER (PARTITION BY source_ip) / (SELECT count(*) FROM logs) AS ip_frequency FROM logs l)
    SELECT t.row_id, CAST(coalesce(v.template_id, -1) AS DOUBLE) AS template_id,
      round(1 - c.n / (SELECT count(*) FROM t), 6) AS template_rarity,
      {', '.join(f'round(CAST({c} AS DOUBLE), 6) AS {c}' for c in [*ft.STATISTICAL, *ft.time_feature_names()])},
      round(service_frequency, 6) AS service_frequency, round(1 - service_frequency, 6) AS service_rarity,
      round(level_rarity_in_service, 6) AS level_rarity_in_service, round(ip_frequency, 6) AS ip_frequency
    FROM f JOIN t USING (row_id) JOIN counts c USING (template) LEFT JOIN vocabulary v USING (template)"""


@query(ALL_FEATURES)
def feature_columns(spark, sf):
    """All numeric features side by side."""
    rows = src.logs(spark, sf, heavy=True)
    model = FeatureModel.fit(rows)
    dense = model.dense(rows, stats="training")
    return dense.select("row_id", *[F.round(c, 6).alias(c) for c in model.dense_names])


@query()
def feature_rows(spark, sf):
    """TF-IDF and numeric features as one sparse row."""
    rows = src.logs(spark, sf, heavy=True)
    return FeatureModel.fit(rows).transform(rows)
