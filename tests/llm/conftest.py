"""Small odd tables for the training-text operators."""

import pytest

# Null, empty and very long texts, ties, repeated rows, white space of every kind, clashing extra columns.
TEXTS = [
    None,
    "",
    " \n\t \n",
    "One short line.",
    "Tab\tand\rreturn\x0bpage\x0c words.\nTab\tand\rreturn\x0bpage\x0c words.",
    "a b c a b c a b c",
    "Übung für ALLE Wörter, ÉCOLE école. " * 9,
    "word " * 30_000,
    "home | news | about | contact\n" * 6 + "A sentence that ends well enough for all of us here. " * 9,
    "x" * 50_000,
    "漢字 かな 𝒳𝒴 😀 text\nsame line\nsame line\nsame line",
]


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(i, t, "en" if i % 2 else None, "s", len(t or ""), i, "clash") for i, t in enumerate(TEXTS)]
    rows += [rows[3], rows[3], (None, "text of a document without a key", None, None, None, None, None)]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, n bigint, words string"
    ).repartition(3)
