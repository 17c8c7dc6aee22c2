"""Quality rules, line first: bad lines go, then documents that lost too much.

Every line is judged by itself: a line without letters or digits, of symbols,
of navigation (cells between bars, or short cells of a menu), of boilerplate
phrases, or a stub without closing punctuation fails and is removed.  A document goes if
its lost lines held more than ``max_lost`` percent of its words, or if it fails the base
rules (fewer than ``min_words`` words, or more than ``max_repeated`` percent of
its words inside word triples that occur twice or more).

All of it is array work inside a row: no shuffle and no Python.  Repeated
triples are found by sorting one array of (hash, position) numbers; equal
neighbours are confirmed on the words, so hash collisions don't count.

Defined results: null and empty text have no words and fail the base rules;
repeated rows give repeated results; other columns of the input are not read;
an empty table gives an empty table; texts of any length are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import SPACE, pinned

# Phrases of page furniture, in lower case.
BOILERPLATE = (
    "all rights reserved",
    "cookie policy",
    "click here",
    "enable javascript",
    "privacy policy",
    "sign up for our newsletter",
    "subscribe to our",
    "terms of service",
    "terms of use",
    "we use cookies",
)

SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS, MAX_REPEATED, MAX_LOST = 50, 50, 50


def _words(line: Column) -> Column:
    """Words of one line.  A pattern of one plain character splits without a regular expression."""
    other = line.contains("\t") | line.contains("\r") | line.contains("\x0b") | line.contains("\x0c")
    return F.filter(F.when(other, F.split(line, SPACE + "+")).otherwise(F.split(line, " ")), lambda w: w != "")


def _n_symbols(line: Column) -> Column:
    """Counting follows a search that most lines end at once."""
    return F.when(line.rlike(SYMBOLS), F.regexp_count(line, F.lit(SYMBOLS))).otherwise(0)


def _n_bars(line: Column) -> Column:
    any_bar = line.contains("|") | line.contains("•") | line.contains("»") | line.contains(">")
    return F.when(any_bar, F.regexp_count(line, F.lit("[|•»>]"))).otherwise(0)


def line_fails(line: Column, n_words: Column, n_symbols: Column) -> Column:
    """The verdict on one line with words; lines without a word never fail."""
    small = F.lower(line)
    phrase = small.contains(BOILERPLATE[0])
    for p in BOILERPLATE[1:]:
        phrase = phrase | small.contains(p)
    stub = (n_words < 3) & ~line.rlike(r"[.!?:;,…。！？\"')\]»”’]" + SPACE + "*$")
    return (n_words > 0) & (
        ~line.rlike(r"[\p{L}\p{N}]")
        | (n_symbols * 2 > n_words)
        | stub
        | F.coalesce((_n_bars(line) >= 2) & (_n_bars(line) * 4 >= n_words), F.lit(False))
        | phrase
    )


def assess(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_words: int = MIN_WORDS,
    max_repeated: int = MAX_REPEATED,
    max_lost: int = MAX_LOST,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """A row per input row: ``keep`` (else the key), the counts, the verdicts and the cleaned text."""
    carried = list(keep or (key,))
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.struct(*carried).alias("_row"), whole.alias("_text"))
    lines = pinned(rows, ["_row"], _lines=F.split("_text", "\n"))
    split = pinned(lines, ["_row", "_lines"], _lw=F.transform("_lines", _words))
    split = pinned(split, ["_row", "_lines", "_lw"], _w=F.flatten("_lw"))
    # A position takes the low bits of a number, the hash the others.
    n = F.size("_w")
    places = F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>"))
    bits = F.length(F.bin(n)).cast("int")
    low = F.call_function("shiftleft", F.lit(1).cast("bigint"), bits) - 1
    sized = pinned(
        split,
        ["_row", "_w", "_lines"],
        _bits=bits,
        _low=low,
        _n=F.transform("_lw", lambda x: F.size(x).cast("bigint")),
        _symbols=F.transform("_lines", _n_symbols),
    )
    counted = pinned(
        sized,
        ["_row", "_w", "_lines", "_low", "_n", "_symbols"],
        _s=F.sort_array(F.transform(places, _numbered)),
        _bad=F.transform("_lines", lambda x, i: line_fails(x, F.get("_n", i), F.get("_symbols", i))),
    )
    found = pinned(counted, ["_row", "_w", "_lines", "_n", "_symbols", "_bad"], _p=_repeated_places())
    covered = F.aggregate(
        "_p",
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-3).cast("bigint").alias("last")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(3).cast("bigint"), p - a["last"])).alias("n"), p.alias("last")),
        lambda a: a["n"],
    )
    with_word = F.filter("_lines", lambda x, i: F.get("_n", i) > 0)
    none = F.lit(0).cast("bigint")
    lost = F.aggregate(F.zip_with("_n", "_bad", lambda k, bad: F.when(bad, k).otherwise(none)), none, lambda a, k: a + k)
    measured = pinned(
        found,
        ["_row"],
        n_words=F.size("_w").cast("bigint"),
        word_chars=F.length(F.array_join("_w", "")).cast("bigint"),
        n_symbols=F.aggregate("_symbols", none, lambda a, k: a + k),
        n_dup_lines=(F.size(with_word) - F.size(F.array_distinct(with_word))).cast("bigint"),
        n_repeat_words=covered,
        n_lost_words=lost,
        clean_text=F.array_join(F.filter("_lines", lambda x, i: ~F.get("_bad", i)), "\n"),
    )
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeated)
    return measured.select(
        *[F.col("_row")[c].alias(c) for c in carried],
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "n_lost_words",
        failed.alias("base_failed"),
        (~failed & (F.col("n_lost_words") * 100 <= F.col("n_words") * max_lost)).alias("kept"),
        "clean_text",
    )


def _numbered(i: Column) -> Column:
    triple = F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2))
    return F.call_function("shiftleft", triple, F.col("_bits")).bitwiseOR(i)


def _repeated_places() -> Column:
    """Positions of triples that occur twice or more, in order."""

    def same(x: Column, y: Column) -> Column:
        # Above the position bits nothing differs; then the words decide.
        equal = x.bitwiseXOR(y) <= F.col("_low")
        equal = equal & (x.bitwiseXOR(y) >= 0)
        at, other = x.bitwiseAND(F.col("_low")).cast("int"), y.bitwiseAND(F.col("_low")).cast("int")
        for k in range(3):
            equal = equal & (F.get("_w", at + k) == F.get("_w", other + k))
        return F.coalesce(equal, F.lit(False))

    def repeated(x: Column, i: Column) -> Column:
        return same(x, F.get("_s", i - 1)) | same(x, F.get("_s", i + 1))

    return F.sort_array(F.transform(F.filter("_s", repeated), lambda x: x.bitwiseAND(F.col("_low"))))


def clean(docs: DataFrame, **options) -> DataFrame:
    """The documents that pass, with the lines that failed taken out; the columns stay.

    ``n_chars``, where there is such a column, follows the new text.
    """
    kept = assess(docs, keep=tuple(docs.columns), **options).where("kept")
    changed = {"text": F.col("clean_text").alias("text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("clean_text").cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return kept.select(*[changed.get(c, F.col(c)) for c in docs.columns])
