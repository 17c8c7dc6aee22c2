"""Word tokens and n-grams for TF-IDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from logloom.functions.text import col

TOKEN = r"[\p{L}\p{N}_]{2,}"

# Default stop words: common English function words.  A parameter everywhere.
STOP_WORDS = """
a about above after again against all am an and any are as at be because been
before being below between both but by can could did do does doing down during
each few for from further had has have having he her here hers herself him
himself his how i if in into is it its itself just me more most my myself no
nor not now of off on once only or other our ours ourselves out over own same
she should so some such than that the their theirs them themselves then there
these they this those through to too under until up very was we were what when
where which while who whom why will with would you your yours yourself
yourselves
""".split()


def tokens(c: Column | str, stop_words: Sequence[str] | None = None) -> Column:
    """Lower-cased words of two or more characters, stop words removed."""
    words = F.regexp_extract_all(F.lower(col(c)), F.lit(TOKEN), F.lit(0))
    stop = STOP_WORDS if stop_words is None else list(stop_words)
    if not stop:
        return words
    return F.filter(words, lambda w: ~w.isin(stop))


def ngrams(words: Column, low: int = 1, high: int = 3) -> Column:
    """All n-grams of ``low`` to ``high`` words, joined by a space.

    Each length is the one before, zipped with the words further on.
    """
    out, grams = [], words
    for n in range(1, high + 1):
        if n > 1:
            size = F.greatest(F.size(words) - (n - 1), F.lit(0))
            grams = F.zip_with(
                F.slice(grams, F.lit(1), size),
                F.slice(words, F.lit(n), size),
                lambda a, b: F.concat(a, F.lit(" "), b),
            )
        if n >= low:
            out.append(grams)
    return F.concat(*out)
