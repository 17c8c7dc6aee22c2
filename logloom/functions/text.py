"""Text scalars: cleaning, hashing, masking and character statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.schema import DEFAULT_LEVEL_CODE, LEVEL_CODES

# Character classes that mean the same in Java and RE2.
# White space follows Unicode, so a non-breaking space counts as blank.
SPACE = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"
UPPER = (
    r"\p{Lu}\x{2160}-\x{216F}\x{24B6}-\x{24CF}"
    r"\x{1F130}-\x{1F149}\x{1F150}-\x{1F169}\x{1F170}-\x{1F189}"
)

# Patterns whose matches must equal the published behaviour.
IPV4 = r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}"
ANSI = r"\x1b\[[0-9;]*[a-zA-Z]"
PII_PATTERNS = [
    (r"[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+", "[EMAIL_REDACTED]"),
    (r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b", "[IP_REDACTED]"),
    (r"\b\d{3}-\d{2}-\d{4}\b", "[SSN_REDACTED]"),
    (r"\b\d{4}[\s-]?\d{4}[\s-]?\d{4}[\s-]?\d{4}\b", "[CC_REDACTED]"),
]


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove leading and trailing white space (all of it, not only spaces)."""
    return F.regexp_replace(col(c), f"^[{SPACE}]+|[{SPACE}]+$", "")


def is_blank(c: Column | str) -> Column:
    """NULL, empty or white space only."""
    return col(c).isNull() | col(c).rlike(f"^[{SPACE}]*$")


def collapse_space(c: Column | str) -> Column:
    """Every run of white space becomes one space; ends are trimmed."""
    return F.trim(F.regexp_replace(col(c), f"[{SPACE}]+", " "))


def strip_ansi(c: Column | str) -> Column:
    return F.regexp_replace(col(c), ANSI, "")


def clean_message(
    c: Column | str,
    ansi: bool = True,
    whitespace: bool = True,
    lowercase: bool = False,
) -> Column:
    out = col(c)
    if ansi:
        out = strip_ansi(out)
    if whitespace:
        out = collapse_space(out)
    if lowercase:
        out = F.lower(out)
    return out


def sha256_hex(c: Column | str) -> Column:
    return F.sha2(col(c), 256)


def extract_ip(c: Column | str) -> Column:
    """First IPv4-looking substring, '' when there is none; octets unchecked."""
    return F.regexp_extract(F.coalesce(col(c), F.lit("")), IPV4, 0)


def mask_pii(c: Column | str) -> Column:
    """Replace e-mail, IPv4, SSN and card numbers, in that order."""
    out = col(c)
    for pattern, tag in PII_PATTERNS:
        out = F.regexp_replace(out, pattern, tag)
    return out


def truncate(c: Column | str, max_length: int = 500) -> Column:
    """Cut to ``max_length`` characters, the last three being '...'."""
    c = col(c)
    return F.when(
        F.length(c) > max_length, F.concat(F.substring(c, 1, max_length - 3), F.lit("..."))
    ).otherwise(c)


def safe_divide(numerator, denominator, default: float = 0.0) -> Column:
    """Quotient as DOUBLE; ``default`` for a zero denominator."""
    return F.coalesce(
        F.try_divide(col(numerator).cast("double"), col(denominator).cast("double")),
        F.lit(float(default)),
    )


def word_count(c: Column | str) -> Column:
    return F.regexp_count(col(c), F.lit(f"[^{SPACE}]+"))


def special_char_ratio(c: Column | str) -> Column:
    """Share of characters that are neither letter, digit nor white space."""
    hits = F.regexp_count(col(c), F.lit(rf"[^\p{{L}}\p{{N}}{SPACE}]"))
    return hits / F.greatest(F.length(col(c)), F.lit(1))


def uppercase_ratio(c: Column | str) -> Column:
    c = col(c)
    # Text of as many bytes as characters has no capitals but A to Z.
    plain = F.when(F.octet_length(c) == F.length(c), F.regexp_count(c, F.lit("[A-Z]")))
    return plain.otherwise(F.regexp_count(c, F.lit(f"[{UPPER}]"))) / F.greatest(F.length(c), F.lit(1))


def level_numeric(c: Column | str) -> Column:
    upper = F.upper(col(c))
    out = None
    for level, code in LEVEL_CODES.items():
        hit = upper == level
        out = F.when(hit, code) if out is None else out.when(hit, code)
    return out.otherwise(DEFAULT_LEVEL_CODE)


def flatten_columns(df: DataFrame, sep: str = ".") -> DataFrame:
    """Turn nested structs into top-level columns named ``outer<sep>inner``."""

    def walk(schema: T.StructType, path: list[str]):
        for field in schema.fields:
            here = path + [field.name]
            if isinstance(field.dataType, T.StructType):
                yield from walk(field.dataType, here)
            else:
                quoted = ".".join(f"`{part}`" for part in here)
                yield F.col(quoted).alias(sep.join(here))

    return df.select(*walk(df.schema, []))
