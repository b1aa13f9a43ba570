"""Text column expressions (all JVM-side built-ins, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leasekit import presets


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_all(c) -> Column:
    """Strip leading/trailing whitespace of any kind (``trim`` only strips spaces)."""
    return F.regexp_replace(_c(c), r"(?U)^\s+|\s+$", "")


def strip_prices(c, pattern: str = presets.PRICE_PATTERN) -> Column:
    """remove price mentions; null text becomes the empty string."""
    return F.regexp_replace(F.coalesce(_c(c), F.lit("")), f"(?iU){pattern}", " ")


def char_length(c) -> Column:
    """length in code points."""
    return F.char_length(_c(c))


def word_count(c) -> Column:
    """number of whitespace-separated words."""
    return F.regexp_count(F.coalesce(_c(c), F.lit("")), F.lit(r"(?U)\S+"))


def ascii_word_count(c) -> Column:
    """Word count with ASCII whitespace classes (for engines whose ``\\s`` is ASCII)."""
    return F.regexp_count(F.coalesce(_c(c), F.lit("")), F.lit(r"[^ \t\n\r\f]+"))


def has_marker(c, pattern: str) -> Column:
    """1 if the case-insensitive pattern occurs, else 0 (null -> 0)."""
    return F.coalesce(_c(c).rlike(f"(?i){pattern}"), F.lit(False)).cast("int")


def slug(c) -> Column:
    """F2 as a column: lower, non-alphanumeric runs -> '_', strip '_'."""
    return F.btrim(F.regexp_replace(F.lower(_c(c)), "[^a-z0-9]+", "_"), F.lit("_"))


def money_first_number(c, pattern: str = presets.MONEY_FIRST_NUMBER_PATTERN) -> Column:
    """F16: first number of a money string ('$1,782 - $1,917' -> 1782.0), bad -> null."""
    digits = F.regexp_replace(F.regexp_extract(_c(c), pattern, 1), ",", "")
    return F.nullif(digits, F.lit("")).try_cast("double")


def join_text(*cols) -> Column:
    """null -> '' and join with a single space (keeps empty parts, unlike concat_ws)."""
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(" "))
        parts.append(F.coalesce(_c(c), F.lit("")))
    return F.concat(*parts)


def split_multi(c, sep: str = ",") -> Column:
    """Comma-joined multi-select -> array of non-empty parts."""
    return F.filter(F.split(F.coalesce(_c(c), F.lit("")), sep), lambda x: x != "")


def array_to_multi(c, sep: str = ",") -> Column:
    """array -> comma string, null -> ''."""
    return F.array_join(F.coalesce(_c(c), F.array().cast("array<string>")), sep)


def fold_accents(c) -> Column:
    """Latin accent folding by a fixed translation table."""
    return F.translate(_c(c), presets.ACCENTED, presets.UNACCENTED)
