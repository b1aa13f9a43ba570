"""Numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c) -> Column:
    """Coercing cast to double; unparsable -> null and NaN -> null.

    ``try_cast`` never throws under ANSI mode; NaN is normalised because Spark
    orders NaN above every number, so range filters would let it through.
    """
    x = _c(c).try_cast("double")
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)


def unix_seconds_to_timestamp(c) -> Column:
    """Unix seconds -> timestamp_ntz (time-zone independent), bad -> null."""
    secs = _c(c).try_cast("double").try_cast("bigint")
    return F.when(secs.isNull(), F.lit(None).cast("timestamp_ntz")).otherwise(
        F.timestamp_add("SECOND", secs, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")))


def safe_denominator(c, zero_to: float = 1.0) -> Column:
    """0 -> ``zero_to`` (keeps nulls), for ratios such as sqft per bedroom."""
    x = _c(c)
    return F.when(x == 0, F.lit(zero_to)).otherwise(x)


def weekday_mon0(c) -> Column:
    """day of week with Monday = 0 (``dayofweek`` is Sunday = 1)."""
    return F.weekday(_c(c))


def skewness_unbiased(c) -> Column:
    """Bias-adjusted sample skewness G1 = g1 * sqrt(n(n-1)) / (n-2)."""
    n = F.count(_c(c)).cast("double")
    return F.skewness(_c(c)) * F.sqrt(n * (n - 1)) / (n - 2)
