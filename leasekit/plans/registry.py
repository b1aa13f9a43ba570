"""Query registry: name -> Spark callable (spark, sf_dir) and, when the query has
an SQL meaning, its DuckDB oracle text."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, Callable[[], str] | str] = {}
OPS: dict[str, str] = {}


def query(name: str, ops: str = "", sql: Callable[[], str] | str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        OPS[name] = ops
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def oracle_texts() -> dict[str, str]:
    return {k: (v() if callable(v) else v) for k, v in ORACLE.items()}


def rnd(c, n: int) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), n)


# --------------------------------------------------------------------------
# Shared inputs (lazily built DataFrames; nothing is executed here).
# --------------------------------------------------------------------------
def lv(spark: SparkSession, d: str) -> DataFrame:
    from leasekit.sources.fixtures import listings_view

    return listings_view(spark, d)


def raw_lv(spark: SparkSession, d: str) -> DataFrame:
    from leasekit.sources.fixtures import raw_listings_view

    return raw_listings_view(spark, d)


ORDER = ["row_ord_price", "row_ord_part"]


def cleaned(spark: SparkSession, d: str, columns: Sequence[str] | None = None) -> DataFrame:
    """LV after the cleaning chain, written once after its dedupe; what follows is a projection and a filter
    over that table, which Catalyst prunes."""
    from leasekit.operators.clean import clean_data

    # The ordering columns only exist to make keep-first deterministic on the fixture.
    return clean_data(lv(spark, d), key="id", order=ORDER, materialize=True, columns=columns).drop(*ORDER)


def featured(spark: SparkSession, d: str) -> DataFrame:
    """Features stay a lazy plan over the cleaned table, so Catalyst
    prunes every feature a query does not read."""
    from leasekit.operators.features import build_features

    return build_features(cleaned(spark, d))

