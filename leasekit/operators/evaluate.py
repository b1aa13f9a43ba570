"""Regression metrics and error reports.

All metrics of one prediction column come from a single aggregate; the
grouped form computes every model (or segment) in the same pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leasekit.operators.ranking import exact_quantiles, grouped_quantiles, null_safe

METRICS = ["mae", "rmse", "mape", "r2", "median_ae"]


def mean_columns(y: str | Column, p: str | Column) -> list[Column]:
    """The metrics that are means and sums; the median of the errors is found apart."""
    y = F.col(y) if isinstance(y, str) else y
    p = F.col(p) if isinstance(p, str) else p
    e = y - p
    return [
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (F.avg(F.abs(F.try_divide(e, y))) * 100).alias("mape"),
        (F.lit(1.0) - F.try_divide(F.sum(e * e), F.var_pop(y) * F.count(y))).alias("r2"),
    ]


def compute_metrics(df: DataFrame, y: str = "y", p: str = "prediction",
                    group: str | Sequence[str] | None = None, approx_median: bool = False) -> DataFrame:
    """MAE, RMSE, MAPE %, R², median absolute error (one row, or one per group; null is a group).

    The medians are exact and no task holds the errors, of all rows or of a group; the predictions are written once for
    them. ``approx_median`` takes one pass instead.
    """
    groups = [] if group is None else [group] if isinstance(group, str) else list(group)
    if approx_median:
        median = F.percentile_approx(F.abs(F.col(y) - F.col(p)), 0.5, 10000).cast("double").alias("median_ae")
        return df.groupBy(*groups).agg(*mean_columns(y, p), median)
    from leasekit.session import materialize

    rows = materialize(df.select(*groups, F.col(y).alias("_y"), F.col(p).alias("_p")))
    means = rows.groupBy(*groups).agg(*mean_columns("_y", "_p"))
    errors = rows.select(*groups, F.abs(F.col("_y") - F.col("_p")).alias("_e"))
    if not groups:
        median = exact_quantiles(errors, ["_e"], [0.5])["_e"][0]
        return means.withColumn("median_ae", F.lit(median).cast("double"))
    medians = grouped_quantiles(errors, groups, ["_e"], [0.5])
    return null_safe(means, medians, groups).withColumn("median_ae", F.col("_e")[0]).drop("_e")


def metrics_long(wide: DataFrame, model_col: str = "model") -> DataFrame:
    """Wide metrics -> long (model, metric, value), the run-log shape."""
    return wide.select(model_col, F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in METRICS])).alias("x")
    ).select(model_col, "x.metric", "x.value")


def metrics_table(long: DataFrame, model_col: str = "model", decimals: int = 3) -> DataFrame:
    """Model x metric pivot, sorted by MAE (explicit pivot values: no extra distinct job)."""
    wide = long.groupBy(model_col).pivot("metric", METRICS).agg(F.first("value"))
    return wide.select(model_col, *[F.round(m, decimals).alias(m) for m in METRICS]).orderBy("mae", model_col)


def qcut_error_analysis(df: DataFrame, y: str = "y", p: str = "prediction", bins: int = 5,
                        decimals: int | None = 1) -> DataFrame:
    """Error by quantile bin of the true value.

    Edges are exact linear-interpolated quantiles (duplicates dropped), bins are
    right-closed (e_i, e_i+1] with the first bin closed on the left, as a
    quantile cut does. The edges are one small array, so binning is a projection and
    the report one aggregation.
    """
    found = exact_quantiles(df.select(F.col(y).alias("y")), ["y"], [i / bins for i in range(bins + 1)])["y"]
    edges = F.array(*[F.lit(e) for e in sorted({e for e in found if e is not None})]).cast("array<double>")
    # bin = number of inner edges strictly below y (positions 2 .. size-1 of the edge array);
    b = F.lit(0)
    for i in range(2, bins + 1):
        below = (F.lit(i) <= F.size(edges) - 1) & (F.try_element_at(edges, F.lit(i)) < F.col(y))
        b = b + F.coalesce(below, F.lit(False)).cast("int")
    rep = df.select(b.alias("bin"), F.col(y).alias("_y"), F.abs(F.col(y) - F.col(p)).alias("_ae"))
    out = rep.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.avg("_y").alias("mean_price"),
                                 F.avg("_ae").alias("mae"), F.sum("_y").alias("sum_price"),
                                 F.sum("_ae").alias("sum_abs_error"))
    # A constant column has a single edge: one bin [v, v].
    out = out.select("bin", F.try_element_at(edges, F.col("bin") + 1).alias("lower"),
                     F.coalesce(F.try_element_at(edges, F.col("bin") + 2), F.element_at(edges, -1)).alias("upper"),
                     "n", "mean_price", "mae", "sum_price", "sum_abs_error")
    if decimals is not None:
        out = out.withColumns({c: F.round(c, decimals) for c in ["mean_price", "mae"]})
    return out
