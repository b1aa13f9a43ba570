"""Grouped quantiles, modes and one-pass distinct counts against pandas, with hot groups, nulls and ties."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from leasekit.operators.distinct import SHORT, distinct_values
from leasekit.operators.evaluate import compute_metrics
from leasekit.operators.ranking import grouped_mode, grouped_quantiles


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    n = 6000
    group = np.where(rng.random(n) < 0.4, "hot", rng.integers(0, 40, n).astype(str))
    frame = pd.DataFrame({"g": group, "a": rng.normal(size=n), "b": rng.integers(0, 4, n).astype(float)})
    frame.loc[rng.random(n) < 0.1, "a"] = np.nan
    frame.loc[frame.g == "7", "a"] = np.nan
    frame.loc[frame.g == "8", "g"] = None
    rows = [(None if pd.isna(r.g) else r.g, None if np.isnan(r.a) else float(r.a), r.b) for r in frame.itertuples()]
    return frame, spark.createDataFrame(rows, "g string, a double, b double").repartition(7)


def test_grouped_quantiles_equal_numpy(table):
    frame, df = table
    shares = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r.g: r for r in grouped_quantiles(df, ["g"], ["a", "b"], shares).collect()}
    want = {None if pd.isna(k) else k: part for k, part in frame.groupby("g", dropna=False)}
    assert got.keys() == want.keys()
    for g, part in want.items():
        for c in ("a", "b"):
            values = part[c].dropna()
            if len(values):
                np.testing.assert_allclose(got[g][c], np.quantile(values, shares), rtol=1e-12)
            else:
                assert got[g][c] == [None] * len(shares)


def test_grouped_quantiles_of_nothing(table):
    _, df = table
    assert grouped_quantiles(df.limit(0), ["g"], ["a"], [0.5]).collect() == []


def test_grouped_plan_collects_no_group(table):
    """The only gathering is of range sums and of one range: no percentile or list buffer."""
    _, df = table
    plan = grouped_quantiles(df, ["g"], ["a"], [0.5])._jdf.queryExecution().toString()
    assert "percentile" not in plan and "collect_list" not in plan and "SinglePartition" not in plan


def test_grouped_mode_smallest_of_ties(spark):
    df = spark.createDataFrame([("x", "b"), ("x", "a"), ("x", None), ("x", None), ("x", None), (None, "c"), ("y", None)], "g string, v string")
    assert {r.g: r.v for r in grouped_mode(df, ["g"], "v").collect()} == {"x": "a", None: "c", "y": None}
    assert grouped_mode(df, [], "v").first().v == "a"


def test_metrics_of_groups_equal_spark_median(table):
    _, df = table
    pairs = df.select("g", F.col("a").alias("y"), F.col("b").alias("prediction"))
    got = {r.g: r.median_ae for r in compute_metrics(pairs, group="g").collect()}
    want = {r.g: r.m for r in pairs.groupBy("g").agg(F.median(F.abs(F.col("y") - F.col("prediction"))).alias("m")).collect()}
    assert got == pytest.approx(want)


def test_distinct_values_equal_count_distinct(spark):
    long_a, long_b = "x" * SHORT + "a", "x" * SHORT + "b"
    rows = [(1, 0.0, "a:1", long_a, [1, None], True), (1, -0.0, "a:1", long_b, [1], True), (2**60, float("nan"), None, long_a, None, None),
            (2**60 + 1, float("nan"), "", None, [1, None], False), (None, None, "", None, [1, None], False), (None, None, "", None, [1, None], False)]
    df = spark.createDataFrame(rows, "i long, d double, s string, t string, l array<int>, f boolean")
    got = distinct_values(df, {**{c: [c] for c in df.columns}, "rows": df.columns, "s2": ["s", "t"], "i_rows": ["i"]}, whole=["i_rows"]).first()
    assert got.n == 6
    for c in df.columns:
        assert got[f"distinct_{c}"] == df.agg(F.count_distinct(c)).first()[0], c
        assert got[f"null_{c}"] == df.where(F.col(c).isNull()).count(), c
    assert got.distinct_rows == df.distinct().count() == 5
    assert got.distinct_s2 == df.select("s", "t").distinct().count()
    assert got.distinct_i_rows == 4


def test_distinct_values_lengths_keep_rows_apart(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), (None, "-"), ("-", None)], "x string, y string")
    assert distinct_values(df, {"rows": ["x", "y"]}).first().distinct_rows == 4
    empty = distinct_values(df.limit(0), {"rows": ["x", "y"], "x": ["x"]}).first()
    assert (empty.n, empty.distinct_rows, empty.null_x) == (0, 0, 0)
