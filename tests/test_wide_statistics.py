"""Statistics of many columns: a few at a time, and no second fit for fewer components."""

import numpy as np
import pytest
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def numbers(spark, n, width):
    x = np.random.default_rng(4).standard_normal((n, width)).round(3)
    return x, spark.createDataFrame([(k, *map(float, r)) for k, r in enumerate(x)], "id long, " + ", ".join(f"c{i} double" for i in range(width)))


@pytest.fixture
def widths(monkeypatch):
    seen, agg = [], DataFrame.agg
    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrame.agg", lambda self, *a: seen.append(len(a)) or _agg(self, *a))
    return seen


def _agg(df, *a):
    return df.groupBy().agg(*a)


def test_correlations_of_many_columns_are_aggregated_a_few_at_a_time(spark, widths):
    from leasekit.operators.reports import target_correlations

    x, df = numbers(spark, 200, 21)
    got = {r.feature: r.corr for r in target_correlations(df, [f"c{i}" for i in range(1, 21)], "c0", top=20).collect()}
    assert got == {f"c{i}": pytest.approx(np.corrcoef(x[:, 0], x[:, i])[0, 1], abs=1e-9) for i in range(1, 21)}
    assert widths and max(widths) <= 8


def test_moments_of_many_columns_are_aggregated_a_few_at_a_time(spark, widths):
    from leasekit.operators.models import fit_preprocessor

    x, df = numbers(spark, 120, 20)
    rows = df.select("id", F.lit("train").alias("split"), F.col("c0").alias("price"), F.when(F.col("id") % 9 > 0, F.col("c1")).alias("c1"), *[f"c{i}" for i in range(2, 20)])
    prep = fit_preprocessor(rows, numeric=[f"c{i}" for i in range(1, 20)], low_card=[], use_target_encoding=False)
    filled = x[:, 1].copy()
    filled[::9] = np.median(np.delete(filled, np.arange(0, 120, 9)))
    assert prep.std["c1__std"] == pytest.approx(filled.std(), abs=1e-9) and prep.std["c19__mean"] == pytest.approx(x[:, 19].mean(), abs=1e-9)
    assert max(widths) <= 3 * 8


def test_components_for_a_share_of_variance_take_one_fit(spark, monkeypatch):
    from leasekit.operators.dimred import fit_pca

    x, df = numbers(spark, 150, 5)
    df = df.select("id", array_to_vector(F.array(*[F.col(f"c{i}") * (i + 1) + F.col("c0") for i in range(5)])).alias("features"))
    fits, fit = [], PCA.fit
    monkeypatch.setattr(PCA, "fit", lambda self, *a: fits.append(1) or fit(self, *a))
    model = fit_pca(df, 0.8)
    assert len(fits) == 1  # before: a second one for the components found
    k = len(model.stages[-1].explainedVariance)
    whole = fit_pca(df, k)
    assert 1 < k < 5 and model.stages[-1].pc.toArray() == pytest.approx(whole.stages[-1].pc.toArray(), abs=1e-9)
    first, again = (m.transform(df).orderBy("id").first().pca.toArray() for m in (model, whole))
    assert first == pytest.approx(again, abs=1e-9) and len(first) == k
