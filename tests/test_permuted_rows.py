"""Permutation importance of a linear model."""

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression, LinearRegressionModel

from leasekit.operators import models as M


class Any:
    """A model that is not known to be linear."""

    def __init__(self, model):
        self.transform = model.transform


def table(df):
    return {r.feature: (r.mae_increase, r.std) for r in df.collect()}


def test_a_linear_model_scores_no_variants(spark, monkeypatch):
    draw = np.random.default_rng(8)
    x = draw.standard_normal((230, 4)).round(2)
    x[:, 3] = 0
    rows = spark.createDataFrame([(k // 2, "val" if k % 5 else "train", [float(v) for v in r], None if k % 41 == 1 else float(3 * r[0] - r[1] + k % 7)) for k, r in enumerate(x)],
                                 "id long, split string, x array<double>, label double").repartition(5)
    rows = rows.dropDuplicates(["id", "split"]).select("id", "split", "label", array_to_vector("x").alias("features"))
    rows = rows.cache()
    model = LinearRegression(solver="normal").fit(rows.where("split = 'train' and label is not null"))
    m = M.Matrix(rows, ["a", "b", "c", "d"])
    whole = table(M.permutation_importance(Any(model), m, repeats=3))
    calls, one = [], LinearRegressionModel.transform
    monkeypatch.setattr(LinearRegressionModel, "transform", lambda *a: calls.append(1) or one(*a))
    monkeypatch.setattr(M, "PERMUTED_ROWS", 20)  # many ranges
    found = table(M.permutation_importance(model, m, repeats=3))
    assert len(calls) == 1  # the rows themselves
    assert found.keys() == whole.keys() and found["a"][0] > 1
    assert np.allclose([found[k] for k in "abcd"], [whole[k] for k in "abcd"], rtol=0, atol=1e-9)
    none = M.Matrix(rows.where("split = 'train'"), m.names)
    assert M.permutation_importance(model, none, repeats=2).count() == 0
