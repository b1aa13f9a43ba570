"""The scoring artifact: saved, loaded, batch and stream give the same; tree ensembles survive saving."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from leasekit.operators import score as SC
from leasekit.operators.trees import Ensemble, Trees
from leasekit.plans import q_score as Q
from leasekit.sources.artifacts import load_model, save_model

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def scorers(spark):
    return Q.fit_scorer(spark, SF, "ridge")


def table(df):
    return sorted(map(str, df.collect()))


def test_saved_scorer_and_stream_equal_batch(spark, scorers):
    from leasekit.streaming.stream import stream_scores

    fitted, loaded = scorers
    requests = Q.requests_from_lv(spark, SF).cache()
    batch = fitted.score(requests, Q.POSTED_AT).cache()
    assert loaded.prep.names == fitted.prep.names and loaded.prep.names[-1].startswith("text_svd_")
    assert table(loaded.score(requests, Q.POSTED_AT)) == table(batch)
    assert table(stream_scores(spark, requests, loaded, Q.POSTED_AT)) == table(batch)
    # Every request once: scored, or rejected with reasons (ids repeat, each row keeps its own text).
    assert batch.count() == requests.count()
    invalid = SC.enrich(SC.validate(requests), fitted.city_ref, fitted.state_ref).where(F.size("errors") > 0).count()
    assert batch.where("errors is not null").count() == invalid > 0
    assert batch.where("errors is null and (price_low is null or price_high - predicted_price > 2 * abs(predicted_price) + 1e9)").count() == 0
    assert 0 < loaded.mae < 1e5


def test_saved_ensemble(spark, tmp_path):
    draw = np.random.default_rng(0)
    x = draw.standard_normal((80, 3)).round(2)
    data = spark.createDataFrame([(i, [float(v) for v in r], float(r[0] * 3 + r[1])) for i, r in enumerate(x)], "id long, x array<double>, label double")
    data = data.select("id", "label", array_to_vector("x").alias("features"))
    model = Trees("boost", 4, 0.3, depth=None, leaves=5).fit(data)
    save_model(model, f"{tmp_path}/m")
    back = load_model(Ensemble, f"{tmp_path}/m", spark)
    assert back.spec == model.spec and table(back.transform(data)) == table(model.transform(data))
