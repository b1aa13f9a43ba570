"""Operators without an SQL twin, checked against brute force / closed forms."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_knn_matches_numpy(spark):
    from leasekit.operators.knn import knn_join

    emb = spark.read.parquet(f"{SF}/embeddings.parquet")
    q = emb.filter(F.col("vec_id") % 5 == 0)
    r = emb.filter(F.col("vec_id") % 5 != 0)
    got = knn_join(q, r, k=10, q_id="vec_id", r_id="vec_id", vec="embedding", block_rows=37).toPandas()
    pdf = emb.toPandas()
    Q = pdf[pdf.vec_id % 5 == 0]
    R = pdf[pdf.vec_id % 5 != 0]
    RV = np.stack(R.embedding.to_numpy()).astype(np.float64)
    for _, row in Q.iterrows():
        d = np.sqrt(((RV - np.asarray(row.embedding, dtype=np.float64)) ** 2).sum(axis=1))
        order = np.lexsort((R.vec_id.to_numpy(), np.round(d, 9)))[:10]
        want = list(R.vec_id.to_numpy()[order])
        have = list(got[got.qid == row.vec_id].sort_values("rank").rid)
        assert have == want


def test_ridge_matches_closed_form(spark):
    from pyspark.ml.feature import VectorAssembler

    from leasekit.operators.models import ridge

    rng = np.random.default_rng(1)
    X = rng.normal(size=(400, 3))
    y = X @ np.array([2.0, -1.0, 0.5]) + 3 + rng.normal(scale=0.5, size=400)
    df = spark.createDataFrame(pd.DataFrame({"a": X[:, 0], "b": X[:, 1], "c": X[:, 2], "label": y}))
    df = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    alpha = 10.0
    model = ridge(alpha, len(y), float(np.std(y, ddof=1))).fit(df)
    Xc, yc = X - X.mean(0), y - y.mean()
    w = np.linalg.solve(Xc.T @ Xc + alpha * np.eye(3), Xc.T @ yc)
    assert np.allclose(model.coefficients.toArray(), w, atol=1e-4)


def test_svd_singular_values_match_numpy(spark):
    from leasekit.operators import text_vectors as TV

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    vocab, weights = TV.tfidf_fit_transform(docs, "doc_id", "text", min_df=5)
    scores, s, v = TV.truncated_svd(weights, vocab, k=5)
    terms = sorted(r[0] for r in vocab.select("term").collect())
    idx = {t: i for i, t in enumerate(terms)}
    w = weights.toPandas()
    docs_ids = sorted(w.doc.unique())
    di = {d: i for i, d in enumerate(docs_ids)}
    M = np.zeros((len(docs_ids), len(terms)))
    for row in w.itertuples():
        M[di[row.doc], idx[row.term]] = row.weight
    ref = np.linalg.svd(M, compute_uv=False)[:5]
    assert np.allclose(s, ref, rtol=1e-3) and np.allclose(v.T @ v, np.eye(5))
    # Scores are A·V, with V's rows in the vocabulary's order.
    order = [r[0] for r in TV.vocabulary_index(vocab).orderBy("j").collect()]
    given = scores.toPandas().set_index("doc").loc[docs_ids].to_numpy()
    assert np.allclose(given, M[:, [idx[t] for t in order]] @ v)


def test_svd_of_low_rank_rows_is_exact(spark, monkeypatch):
    """Three directions only: values to rounding, whatever the number of parts, and with fewer columns than asked for."""
    from leasekit.operators import text_vectors as TV

    monkeypatch.setattr(TV, "_CHUNK", 7)
    draw = np.random.default_rng(0)
    A = np.abs(draw.standard_normal((60, 3))) @ np.abs(draw.standard_normal((3, 25)))
    rows = spark.createDataFrame([(i, list(range(25)), [float(x) for x in r]) for i, r in enumerate(A)], "doc long, j array<int>, w array<double>").repartition(5)
    s, v = TV.randomized_svd(rows, 25, 3)
    assert np.allclose(s, np.linalg.svd(A, compute_uv=False)[:3], rtol=1e-10)
    assert np.allclose(A @ v @ v.T, A)


def test_pca_explained_variance_matches_numpy(spark):
    from pyspark.ml.feature import VectorAssembler

    from leasekit.operators.dimred import explained_variance_table, fit_pca

    rng = np.random.default_rng(3)
    X = rng.normal(size=(300, 4)) @ rng.normal(size=(4, 4))
    X = (X - X.mean(0)) / X.std(0)
    df = VectorAssembler(inputCols=list("abcd"), outputCol="features").transform(
        spark.createDataFrame(pd.DataFrame(X, columns=list("abcd"))))
    model = fit_pca(df, 4)
    ev = np.linalg.eigvalsh(np.cov(X.T))[::-1]
    assert np.allclose(model.stages[-1].explainedVariance.toArray(), ev / ev.sum(), atol=1e-8)
    table = explained_variance_table(model, spark).toPandas()
    assert table.cumulative.iloc[-1] == pytest.approx(1.0, abs=1e-4)


def test_target_encoding_oof_matches_pandas(spark):
    from leasekit.functions.hashing import bucket
    from leasekit.operators.encode import target_encode_oof

    rng = np.random.default_rng(7)
    n = 300
    pdf = pd.DataFrame({"id": np.arange(n), "cat": rng.choice(list("abcdefg"), n),
                        "price": rng.normal(1500, 400, n), "split": "train"})
    df = spark.createDataFrame(pdf)
    got = target_encode_oof(df, "cat", "price", "id", folds=5).toPandas().set_index("id")
    folds = df.select("id", bucket(F.col("id"), "42|fold", 5).alias("f")).toPandas().set_index("id").f
    pdf["fold"] = pdf.id.map(folds)
    for _, r in pdf.iterrows():
        other = pdf[pdf.fold != r.fold]
        same = other[other["cat"] == r["cat"]].price
        gm, gv = other.price.mean(), other.price.var(ddof=0)
        if len(same) == 0:
            want = gm
        else:
            lam = len(same) * gv / (len(same) * gv + same.var(ddof=0))
            want = lam * same.mean() + (1 - lam) * gm
        assert got.loc[r.id, "cat_te"] == pytest.approx(want, rel=1e-9)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 400), st.floats(0, 100)), min_size=1, max_size=60,
                unique_by=lambda t: (t[0], t[1])))
def test_running_min_matches_pandas(spark, rows):
    from leasekit.operators.reports import running_min

    pdf = pd.DataFrame(rows, columns=["study", "number", "mae"])
    df = spark.createDataFrame(pdf)
    got = running_min(df, "study", "number", "mae", block=16).toPandas().sort_values(["study", "number"])
    want = pdf.sort_values(["study", "number"]).groupby("study").mae.cummin()
    assert np.allclose(got.running_best.to_numpy(), want.to_numpy())


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(1, 1000), min_size=5, max_size=80), st.integers(2, 6))
def test_qcut_matches_numpy(spark, ys, bins):
    from leasekit.operators.evaluate import qcut_error_analysis

    y = np.array(ys)
    df = spark.createDataFrame([(float(v), float(v)) for v in y], "y double, prediction double")
    got = qcut_error_analysis(df, bins=bins, decimals=None).toPandas()
    edges = np.unique(np.quantile(y, np.linspace(0, 1, bins + 1)))
    b = np.clip(np.searchsorted(edges, y, side="left") - 1, 0, max(len(edges) - 2, 0))
    want = pd.Series(b).value_counts().sort_index()
    assert list(got.sort_values("bin").n) == list(want.to_numpy())


def test_onehot_pools_rare_levels_and_leaves_unseen_ones_zero(spark):
    from leasekit.operators import encode as E

    rows = [("train", "a")] * 60 + [("train", "rare.1")] * 3 + [("train", None)] * 2 + [("val", x) for x in ("a", "rare.1", "never", None)]
    df = spark.createDataFrame(rows, "split string, c string")
    out = E.apply_onehot(df, E.fit_onehot(df, ["c"])).where("split = 'val'")
    got = {r["c"]: (r["c_a"], r["c_infrequent_sklearn"]) for r in out.collect()}
    assert got == {"a": (1, 0), "rare.1": (0, 1), "never": (0, 0), None: (0, 0)}


def test_knn_ranks_near_ties_by_id(spark):
    from leasekit.operators.knn import knn_join

    refs = [(5, [1.0]), (1, [1.0 + 1e-12]), *[(k, [1.0]) for k in range(20, 40)], (9, [3.0])]
    got = knn_join(spark.createDataFrame([(0, [0.0])], "id long, features array<double>"),
                   spark.createDataFrame(refs, "id long, features array<double>"), k=3).collect()
    assert sorted((r["rank"], r.rid) for r in got) == [(1, 1), (2, 5), (3, 20)]


def test_numbering_and_quantiles_over_ranges(spark):
    import numpy as np
    from pyspark.sql import functions as F

    from leasekit.operators.ranking import exact_quantiles, numbered

    rng = np.random.default_rng(7)
    data = [(float(a), None if b < 0.1 else float(round(b, 2)), None) for a, b in rng.uniform(0, 1, (997, 2))]
    df = spark.createDataFrame(data, "a double, b double, c double").repartition(7)
    rows, n = numbered(df, ["a"], "k")
    got = [r.a for r in rows.orderBy("k").collect()]
    assert n == 997 and got == sorted(x[0] for x in data)
    assert rows.agg(F.min("k"), F.max("k"), F.count_distinct("k")).first()[:] == (0, 996, 997)
    assert numbered(df.limit(0), ["a"], "k")[1] == 0
    shares = [0, 0.1, 0.25, 0.5, 0.75, 0.999, 1]
    found = exact_quantiles(df, ["a", "b", "c"], shares)
    for i, c in enumerate("ab"):
        assert found[c] == pytest.approx(list(np.quantile([x[i] for x in data if x[i] is not None], shares)))
    assert found["c"] == [None] * len(shares)


def test_pca_standardises_and_takes_a_share_of_variance(spark):
    import numpy as np
    from pyspark.ml.linalg import Vectors

    from leasekit.operators.dimred import explained_variance_table, fit_pca

    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 4)) @ np.diag([1, 1, 1000, 1]) + [0, 5, 70_000, 0]
    x[:, 3] = x[:, 0] + 0.1 * x[:, 3]
    df = spark.createDataFrame([(Vectors.dense(r),) for r in x.tolist()], ["features"])
    want = np.sort(np.linalg.eigvalsh(np.corrcoef(x.T)))[::-1] / 4
    assert fit_pca(df, 4).stages[-1].explainedVariance.toArray() == pytest.approx(want, abs=1e-9)
    assert len(fit_pca(df, 0.95).stages[-1].explainedVariance) == int(np.argmax(want.cumsum() >= 0.95)) + 1
    table = explained_variance_table(fit_pca(df, 4), spark).collect()
    assert [r.cumulative for r in table] == pytest.approx(want.cumsum().round(4))
    with pytest.raises(ValueError):
        fit_pca(df, 5)


def test_target_encoding_table_equals_leave_out_statistics(spark):
    import numpy as np

    from leasekit.functions.hashing import bucket
    from leasekit.operators import encode as E

    rng = np.random.default_rng(11)
    rows = [(k, "train" if k % 4 else "val", [None, "a", "b", "c", "d"][rng.integers(0, 5)], float(rng.normal(1000, 200))) for k in range(400)]
    rows += [(1000, "train", "once", 5.0), (1001, "val", "never", 6.0)]
    df = spark.createDataFrame(rows, "id long, split string, cat string, price double")
    df = df.withColumn("f", F.when(F.col("split") == "train", bucket(F.col("id"), "42|fold", 5)).otherwise(-1))
    train = [r for r in df.collect() if r.split == "train"]
    mean = float(np.mean([r.price for r in train]))
    table = E.target_encoding_table(df, "cat", "price", "split", "id", mean)
    got = {r.id: r.e for r in E.join_target_encoding(df, table, "cat", "f", mean, "e").collect()}
    for r in df.collect():
        rest = [t for t in train if t.f != r.f]
        mine = [t.price for t in rest if t.cat == r.cat]
        ym, yv = np.mean([t.price for t in rest]), np.var([t.price for t in rest])
        want = ym
        if mine:
            lam = len(mine) * yv / (len(mine) * yv + np.var(mine))
            want = lam * np.mean(mine) + (1 - lam) * ym
        elif r.cat == "never":
            want = mean
        assert got[r.id] == pytest.approx(want, rel=1e-9), r
