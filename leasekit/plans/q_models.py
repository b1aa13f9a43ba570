"""Queries for evaluation, k-NN, TF-IDF, models and interpretation."""

from __future__ import annotations

from pyspark.sql import functions as F

from leasekit import presets
from leasekit.operators import evaluate as EV
from leasekit.operators import knn as KNN
from leasekit.operators import reports as R
from leasekit.operators import split as SP
from leasekit.operators import text_vectors as TV
from leasekit.plans import oracle_sql as S
from leasekit.plans.q_split import split_features, with_split
from leasekit.plans.registry import query, rnd
from leasekit.session import materialize
from leasekit.sources.tables import read_table

# y = l_extendedprice, p = a deterministic function of the row.
P_EXPR_SQL = "l_extendedprice * (1 - l_discount) + l_tax * 1000 + l_quantity"


def _pred(spark, d):
    li = read_table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_returnflag", F.col("l_extendedprice").alias("y"),
                     (F.col("l_extendedprice") * (1 - F.col("l_discount")) + F.col("l_tax") * 1000
                      + F.col("l_quantity")).alias("prediction"))


METRIC_SQL = """round(avg(abs(y - p)), 4) AS mae, round(sqrt(avg((y - p) * (y - p))), 4) AS rmse,
  round(avg(abs((y - p) / y)) * 100, 4) AS mape,
  round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y)), 6) AS r2,
  round(median(abs(y - p)), 4) AS median_ae"""


def _round_metrics(df, keys=()):
    return df.select(*keys, *[rnd(m, 6 if m == "r2" else 4).alias(m) for m in EV.METRICS])


# ------------------------------------------------------------------ A8 A20 A7
@query("metrics", "A8", sql=f"""
WITH x AS (SELECT l_extendedprice AS y, {P_EXPR_SQL} AS p FROM lineitem)
SELECT {METRIC_SQL} FROM x""")
def q_metrics(spark, d):
    return _round_metrics(EV.compute_metrics(_pred(spark, d), "y", "prediction"))


@query("metrics_by_group", "A8 M13", sql=f"""
WITH x AS (SELECT l_returnflag AS model, l_extendedprice AS y, {P_EXPR_SQL} AS p FROM lineitem)
SELECT model, {METRIC_SQL} FROM x GROUP BY model""")
def q_metrics_group(spark, d):
    df = _pred(spark, d).withColumnRenamed("l_returnflag", "model")
    return _round_metrics(EV.compute_metrics(df, "y", "prediction", group="model"), ["model"])


@query("metrics_table", "A20 T3", sql=f"""
WITH x AS (SELECT l_returnflag AS model, l_extendedprice AS y, {P_EXPR_SQL} AS p FROM lineitem)
SELECT model, round(avg(abs(y - p)), 3) AS mae, round(sqrt(avg((y - p) * (y - p))), 3) AS rmse,
  round(avg(abs((y - p) / y)) * 100, 3) AS mape, round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y)), 3) AS r2,
  round(median(abs(y - p)), 3) AS median_ae FROM x GROUP BY model""")
def q_metrics_table(spark, d):
    df = _pred(spark, d).withColumnRenamed("l_returnflag", "model")
    long = EV.metrics_long(EV.compute_metrics(df, "y", "prediction", group="model"))
    return EV.metrics_table(long)


@query("qcut_error_analysis", "A7", sql=f"""
WITH x AS (SELECT l_extendedprice AS y, {P_EXPR_SQL} AS p FROM lineitem),
e AS (SELECT list_sort(list_distinct(quantile_cont(y, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]))) AS e FROM x),
b AS (SELECT len(list_filter(e[2:len(e) - 1], lambda v: v < y)) AS bin, y, abs(y - p) AS ae, e FROM x, e)
SELECT CAST(bin AS INTEGER) AS bin, round(e[bin + 1], 4) AS lower, round(e[bin + 2], 4) AS upper, count(*) AS n,
  round(sum(y), 3) AS sum_price, round(sum(ae), 5) AS sum_abs_error FROM b GROUP BY bin, e""")
def q_qcut(spark, d):
    # Bin means of 3-decimal prices over n rows often sit exactly on a rounding tie, so the
    # checked columns are the exact-decimal sums (mean = sum / n); means are covered in tests/.
    out = EV.qcut_error_analysis(_pred(spark, d), "y", "prediction", bins=5, decimals=None)
    return out.select("bin", rnd("lower", 4).alias("lower"), rnd("upper", 4).alias("upper"), "n",
                      rnd("sum_price", 3).alias("sum_price"), rnd("sum_abs_error", 5).alias("sum_abs_error"))


# ------------------------------------------------------------------ A17 I3
@query("group_importance", "A17 I3", sql="""
WITH imp AS (
  SELECT CASE l_linenumber % 7 WHEN 0 THEN 'num__square_feet' WHEN 1 THEN 'num__am_pool'
    WHEN 2 THEN 'text_svd_' || CAST(l_linenumber AS VARCHAR) WHEN 3 THEN 'high_card__cityname'
    WHEN 4 THEN 'low_card__state_CA' WHEN 5 THEN 'num__pets_cats' ELSE 'num__latitude' END AS feature,
    l_quantity AS importance FROM lineitem)
SELECT CASE WHEN contains(feature, 'am_') THEN 'amenities' WHEN contains(feature, 'pets_') THEN 'pets'
  WHEN contains(feature, 'text_svd_') THEN 'listing text' WHEN contains(feature, 'high_card__') THEN 'city and state'
  WHEN contains(feature, 'low_card__') THEN 'categorical' ELSE 'numeric' END AS "group",
  round(sum(importance), 4) AS importance FROM imp GROUP BY 1""")
def q_group_importance(spark, d):
    li = read_table(spark, d, "lineitem")
    m = F.col("l_linenumber") % 7
    feature = (F.when(m == 0, "num__square_feet").when(m == 1, "num__am_pool")
               .when(m == 2, F.concat(F.lit("text_svd_"), F.col("l_linenumber").cast("string")))
               .when(m == 3, "high_card__cityname").when(m == 4, "low_card__state_CA")
               .when(m == 5, "num__pets_cats").otherwise("num__latitude"))
    imp = li.select(feature.alias("feature"), F.col("l_quantity").alias("importance"))
    out = R.group_importance(imp)
    return out.select("group", rnd("importance", 4).alias("importance"))


# ------------------------------------------------------------------ J6 M3 (embeddings)
def _emb_parts(spark, d):
    emb = read_table(spark, d, "embeddings")
    s = SP.assign_split(emb, "vec_id", test_size=0.2, val_size=0.0)
    return s.filter(F.col("split") == "test"), s.filter(F.col("split") == "train")


EMB_SQL = f"""
WITH s AS (SELECT vec_id, embedding, label,
  CASE WHEN {S.md5_unit('vec_id', '42|test')} < 0.2 THEN 'test' ELSE 'train' END AS split FROM embeddings),
pairs AS (SELECT q.vec_id AS qid, r.vec_id AS rid, r.label,
  sqrt(list_sum(list_transform(list_zip(q.embedding, r.embedding),
       lambda x: (CAST(x[1] AS DOUBLE) - CAST(x[2] AS DOUBLE)) * (CAST(x[1] AS DOUBLE) - CAST(x[2] AS DOUBLE))))) AS dist
  FROM s q, s r WHERE q.split = 'test' AND r.split = 'train'),
ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(dist, 9), rid) AS rank FROM pairs)"""


@query("knn_topk", "J6", sql=EMB_SQL + """
SELECT qid, rid, CAST(rank AS INTEGER) AS rank, round(dist, 5) AS dist FROM ranked WHERE rank <= 10""")
def q_knn_topk(spark, d):
    q, r = _emb_parts(spark, d)
    out = KNN.knn_join(q, r, k=10, q_id="vec_id", r_id="vec_id", vec="embedding", block_rows=128)
    return out.select("qid", "rid", "rank", rnd("dist", 5).alias("dist"))


@query("knn_regress", "M3 J6", sql=EMB_SQL + """
SELECT qid, round(avg(label), 6) AS prediction, count(*) AS n_neighbors FROM ranked WHERE rank <= 10 GROUP BY qid""")
def q_knn_regress(spark, d):
    q, r = _emb_parts(spark, d)
    out = KNN.knn_regress(q, r, k=10, q_id="vec_id", r_id="vec_id", vec="embedding", label="label",
                          block_rows=128)
    return out.select("qid", rnd("prediction", 6).alias("prediction"), "n_neighbors")


# ------------------------------------------------------------------ E7 (documents and listing text)
def _stop_sql() -> str:
    return "[" + ", ".join(f"'{w}'" for w in presets.ENGLISH_STOP_WORDS) + "]"


def _tfidf_ctes(src_sql: str) -> str:
    acc, un = presets.ACCENTED, presets.UNACCENTED
    return f"""
d AS ({src_sql}),
tk AS (SELECT doc, list_filter(regexp_extract_all(translate(lower(coalesce(text, '')), '{acc}', '{un}'),
        '{TV.TOKEN_PATTERN}'), lambda t: NOT list_contains({_stop_sql()}, t)) AS t FROM d),
terms AS (SELECT doc, unnest(t) AS term FROM tk
  UNION ALL SELECT doc, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) FROM tk
  WHERE len(t) >= 2),
tc AS (SELECT doc, term, count(*) AS tf FROM terms GROUP BY doc, term),
st AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM tc GROUP BY term),
vocab AS (SELECT * FROM st WHERE df >= 5 ORDER BY cf DESC, term LIMIT 20000),
nd AS (SELECT count(*) AS n FROM d),
w AS (SELECT tc.doc, tc.term, (1 + ln(tf)) * (ln((1 + n) / (1 + df)) + 1) AS w FROM tc JOIN vocab USING (term), nd),
nr AS (SELECT doc, sqrt(sum(w * w)) AS norm FROM w GROUP BY doc)"""


DOC_SRC = "SELECT doc_id AS doc, text FROM documents"


@query("tfidf_vocab", "E7", sql="WITH " + _tfidf_ctes(DOC_SRC) + """
SELECT term, df, CAST(cf AS BIGINT) AS cf FROM vocab""")
def q_tfidf_vocab(spark, d):
    docs = read_table(spark, d, "documents")
    vocab, _ = TV.tfidf_fit_transform(docs, "doc_id", "text")
    return vocab.select("term", "df", F.col("cf").cast("bigint").alias("cf"))


@query("tfidf_weights", "E7", sql="WITH " + _tfidf_ctes(DOC_SRC) + """
SELECT w.doc AS doc_id, w.term, round(w.w / nr.norm, 6) AS weight FROM w JOIN nr USING (doc)""")
def q_tfidf_weights(spark, d):
    docs = read_table(spark, d, "documents")
    _, weights = TV.tfidf_fit_transform(docs, "doc_id", "text")
    return weights.select(F.col("doc").alias("doc_id"), "term", rnd("weight", 6).alias("weight"))


@query("tfidf_listings", "E7 F18", sql=lambda: with_split(_tfidf_ctes(
        "SELECT id AS doc, coalesce(title_clean, '') || ' ' || coalesce(body_clean, '') AS text FROM fsp "
        "WHERE split = 'train'")) + """
SELECT w.doc AS id, w.term, round(w.w / nr.norm, 6) AS weight FROM w JOIN nr USING (doc)""")
def q_tfidf_listings(spark, d):
    from leasekit.functions.text import join_text

    tr = split_features(spark, d).filter(F.col("split") == "train")
    docs = tr.select("id", join_text("title_clean", "body_clean").alias("text"))
    _, weights = TV.tfidf_fit_transform(docs, "id", "text")
    return weights.select(F.col("doc").alias("id"), "term", rnd("weight", 6).alias("weight"))


# ------------------------------------------------------------------ M1 M2 M10 M12 (oracle-able)
def _split_sql_ctes():
    return with_split("tr AS (SELECT * FROM fsp WHERE split = 'train')", "va AS (SELECT * FROM fsp WHERE split = 'val')")


@query("dummy_median", "M1 A8", sql=lambda: _split_sql_ctes() + """,
x AS (SELECT price AS y, (SELECT median(price) FROM tr) AS p FROM va)
SELECT """ + METRIC_SQL + " FROM x")
def q_dummy(spark, d):
    from leasekit.operators.models import MedianDummy

    df = split_features(spark, d).select("id", "split", F.col("price").alias("label"))
    model = MedianDummy().fit(df.filter(F.col("split") == "train"))
    pred = model.transform(df.filter(F.col("split") == "val"))
    return _round_metrics(EV.compute_metrics(pred, "label", "prediction"))


def _one_feature(spark, d):
    from pyspark.ml.feature import VectorAssembler

    df = split_features(spark, d).select("id", "split", "square_feet", F.col("price").alias("label"))
    return VectorAssembler(inputCols=["square_feet"], outputCol="features").transform(df)


@query("linear_ols", "M2", sql=lambda: _split_sql_ctes() + """
SELECT round(regr_slope(price, square_feet), 6) AS slope, round(regr_intercept(price, square_feet), 4) AS intercept
FROM tr""")
def q_ols(spark, d):
    from pyspark.ml.regression import LinearRegression

    model = LinearRegression(solver="normal").fit(_one_feature(spark, d).filter(F.col("split") == "train"))
    return spark.createDataFrame([(float(model.coefficients[0]), float(model.intercept))], "slope double, intercept double") \
        .select(rnd("slope", 6).alias("slope"), rnd("intercept", 4).alias("intercept"))


@query("log_target", "M12 F20", sql=lambda: _split_sql_ctes() + """,
coef AS (SELECT regr_slope(ln(1 + price), square_feet) AS b, regr_intercept(ln(1 + price), square_feet) AS a FROM tr),
x AS (SELECT price AS y, exp(a + b * square_feet) - 1 AS p FROM va, coef)
SELECT round(avg(abs(y - p)), 3) AS mae, round(median(abs(y - p)), 3) AS median_ae FROM x""")
def q_log_target(spark, d):
    from leasekit.operators.models import fit_predict

    rows = _one_feature(spark, d)
    pred, _ = fit_predict("linear_regression", rows.filter(F.col("split") == "train"), rows.filter(F.col("split") == "val"), log_target=True)
    m = EV.compute_metrics(pred, "label", "prediction")
    return m.select(rnd("mae", 3).alias("mae"), rnd("median_ae", 3).alias("median_ae"))


@query("voting_mean", "M10", sql="""
WITH x AS (SELECT l_extendedprice AS y, l_extendedprice * (1 - l_discount) AS p1, l_extendedprice * (1 + l_tax) AS p2,
  l_quantity * 1000 AS p3 FROM lineitem)
SELECT round(avg(abs(y - (p1 + p2 + p3) / 3)), 4) AS mae, count(*) AS n FROM x""")
def q_voting(spark, d):
    li = read_table(spark, d, "lineitem")
    preds = li.select(F.col("l_extendedprice").alias("y"),
                      (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("p1"),
                      (F.col("l_extendedprice") * (1 + F.col("l_tax"))).alias("p2"),
                      (F.col("l_quantity") * 1000).alias("p3"))
    from leasekit.operators.models import voting

    avg = voting(preds, ["p1", "p2", "p3"])
    return avg.agg(rnd(F.avg(F.abs(F.col("y") - F.col("prediction"))), 4).alias("mae"),
                   F.count(F.lit(1)).alias("n"))


@query("residuals", "I4", sql=lambda: _split_sql_ctes() + """
SELECT id, price AS y, round((SELECT median(price) FROM tr), 4) AS p,
  round(price - (SELECT median(price) FROM tr), 4) AS residual FROM va""")
def q_residuals(spark, d):
    from leasekit.operators.models import MedianDummy, residuals

    df = split_features(spark, d).select("id", "split", F.col("price").alias("label"))
    pred = MedianDummy().fit(df.filter(F.col("split") == "train")).transform(df.filter(F.col("split") == "val"))
    return residuals(pred, keep=["id"]).select("id", "y", rnd("p", 4).alias("p"), rnd("residual", 4).alias("residual"))


# ------------------------------------------------------------------ rows-only model stages
def _matrix(spark, d, **kw):
    from leasekit.operators.models import prepare_matrix

    return prepare_matrix(split_features(spark, d), **kw)


def _model_query(name):
    def fn(spark, d):
        from leasekit.operators.models import run_experiment

        return run_experiment(name, name, _matrix(spark, d))
    return fn


for _m, _ops in [("ridge", "M4"), ("lasso", "M5"), ("decision_tree", "M6"), ("random_forest", "M7"),
                 ("xgboost", "M8"), ("extra_trees", "M9")]:
    query(f"model_{_m}", f"{_ops} M13")(_model_query(_m))


@query("model_stacking", "M11 J8")
def q_stacking(spark, d):
    from leasekit.operators.models import run_experiment

    return run_experiment("stacking", "stacking_lgbm_rf_ridge", _matrix(spark, d))


@query("model_voting", "M10")
def q_voting_models(spark, d):
    from leasekit.operators.models import run_experiment

    return run_experiment("voting", "voting_lgbm_xgb_rf", _matrix(spark, d))


@query("baseline_suite", "M14 E12 M1 M2 M3")
def q_baseline(spark, d):
    from leasekit.operators.models import prepare_matrix, run_suite

    df = split_features(spark, d)
    raw = prepare_matrix(df, use_target_encoding=False, numeric=presets.RAW_NUMERIC, low_card=[])
    fe = prepare_matrix(df, use_target_encoding=False)
    models = ["dummy_median", "linear_regression", "knn_10"]
    return run_suite("baseline_raw", models, raw).unionByName(run_suite("baseline_fe", models, fe))


@query("split_honesty", "G7 G4 M3")
def q_split_honesty(spark, d):
    from leasekit.operators import split as SP2
    from leasekit.operators.models import prepare_matrix, run_experiment

    f = SP.add_listing_group(split_features(spark, d).drop("split"))
    out = None
    for kind, df in [("group", SP2.group_split(f)), ("naive", SP2.naive_split(f))]:
        m = prepare_matrix(df, use_target_encoding=False)
        r = run_experiment(f"split_{kind}", "knn_10", m)
        leak = SP2.leakage_check(df).select(F.lit(f"split_{kind}").alias("run"), F.lit("knn_10").alias("model"),
                                            F.lit("shared_groups").alias("metric"),
                                            F.col("shared_groups").cast("double").alias("value"))
        r = r.unionByName(leak)
        out = r if out is None else out.unionByName(r)
    return out


@query("feature_ablation", "M16 E11 E5")
def q_ablation(spark, d):
    from leasekit.operators.models import prepare_matrix, run_experiment

    df = split_features(spark, d)
    runs = [("no_te", dict(use_target_encoding=False), False), ("te", dict(), False),
            ("te_text", dict(use_text=True), False),
            ("te_text_log", dict(use_text=True), True)]
    out = None
    for name, kw, log in runs:
        r = run_experiment(name, "lightgbm", prepare_matrix(df, **kw), log_target=log)
        out = r if out is None else out.unionByName(r)
    return out


@query("model_zoo", "M15 M13 A20")
def q_zoo(spark, d):
    from leasekit.operators.evaluate import metrics_table
    from leasekit.operators.models import ZOO, run_suite

    runs = run_suite("zoo", ZOO, _matrix(spark, d))
    return metrics_table(runs.filter(F.col("metric") != "fit_seconds"))


@query("pca_variance", "E9 E10")
def q_pca(spark, d):
    from leasekit.operators.dimred import explained_variance_table, fit_pca

    m = _matrix(spark, d)
    model = fit_pca(m.data.filter(F.col("split") == "train"), k=0.95)
    return explained_variance_table(model, spark)


@query("dimred_sweep", "M18 E9 J6")
def q_dimred(spark, d):
    from leasekit.operators.dimred import pca_knn_sweep

    return pca_knn_sweep(_matrix(spark, d), presets.PCA_GRID)


@query("svd_text", "E8")
def q_svd(spark, d):
    docs = read_table(spark, d, "documents")
    vocab, weights = TV.tfidf_fit_transform(docs, "doc_id", "text")
    scores, s, _ = TV.truncated_svd(weights, vocab, k=presets.SVD_COMPONENTS)
    return scores


@query("hyper_search", "M19 M20 W1 T3")
def q_search(spark, d):
    from leasekit.operators.search import best_params, random_search

    trials = random_search(_matrix(spark, d, use_text=True))
    return best_params(trials)


@query("importance", "I1 I3 A17")
def q_importance(spark, d):
    from leasekit.operators.models import builtin_importance, make_model

    m = _matrix(spark, d)
    model = make_model("random_forest").fit(m.data.filter(F.col("split") == "train"))
    imp = builtin_importance(model, m.names, spark, top=len(m.names))
    return R.group_importance(imp)


@query("permutation_importance", "I2")
def q_perm(spark, d):
    from leasekit.operators.models import make_model, permutation_importance

    m = _matrix(spark, d, use_target_encoding=False)
    model = make_model("linear_regression").fit(m.data.filter(F.col("split") == "train"))
    return permutation_importance(model, m)


@query("final_model", "M21 A7 U1")
def q_final(spark, d):
    """Encoders and model fitted on train + val (default final parameters, text, log target), scored once on test:
    the metrics, and the error analysis by price quartile."""
    from leasekit.operators.models import fit_predict, prepare_matrix

    df = split_features(spark, d).withColumn("split", F.when(F.col("split") == "val", "train").otherwise(F.col("split")))
    m = prepare_matrix(df, use_text=True)
    pred, _ = fit_predict("final", m.data.filter("split = 'train'"), m.data.filter("split = 'test'"), log_target=True)
    pred = materialize(pred.select("label", "prediction"))
    row = EV.compute_metrics(pred, "label", "prediction").first()
    rows = [("all", k, float(row[k]) if row[k] is not None else None) for k in EV.METRICS]
    bins = EV.qcut_error_analysis(pred.withColumnRenamed("label", "y"))
    names = [c for c, kind in bins.dtypes if kind in ("double", "bigint", "int")]
    for b in bins.collect():
        rows += [(str(b[0]), c, float(b[c]) if b[c] is not None else None) for c in names]
    return spark.createDataFrame(rows, "part string, metric string, value double")


@query("leak_audit_models", "G8 M2")
def q_leak_models(spark, d):
    """The same linear model on raw numerics with and without the number read from
    the price text (the leak); the leaky variant scores far better on validation."""
    from leasekit.functions.text import money_first_number
    from leasekit.operators import split as SP2
    from leasekit.operators.models import prepare_matrix, run_experiment
    from leasekit.plans.registry import cleaned

    raw = list(presets.RAW_NUMERIC)
    read = ["id", presets.TARGET, "price_display", *raw, *presets.DEDUP_KEYS]
    df = SP2.group_split(cleaned(spark, d, read)).withColumn("display_number", money_first_number("price_display"))
    out = None
    for name, cols in [("with_leak", raw + ["display_number"]), ("without_leak", raw)]:
        m = prepare_matrix(df, numeric=cols, low_card=[], use_target_encoding=False)
        r = run_experiment(name, "linear_regression", m)
        out = r if out is None else out.unionByName(r)
    return out


@query("finalists", "M17 T3 E7 E8 M12")
def q_finalists(spark, d):
    """Text + log-target finalists, with the arg-min model by validation MAE."""
    from leasekit.operators.models import FINALISTS, prepare_matrix, run_suite

    m = prepare_matrix(split_features(spark, d), use_text=True)
    runs = run_suite("finalists", FINALISTS, m, log_target=True)
    best = runs.filter(F.col("metric") == "mae").agg(F.min_by("model", "value").alias("best_model"))
    return runs.withColumn("best_model", best.scalar())


@query("builtin_importance", "I1")
def q_builtin_importance(spark, d):
    from leasekit.operators.models import builtin_importance, make_model

    m = _matrix(spark, d)
    model = make_model("xgboost").fit(m.data.filter(F.col("split") == "train"))
    return builtin_importance(model, m.names, spark, top=25)
