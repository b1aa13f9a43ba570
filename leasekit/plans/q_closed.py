"""Models on few features of whole tables, where DuckDB has a closed form: normal equations, soft threshold, two components,
group means, geometric decay. The operators are those of the full-strength queries."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leasekit import presets
from leasekit.operators import models as M
from leasekit.operators.trees import Trees
from leasekit.plans.registry import query, rnd
from leasekit.sources.tables import read_table


def _lines(spark: SparkSession, d: str, *features: str) -> DataFrame:
    """``id, grp, label, features``: an order line's price by columns of ``lineitem``; ``grp`` is the first feature."""
    rows = read_table(spark, d, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_extendedprice").cast("double").alias("label"),
        *(F.expr(f).cast("double").alias(f"x{k}") for k, f in enumerate(features)))
    made = VectorAssembler(inputCols=[f"x{k}" for k in range(len(features))], outputCol="features").transform(rows)
    return made.select("id", F.col("x0").alias("grp"), "label", "features")


def _groups(pred: DataFrame) -> DataFrame:
    """What a model predicts for each value of the first feature, and whether it is one number."""
    return pred.groupBy(F.col("grp").cast("int").alias("grp")).agg(
        F.count("*").alias("n"), rnd(F.avg("prediction"), 3).alias("prediction"),
        (F.max("prediction") - F.min("prediction") < 1e-6).alias("one_value"))


RIDGE_ALPHA = 50_000.0


@query("ridge_two_features", "M4", sql=f"""
WITH s AS (SELECT count(*) * var_pop(x) + {RIDGE_ALPHA} AS xx, count(*) * var_pop(z) + {RIDGE_ALPHA} AS zz, count(*) * covar_pop(x, z) AS xz,
  count(*) * covar_pop(x, y) AS xy, count(*) * covar_pop(z, y) AS zy, avg(x) AS mx, avg(z) AS mz, avg(y) AS my
  FROM (SELECT CAST(l_quantity AS DOUBLE) AS x, CAST(l_discount AS DOUBLE) * 100 AS z, CAST(l_extendedprice AS DOUBLE) AS y FROM lineitem)),
w AS (SELECT (xy * zz - zy * xz) / (xx * zz - xz * xz) AS a, (zy * xx - xy * xz) / (xx * zz - xz * xz) AS b, mx, mz, my FROM s)
SELECT round(a, 4) AS quantity, round(b, 4) AS discount, round(my - a * mx - b * mz, 3) AS intercept FROM w""")
def q_ridge(spark, d):
    """The penalised normal equations of two features, the intercept free."""
    rows = _lines(spark, d, "l_quantity", "l_discount * 100")
    n, std = rows.agg(F.count("*"), F.stddev_pop("label")).first()
    model = M.ridge(RIDGE_ALPHA, n, std).fit(rows)
    return spark.createDataFrame([(*map(float, model.coefficients), float(model.intercept))], "quantity double, discount double, intercept double") \
        .select(rnd("quantity", 4).alias("quantity"), rnd("discount", 4).alias("discount"), rnd("intercept", 3).alias("intercept"))


LASSO_ALPHA = 20_000.0


@query("lasso_one_feature", "M5", sql=f"""
WITH s AS (SELECT var_pop(x) AS v, covar_pop(x, y) AS c, avg(x) AS mx, avg(y) AS my
  FROM (SELECT CAST(l_quantity AS DOUBLE) AS x, CAST(l_extendedprice AS DOUBLE) AS y FROM lineitem)),
w AS (SELECT sign(c) * greatest(abs(c) - {LASSO_ALPHA}, 0) / v AS a, mx, my FROM s)
SELECT round(a, 2) AS quantity, round(my - a * mx, 0) AS intercept FROM w""")
def q_lasso(spark, d):
    """The soft threshold of one feature's covariance."""
    model = M.lasso(LASSO_ALPHA).fit(_lines(spark, d, "l_quantity"))
    return spark.createDataFrame([(float(model.coefficients[0]), float(model.intercept))], "quantity double, intercept double") \
        .select(rnd("quantity", 2).alias("quantity"), rnd("intercept", 0).alias("intercept"))


_MEANS = """
SELECT CAST({g} AS INTEGER) AS grp, count(*) AS n, round(avg(CAST(l_extendedprice AS DOUBLE)), 3) AS prediction, true AS one_value
FROM lineitem GROUP BY 1"""


@query("decision_tree_groups", "M6", sql=_MEANS.format(g="l_linenumber"))
def q_tree(spark, d):
    """A tree on one feature of few values ends in their means."""
    rows = _lines(spark, d, "l_linenumber")
    return _groups(M.make_model("decision_tree").fit(rows).transform(rows))


@query("extra_trees_groups", "M9", sql=_MEANS.format(g="l_linenumber"))
def q_extra(spark, d):
    """Random cuts to purity, without a bootstrap: every tree ends in the means, wherever its cuts fall."""
    rows = _lines(spark, d, "l_linenumber")
    return _groups(M.tree_parameters("extra_trees").fit(rows).transform(rows))


@query("forest_step_function", "M7", sql=_MEANS.format(g="l_linenumber"))
def q_forest(spark, d):
    """Targets that are the same for all rows of a value come back from any bootstrap: the target here is the value's mean."""
    rows = _lines(spark, d, "l_linenumber")
    means = rows.groupBy("grp").agg(F.avg("label").alias("label"))  # a row a value
    rows = rows.drop("label").join(means, "grp")
    return _groups(M.tree_parameters("random_forest").fit(rows).transform(rows))


BOOST = dict(trees=40, rate=0.1, depth=1, l2=2000.0)


@query("boost_decay", "M8", sql=f"""
WITH g AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS grp, count(*) AS n, avg(CAST(l_extendedprice AS DOUBLE)) AS m FROM lineitem GROUP BY 1),
a AS (SELECT avg(CAST(l_extendedprice AS DOUBLE)) AS base FROM lineitem)
SELECT grp, n, round(base + (m - base) * (1 - pow(1 - {BOOST['rate']} * n / (n + {BOOST['l2']}), {BOOST['trees']})), 3) AS prediction, true AS one_value
FROM g, a""")
def q_boost(spark, d):
    """Stumps on one flag: each round takes the share rate * n / (n + L2) of what a group still lacks."""
    rows = _lines(spark, d, "CAST(l_returnflag = 'R' AS INT)")
    return _groups(Trees("boost", **BOOST).fit(rows).transform(rows))


@query("pca_two_features", "E9 E10", sql="""
WITH r AS (SELECT abs(corr(CAST(l_quantity AS DOUBLE), CAST(l_extendedprice AS DOUBLE))) AS r FROM lineitem)
SELECT 1 AS component, round((1 + r) / 2, 4) AS explained, round((1 + r) / 2, 4) AS cumulative, (1 + r) / 2 >= 0.95 AS reaches_threshold FROM r
UNION ALL SELECT 2, round((1 - r) / 2, 4), 1.0, (1 + r) / 2 < 0.95 FROM r""")
def q_pca_two(spark, d):
    """The components of two standardised features explain (1 + |r|) / 2 and (1 - |r|) / 2."""
    from leasekit.operators.dimred import explained_variance_table, fit_pca

    return explained_variance_table(fit_pca(_lines(spark, d, "l_quantity", "l_extendedprice"), 2), spark)


POSTED = "2024-03-09 17:45:00"


@query("listing_rows", "F22 F23", sql=f"""
SELECT o_orderkey AS id, concat_ws(',', CASE WHEN o_orderkey % 2 = 0 THEN 'Pool' END, CASE WHEN o_orderkey % 3 = 0 THEN 'Gym' END) AS amenities,
  CASE WHEN o_orderkey % 5 = 0 THEN 'Cats,Dogs' WHEN o_orderkey % 5 = 1 THEN 'Cats' ELSE '' END AS pets_allowed,
  CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE o_orderpriority END AS title, CASE WHEN o_orderkey % 11 = 0 THEN 'Yes' ELSE 'No' END AS has_photo,
  CAST(TIMESTAMP '{POSTED}' AS VARCHAR) AS posted_at, 'cat' AS category
FROM orders""")
def q_listing_rows(spark, d):
    """Requests made of orders, as listings: lists to comma texts (null: empty), the posting time a parameter, defaults filled."""
    from leasekit.operators.score import to_listing_rows

    key = F.col("o_orderkey")
    when = lambda by, rest, then: F.when(key % by == rest, then)
    requests = read_table(spark, d, "orders").select(
        key.alias("request_id"), F.array_compact(F.array(when(2, 0, F.lit("Pool")), when(3, 0, F.lit("Gym")))).alias("amenities"),
        F.coalesce(when(5, 0, F.array(F.lit("Cats"), F.lit("Dogs"))), when(5, 1, F.array(F.lit("Cats")))).alias("pets_allowed"),
        F.when(key % 7 != 0, F.col("o_orderpriority")).alias("title"), F.lit(None).cast("string").alias("body"),
        F.when(key % 11 != 0, "No").alias("has_photo"))
    rows = to_listing_rows(requests, {"category": "cat", "fee": "No", "source": "web"}, POSTED)
    return rows.select("id", "amenities", "pets_allowed", "title", "has_photo", F.col("posted_at").cast("string").alias("posted_at"), "category")


@query("model_card_ols", "V3 M2 A8", sql=f"""
WITH t AS (SELECT CAST(l_quantity AS DOUBLE) AS x, CAST(l_extendedprice AS DOUBLE) AS y, l_linenumber % 4 = 0 AS held FROM lineitem),
w AS (SELECT regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM t WHERE NOT held),
p AS (SELECT y, y - (a * x + b) AS e FROM t, w WHERE held)
SELECT 'LinearRegression' AS model_type, round(avg(abs(e)), 3) AS mae, round(sqrt(avg(e * e)), 3) AS rmse, round(avg(abs(e / y)) * 100, 3) AS mape,
  round(1 - sum(e * e) / (var_pop(y) * count(*)), 3) AS r2, round(median(abs(e)), 3) AS median_ae, 1 AS n_features,
  {len(presets.AMENITIES_VOCAB)} AS n_amenities
FROM p""")
def q_card_ols(spark, d):
    """The card of a straight line through three quarters of the lines, judged on the others."""
    from leasekit.operators.score import model_card

    rows = _lines(spark, d, "l_quantity").withColumn("split", F.when(F.col("id") % 10 % 4 == 0, "val").otherwise("train"))
    runs = M.run_experiment("card", "linear_regression", M.Matrix(rows, ["quantity"]))
    card = model_card(runs, "LinearRegression", 1, spark)
    return card.withColumn("n_amenities", F.size("amenities")).drop("amenities")
