"""Queries for encoders fitted on the training part."""

from __future__ import annotations

from pyspark.sql import functions as F

from leasekit.operators import encode as E
from leasekit.operators import split as SP
from leasekit.plans import oracle_sql as S
from leasekit.plans.q_split import split_features, split_sql, with_split
from leasekit.plans.registry import lv, query, rnd


def lv_split(spark, d):
    return SP.naive_split(lv(spark, d))


def with_lv_split(*ctes: str) -> str:
    return S.with_lv(f"ls AS (SELECT *, {split_sql('id')} AS split FROM lv)", *ctes)


# ------------------------------------------------------------------ E1
@query("impute_median", "E1", sql=lambda: with_lv_split() + """
SELECT id, split,
  coalesce(bathrooms, (SELECT median(bathrooms) FROM ls WHERE split = 'train')) AS bathrooms,
  coalesce(bedrooms, (SELECT median(bedrooms) FROM ls WHERE split = 'train')) AS bedrooms,
  round(coalesce(price, (SELECT median(price) FROM ls WHERE split = 'train')), 4) AS price
FROM ls""")
def q_impute_median(spark, d):
    df = lv_split(spark, d)
    cols = ["bathrooms", "bedrooms", "price"]
    out = E.apply_fill(df, E.fit_median(df, cols), cols)
    return out.select("id", "split", "bathrooms", "bedrooms", rnd("price", 4).alias("price"))


# ------------------------------------------------------------------ E2
STD_COLS = ["square_feet", "bathrooms", "latitude", "amenities_count"]


@query("standardize", "E2", sql=lambda: with_split("tr AS (SELECT * FROM fsp WHERE split = 'train')") + """
SELECT id, split, """ + ", ".join(
    f"round(({c} - (SELECT avg({c}) FROM tr)) / coalesce(nullif((SELECT stddev_pop({c}) FROM tr), 0), 1), 6) AS {c}"
    for c in STD_COLS) + " FROM fsp")
def q_standardize(spark, d):
    df = split_features(spark, d)
    out = E.apply_standard(df, E.fit_standard(df, STD_COLS), STD_COLS)
    return out.select("id", "split", *[rnd(c, 6).alias(c) for c in STD_COLS])


# ------------------------------------------------------------------ E3
def _mode_sql(c: str) -> str:
    return (f"(SELECT {c} FROM (SELECT {c}, count(*) AS n FROM ls WHERE split = 'train' AND {c} IS NOT NULL "
            f"GROUP BY {c}) ORDER BY n DESC, {c} LIMIT 1)")


@query("impute_mode", "E3", sql=lambda: with_lv_split() + f"""
SELECT id, coalesce(pets_allowed, {_mode_sql('pets_allowed')}) AS pets_allowed,
  coalesce(cityname, {_mode_sql('cityname')}) AS cityname FROM ls""")
def q_impute_mode(spark, d):
    df = lv_split(spark, d)
    cols = ["pets_allowed", "cityname"]
    out = E.apply_fill(df, E.fit_mode(df, cols), cols)
    return out.select("id", "pets_allowed", "cityname")


# ------------------------------------------------------------------ E4
OH_COLS = ["category", "has_photo", "source", "state"]


def _onehot_sql() -> str:
    cols = []
    return with_lv_split("""
lv_t AS (SELECT * FROM ls WHERE split = 'train'),
lev AS (SELECT 'category' AS col, category AS level, count(*) AS n FROM lv_t GROUP BY category
  UNION ALL SELECT 'has_photo', has_photo, count(*) FROM lv_t GROUP BY has_photo
  UNION ALL SELECT 'source', source, count(*) FROM lv_t GROUP BY source
  UNION ALL SELECT 'state', state, count(*) FROM lv_t GROUP BY state)""") + """
SELECT ls.id,
  (SELECT CASE WHEN n >= 50 THEN level ELSE 'infrequent_sklearn' END FROM lev WHERE col = 'category' AND level = ls.category) AS category_level,
  (SELECT CASE WHEN n >= 50 THEN level ELSE 'infrequent_sklearn' END FROM lev WHERE col = 'has_photo' AND level = ls.has_photo) AS has_photo_level,
  (SELECT CASE WHEN n >= 50 THEN level ELSE 'infrequent_sklearn' END FROM lev WHERE col = 'source' AND level = ls.source) AS source_level,
  (SELECT CASE WHEN n >= 50 THEN level ELSE 'infrequent_sklearn' END FROM lev WHERE col = 'state' AND level = ls.state) AS state_level
FROM ls""" + ("" if not cols else "")


@query("onehot_minfreq", "E4", sql=_onehot_sql)
def q_onehot(spark, d):
    df = lv_split(spark, d)
    levels = E.fit_onehot(df, OH_COLS)
    out = df.select("id", *OH_COLS)
    for c in OH_COLS:
        out = E.onehot_pooled_level(out, levels, c)
    return out.select("id", *[f"{c}_level" for c in OH_COLS])


@query("onehot_columns", "E4", sql=lambda: with_lv_split("""
lv_t AS (SELECT * FROM ls WHERE split = 'train'),
lev AS (SELECT 'category' AS col, category AS level, count(*) AS n FROM lv_t GROUP BY category
  UNION ALL SELECT 'price_type', price_type, count(*) FROM lv_t GROUP BY price_type),
enc AS (
  SELECT id, 'category_' || (SELECT CASE WHEN n >= 50 THEN level ELSE 'infrequent_sklearn' END
                             FROM lev WHERE col = 'category' AND level = ls.category) AS feature FROM ls
  UNION ALL
  SELECT id, 'price_type_' || (SELECT CASE WHEN n >= 50 THEN level ELSE 'infrequent_sklearn' END
                               FROM lev WHERE col = 'price_type' AND level = ls.price_type) FROM ls)""") + """
SELECT id, feature FROM enc WHERE feature IS NOT NULL""")
def q_onehot_cols(spark, d):
    """Explicit one-hot columns, reported as the (row, active column) pairs."""
    df = lv_split(spark, d)
    cols = ["category", "price_type"]
    wide = E.apply_onehot(df.select("id", *cols), E.fit_onehot(df, cols), drop_input=True)
    feats = [c for c in wide.columns if c != "id"]
    pairs = wide.select("id", F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").alias("v")) for c in feats])).alias("p"))
    return pairs.filter(F.col("p.v") == 1).select("id", F.col("p.feature").alias("feature"))


# ------------------------------------------------------------------ E5 E6 J3
def _te_oof_sql(cat: str) -> str:
    fold = S.md5_bucket("id", "42|fold", 5)
    return with_split(f"""
t AS (SELECT id, {cat} AS cat, price AS y, {fold} AS fold FROM fsp WHERE split = 'train'),
r AS (SELECT a.id, a.fold, count(b.y) AS n, avg(b.y) AS m, var_pop(b.y) AS w
      FROM t a LEFT JOIN t b ON a.cat IS NOT DISTINCT FROM b.cat AND a.fold <> b.fold GROUP BY a.id, a.fold),
g AS (SELECT k.fold, avg(t.y) AS gm, var_pop(t.y) AS gv FROM (SELECT DISTINCT fold FROM t) k
      JOIN t ON t.fold <> k.fold GROUP BY k.fold),
e AS (SELECT r.id, r.fold, r.n, r.m, r.w, g.gm, g.gv,
      CASE WHEN r.n * g.gv + r.w = 0 THEN NULL ELSE r.n * g.gv / (r.n * g.gv + r.w) END AS lam
      FROM r JOIN g ON r.fold = g.fold)""") + f"""
SELECT id, fold, round(CASE WHEN n = 0 OR lam IS NULL THEN gm ELSE lam * m + (1 - lam) * gm END, 4) AS {cat}_te
FROM e"""


@query("target_encode_oof", "E5", sql=lambda: _te_oof_sql("cityname"))
def q_te_oof(spark, d):
    out = E.target_encode_oof(split_features(spark, d), "cityname")
    return out.select("id", "fold", rnd("cityname_te", 4).alias("cityname_te"))


@query("target_encode_oof_state", "E5", sql=lambda: _te_oof_sql("state"))
def q_te_oof_state(spark, d):
    out = E.target_encode_oof(split_features(spark, d), "state")
    return out.select("id", "fold", rnd("state_te", 4).alias("state_te"))


@query("target_encode_apply", "E6 J3", sql=lambda: with_split("""
t AS (SELECT cityname AS cat, price AS y FROM fsp WHERE split = 'train'),
gm AS (SELECT avg(y) AS gm, var_pop(y) AS gv FROM t),
cs AS (SELECT cat, count(*) AS n, avg(y) AS m, var_pop(y) AS w FROM t GROUP BY cat),
e AS (SELECT cs.cat, CASE WHEN n * gv + w = 0 THEN gm ELSE (n * gv / (n * gv + w)) * m + (1 - n * gv / (n * gv + w)) * gm END
      AS enc FROM cs, gm)""") + """
SELECT id, split, round(coalesce(e.enc, (SELECT gm FROM gm)), 4) AS cityname_te
FROM fsp LEFT JOIN e ON fsp.cityname IS NOT DISTINCT FROM e.cat WHERE split <> 'train'""")
def q_te_apply(spark, d):
    df = split_features(spark, d)
    train = df.filter(F.col("split") == "train")
    enc = E.fit_target_encoding(df, "cityname")
    out = E.apply_target_encoding(df.filter(F.col("split") != "train"), enc, "cityname", train=train)
    return out.select("id", "split", rnd("cityname_te", 4).alias("cityname_te"))
