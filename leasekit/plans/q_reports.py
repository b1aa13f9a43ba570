"""Queries for profiling reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from leasekit import presets
from leasekit.operators import reports as R
from leasekit.plans import oracle_sql as S
from leasekit.plans.registry import cleaned, featured, lv, query, rnd
from leasekit.sources.tables import read_table


# ------------------------------------------------------------------ A9 (flagship)
@query("state_price_top", "A9 T2", sql=lambda: S.with_features() + """
SELECT state, round(median(price), 4) AS median_price, count(*) AS n FROM f
GROUP BY state HAVING count(*) >= 100 ORDER BY median(price) DESC, state LIMIT 20""")
def q_state_price_top(spark, d):
    out = R.group_median_top(featured(spark, d), "state", "price", min_count=100, top=20)
    return out.select("state", rnd("median_price", 4).alias("median_price"), "n")


# ------------------------------------------------------------------ A1
@query("value_counts", "A1", sql=lambda: S.with_lv() + """
SELECT has_photo, count(*) AS n, round(count(*) / (SELECT count(*) FROM lv), 6) AS share
FROM lv GROUP BY has_photo""")
def q_value_counts(spark, d):
    out = R.value_counts(lv(spark, d), "has_photo")
    return out.select("has_photo", "n", rnd("share", 6).alias("share"))


@query("value_counts_top", "A1 T2", sql=lambda: S.with_lv() + """
SELECT cityname, count(*) AS n FROM lv GROUP BY cityname ORDER BY count(*) DESC, cityname NULLS LAST LIMIT 10""")
def q_value_counts_top(spark, d):
    return R.value_counts(lv(spark, d), "cityname", top=10).select("cityname", "n")


# ------------------------------------------------------------------ A2
MISSING_TYPES = {"id": "bigint", **dict.fromkeys(["bathrooms", "bedrooms", "price", "square_feet", "latitude", "longitude"], "double"),
                 **dict.fromkeys(["category", "title", "body", "amenities", "currency", "fee", "has_photo", "pets_allowed",
                                  "price_display", "price_type", "address", "cityname", "state", "source"], "string"),
                 "time": "bigint"}
MISSING_COLS = list(MISSING_TYPES)


def _missing_sql():
    dtypes = MISSING_TYPES
    parts = [f"""SELECT '{c}' AS "column", CAST(count_if("{c}" IS NULL) AS BIGINT) AS n_missing,
  round_even(100.0 * count_if("{c}" IS NULL) / count(*), 2) AS pct_missing, '{dtypes[c]}' AS dtype,
  CAST(count(DISTINCT "{c}") AS BIGINT) AS n_unique FROM lv""" for c in MISSING_COLS]
    return S.with_lv() + "\nUNION ALL\n".join(parts)


@query("missing_report", "A2", sql=_missing_sql)
def q_missing(spark, d):
    return R.missing_report(lv(spark, d), MISSING_COLS)


# ------------------------------------------------------------------ A3 A4
@query("iqr_bounds", "A3", sql=lambda: S.with_lv("""
q AS (SELECT quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3 FROM lv)""") + """
SELECT round(q1, 4) AS q1, round(q3, 4) AS q3, round(q3 - q1, 4) AS iqr, round(q1 - 1.5 * (q3 - q1), 4) AS lower,
  round(q3 + 1.5 * (q3 - q1), 4) AS upper,
  (SELECT count_if(price < q1 - 1.5 * (q3 - q1) OR price > q3 + 1.5 * (q3 - q1)) FROM lv) AS n_outside
FROM q""")
def q_iqr(spark, d):
    out = R.iqr_bounds(lv(spark, d), "price")
    return out.select(*[rnd(c, 4).alias(c) for c in ["q1", "q3", "iqr", "lower", "upper"]], "n_outside")


DESCRIBE_COLS = ["l_extendedprice", "l_quantity", "l_discount"]


def _describe_sql():
    parts = [f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean,
  round(stddev_samp({c}), 4) AS std, round(min({c}), 4) AS min, round(quantile_cont({c}, 0.25), 4) AS p25,
  round(quantile_cont({c}, 0.5), 4) AS p50, round(quantile_cont({c}, 0.75), 4) AS p75,
  round(max({c}), 4) AS max FROM lineitem""" for c in DESCRIBE_COLS]
    return "\nUNION ALL\n".join(parts)


@query("describe", "A4", sql=_describe_sql)
def q_describe(spark, d):
    out = R.describe(read_table(spark, d, "lineitem"), DESCRIBE_COLS)
    return out.select("column", "count", *[rnd(c, 4).alias(c) for c in
                                           ["mean", "std", "min", "p25", "p50", "p75", "max"]])


# ------------------------------------------------------------------ A10 A11 A12 A13
AM_FLAGS = list(presets.AMENITY_FLAGS)


def _effect_sql():
    parts = [f"""SELECT '{c[3:]}' AS flag, CAST(sum({c}) AS BIGINT) AS support,
  round(median(CASE WHEN {c} = 1 THEN price END) - (SELECT median(price) FROM f), 4) AS effect FROM f"""
             for c in AM_FLAGS]
    return S.with_features() + "SELECT * FROM (" + "\nUNION ALL\n".join(parts) + ") WHERE support >= 100"


@query("amenity_effect", "A10", sql=_effect_sql)
def q_effect(spark, d):
    out = R.flag_effect(featured(spark, d), AM_FLAGS, "price", min_support=100)
    return out.select("flag", "support", rnd("effect", 4).alias("effect"))


CORR_COLS = [*AM_FLAGS, "amenities_count", "has_amenities", "pets_cats", "pets_dogs", "pets_not_specified", "title_len",
             "body_len", "body_word_count", "title_word_count", "text_luxury", "text_renovated", "is_studio",
             "bathrooms", "bedrooms", "square_feet", "latitude", "longitude", "sqft_per_bedroom", "bath_per_bedroom",
             "total_rooms", "sqft_per_room", "log_square_feet", "city_listing_count", "state_listing_count",
             "lat_lon_interaction", "month", "quarter", "dayofweek"]


def _corr_sql():
    parts = [f"SELECT '{c}' AS feature, corr(CAST({c} AS DOUBLE), price) AS r FROM f" for c in CORR_COLS]
    return S.with_features("cr AS (" + "\nUNION ALL\n".join(parts) + ")") + """
SELECT feature, round(r, 6) AS corr FROM cr WHERE r IS NOT NULL AND NOT isnan(r)
ORDER BY round(abs(r), 9) DESC, feature LIMIT 20"""


@query("correlations", "A11 T2", sql=_corr_sql)
def q_corr(spark, d):
    out = R.target_correlations(featured(spark, d), CORR_COLS, "price", top=20)
    return out.select("feature", rnd("corr", 6).alias("corr"))


@query("skewness", "A12", sql=lambda: S.with_features() + """
SELECT round(skewness(price), 6) AS skewness, count(price) AS n FROM f""")
def q_skew(spark, d):
    return R.skewness_report(featured(spark, d), "price").select(rnd("skewness", 6).alias("skewness"), "n")


def _hist_sql(col: str, bins: int, log: bool):
    x = f"ln(1 + {col})" if log else f"CAST({col} AS DOUBLE)"
    return f"""
WITH b AS (SELECT {x} AS x FROM lineitem WHERE {col} IS NOT NULL),
mm AS (SELECT min(x) AS lo, max(x) AS hi FROM b),
h AS (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((x - lo) / ((hi - lo) / {bins})), {bins - 1}) END AS INTEGER)
      AS bin, lo, hi FROM b, mm)
SELECT bin, round(lo + bin * ((hi - lo) / {bins}), 4) AS lower, round(lo + (bin + 1) * ((hi - lo) / {bins}), 4) AS upper,
  count(*) AS n FROM h GROUP BY bin, lo, hi"""


@query("histogram", "A13", sql=_hist_sql("l_extendedprice", 60, False))
def q_hist(spark, d):
    out = R.histogram(read_table(spark, d, "lineitem"), "l_extendedprice", bins=60)
    return out.select("bin", rnd("lower", 4).alias("lower"), rnd("upper", 4).alias("upper"), "n")


@query("histogram_log", "A13 F20", sql=_hist_sql("l_extendedprice", 80, True))
def q_hist_log(spark, d):
    out = R.histogram(read_table(spark, d, "lineitem"), "l_extendedprice", bins=80, log1p=True)
    return out.select("bin", rnd("lower", 4).alias("lower"), rnd("upper", 4).alias("upper"), "n")


# ------------------------------------------------------------------ A14 A15 A16
@query("token_counts", "A14", sql=lambda: S.with_lv("""
t AS (SELECT unnest(list_filter(string_split(coalesce(amenities, ''), ','), lambda x: x <> '')) AS token FROM lv)""") + """
SELECT token, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM lv), 4) AS pct_rows FROM t GROUP BY token""")
def q_tokens(spark, d):
    out = R.token_counts(lv(spark, d), "amenities")
    return out.select("token", "n", rnd("pct_rows", 4).alias("pct_rows"))


@query("distinct_counts", "A15", sql=lambda: S.with_lv() + """
SELECT count(DISTINCT cityname) AS n_cityname, count(DISTINCT state) AS n_state FROM lv""")
def q_distinct(spark, d):
    return R.distinct_counts(lv(spark, d), ["cityname", "state"])


@query("dup_audit", "A16", sql=lambda: S.with_lv("""
src AS (SELECT * FROM lv UNION ALL SELECT * FROM lv WHERE id % 50 = 0),
cnt AS (SELECT (SELECT count(*) FROM src) AS n,
  (SELECT count(*) FROM (SELECT DISTINCT * FROM src)) AS d_rows,
  (SELECT count(DISTINCT id) FROM src) AS d_key,
  (SELECT count(*) FROM (SELECT DISTINCT latitude, longitude, square_feet, bedrooms, bathrooms FROM src)) AS d_k)""") + """
SELECT 'full_rows' AS kind, n - d_rows AS n_duplicates, round(100.0 * (n - d_rows) / n, 4) AS pct FROM cnt UNION ALL
SELECT 'id', n - d_key, round(100.0 * (n - d_key) / n, 4) FROM cnt UNION ALL
SELECT 'dedup_keys', n - d_k, round(100.0 * (n - d_k) / n, 4) FROM cnt""")
def q_dup_audit(spark, d):
    base = lv(spark, d)
    src = base.unionByName(base.filter(F.col("id") % 50 == 0))
    return R.duplicate_audit(src, "id")


# ------------------------------------------------------------------ A19 A21
@query("quantile_clip", "A19", sql=lambda: S.with_features() + """
SELECT round(quantile_cont(price, 0.05), 4) AS q_low, round(quantile_cont(price, 0.95), 4) AS q_high FROM f""")
def q_qclip(spark, d):
    out = R.quantile_clip(featured(spark, d), "price")
    return out.select(rnd("q_low", 4).alias("q_low"), rnd("q_high", 4).alias("q_high"))


@query("clip_bedrooms", "A21", sql=lambda: S.with_features() + """
SELECT least(bedrooms, 4) AS bedrooms_clipped, count(*) AS n FROM f GROUP BY 1""")
def q_clip(spark, d):
    return R.clip_counts(featured(spark, d), "bedrooms", 4)


# ------------------------------------------------------------------ W1 W3 T3 M20 (orders as trials)
@query("running_best", "W1", sql="""
SELECT o_orderkey AS number, o_orderpriority AS study, round(o_totalprice, 2) AS mae,
  round(min(o_totalprice) OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS running_best
FROM orders""")
def q_running_best(spark, d):
    trials = read_table(spark, d, "orders").select(
        F.col("o_orderkey").alias("number"), F.col("o_orderpriority").alias("study"),
        F.col("o_totalprice").alias("mae"))
    out = R.running_min(trials, "study", "number", "mae", block=4096)
    return out.select("number", "study", rnd("mae", 2).alias("mae"), rnd("running_best", 2).alias("running_best"))


@query("best_trial", "T3 M20", sql="""
SELECT o_orderpriority AS study, arg_min(o_orderkey, o_totalprice) AS best_number,
  round(min(o_totalprice), 2) AS best_mae FROM orders GROUP BY o_orderpriority""")
def q_best_trial(spark, d):
    trials = read_table(spark, d, "orders").select(
        F.col("o_orderkey").alias("number"), F.col("o_orderpriority").alias("study"),
        F.col("o_totalprice").alias("mae"))
    out = R.arg_min(trials, "number", "mae", group="study")
    return out.select("study", "best_number", rnd("best_mae", 2).alias("best_mae"))


@query("gain_vs_reference", "W3", sql="""
WITH s AS (SELECT o_orderpriority AS model, avg(o_totalprice) AS mae FROM orders GROUP BY 1)
SELECT model, round(mae, 4) AS mae, round((SELECT mae FROM s WHERE model = '1-URGENT') - mae, 4) AS gain FROM s""")
def q_gain(spark, d):
    runs = (read_table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("model"))
            .agg(F.avg("o_totalprice").alias("mae")))
    out = R.gain_vs_reference(runs, "1-URGENT")
    return out.select("model", rnd("mae", 4).alias("mae"), rnd("gain", 4).alias("gain"))


# ------------------------------------------------------------------ T1 T5
@query("nlargest", "T1", sql="""
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 10""")
def q_nlargest(spark, d):
    return R.top_n(read_table(spark, d, "lineitem"), "l_extendedprice", 10, tie=["l_orderkey", "l_linenumber"],
                   columns=["l_orderkey", "l_linenumber", "l_extendedprice"])


@query("preview", "T5", sql=lambda: S.with_clean() + """
SELECT id, title, round(price, 4) AS price FROM c ORDER BY id LIMIT 5""")
def q_preview(spark, d):
    return R.preview(cleaned(spark, d), 5).select("id", "title", rnd("price", 4).alias("price"))
