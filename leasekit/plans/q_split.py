"""Queries for grouping keys, splits, leakage, samples and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from leasekit.operators import lookup as L
from leasekit.operators import split as SP
from leasekit.plans import oracle_sql as S
from leasekit.plans.registry import featured, query, rnd
from leasekit.sources.tables import read_table


def key_sql() -> str:
    parts = [f"coalesce(CAST(CAST(round({c} * 1000000.0) AS BIGINT) AS VARCHAR), 'nan')"
             for c in ["latitude", "longitude", "square_feet", "bedrooms", "bathrooms"]]
    return "concat_ws('|', " + ", ".join(parts) + ")"


def split_sql(key: str) -> str:
    return (f"CASE WHEN {S.md5_unit(key, '42|test')} < 0.2 THEN 'test' "
            f"WHEN {S.md5_unit(key, '42|val')} < 0.2 THEN 'val' ELSE 'train' END")


def with_split(*ctes: str) -> str:
    return S.with_features(f"fs AS (SELECT *, {key_sql()} AS listing_key FROM f)",
                           f"fsp AS (SELECT *, {split_sql('listing_key')} AS split FROM fs)", *ctes)


def split_features(spark, d):
    return SP.group_split(featured(spark, d))


# ------------------------------------------------------------------ G1 G2
@query("listing_group", "G1 F17", sql=lambda: with_split() + "SELECT id, listing_key FROM fs")
def q_listing_group(spark, d):
    df = SP.add_listing_group(featured(spark, d))
    return df.select("id", "listing_key")


@query("group_profile", "G2", sql=lambda: with_split() + """
SELECT count(DISTINCT listing_key) AS n_groups, count(*) AS n_rows,
  round(count(*) / count(DISTINCT listing_key), 6) AS rows_per_group FROM fs""")
def q_group_profile(spark, d):
    out = SP.group_profile(SP.add_listing_group(featured(spark, d)))
    return out.select("n_groups", "n_rows", rnd("rows_per_group", 6).alias("rows_per_group"))


# ------------------------------------------------------------------ G3 G4 G5 G6
@query("group_split", "G3", sql=lambda: with_split() + "SELECT id, listing_key, split FROM fsp")
def q_group_split(spark, d):
    return split_features(spark, d).select("id", "listing_key", "split")


@query("naive_split", "G4", sql=lambda: S.with_features() + f"SELECT id, {split_sql('id')} AS split FROM f")
def q_naive_split(spark, d):
    return SP.naive_split(featured(spark, d)).select("id", "split")


def _leak_sql(split_expr: str) -> str:
    return with_split(f"x AS (SELECT listing_key, {split_expr} AS sp FROM fsp)", """
k AS (SELECT listing_key, max(CASE WHEN sp = 'train' THEN 1 ELSE 0 END) AS a,
             max(CASE WHEN sp = 'test' THEN 1 ELSE 0 END) AS b FROM x GROUP BY listing_key)""") + """
SELECT CAST(count_if(a = 1 AND b = 1) AS BIGINT) AS shared_groups,
       CAST(count_if(a = 1 AND b = 1) AS BIGINT) AS shared_dedup_keys FROM k"""


@query("leakage_check", "G5 J4", sql=lambda: _leak_sql("split"))
def q_leakage(spark, d):
    return SP.leakage_check(split_features(spark, d))


@query("leakage_check_naive", "G5 G7", sql=lambda: _leak_sql(split_sql("id")))
def q_leakage_naive(spark, d):
    df = SP.naive_split(SP.add_listing_group(featured(spark, d)))
    return SP.leakage_check(df)


@query("shared_keys", "U3 J4", sql=lambda: with_split() + """
SELECT count(*) AS n_shared FROM (SELECT listing_key FROM fs WHERE (""" + split_sql("id") + """) = 'train'
  INTERSECT SELECT listing_key FROM fs WHERE (""" + split_sql("id") + """) = 'test')""")
def q_shared_keys(spark, d):
    df = SP.naive_split(SP.add_listing_group(featured(spark, d)))
    tr, te = df.filter(F.col("split") == "train"), df.filter(F.col("split") == "test")
    return SP.shared_keys(tr, te, "listing_key").agg(F.count(F.lit(1)).alias("n_shared"))


@query("split_profile", "G6", sql=lambda: with_split() + """
SELECT split, count(*) AS n, round(avg(price), 4) AS mean_price, round(stddev_samp(price), 4) AS std_price,
  round(min(price), 4) AS min_price, round(max(price), 4) AS max_price,
  round(quantile_cont(price, 0.25), 5) AS p25_price, round(quantile_cont(price, 0.5), 5) AS p50_price,
  round(quantile_cont(price, 0.75), 5) AS p75_price,
  round(100.0 * count(*) / (SELECT count(*) FROM fsp), 4) AS pct FROM fsp GROUP BY split""")
def q_split_profile(spark, d):
    out = SP.split_profile(split_features(spark, d))
    # Quartiles of 3-decimal prices have 5 decimals: at fewer, a tie may fall either way.
    return out.select("split", "n", *[rnd(c, 5 if c[0] == "p" and c != "pct" else 4).alias(c) for c in
                                      ["mean_price", "std_price", "min_price", "max_price", "p25_price",
                                       "p50_price", "p75_price", "pct"]])


@query("train_val_union", "U1", sql=lambda: with_split() + """
SELECT id, split FROM fsp WHERE split = 'train' UNION ALL SELECT id, split FROM fsp WHERE split = 'val'""")
def q_union(spark, d):
    return SP.parts(split_features(spark, d), ["train", "val"]).select("id", "split")


# ------------------------------------------------------------------ S8 J5 U4
@query("anti_sample", "S8 J5 U4", sql=f"""
WITH s AS (SELECT o_orderkey FROM orders WHERE {S.md5_unit('o_orderkey', '42|sample')} < 0.8)
SELECT o_orderkey, round(o_totalprice, 2) AS o_totalprice FROM orders
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s)""")
def q_anti_sample(spark, d):
    orders = read_table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    sample = SP.hash_fraction_sample(orders, 0.8, key="o_orderkey")
    out = SP.complement(orders, sample, key="o_orderkey")
    return out.select("o_orderkey", rnd("o_totalprice", 2).alias("o_totalprice"))


@query("sample_n", "S8", sql=f"""
SELECT o_orderkey FROM orders ORDER BY {S.md5_unit('o_orderkey', '42|sample')}, o_orderkey LIMIT 1000""")
def q_sample_n(spark, d):
    orders = read_table(spark, d, "orders").select("o_orderkey")
    return SP.hash_n_sample(orders, 1000, key="o_orderkey")


# ------------------------------------------------------------------ A5 A6 T4
def _city_ref_sql() -> str:
    return with_split("""
tr AS (SELECT * FROM fsp WHERE split = 'train'),
ms AS (SELECT cityname, state, row_number() OVER (PARTITION BY cityname ORDER BY count(*) DESC, state) AS rn
       FROM tr GROUP BY cityname, state),
cr AS (SELECT tr.cityname, count(*) AS listings, round_even(median(price), 0) AS median_price,
       round_even(median(latitude), 4) AS latitude, round_even(median(longitude), 4) AS longitude
       FROM tr WHERE cityname IS NOT NULL GROUP BY tr.cityname)""")


@query("city_reference", "A5", sql=lambda: _city_ref_sql() + """
SELECT cr.cityname, cr.listings, cr.median_price, cr.latitude, cr.longitude, ms.state
FROM cr JOIN ms ON cr.cityname = ms.cityname AND ms.rn = 1""")
def q_city_ref(spark, d):
    tr = split_features(spark, d).filter(F.col("split") == "train")
    return L.city_reference(tr).select("cityname", "listings", "median_price", "latitude", "longitude", "state")


@query("state_reference", "A5", sql=lambda: with_split() + """
SELECT state, count(*) AS listings FROM fsp WHERE split = 'train' GROUP BY state""")
def q_state_ref(spark, d):
    return L.state_reference(split_features(spark, d).filter(F.col("split") == "train"))


def _mode_sql(c: str) -> str:
    return (f"(SELECT {c} FROM (SELECT {c}, count(*) AS n FROM tr GROUP BY {c}) "
            f"ORDER BY n DESC, {c} LIMIT 1) AS {c}")


@query("defaults", "A6", sql=lambda: with_split("tr AS (SELECT * FROM fsp WHERE split = 'train')") + f"""
SELECT {_mode_sql('category')}, {_mode_sql('fee')}, {_mode_sql('has_photo')}, {_mode_sql('source')},
  (SELECT round(median(price), 4) FROM tr) AS median_price,
  (SELECT count(DISTINCT source) FROM tr) AS n_sources""")
def q_defaults(spark, d):
    out = L.defaults(split_features(spark, d).filter(F.col("split") == "train"))
    return out.select("category", "fee", "has_photo", "source", rnd("median_price", 4).alias("median_price"),
                      "n_sources")


@query("sources_list", "A6", sql=lambda: with_split() + """
SELECT DISTINCT source FROM fsp WHERE split = 'train' AND source IS NOT NULL""")
def q_sources(spark, d):
    return L.sources(split_features(spark, d).filter(F.col("split") == "train"))


@query("city_search", "T4", sql=lambda: _city_ref_sql() + """
SELECT cityname, listings, (SELECT count(*) FROM cr WHERE contains(lower(cityname), '12')) AS total
FROM cr WHERE contains(lower(cityname), '12') ORDER BY listings DESC, cityname LIMIT 20""")
def q_city_search(spark, d):
    from leasekit.operators.reports import substring_search

    tr = split_features(spark, d).filter(F.col("split") == "train")
    return substring_search(L.city_reference(tr), " 12 ", "cityname", "listings", limit=20)


@query("listing_group_dense", "W4 G1", sql=lambda: with_split() + """
SELECT id, CAST(dense_rank() OVER (ORDER BY listing_key) - 1 AS BIGINT) AS listing_group FROM fs""")
def q_group_dense(spark, d):
    df = SP.add_listing_group(featured(spark, d), dense=True)
    return df.select("id", "listing_group")
