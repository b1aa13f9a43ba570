"""Queries for sources, cleaning and features."""

from __future__ import annotations

from pyspark.sql import functions as F

from leasekit import presets
from leasekit.functions.text import (ascii_word_count, char_length, join_text, money_first_number,
                                     strip_prices)
from leasekit.operators import clean as C
from leasekit.operators import features as FE
from leasekit.operators import reports as R
from leasekit.plans import oracle_sql as S
from leasekit.plans.registry import ORDER, cleaned, featured, lv, query, raw_lv, rnd


# ------------------------------------------------------------------ S2 P1–P3
MISSING = """('null', 'NULL', '', 'none', 'None', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan',
  '1.#IND', '1.#QNAN', '<NA>', 'N/A', 'NA', 'NaN', 'n/a', 'nan')"""


@query("null_tokens", "S2", sql=lambda: S.with_lv(S.raw_lv_cte()) + f"""
SELECT id,
  CASE WHEN price IN {MISSING} THEN NULL ELSE price END AS price,
  CASE WHEN state IN {MISSING} THEN NULL ELSE state END AS state,
  CASE WHEN "time" IN {MISSING} THEN NULL ELSE "time" END AS "time"
FROM raw_lv""")
def q_null_tokens(spark, d):
    df = C.normalize_null_tokens(raw_lv(spark, d))
    return df.select("id", "price", "state", "time")


@query("cast_types", "P1 P2 P3", sql=lambda: S.with_lv(S.raw_lv_cte(), "t AS (" + S.typed_select("raw_lv") + ")") + """
SELECT id, round(price, 4) AS price, round(square_feet, 4) AS square_feet, bedrooms, bathrooms,
  latitude, longitude, category, state, fee, source, posted_at
FROM t""")
def q_cast_types(spark, d):
    df = C.cast_types(raw_lv(spark, d))
    return df.select("id", rnd("price", 4).alias("price"), rnd("square_feet", 4).alias("square_feet"),
                     "bedrooms", "bathrooms", "latitude", "longitude", "category", "state", "fee", "source",
                     "posted_at")


# ---------------------------------------------------------------- U2 W2
@query("dedupe_keep_first", "U2 W2", sql=lambda: S.with_lv("""
src AS (SELECT * FROM lv UNION ALL SELECT * FROM lv WHERE id % 50 = 0),
d AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY row_ord_price, row_ord_part) AS rn FROM src)""") + """
SELECT id, row_ord_price, row_ord_part, title, price FROM d WHERE rn = 1""")
def q_dedupe(spark, d):
    base = lv(spark, d)
    src = base.unionByName(base.filter(F.col("id") % 50 == 0))
    return C.drop_duplicates(src, "id", ORDER).select("id", "row_ord_price", "row_ord_part", "title", "price")


# ------------------------------------------------------------------ P4 P18
@query("normalize_units", "P4", sql=lambda: S.with_lv("""
u AS (SELECT id,
  CASE WHEN coalesce(trim(price_type), '') = 'Weekly' THEN price * (CAST(52 AS DOUBLE) / 12) ELSE price END AS price,
  CASE WHEN coalesce(trim(price_type), '') = 'Weekly' THEN 'Monthly' ELSE price_type END AS price_type
  FROM lv)""") + "SELECT id, round(price, 4) AS price, price_type FROM u")
def q_units(spark, d):
    df = C.normalize_price_units(lv(spark, d))
    return df.select("id", rnd("price", 4).alias("price"), "price_type")


@query("unit_exceptions", "P18", sql=lambda: S.with_lv() + """
SELECT id, price, price_type FROM lv WHERE price_type IS DISTINCT FROM 'Monthly'""")
def q_unit_exceptions(spark, d):
    return C.unit_exceptions(lv(spark, d))


@query("range_price_rows", "P18", sql=lambda: S.with_lv("""
lv2 AS (SELECT id, price, CASE WHEN id % 13 = 0 THEN price_display || ' - ' || price_display
        ELSE price_display END AS price_display FROM lv)""") + """
SELECT id, price, price_display FROM lv2 WHERE contains(price_display, ' - ')""")
def q_range_rows(spark, d):
    df = lv(spark, d).select("id", "price", F.when(F.col("id") % 13 == 0, F.concat(
        "price_display", F.lit(" - "), "price_display")).otherwise(F.col("price_display")).alias("price_display"))
    return C.range_price_rows(df)


# --------------------------------------------------------------- P5 P6 P7 P8 P10
@query("drop_missing", "P5 P6", sql=lambda: S.with_lv() + """
SELECT id, price, cityname, state FROM lv
WHERE price IS NOT NULL AND cityname IS NOT NULL AND state IS NOT NULL AND latitude IS NOT NULL
  AND longitude IS NOT NULL""")
def q_drop_missing(spark, d):
    df = C.drop_missing(lv(spark, d), [presets.TARGET])
    df = C.drop_missing(df, presets.GEO_COLUMNS)
    return df.select("id", "price", "cityname", "state")


@query("fill_optional", "P7 P8", sql=lambda: S.with_lv() + """
SELECT id, coalesce(amenities, '') AS amenities, coalesce(pets_allowed, '') AS pets_allowed,
  coalesce(bathrooms, (SELECT median(bathrooms) FROM lv)) AS bathrooms,
  coalesce(bedrooms, (SELECT median(bedrooms) FROM lv)) AS bedrooms
FROM lv""")
def q_fill_optional(spark, d):
    df = C.fill_median(C.fill_empty(lv(spark, d)))
    return df.select("id", "amenities", "pets_allowed", "bathrooms", "bedrooms")


@query("range_filter", "P10", sql=lambda: S.with_lv() + """
SELECT id, price, square_feet FROM lv
WHERE price BETWEEN 200 AND 10000 AND square_feet BETWEEN 100 AND 6000""")
def q_range_filter(spark, d):
    return C.range_filter(lv(spark, d), C.DEFAULT_BOUNDS).select("id", "price", "square_feet")


# ------------------------------------------------------------- P15 P14 P9 P11
CLEAN_COLS = ["id", "category", "title", "body", "currency", "price_display", "time", "amenities", "bathrooms", "bedrooms", "fee", "has_photo",
              "pets_allowed", "price", "price_type", "square_feet", "cityname", "state",
              "latitude", "longitude", "source", "posted_at"]


@query("clean_listings", "P15 P9", sql=lambda: S.with_clean() + """
SELECT id, category, title, body, currency, price_display, "time", amenities, bathrooms, bedrooms, fee, has_photo, pets_allowed, round(price, 4) AS price,
  price_type, square_feet, cityname, state, latitude, longitude, source, posted_at FROM c""")
def q_clean(spark, d):
    df = cleaned(spark, d)
    assert "address" not in df.columns
    return df.select(*[rnd(c, 4).alias(c) if c == "price" else F.col(c) for c in CLEAN_COLS])


@query("clean_raw_export", "S2 P15", sql=lambda: S.with_clean(raw=True) + """
SELECT id, category, bathrooms, bedrooms, round(price, 4) AS price, square_feet, state, source, posted_at FROM c""")
def q_clean_raw(spark, d):
    df = C.clean_data(raw_lv(spark, d), key="id", order=ORDER, materialize=True)
    return df.select("id", "category", "bathrooms", "bedrooms", rnd("price", 4).alias("price"),
                     "square_feet", "state", "source", "posted_at")


@query("clean_audit", "P14", sql=lambda: S.with_lv("""
dd AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY row_ord_price, row_ord_part) AS rn FROM lv),
t AS (SELECT * REPLACE (CASE WHEN coalesce(trim(price_type), '') = 'Weekly'
        THEN price * (CAST(52 AS DOUBLE) / 12) ELSE price END AS price) FROM dd WHERE rn = 1),
cnt AS (SELECT
  (SELECT count(*) FROM lv) AS n_raw,
  (SELECT count(*) FROM (SELECT DISTINCT * FROM lv)) AS n_distinct,
  (SELECT count(DISTINCT id) FROM lv) AS n_ids,
  count_if(price IS NULL) AS r_target,
  count_if(price IS NOT NULL AND (cityname IS NULL OR state IS NULL OR latitude IS NULL OR longitude IS NULL)) AS r_geo,
  count_if(price IS NOT NULL AND NOT (cityname IS NULL OR state IS NULL OR latitude IS NULL OR longitude IS NULL)
           AND NOT coalesce(price BETWEEN 200 AND 10000, false)) AS r_price,
  count_if(price IS NOT NULL AND NOT (cityname IS NULL OR state IS NULL OR latitude IS NULL OR longitude IS NULL)
           AND coalesce(price BETWEEN 200 AND 10000, false)
           AND NOT coalesce(square_feet BETWEEN 100 AND 6000, false)) AS r_sqft
  FROM t),
s AS (
  SELECT 1 AS step_no, 'full_duplicates' AS step, n_raw - n_distinct AS rows_removed, n_raw FROM cnt UNION ALL
  SELECT 2, 'duplicate_ids', n_distinct - n_ids, n_raw FROM cnt UNION ALL
  SELECT 3, 'missing_target', r_target, n_raw FROM cnt UNION ALL
  SELECT 4, 'missing_geo', r_geo, n_raw FROM cnt UNION ALL
  SELECT 5, 'price_outliers', r_price, n_raw FROM cnt UNION ALL
  SELECT 6, 'sqft_outliers', r_sqft, n_raw FROM cnt)""") + """
SELECT CAST(step_no AS INTEGER) AS step_no, step, CAST(rows_removed AS BIGINT) AS rows_removed,
  CAST(n_raw - sum(rows_removed) OVER (ORDER BY step_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
       AS BIGINT) AS rows_after
FROM s""")
def q_clean_audit(spark, d):
    return C.clean_audit(lv(spark, d), key="id", order=ORDER)


# ---------------------------------------------------------------- F1–F4
AM_COLS = list(presets.AMENITY_FLAGS)


@query("amenity_flags", "F1 F2 F3", sql=lambda: S.with_features() + f"""
SELECT id, {', '.join(AM_COLS)}, amenities_count, has_amenities FROM f""")
def q_amenity_flags(spark, d):
    df = FE.amenity_flags(cleaned(spark, d))
    return df.select("id", *AM_COLS, "amenities_count", "has_amenities")


def _token_sql():
    has = "list_contains(list_filter(string_split(amenities, ','), lambda x: x <> ''), '{}')"
    return S.with_clean() + "SELECT id, " + ",\n  ".join(
        f"CAST({has.format(value)} AS INTEGER) AS {flag}" for flag, value in presets.AMENITY_FLAGS.items()) + " FROM c"


@query("amenity_flags_token", "F1 (token mode)", sql=_token_sql)
def q_amenity_token(spark, d):
    return FE.amenity_flags(cleaned(spark, d), match="token").select("id", *AM_COLS)


@query("pets_flags", "F4", sql=lambda: S.with_features() + """
SELECT id, pets_cats, pets_dogs, pets_not_specified FROM f""")
def q_pets(spark, d):
    return FE.pets_flags(cleaned(spark, d)).select("id", "pets_cats", "pets_dogs", "pets_not_specified")


# --------------------------------------------------------------- F5–F9 F18 A18
@query("strip_prices", "F5", sql=lambda: S.with_features() + """
SELECT id, title_clean, body_clean FROM f""")
def q_strip(spark, d):
    return FE.text_features(cleaned(spark, d)).select("id", "title_clean", "body_clean")


@query("text_stats", "F6 F7", sql=lambda: S.with_features() + """
SELECT id, title_len, body_len, body_word_count, title_word_count FROM f""")
def q_text_stats(spark, d):
    return FE.text_features(cleaned(spark, d)).select(
        "id", "title_len", "body_len", "body_word_count", "title_word_count")


@query("document_word_counts", "F6 F7 (documents)", sql="""
SELECT doc_id, CAST(length(text) AS INTEGER) AS n_chars_text,
  CAST(len(regexp_extract_all(text, '[^ \\t\\n\\r\\f]+')) AS INTEGER) AS n_words,
  CAST(len(regexp_extract_all({stripped}, '[^ \\t\\n\\r\\f]+')) AS INTEGER) AS n_words_stripped
FROM documents""".replace("{stripped}", S.strip_prices_sql("text")))
def q_doc_words(spark, d):
    from leasekit.sources.tables import read_table

    docs = read_table(spark, d, "documents").select("doc_id", "text")
    return docs.select("doc_id", char_length("text").alias("n_chars_text"),
                       ascii_word_count("text").alias("n_words"),
                       ascii_word_count(strip_prices("text")).alias("n_words_stripped"))


@query("text_markers", "F8 F9", sql=lambda: S.with_features() + """
SELECT id, text_luxury, text_renovated FROM f""")
def q_markers(spark, d):
    return FE.text_features(cleaned(spark, d)).select("id", "text_luxury", "text_renovated")


@query("price_mentions", "A18", sql=f"""
SELECT count_if(regexp_matches(text, '{presets.PRICE_PATTERN}', 'i')) AS n_with, count(*) AS n FROM documents""")
def q_price_mentions(spark, d):
    from leasekit.sources.tables import read_table

    return R.pattern_coverage(read_table(spark, d, "documents"), "text")


@query("join_text", "F18", sql=lambda: S.with_features() + """
SELECT id, coalesce(title_clean, '') || ' ' || coalesce(body_clean, '') AS text_joined FROM f""")
def q_join_text(spark, d):
    df = FE.text_features(cleaned(spark, d))
    return df.select("id", join_text("title_clean", "body_clean").alias("text_joined"))


# ---------------------------------------------------------------- F10–F15 J1
@query("ratio_features", "F10 F11 F12", sql=lambda: S.with_features() + """
SELECT id, is_studio, round(sqft_per_bedroom, 6) AS sqft_per_bedroom, round(bath_per_bedroom, 6) AS bath_per_bedroom,
  round(total_rooms, 6) AS total_rooms, round(sqft_per_room, 6) AS sqft_per_room,
  round(log_square_feet, 6) AS log_square_feet FROM f""")
def q_ratio(spark, d):
    df = FE.ratio_features(cleaned(spark, d))
    return df.select("id", "is_studio", *[rnd(c, 6).alias(c) for c in [
        "sqft_per_bedroom", "bath_per_bedroom", "total_rooms", "sqft_per_room", "log_square_feet"]])


@query("time_features", "F14", sql=lambda: S.with_features() + """
SELECT id, CAST(month AS INTEGER) AS month, CAST(quarter AS INTEGER) AS quarter,
  CAST(dayofweek AS INTEGER) AS dayofweek FROM f""")
def q_time(spark, d):
    return FE.time_features(cleaned(spark, d)).select("id", "month", "quarter", "dayofweek")


@query("geo_features", "F13", sql=lambda: S.with_features() + """
SELECT id, round(lat_lon_interaction, 6) AS lat_lon_interaction FROM f""")
def q_geo(spark, d):
    return FE.geo_features(cleaned(spark, d)).select("id", rnd("lat_lon_interaction", 6).alias("lat_lon_interaction"))


@query("listing_counts", "J1 F15", sql=lambda: S.with_features() + """
SELECT id, city_listing_count, state_listing_count FROM f""")
def q_counts(spark, d):
    return FE.geo_features(cleaned(spark, d)).select("id", "city_listing_count", "state_listing_count")


# ---------------------------------------------------------------- P16 P11 P12
WHOLE_FEATURES = [*presets.AMENITY_FLAGS, "amenities_count", "has_amenities", "pets_cats", "pets_dogs", "pets_not_specified",
                  "title_len", "body_len", "body_word_count", "title_word_count", "text_luxury", "text_renovated",
                  "is_studio", "city_listing_count", "state_listing_count", "month", "quarter", "dayofweek"]
REAL_FEATURES = ["price", "bathrooms", "bedrooms", "square_feet", "latitude", "longitude", "sqft_per_bedroom",
                 "bath_per_bedroom", "total_rooms", "sqft_per_room", "log_square_feet", "lat_lon_interaction"]
TEXT_FEATURES = ["category", "title", "body", "amenities", "fee", "has_photo", "pets_allowed", "cityname", "state", "source",
                 "time", "posted_at", "title_clean", "body_clean"]


@query("build_features", "P16 P11 P12", sql=lambda: S.with_features() + "SELECT id, " + ", ".join(
    [f"CAST({c} AS BIGINT) AS {c}" for c in WHOLE_FEATURES] + [f"round({c}, 6) AS {c}" for c in REAL_FEATURES]
    + TEXT_FEATURES) + " FROM f")
def q_features(spark, d):
    df = featured(spark, d)
    for leaky in presets.LEAKY_COLUMNS:
        assert leaky not in df.columns
    assert not {"id", "listing_group"} & set(FE.column_roles(df)["numeric"])
    assert {"id", *WHOLE_FEATURES, *REAL_FEATURES, *TEXT_FEATURES} == set(df.columns), sorted(df.columns)
    return df.select("id", *[F.col(c).cast("bigint").alias(c) for c in WHOLE_FEATURES],
                     *[rnd(c, 6).alias(c) for c in REAL_FEATURES], *TEXT_FEATURES)


# ---------------------------------------------------------------- F16 G8
@query("money_first_number", "F16", sql=lambda: S.with_lv("""
m AS (SELECT id, CASE WHEN id % 9 = 0 THEN price_display || ' - $' || CAST(CAST(floor(price) AS BIGINT) + 35 AS VARCHAR)
   ELSE price_display END AS price_display FROM lv)""") + """
SELECT id, price_display,
  try_cast(nullif(replace(regexp_extract(price_display, '\\$?\\s*([\\d,]+)', 1), ',', ''), '') AS DOUBLE) AS first_number
FROM m""")
def q_money(spark, d):
    df = lv(spark, d)
    disp = F.when(F.col("id") % 9 == 0, F.concat(
        "price_display", F.lit(" - $"), (F.floor("price").cast("bigint") + 35).cast("string"))
    ).otherwise(F.col("price_display"))
    m = df.select("id", disp.alias("price_display"))
    return m.select("id", "price_display", money_first_number("price_display").alias("first_number"))


@query("leak_audit_corr", "G8", sql=lambda: S.with_clean() + """
SELECT round(corr(try_cast(nullif(replace(regexp_extract(price_display, '\\$?\\s*([\\d,]+)', 1), ',', ''), '')
  AS DOUBLE), price), 6) AS corr_display_price, count(*) AS n FROM c""")
def q_leak_corr(spark, d):
    df = cleaned(spark, d)
    return df.agg(rnd(R.safe_corr(money_first_number("price_display"), F.col("price")), 6).alias("corr_display_price"),
                  F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- P9 T5
@query("drop_columns", "P9 P11", sql=lambda: S.with_lv() + """
SELECT id, title, price FROM lv""")
def q_drop_columns(spark, d):
    df = C.drop_columns(lv(spark, d), ["address", "row_ord_price", "row_ord_part"])
    df = FE.drop_leaky(df)
    assert "address" not in df.columns and "price_display" not in df.columns
    return df.select("id", "title", "price")
