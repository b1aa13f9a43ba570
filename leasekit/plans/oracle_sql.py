"""DuckDB SQL twins of the fixture views and the cleaning/feature chain.

These strings are the *independent* statement of each operator's semantics:
the driver runs them in DuckDB against the same parquet files and compares
with the Spark operator's output. They are built from the same presets, but
by hand-written SQL, not by translating the Spark plan.
"""

from __future__ import annotations

from leasekit import presets

WEEKS = "(CAST(52 AS DOUBLE) / 12)"


def lv_cte() -> str:
    fp = "CAST(CAST(floor(l.l_extendedprice / 10) AS BIGINT) AS VARCHAR)"
    return f"""
lv AS (
  SELECT
    l.l_orderkey * 10 + l.l_linenumber AS id,
    l.l_extendedprice AS row_ord_price,
    l.l_partkey AS row_ord_part,
    CASE WHEN l.l_partkey % 200 = 0 THEN 'housing/rent/home' ELSE 'housing/rent/apartment' END AS category,
    p.p_name AS title,
    'Nice ' || p.p_name || ' place, only $' || {fp} || ' per month. ' ||
      CASE WHEN l.l_linenumber = 1 THEN 'Newly renovated.'
           WHEN l.l_linenumber = 2 THEN 'Luxury, high-end.' ELSE 'Great view.' END AS body,
    CASE WHEN l.l_partkey % 6 = 0 THEN NULL ELSE
      'Parking' || CASE WHEN l.l_orderkey % 2 = 0 THEN ',Pool' ELSE '' END
                || CASE WHEN l.l_orderkey % 3 = 0 THEN ',Fireplace' ELSE '' END
                || CASE WHEN l.l_orderkey % 5 = 0 THEN ',AC' ELSE '' END
                || CASE WHEN l.l_orderkey % 7 = 0 THEN ',Internet Access' ELSE '' END
    END AS amenities,
    CASE WHEN l.l_partkey % 97 = 0 THEN NULL
         ELSE CAST(1.0 AS DOUBLE) + CAST(l.l_linenumber % 3 AS DOUBLE) * CAST(0.5 AS DOUBLE) END AS bathrooms,
    CASE WHEN l.l_partkey % 89 = 0 THEN NULL ELSE CAST(l.l_linenumber % 5 AS DOUBLE) END AS bedrooms,
    'USD' AS currency,
    CASE WHEN l.l_orderkey % 500 = 0 THEN 'Yes' ELSE 'No' END AS fee,
    CASE WHEN l.l_returnflag = 'A' THEN 'Yes' WHEN l.l_returnflag = 'N' THEN 'No' ELSE 'Thumbnail' END AS has_photo,
    CASE WHEN l.l_orderkey % 5 = 3 THEN 'Cats' WHEN l.l_orderkey % 5 = 4 THEN 'Cats,Dogs' ELSE NULL END AS pets_allowed,
    CASE WHEN l.l_orderkey % 1001 = 0 THEN NULL ELSE l.l_extendedprice / 10 END AS price,
    '$' || {fp} AS price_display,
    CASE WHEN l.l_orderkey % 700 = 0 THEN 'Weekly' WHEN l.l_orderkey % 701 = 0 THEN 'Monthly|Weekly'
         ELSE 'Monthly' END AS price_type,
    CAST(l.l_quantity * 130 AS DOUBLE) AS square_feet,
    CASE WHEN l.l_partkey % 12 = 0 THEN 'addr ' || CAST(l.l_orderkey AS VARCHAR) ELSE NULL END AS address,
    CASE WHEN l.l_partkey % 331 = 0 THEN NULL ELSE 'city_' || CAST(l.l_suppkey AS VARCHAR) END AS cityname,
    n.n_name AS state,
    CAST(25.0 AS DOUBLE) + s.s_nationkey + CAST(0.25 AS DOUBLE) * (l.l_suppkey % 4) AS latitude,
    CAST(-70.0 AS DOUBLE) - s.s_nationkey - CAST(0.25 AS DOUBLE) * (l.l_suppkey % 3) AS longitude,
    'src' || CAST(l.l_partkey % 9 AS VARCHAR) AS source,
    CAST(1544000000 + (l.l_orderkey * 7919 + l.l_linenumber * 13) % 33000000 AS BIGINT) AS "time"
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
)"""


def raw_lv_cte() -> str:
    """All-string LV with injected tokens (requires ``lv``)."""
    def tok(c: str) -> str:
        return (f"CASE WHEN id % 37 = 0 THEN 'null' WHEN id % 41 = 0 THEN 'None' "
                f"WHEN id % 43 = 0 THEN '' WHEN id % 47 = 0 THEN 'n/a' "
                f"WHEN id % 59 = 0 THEN '#N/A' WHEN id % 61 = 0 THEN 'NA' "
                f"ELSE CAST({c} AS VARCHAR) END AS {c}")

    def pad(c: str) -> str:
        return (f"CASE WHEN id % 53 = 0 THEN 'NULL' WHEN id % 11 = 0 THEN ' ' || chr(9) || {c} || '  ' "
                f"ELSE {c} END AS {c}")

    cols = ["id", "row_ord_price", "row_ord_part", pad("category"), "title", "body", "amenities",
            tok("bathrooms"), tok("bedrooms"), "currency", pad("fee"), "has_photo", "pets_allowed",
            tok("price"), "price_display", "price_type", tok("square_feet"), "address", "cityname",
            pad("state"), tok("latitude"), tok("longitude"), pad("source"), tok('"time"')]
    cols = [c.replace('AS "time"', 'AS "time"') for c in cols]
    return "raw_lv AS (SELECT " + ", ".join(cols) + " FROM lv)"


def trim_sql(c: str) -> str:
    return f"regexp_replace(CAST({c} AS VARCHAR), '^\\s+|\\s+$', '', 'g')"


def num_sql(c: str) -> str:
    return f"try_cast({c} AS DOUBLE)"


def typed_select(src: str) -> str:
    """Cast step P1–P3 as a SELECT over ``src``."""
    return f"""SELECT id, row_ord_price, row_ord_part, {trim_sql('category')} AS category, title, body, amenities,
    {num_sql('bathrooms')} AS bathrooms, {num_sql('bedrooms')} AS bedrooms, {trim_sql('currency')} AS currency,
    {trim_sql('fee')} AS fee, {trim_sql('has_photo')} AS has_photo, pets_allowed, {num_sql('price')} AS price,
    price_display, {trim_sql('price_type')} AS price_type, {num_sql('square_feet')} AS square_feet, address,
    cityname, {trim_sql('state')} AS state, {num_sql('latitude')} AS latitude, {num_sql('longitude')} AS longitude,
    {trim_sql('source')} AS source, "time",
    make_timestamp(try_cast(try_cast("time" AS DOUBLE) AS BIGINT) * 1000000) AS posted_at
  FROM {src}"""


def clean_ctes(src: str = "lv") -> str:
    """P15 chain over ``src`` -> CTE ``c`` (and intermediate ones)."""
    return f"""
dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY row_ord_price, row_ord_part) AS rn FROM {src})
  WHERE rn = 1
),
typed AS ({typed_select('dedup')}),
units AS (
  SELECT * REPLACE (
    CASE WHEN coalesce({trim_sql('price_type')}, '') = 'Weekly' THEN price * {WEEKS} ELSE price END AS price,
    CASE WHEN coalesce({trim_sql('price_type')}, '') = 'Weekly' THEN 'Monthly' ELSE price_type END AS price_type)
  FROM typed
),
kept AS (
  SELECT * REPLACE (coalesce(amenities, '') AS amenities, coalesce(pets_allowed, '') AS pets_allowed)
  FROM units
  WHERE price IS NOT NULL AND cityname IS NOT NULL AND state IS NOT NULL
    AND latitude IS NOT NULL AND longitude IS NOT NULL
),
filled AS (
  SELECT * EXCLUDE (address) REPLACE (
    coalesce(bathrooms, (SELECT median(bathrooms) FROM kept)) AS bathrooms,
    coalesce(bedrooms, (SELECT median(bedrooms) FROM kept)) AS bedrooms)
  FROM kept
),
c AS (
  SELECT * FROM filled
  WHERE price BETWEEN {presets.PRICE_MIN} AND {presets.PRICE_MAX}
    AND square_feet BETWEEN {presets.SQFT_MIN} AND {presets.SQFT_MAX}
)"""


def strip_prices_sql(c: str) -> str:
    pat = presets.PRICE_PATTERN.replace("'", "''")
    return f"regexp_replace(coalesce({c}, ''), '{pat}', ' ', 'gi')"


def word_count_sql(c: str) -> str:
    return f"len(regexp_extract_all(coalesce({c}, ''), '\\S+'))"


def features_ctes() -> str:
    """P16 chain over ``c`` -> CTE ``f``."""
    flags = ",\n    ".join(
        f"CAST(contains(lower(amenities), '{name.lower()}') AS INTEGER) AS {flag}"
        for flag, name in presets.AMENITY_FLAGS.items())
    pets = ",\n    ".join(
        f"CAST(contains(lower(pets_allowed), '{p.lower()}') AS INTEGER) AS pets_{p.lower()}"
        for p in presets.PETS_VOCAB)
    parts = "list_filter(string_split(amenities, ','), lambda x: x <> '')"
    return f"""
f1 AS (
  SELECT *,
    {flags},
    CAST(len({parts}) AS INTEGER) AS amenities_count,
    CAST(len({parts}) > 0 AS INTEGER) AS has_amenities,
    {pets},
    CAST({trim_sql('pets_allowed')} = '' AS INTEGER) AS pets_not_specified,
    {strip_prices_sql('title')} AS title_clean,
    {strip_prices_sql('body')} AS body_clean
  FROM c
),
f2 AS (
  SELECT *,
    CAST(length(title_clean) AS INTEGER) AS title_len,
    CAST(length(body_clean) AS INTEGER) AS body_len,
    CAST({word_count_sql('body_clean')} AS INTEGER) AS body_word_count,
    CAST({word_count_sql('title_clean')} AS INTEGER) AS title_word_count,
    CAST(regexp_matches(body_clean, '{presets.LUXURY_PATTERN}', 'i') AS INTEGER) AS text_luxury,
    CAST(regexp_matches(body_clean, '{presets.RENOVATED_PATTERN}', 'i') AS INTEGER) AS text_renovated,
    CAST(coalesce(bedrooms = 0, false) AS INTEGER) AS is_studio,
    square_feet / CASE WHEN bedrooms = 0 THEN 1 ELSE bedrooms END AS sqft_per_bedroom,
    bathrooms / CASE WHEN bedrooms = 0 THEN 1 ELSE bedrooms END AS bath_per_bedroom,
    bedrooms + bathrooms AS total_rooms,
    square_feet / CASE WHEN bedrooms + bathrooms = 0 THEN 1 ELSE bedrooms + bathrooms END AS sqft_per_room,
    ln(1 + square_feet) AS log_square_feet,
    latitude * longitude AS lat_lon_interaction,
    month(posted_at) AS month,
    quarter(posted_at) AS quarter,
    isodow(posted_at) - 1 AS dayofweek
  FROM f1
),
city_n AS (SELECT cityname AS _k, count(*) AS _n FROM f2 WHERE cityname IS NOT NULL GROUP BY cityname),
state_n AS (SELECT state AS _k, count(*) AS _n FROM f2 WHERE state IS NOT NULL GROUP BY state),
f AS (
  SELECT f2.* EXCLUDE (price_display, price_type, currency),
    CAST(coalesce(city_n._n, 0) AS BIGINT) AS city_listing_count,
    CAST(coalesce(state_n._n, 0) AS BIGINT) AS state_listing_count
  FROM f2
  LEFT JOIN city_n ON f2.cityname = city_n._k
  LEFT JOIN state_n ON f2.state = state_n._k
)"""


def with_lv(*ctes: str) -> str:
    return "WITH " + ",\n".join([lv_cte(), *ctes])


def with_clean(*ctes: str, raw: bool = False) -> str:
    if raw:
        return "WITH " + ",\n".join([lv_cte(), raw_lv_cte(), clean_ctes("raw_lv"), *ctes])
    return "WITH " + ",\n".join([lv_cte(), clean_ctes("lv"), *ctes])


def with_features(*ctes: str) -> str:
    return "WITH " + ",\n".join([lv_cte(), clean_ctes("lv"), features_ctes(), *ctes])


def md5_unit(key_sql: str, salt: str) -> str:
    """DuckDB twin of ``leasekit.functions.hashing.unit_hash``."""
    return (f"(CAST(CAST('0x' || substr(md5('{salt}|' || CAST({key_sql} AS VARCHAR)), 1, 8) AS BIGINT) "
            f"AS DOUBLE) / 4294967296.0)")


def md5_bucket(key_sql: str, salt: str, n: int) -> str:
    return f"CAST(floor({md5_unit(key_sql, salt)} * {n}) AS INTEGER)"
