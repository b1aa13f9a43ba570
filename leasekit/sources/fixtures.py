"""Listings-shaped views over the driver tables.

``listings_view`` (LV) turns ``lineitem ⋈ part ⋈ supplier ⋈ nation`` into a table
with the 22 columns of a raw rental-listings export, with defects injected by
rules so that every cleaning/feature operator has something to do. The same
definition exists as SQL in ``leasekit.plans.oracle`` for the DuckDB check.

Joins: part and supplier are dimension tables whose size grows with the scale
factor, so no broadcast is forced; AQE measures them at runtime and broadcasts
when they fit the threshold. ``nation`` is a fixed 25-row table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leasekit.sources.tables import read_table

LV_COLUMNS = [
    "id", "row_ord_price", "row_ord_part", "category", "title", "body", "amenities",
    "bathrooms", "bedrooms", "currency", "fee", "has_photo", "pets_allowed", "price",
    "price_display", "price_type", "square_feet", "address", "cityname", "state",
    "latitude", "longitude", "source", "time",
]


def _mod(c: str, n: int) -> Column:
    return F.col(c) % F.lit(n)


def listings_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_returnflag")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    supp = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")

    j = (li.join(part, li.l_partkey == part.p_partkey)
           .join(supp, li.l_suppkey == supp.s_suppkey)
           .join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey")))

    floor_price = F.floor(F.col("l_extendedprice") / 10).cast("bigint").cast("string")
    marker = (F.when(F.col("l_linenumber") == 1, F.lit("Newly renovated."))
               .when(F.col("l_linenumber") == 2, F.lit("Luxury, high-end."))
               .otherwise(F.lit("Great view.")))

    def opt(cond: Column, text: str) -> Column:
        return F.when(cond, F.lit(text)).otherwise(F.lit(""))

    amenities = F.when(_mod("l_partkey", 6) == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("Parking"),
                 opt(_mod("l_orderkey", 2) == 0, ",Pool"),
                 opt(_mod("l_orderkey", 3) == 0, ",Fireplace"),
                 opt(_mod("l_orderkey", 5) == 0, ",AC"),
                 opt(_mod("l_orderkey", 7) == 0, ",Internet Access")))

    return j.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("bigint").alias("id"),
        F.col("l_extendedprice").alias("row_ord_price"),
        F.col("l_partkey").alias("row_ord_part"),
        F.when(_mod("l_partkey", 200) == 0, F.lit("housing/rent/home"))
         .otherwise(F.lit("housing/rent/apartment")).alias("category"),
        F.col("p_name").alias("title"),
        F.concat(F.lit("Nice "), F.col("p_name"), F.lit(" place, only $"), floor_price,
                 F.lit(" per month. "), marker).alias("body"),
        amenities.alias("amenities"),
        F.when(_mod("l_partkey", 97) == 0, F.lit(None))
         .otherwise(1.0 + (_mod("l_linenumber", 3)).cast("double") * 0.5).cast("double").alias("bathrooms"),
        F.when(_mod("l_partkey", 89) == 0, F.lit(None))
         .otherwise(_mod("l_linenumber", 5)).cast("double").alias("bedrooms"),
        F.lit("USD").alias("currency"),
        F.when(_mod("l_orderkey", 500) == 0, F.lit("Yes")).otherwise(F.lit("No")).alias("fee"),
        F.when(F.col("l_returnflag") == "A", F.lit("Yes"))
         .when(F.col("l_returnflag") == "N", F.lit("No"))
         .otherwise(F.lit("Thumbnail")).alias("has_photo"),
        F.when(_mod("l_orderkey", 5) == 3, F.lit("Cats"))
         .when(_mod("l_orderkey", 5) == 4, F.lit("Cats,Dogs")).alias("pets_allowed"),
        F.when(_mod("l_orderkey", 1001) == 0, F.lit(None))
         .otherwise(F.col("l_extendedprice") / 10).cast("double").alias("price"),
        F.concat(F.lit("$"), floor_price).alias("price_display"),
        F.when(_mod("l_orderkey", 700) == 0, F.lit("Weekly"))
         .when(_mod("l_orderkey", 701) == 0, F.lit("Monthly|Weekly"))
         .otherwise(F.lit("Monthly")).alias("price_type"),
        (F.col("l_quantity") * 130).cast("double").alias("square_feet"),
        F.when(_mod("l_partkey", 12) == 0,
               F.concat(F.lit("addr "), F.col("l_orderkey").cast("string"))).alias("address"),
        F.when(_mod("l_partkey", 331) == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("city_"), F.col("l_suppkey").cast("string"))).alias("cityname"),
        F.col("n_name").alias("state"),
        (25.0 + F.col("s_nationkey") + 0.25 * _mod("l_suppkey", 4)).cast("double").alias("latitude"),
        (-70.0 - F.col("s_nationkey") - 0.25 * _mod("l_suppkey", 3)).cast("double").alias("longitude"),
        F.concat(F.lit("src"), _mod("l_partkey", 9).cast("string")).alias("source"),
        (F.lit(1544000000) + (F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 13) % 33000000)
         .cast("bigint").alias("time"),
    )


def raw_listings_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LV as an all-string export with null tokens, junk numbers and padded labels."""
    lv = listings_view(spark, sf_dir)
    k = F.col("id")

    def tokenised(c: str) -> Column:
        s = F.col(c).cast("string")
        return (F.when(k % 37 == 0, F.lit("null"))
                 .when(k % 41 == 0, F.lit("None"))
                 .when(k % 43 == 0, F.lit(""))
                 .when(k % 47 == 0, F.lit("n/a"))
                 .when(k % 59 == 0, F.lit("#N/A"))
                 .when(k % 61 == 0, F.lit("NA"))
                 .otherwise(s))

    cols = []
    for c in LV_COLUMNS:
        if c in ("id", "row_ord_price", "row_ord_part"):
            cols.append(F.col(c))
        elif c in ("price", "square_feet", "bathrooms", "bedrooms", "latitude", "longitude", "time"):
            cols.append(tokenised(c).alias(c))
        elif c in ("category", "fee", "source", "state"):
            padded = F.when(k % 11 == 0, F.concat(F.lit(" \t"), F.col(c), F.lit("  "))).otherwise(F.col(c))
            cols.append(F.when(k % 53 == 0, F.lit("NULL")).otherwise(padded).alias(c))
        else:
            cols.append(F.col(c).cast("string").alias(c))
    return lv.select(*cols)
