import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from leasekit.session import ensure_checkpoint_dir, get_session

    s = get_session("local[4]", 8)
    # Tests only: no spark.checkpoint.dir is configured here, so use a fresh temp folder.
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="leasekit-test-"))
    yield s


#: Flats of the cleaning fixture: id, rooms, area, rent. One defect per cleaning rule is set by id below.
FLATS = [(f"L{k:02d}", 1 + k % 4, 38.5 * 11 + 53 * k, 745 + 61 * k) for k in range(36)]
DEFECTS = {
    "L03": {"price": ""},
    "L08": {"price": "415", "price_type": "Weekly"},
    "L12": {"price": "185000"},
    "L17": {"square_feet": "41"},
    "L21": {"cityname": None},
    "L24": {"bathrooms": None},
    "L30": {"longitude": "east"},
}
TOWNS = [("Boise", "ID", "43.61", "-116.2"), ("Omaha", "NE", "41.26", "-95.93"), ("Tulsa", "OK", "36.15", "-95.99"),
         ("Fargo", "ND", "46.88", "-96.79")]


@pytest.fixture(scope="session")
def raw_frame(spark):
    """An all-string export: FLATS with DEFECTS, the last flat listed twice, row_no as the order of listing."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    flats = spark.createDataFrame(FLATS, "id string, rooms int, area double, rent int")
    k = F.substring("id", 2, 2).cast("int")
    town = F.element_at(F.array(*[F.struct(*[F.lit(x).alias(n) for x, n in zip(t, ("c", "s", "la", "lo"))])
                                  for t in TOWNS]), k % len(TOWNS) + 1)
    full = {
        "category": F.lit("housing/rent/apartment"), "title": F.concat(F.lit("Flat "), "id", F.lit(" by the river")),
        "body": F.concat(F.lit("Rooms: "), "rooms", F.lit(". Rent $"), "rent", F.lit(" with heating.")),
        "amenities": F.when(k % 5 == 0, None).otherwise(F.lit("Elevator,Storage")),
        "bathrooms": F.when(k % 2 == 0, "1.0").otherwise("2.0"), "bedrooms": F.col("rooms").cast("string"),
        "currency": F.lit("USD"), "fee": F.lit("No"), "has_photo": F.when(k % 3 == 0, "Thumbnail").otherwise("Yes"),
        "pets_allowed": F.when(k % 4 == 1, "Dogs"), "price": F.col("rent").cast("string"),
        "price_display": F.concat(F.lit("$"), "rent"), "price_type": F.lit("Monthly"),
        "square_feet": F.col("area").cast("string"), "address": F.lit(None).cast("string"), "cityname": town["c"],
        "state": town["s"], "latitude": town["la"], "longitude": town["lo"], "source": F.lit("listings"),
        "time": (F.lit(1550000000) + 86400 * k).cast("string"),
    }
    for name in full:
        for flat, change in DEFECTS.items():
            if name in change:
                full[name] = F.when(F.col("id") == flat, F.lit(change[name])).otherwise(full[name])
    rows = flats.select("id", *[c.cast("string").alias(n) for n, c in full.items()], k.cast("long").alias("row_no"))
    assert isinstance(rows.schema["price"].dataType, T.StringType)
    return rows.unionByName(rows.where("id = 'L35'").withColumn("row_no", F.lit(99).cast("long")))
