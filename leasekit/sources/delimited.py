"""Delimited listing exports.

The export is ';'-separated, Windows-1252 encoded, with doubled quotes inside
quoted fields. Every column is read as a string with an explicit schema (no
inference pass over the data) and typed later by ``clean.cast_types``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leasekit import presets
from leasekit.operators.clean import normalize_null_tokens

RAW_COLUMNS = ["id", "category", "title", "body", "amenities", "bathrooms", "bedrooms", "currency", "fee",
               "has_photo", "pets_allowed", "price", "price_display", "price_type", "square_feet", "address",
               "cityname", "state", "latitude", "longitude", "source", "time"]


#: Code points of the bytes 0x80-0x9F in Windows-1252 and in ISO-8859-1 (bytes without a Windows character stay as they are).
_WINDOWS = [(bytes([b]).decode("windows-1252"), chr(b)) for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)]
WINDOWS, LATIN = ("".join(x) for x in zip(*_WINDOWS))


def _translated(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.select(*[F.translate(F.col(c), old, new).alias(c) for c in df.columns])


def read_listings_csv(spark: SparkSession, path: str, columns: Sequence[str] = RAW_COLUMNS,
                      sep: str = presets.CSV_SEP, encoding: str = presets.CSV_ENCODING,
                      multiline: bool = False) -> DataFrame:
    """S1 + S2: read the export and turn the null tokens into nulls.

    Spark 4 reads Windows-1252 only under a session-wide legacy setting, so such files are read as ISO-8859-1 and the
    characters in which the two differ are translated. ``multiLine`` is only needed when bodies contain newlines (it
    makes each file one split).
    """
    windows = encoding.lower().replace("_", "-") in ("windows-1252", "cp1252")
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    df = (spark.read.option("header", True).option("sep", sep).option("encoding", "ISO-8859-1" if windows else encoding)
          .option("quote", '"').option("escape", '"').option("multiLine", multiline)
          .schema(schema).csv(path))
    return normalize_null_tokens(_translated(df, LATIN, WINDOWS) if windows else df)


def write_listings_csv(df: DataFrame, path: str, sep: str = presets.CSV_SEP) -> None:
    """The reverse of :func:`read_listings_csv` for string columns: Windows-1252 text, spaces kept, quotes doubled."""
    (_translated(df, WINDOWS, LATIN).write.option("header", True).option("sep", sep).option("encoding", "ISO-8859-1")
     .option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
