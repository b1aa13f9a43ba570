"""Exact numbers of different values of many columns and key sets in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Texts up to this length are compared as they are, longer ones by their SHA-256 digest (which is longer than this).
SHORT = 64

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _text(c: Column, kind: T.DataType) -> Column:
    """A text that is equal for equal values of one type, and only for those."""
    if isinstance(kind, T.StringType):
        return c
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return (c + F.lit(0).cast(kind)).cast("string")  # -0.0 equals 0.0
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("string")
    if isinstance(kind, T.BinaryType):
        return F.hex(c)
    if isinstance(kind, (T.ArrayType, T.StructType)):
        return F.when(c.isNotNull(), F.to_json(F.struct(c), {"ignoreNullFields": "false"}))
    return c.cast("string")


def _short(text: Column) -> Column:
    return F.when(F.length(text) <= SHORT, text).otherwise(F.concat(F.lit("sha256:"), F.sha2(text, 256)))


def _row_text(df: DataFrame, columns: Sequence[str]) -> Column:
    """Values with their lengths, so that different rows have different texts; a null has no length."""
    parts = []
    for c in columns:
        text = _text(F.col(c), df.schema[c].dataType)
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.concat(*parts)


def distinct_values(df: DataFrame, sets: dict[str, Sequence[str]], whole: Sequence[str] = ()) -> DataFrame:
    """One row: ``n`` rows, and for each named set of columns ``distinct_<name>`` and ``null_<name>``.

    A single column counts its different non-null values and its nulls; the sets named in ``whole``, and those of several
    columns, count different rows, in which null is a value. Each row becomes one (set, value) pair for each set;
    map tasks deduplicate them, and what is left is shuffled once, as numbers or short texts: a long text counts by its
    SHA-256 digest. No wide row is grouped and the input is read once. An empty table gives zeros.
    """
    whole_text, columns_of, pairs = {}, {}, []
    for i, (name, columns) in enumerate(sets.items()):
        kind, c = df.schema[columns[0]].dataType, F.col(columns[0])
        if len(columns) > 1 or name in whole:
            whole_text[f"_t{i}"] = _row_text(df, columns)
        elif isinstance(kind, _WHOLE):
            columns_of[f"_l{i}"] = c.cast("long")
        elif isinstance(kind, (T.FloatType, T.DoubleType)):
            columns_of[f"_d{i}"] = c.cast("double")
        else:
            whole_text[f"_t{i}"] = _text(c, kind)
        of = lambda at, as_type: F.col(at) if at in columns_of or at in whole_text else F.lit(None).cast(as_type)
        pairs.append(F.struct(F.lit(i).alias("k"), of(f"_l{i}", "long").alias("l"), of(f"_d{i}", "double").alias("d"), of(f"_t{i}", "string").alias("t")))
    # Each text is made once, then shortened.
    plain = df.select(*[c.alias(n) for n, c in {**columns_of, **whole_text}.items()])
    plain = plain.select(*columns_of, *[_short(F.col(t)).alias(t) for t in whole_text])
    rows = plain.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")
    values = rows.groupBy("k", "l", "d", "t").agg(F.count("*").alias("n"))
    empty = F.col("l").isNull() & F.col("d").isNull() & F.col("t").isNull()
    by_set = values.groupBy("k").agg(F.sum("n").alias("n"), F.count_if(~empty).alias("values"),
                                     F.sum(F.when(empty, F.col("n")).otherwise(0)).alias("nulls"))
    of = lambda i, c: F.coalesce(F.max(F.when(F.col("k") == i, F.col(c))), F.lit(0))
    return by_set.agg(of(0, "n").alias("n"), *[of(i, c).alias(f"{out}_{name}") for i, name in enumerate(sets)
                                               for out, c in (("distinct", "values"), ("null", "nulls"))])
