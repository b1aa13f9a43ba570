"""Grouping keys, splits and leakage checks.

Splits are a column (``split`` in train/val/test), not three copies of the
data, and the assignment is a pure function of the group key and a seed
(md5 bucket), so it is identical on any cluster layout and in the DuckDB
oracle. Whole groups land in one part by construction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leasekit import presets
from leasekit.functions.hashing import unit_hash


# ----------------------------------------------------------------------- G1 F17
def listing_key(keys: Sequence[str] = presets.DEDUP_KEYS,
                decimals: int = presets.DEDUP_KEY_DECIMALS) -> Column:
    """Composite key string of the rounded key columns, joined by '|'.

    Values are printed as integers of ``round(x * 10^decimals)`` so every
    engine prints the same text; a null prints as 'nan' (``concat_ws`` would
    silently drop it and merge different keys).
    """
    scale = float(10 ** decimals)
    parts = [F.coalesce(F.round(F.col(c).cast("double") * scale).cast("bigint").cast("string"), F.lit("nan"))
             for c in keys]
    return F.concat_ws("|", *parts)


def add_listing_group(df: DataFrame, keys: Sequence[str] = presets.DEDUP_KEYS,
                      key_col: str = "listing_key", group_col: str = "listing_group",
                      dense: bool = False) -> DataFrame:
    """Add the key string and a 64-bit group id (``xxhash64`` of the key).

    ``dense=True`` gives dense 0..n-1 codes instead, in key order: the distinct keys are range-sorted and numbered
    range by range, in no single task.
    """
    out = df.withColumn(key_col, listing_key(keys))
    if not dense:
        return out.withColumn(group_col, F.xxhash64(key_col))
    from leasekit.operators.ranking import numbered

    codes, _ = numbered(out.select(key_col).distinct(), [key_col], group_col)
    return out.join(codes, key_col, "left")


# ----------------------------------------------------------------------- G2
def group_profile(df: DataFrame, key_col: str = "listing_key") -> DataFrame:
    return df.agg(F.count_distinct(key_col).alias("n_groups"), F.count(F.lit(1)).alias("n_rows")).select(
        "n_groups", "n_rows", (F.col("n_rows") / F.col("n_groups")).alias("rows_per_group"))


# ------------------------------------------------------------------- G3 G4
def assign_split(df: DataFrame, key: str | Column, test_size: float = presets.TEST_SIZE,
                 val_size: float = presets.VAL_SIZE, seed: int = presets.SEED,
                 out: str = "split") -> DataFrame:
    """train/val/test by two independent md5 buckets of ``key``: a share
    ``test_size`` of keys goes to test, then ``val_size`` of the rest to val."""
    k = F.col(key) if isinstance(key, str) else key
    u_test = unit_hash(k, f"{seed}|test")
    u_val = unit_hash(k, f"{seed}|val")
    label = (F.when(u_test < F.lit(test_size), F.lit("test"))
              .when(u_val < F.lit(val_size), F.lit("val"))
              .otherwise(F.lit("train")))
    return df.withColumn(out, label)


def group_split(df: DataFrame, key_col: str = "listing_key", **kw) -> DataFrame:
    """Whole listing groups go to one part."""
    if key_col not in df.columns:
        df = add_listing_group(df, key_col=key_col)
    return assign_split(df, key_col, **kw)


def naive_split(df: DataFrame, id_col: str = "id", **kw) -> DataFrame:
    """Row-level split (for comparison with the group split)."""
    return assign_split(df, id_col, **kw)


# ----------------------------------------------------------------------- G5
def leakage_check(df: DataFrame, split: str = "split", group_col: str = "listing_key",
                  key_cols: Sequence[str] = presets.DEDUP_KEYS, a: str = "train", b: str = "test") -> DataFrame:
    """Number of groups and of dedup keys present in both parts (must be 0).

    One aggregation per key: group by the key and test whether both parts
    occur; partial aggregation keeps hot keys cheap.
    """
    def shared(key: Column) -> Column:
        per_key = df.groupBy(key.alias("_k")).agg(
            F.max((F.col(split) == a).cast("int")).alias("_a"),
            F.max((F.col(split) == b).cast("int")).alias("_b"))
        return per_key.agg(F.count_if((F.col("_a") == 1) & (F.col("_b") == 1)).alias("n")).scalar()

    one = df.agg(F.count(F.lit(1)).alias("_n"))
    return one.select(shared(F.col(group_col)).cast("bigint").alias("shared_groups"),
                      shared(listing_key(key_cols)).cast("bigint").alias("shared_dedup_keys"))


def shared_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys present on both sides (set intersection)."""
    return left.select(key).intersect(right.select(key))


# ----------------------------------------------------------------------- G6
def split_profile(df: DataFrame, split: str = "split", target: str = presets.TARGET) -> DataFrame:
    """Size, share and the target's describe of each part. Percentiles are exact, from value counts of all parts at once
    (as many columns as parts), so no task holds a part."""
    from leasekit.operators.ranking import exact_quantiles

    total = df.agg(F.count(F.lit(1)).alias("t")).scalar()
    out = df.groupBy(split).agg(
        F.count(F.lit(1)).alias("n"), F.avg(target).alias("mean_price"),
        F.stddev_samp(target).alias("std_price"), F.min(target).alias("min_price"),
        F.max(target).alias("max_price"),
    ).withColumn("pct", 100.0 * F.col("n") / total)
    names = [r[0] for r in df.select(split).distinct().collect()]
    by_part = df.select(*[F.when(F.col(split).eqNullSafe(F.lit(n)), F.col(target)).alias(f"part{i}")
                          for i, n in enumerate(names)])
    found = exact_quantiles(by_part, by_part.columns, [0.25, 0.5, 0.75]) if names else {}
    for k, column in enumerate(("p25_price", "p50_price", "p75_price")):
        value = F.lit(None).cast("double")
        for i, n in enumerate(names):
            value = F.when(F.col(split).eqNullSafe(F.lit(n)), F.lit(found[f"part{i}"][k])).otherwise(value)
        out = out.withColumn(column, value)
    return out


# ----------------------------------------------------------------------- U1
def parts(df: DataFrame, names: Sequence[str], split: str = "split") -> DataFrame:
    """Union of parts as a filter (no copy, partition-prunable when written by split)."""
    return df.filter(F.col(split).isin(list(names)))


# -------------------------------------------------------------- S8 J5 U4
def hash_fraction_sample(df: DataFrame, fraction: float, key: str = "id", seed: int = presets.SEED) -> DataFrame:
    """Deterministic Bernoulli sample by key hash (same rows on any partitioning)."""
    return df.filter(unit_hash(F.col(key), f"{seed}|sample") < F.lit(fraction))


def hash_n_sample(df: DataFrame, n: int, key: str = "id", seed: int = presets.SEED) -> DataFrame:
    """Exactly ``min(n, rows)`` rows: the n smallest key hashes (top-n, no full sort)."""
    return df.orderBy(unit_hash(F.col(key), f"{seed}|sample"), F.col(key)).limit(n)


def complement(df: DataFrame, sample: DataFrame, key: str = "id") -> DataFrame:
    """Rows not in the sample (anti join on the key)."""
    return df.join(sample.select(key), key, "left_anti")
