"""Profiling and report operators.

Conventions: totals and other one-row statistics are scalar subqueries
(``df.agg(...).scalar()``), never a global window over row-level data, and
many statistics of one table are computed in one wide aggregate followed by
``explode(array(struct...))`` to turn columns into rows (no job per column).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leasekit import presets
from leasekit.functions.numeric import skewness_unbiased
from leasekit.functions.text import split_multi
from leasekit.operators.distinct import distinct_values
from leasekit.operators.ranking import exact_quantiles, grouped_quantiles, null_safe


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson r over pairwise-complete rows; null (not an ANSI error) when a side is constant."""
    both = x.isNotNull() & y.isNotNull()
    xs, ys = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(xs, ys), F.stddev_pop(xs) * F.stddev_pop(ys))


def _rows(df_one_row: DataFrame, structs: list[Column]) -> DataFrame:
    """Turn one wide row into many rows."""
    return df_one_row.select(F.explode(F.array(*structs)).alias("_r")).select("_r.*")


def aggregated_together(columns: Sequence[str], most: int = 8) -> list[list[str]]:
    """Columns in groups of at most ``most`` (one group at least): one aggregation of several moments of dozens of columns
    compiles to a method too large for the JVM to optimise, and takes several times as long as one after the other."""
    return [list(columns[a:a + most]) for a in range(0, max(len(columns), 1), most)]


def total_rows(df: DataFrame) -> Column:
    return df.agg(F.count(F.lit(1)).alias("n")).scalar()


# ----------------------------------------------------------------------- A1
def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Counts per value (null is a value) with its share of all rows."""
    out = (df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
             .withColumn("share", F.col("n") / total_rows(df)))
    if top is not None:
        out = out.orderBy(F.desc("n"), F.asc_nulls_last(column)).limit(top)
    return out


# ----------------------------------------------------------------------- A2
def missing_report(df: DataFrame, columns: Sequence[str] | None = None,
                   approx_distinct: bool = False) -> DataFrame:
    """Per column: n_missing, pct_missing (2 dp, half-even), dtype, n_unique.

    All columns are counted in one pass over (column, value) pairs, which map tasks deduplicate
    (``approx_distinct``: one sketch for each column instead).
    """
    columns = list(columns or df.columns)
    dtypes = dict(df.dtypes)
    if approx_distinct:
        aggs = [F.count(F.lit(1)).alias("_n")]
        for i, c in enumerate(columns):
            aggs.append(F.count_if(F.col(c).isNull()).alias(f"m{i}"))
            aggs.append(F.approx_count_distinct(F.col(c)).alias(f"u{i}"))
        wide = df.agg(*aggs)
    else:
        wide = distinct_values(df, {str(i): [c] for i, c in enumerate(columns)}).select(
            F.col("n").alias("_n"), *[F.col(f"null_{i}").alias(f"m{i}") for i in range(len(columns))],
            *[F.col(f"distinct_{i}").alias(f"u{i}") for i in range(len(columns))])
    return _rows(wide, [
        F.struct(F.lit(c).alias("column"), F.col(f"m{i}").cast("bigint").alias("n_missing"),
                 F.bround(F.try_divide(100.0 * F.col(f"m{i}"), F.col("_n")), 2).alias("pct_missing"),
                 F.lit(dtypes[c]).alias("dtype"), F.col(f"u{i}").cast("bigint").alias("n_unique"))
        for i, c in enumerate(columns)])


# ------------------------------------------------------------------------ A3
def iqr_bounds(df: DataFrame, column: str, k: float = 1.5) -> DataFrame:
    """Linear-interpolated quartiles of non-nulls, IQR fences and the count outside."""
    q1, q3 = (F.lit(q).cast("double") for q in exact_quantiles(df.select(column), [column], [0.25, 0.75])[column])
    lo, hi = q1 - F.lit(k) * (q3 - q1), q3 + F.lit(k) * (q3 - q1)
    return df.agg(F.count_if((F.col(column) < lo) | (F.col(column) > hi)).alias("n_outside")).select(
        q1.alias("q1"), q3.alias("q3"), (q3 - q1).alias("iqr"), lo.alias("lower"), hi.alias("upper"),
        F.col("n_outside").cast("bigint").alias("n_outside"))


# ------------------------------------------------------------------------ A4
def describe(df: DataFrame, columns: Sequence[str],
             percentiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """count / mean / std (sample) / min / exact percentiles / max, one row per column."""
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(c)
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"a{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).cast("double").alias(f"lo{i}"), F.max(x).cast("double").alias(f"hi{i}")]
    found = exact_quantiles(df.select(*columns), columns, percentiles)
    wide = df.agg(*aggs)
    names = [f"p{int(round(p * 100))}" for p in percentiles]
    return _rows(wide, [
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").cast("bigint").alias("count"),
                 F.col(f"a{i}").alias("mean"), F.col(f"s{i}").alias("std"), F.col(f"lo{i}").alias("min"),
                 *[F.lit(found[c][j]).cast("double").alias(nm) for j, nm in enumerate(names)],
                 F.col(f"hi{i}").alias("max"))
        for i, c in enumerate(columns)])


# ------------------------------------------------------------------------ A7 lives in evaluate
# ------------------------------------------------------------------------ A9
def group_median_top(df: DataFrame, group: str = "state", value: str = presets.TARGET,
                     min_count: int = 100, top: int = 20, approx: bool = False) -> DataFrame:
    """Median per group with HAVING count >= min_count, top n by median.

    Exact medians are selected from range-sorted counts: no task holds a group (``approx``: a sketch for each group).
    """
    n = F.count(F.lit(1)).alias("n")
    if approx:
        by_group = df.groupBy(group).agg(F.percentile_approx(value, 0.5, 10000).cast("double").alias("median_price"), n)
    else:
        from leasekit.session import materialize

        rows = materialize(df.select(F.col(group).alias(group), F.col(value).alias("_value")))
        medians = grouped_quantiles(rows, [group], ["_value"], [0.5])
        by_group = null_safe(rows.groupBy(group).agg(n), medians, [group]).select(
            group, F.col("_value")[0].alias("median_price"), "n")
    return (by_group.filter(F.col("n") >= min_count)
              .orderBy(F.desc("median_price"), F.asc(group)).limit(top))


# ----------------------------------------------------------------------- A10
def flag_effect(df: DataFrame, flags: Sequence[str], value: str = presets.TARGET,
                min_support: int = 100, strip_prefix: str = "am_") -> DataFrame:
    """median(value | flag = 1) - overall median, for flags with support >= min_support."""
    by_flag = df.select(F.col(value).alias("all"), *[F.when(F.col(fl) == 1, F.col(value)).alias(f"m{i}") for i, fl in enumerate(flags)])
    medians = {c: F.lit(v[0]).cast("double") for c, v in exact_quantiles(by_flag, by_flag.columns, [0.5]).items()}
    wide = df.agg(*[F.sum(F.col(fl)).alias(f"s{i}") for i, fl in enumerate(flags)])
    rows = _rows(wide, [
        F.struct(F.lit(fl[len(strip_prefix):] if fl.startswith(strip_prefix) else fl).alias("flag"),
                 F.col(f"s{i}").cast("bigint").alias("support"),
                 (medians[f"m{i}"] - medians["all"]).alias("effect"))
        for i, fl in enumerate(flags)])
    return rows.filter(F.col("support") >= min_support)


# ----------------------------------------------------------------------- A11
def target_correlations(df: DataFrame, columns: Sequence[str], target: str = presets.TARGET,
                        top: int = 20) -> DataFrame:
    """Pearson r of every column with the target (pairwise-complete), top n by |r|."""
    rows = None
    for some in aggregated_together(columns):
        wide = df.agg(*[safe_corr(F.col(c).cast("double"), F.col(target)).alias(f"r{i}") for i, c in enumerate(some)])
        part = _rows(wide, [F.struct(F.lit(c).alias("feature"), F.col(f"r{i}").alias("corr")) for i, c in enumerate(some)])
        rows = part if rows is None else rows.unionByName(part)
    rows = rows.filter(F.col("corr").isNotNull() & ~F.isnan("corr"))
    return rows.orderBy(F.desc(F.round(F.abs("corr"), 9)), F.asc("feature")).limit(top)


# ----------------------------------------------------------------------- A12
def skewness_report(df: DataFrame, column: str = presets.TARGET) -> DataFrame:
    return df.agg(skewness_unbiased(column).alias("skewness"), F.count(column).alias("n"))


# ----------------------------------------------------------------------- A13
def histogram(df: DataFrame, column: str, bins: int = 60, log1p: bool = False) -> DataFrame:
    """Equal-width histogram over [min, max]; the last bin is closed (as numpy)."""
    x = F.log1p(F.col(column)) if log1p else F.col(column).cast("double")
    base = df.select(x.alias("x")).filter(F.col("x").isNotNull())
    mm = base.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    lo, hi = mm.select("lo").scalar(), mm.select("hi").scalar()
    width = (hi - lo) / F.lit(bins)
    b = F.when(hi == lo, F.lit(0)).otherwise(
        F.least(F.floor((F.col("x") - lo) / width), F.lit(bins - 1))).cast("int")
    return (base.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
                .select("bin", (lo + F.col("bin") * width).alias("lower"),
                        (lo + (F.col("bin") + 1) * width).alias("upper"), "n"))


# ----------------------------------------------------------------------- A14
def token_counts(df: DataFrame, column: str, sep: str = ",") -> DataFrame:
    """Frequency of each multi-select token with % of all rows."""
    tokens = df.select(F.explode(split_multi(column, sep)).alias("token"))
    return (tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
                  .withColumn("pct_rows", 100.0 * F.col("n") / total_rows(df)))


# ----------------------------------------------------------------------- A15
def distinct_counts(df: DataFrame, columns: Sequence[str], approx: bool = False) -> DataFrame:
    """One row with the number of different non-null values of each column, from one pass."""
    if approx:
        return df.agg(*[F.approx_count_distinct(c).alias(f"n_{c}") for c in columns])
    found = distinct_values(df, {str(i): [c] for i, c in enumerate(columns)})
    return found.select(*[F.col(f"distinct_{i}").alias(f"n_{c}") for i, c in enumerate(columns)])


# ----------------------------------------------------------------------- A16
def duplicate_audit(df: DataFrame, key: str = "id",
                    key_sets: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Full-row duplicates, repeated ids and per-key-set duplicates, with % of rows."""
    key_sets = key_sets or {"dedup_keys": presets.DEDUP_KEYS}
    found = distinct_values(df, {"rows": df.columns, "key": [key], **{f"set_{n}": c for n, c in key_sets.items()}}, whole=("rows", *[f"set_{n}" for n in key_sets]))
    wide = found.select("n", F.col("distinct_rows").alias("d_rows"), F.col("distinct_key").alias("d_key"),
                        *[F.col(f"distinct_set_{n}").alias(f"d_{n}") for n in key_sets])
    kinds = [("full_rows", "d_rows"), (key, "d_key")] + [(n, f"d_{n}") for n in key_sets]
    return _rows(wide, [
        F.struct(F.lit(kind).alias("kind"), (F.col("n") - F.col(d)).cast("bigint").alias("n_duplicates"),
                 F.round(F.try_divide(100.0 * (F.col("n") - F.col(d)), F.col("n")), 4).alias("pct"))
        for kind, d in kinds])


# ----------------------------------------------------------------------- A17
def group_importance(importance: DataFrame, feature: str = "feature", value: str = "importance",
                     groups: Sequence[tuple[str, str]] = presets.IMPORTANCE_GROUPS,
                     default: str = presets.IMPORTANCE_DEFAULT_GROUP) -> DataFrame:
    """Map each feature to the first group whose prefix occurs in its name; sum per group."""
    expr = None
    for prefix, label in groups:
        cond = F.col(feature).contains(prefix)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    expr = expr.otherwise(F.lit(default))
    return (importance.groupBy(expr.alias("group")).agg(F.sum(value).alias("importance"))
                      .orderBy(F.desc("importance"), F.asc("group")))


# ----------------------------------------------------------------------- A18
def pattern_coverage(df: DataFrame, column: str, pattern: str = presets.PRICE_PATTERN) -> DataFrame:
    hit = F.coalesce(F.col(column).rlike(f"(?iU){pattern}"), F.lit(False))
    return df.agg(F.count_if(hit).cast("bigint").alias("n_with"),
                  F.count(F.lit(1)).cast("bigint").alias("n"))


# ----------------------------------------------------------------------- A19
def quantile_clip(df: DataFrame, column: str, lo: float = 0.05, hi: float = 0.95) -> DataFrame:
    low, high = exact_quantiles(df.select(column), [column], [lo, hi])[column]
    return df.sparkSession.range(1).select(F.lit(low).cast("double").alias("q_low"), F.lit(high).cast("double").alias("q_high"))


# ----------------------------------------------------------------------- A21
def clip_counts(df: DataFrame, column: str = "bedrooms", upper: float = 4) -> DataFrame:
    clipped = F.least(F.col(column), F.lit(upper))
    return df.groupBy(clipped.alias(f"{column}_clipped")).agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------------ W1
def running_min(df: DataFrame, group: str, order: str, value: str, out: str = "running_best",
                block: int = 1 << 16) -> DataFrame:
    """Cumulative minimum of ``value`` by ``order`` within ``group``.

    A plain ``Window.partitionBy(group)`` sorts a whole group in one task, which
    fails when one group holds a large share of the rows. Instead this is a
    two-level prefix scan: rows are cut into blocks of ``block`` consecutive
    ``order`` values; each block computes its local running minimum (bounded
    window), block minima (a small table) get an exclusive prefix minimum, and
    the two are combined. ``order`` must be numeric.
    """
    blk = F.floor(F.col(order) / F.lit(block)).cast("bigint")
    with_blk = df.withColumn("_blk", blk)
    local_w = (Window.partitionBy(group, "_blk").orderBy(order)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = with_blk.withColumn("_local", F.min(value).over(local_w))
    block_min = with_blk.groupBy(group, "_blk").agg(F.min(value).alias("_bmin"))
    prev_w = (Window.partitionBy(group).orderBy("_blk")
              .rowsBetween(Window.unboundedPreceding, -1))
    prefix = block_min.select(group, "_blk", F.min("_bmin").over(prev_w).alias("_prev"))
    joined = local.join(prefix, [group, "_blk"], "left")
    return joined.select(*df.columns,
                         F.least(F.col("_local"), F.coalesce(F.col("_prev"), F.col("_local"))).alias(out))


# ------------------------------------------------------------------------ W3
def gain_vs_reference(runs: DataFrame, reference: str, name: str = "model", metric: str = "mae") -> DataFrame:
    """Difference of every run's metric from a named reference run (positive = better)."""
    ref = runs.filter(F.col(name) == reference).agg(F.first(metric).alias("_ref")).scalar()
    return runs.select(name, metric, (ref - F.col(metric)).alias("gain"))


# ------------------------------------------------------------------- T1 T2 T5
def top_n(df: DataFrame, value: str, n: int = 10, tie: Sequence[str] = (), columns: Sequence[str] | None = None,
          ascending: bool = False) -> DataFrame:
    """Top-n rows by a value (TakeOrderedAndProject: per-partition top-n, then merge)."""
    order = [F.asc(value) if ascending else F.desc(value)] + [F.asc(t) for t in tie]
    out = df.orderBy(*order).limit(n)
    return out.select(*columns) if columns else out


def preview(df: DataFrame, n: int = 5, order: Sequence[str] = ("id",)) -> DataFrame:
    return df.orderBy(*order).limit(n)


# ------------------------------------------------------------------------ T3
def arg_min(df: DataFrame, what: str, by: str, group: str | None = None) -> DataFrame:
    agg = [F.min_by(what, by).alias(f"best_{what}"), F.min(by).alias(f"best_{by}")]
    return df.groupBy(group).agg(*agg) if group else df.agg(*agg)


# ------------------------------------------------------------------------ T4
def substring_search(ref: DataFrame, query: str, name: str = "cityname", weight: str = "listings",
                     limit: int = 20) -> DataFrame:
    """Case-insensitive substring match, total count, top ``limit`` by weight desc."""
    q = query.strip().lower()
    matched = ref.filter(F.lower(F.col(name)).contains(q)) if q else ref
    total = matched.agg(F.count(F.lit(1)).alias("t")).scalar()
    return (matched.orderBy(F.desc(weight), F.asc(name)).limit(limit)
                   .select(name, weight, total.alias("total")))
