"""Feature encoders fitted on one part and applied to any part.

Every encoder is a pair ``fit(df) -> stats DataFrame`` and
``apply(df, stats) -> DataFrame``. Stats are aggregates of the training
part: one row (medians, means, modes) or one row per category. One-row stats
enter ``apply`` as scalar subqueries; per-category stats are joined back
with plain joins that AQE turns into broadcasts after measuring them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leasekit import presets
from leasekit.functions.hashing import bucket
from leasekit.operators.ranking import exact_quantiles


def _train(df: DataFrame, split: str | None, part: str = "train") -> DataFrame:
    return df.filter(F.col(split) == part) if split else df


# ----------------------------------------------------------------------- E1
def fit_median(df: DataFrame, columns: Sequence[str], split: str | None = "split",
               approx: bool = False) -> DataFrame:
    """One row of medians; exact ones are selected from range-sorted counts, so no task holds a column."""
    src = _train(df, split)
    if approx:
        return src.agg(*[F.percentile_approx(c, 0.5, 10000).cast("double").alias(c) for c in columns])
    found = exact_quantiles(src.select(*columns), columns, [0.5])
    return df.sparkSession.range(1).select(*[F.lit(found[c][0]).cast("double").alias(c) for c in columns])


def _one_row(stats: DataFrame) -> dict:
    """Fitted one-row statistics, fetched once (a single bounded row) and inlined
    as literals: scalar subqueries would embed the whole upstream plan once per column."""
    row = stats.first()
    return row.asDict() if row is not None else {}


def apply_fill(df: DataFrame, stats: DataFrame | dict, columns: Sequence[str]) -> DataFrame:
    vals = stats if isinstance(stats, dict) else _one_row(stats)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(vals[c])) for c in columns if vals.get(c) is not None})


# ----------------------------------------------------------------------- E2
def fit_standard(df: DataFrame, columns: Sequence[str], split: str | None = "split") -> DataFrame:
    """Mean and population std (zero std -> 1) per column, on the training part."""
    src = _train(df, split)
    aggs = []
    for c in columns:
        aggs += [F.avg(c).alias(f"{c}__mean"),
                 F.coalesce(F.nullif(F.stddev_pop(c), F.lit(0.0)), F.lit(1.0)).alias(f"{c}__std")]
    return src.agg(*aggs)


def apply_standard(df: DataFrame, stats: DataFrame | dict, columns: Sequence[str]) -> DataFrame:
    vals = stats if isinstance(stats, dict) else _one_row(stats)
    return df.withColumns({
        c: (F.col(c) - F.lit(vals[f"{c}__mean"])) / F.lit(vals[f"{c}__std"])
        for c in columns if vals.get(f"{c}__mean") is not None})


# ----------------------------------------------------------------------- E3
def fit_mode(df: DataFrame, columns: Sequence[str], split: str | None = "split") -> DataFrame:
    """Most frequent value per column (ties -> smallest)."""
    return _train(df, split).agg(*[F.mode(c, True).alias(c) for c in columns])


# ----------------------------------------------------------------------- E4
def fit_onehot(df: DataFrame, columns: Sequence[str], split: str | None = "split",
               min_frequency: int = presets.ONEHOT_MIN_FREQUENCY) -> DataFrame:
    """Level table ``(column, level, n, kept)``: levels seen < min_frequency times are pooled."""
    src = _train(df, split)
    parts = [src.groupBy(F.col(c).cast("string").alias("level")).agg(F.count(F.lit(1)).alias("n"))
                .withColumn("column", F.lit(c)) for c in columns]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("kept", F.col("n") >= min_frequency).select("column", "level", "n", "kept")


def onehot_levels(levels: DataFrame) -> dict[str, tuple[list[str], bool]]:
    """Kept levels of each column and whether a pooled one exists. Only kept levels come to the driver (each has at
    least ``min_frequency`` rows and makes a column of the result); rare ones are told apart by a join."""
    out: dict[str, tuple[list[str], bool]] = {}
    summary = levels.groupBy("column").agg(F.sort_array(F.collect_list(F.when(F.col("kept"), F.col("level")))).alias("kept"),
                                           F.coalesce(F.bool_or(~F.col("kept") & F.col("level").isNotNull()), F.lit(False)).alias("pooled"))
    for r in summary.orderBy("column").collect():
        out[r["column"]] = (list(r["kept"]), r["pooled"])
    return out


def apply_onehot(df: DataFrame, levels: DataFrame, infrequent: str = presets.ONEHOT_INFREQUENT_LABEL,
                 drop_input: bool = False, names: dict[str, tuple[list[str], bool]] | None = None) -> DataFrame:
    """Explicit 0/1 columns ``<col>_<level>`` (+ ``<col>_<infrequent>``) from the level table. A level that training
    had too rarely is pooled; one that it never had (or null) is all zeros."""
    names = onehot_levels(levels) if names is None else names
    out = df
    new: dict[str, Column] = {}
    for c, (kept, pooled) in names.items():
        out = onehot_pooled_level(out, levels, c, infrequent, f"_{c}_level")
        for lv in [*kept, *([infrequent] if pooled else [])]:
            new[f"{c}_{lv}"] = F.coalesce(F.col(f"_{c}_level") == lv, F.lit(False)).cast("int")
    out = out.withColumns(new).drop(*[f"_{c}_level" for c in names])
    return out.drop(*names) if drop_input else out


def onehot_pooled_level(df: DataFrame, levels_df: DataFrame, column: str,
                        infrequent: str = presets.ONEHOT_INFREQUENT_LABEL, out: str | None = None) -> DataFrame:
    """Per-row encoded level (kept level, pooled label, or null when unknown) by a join to the level table."""
    out = out or f"{column}_level"
    lv = levels_df.filter(F.col("column") == column).select(
        F.col("level").alias("_lvl"), F.when(F.col("kept"), F.col("level")).otherwise(F.lit(infrequent)).alias(out))
    return df.join(lv, F.col(column).cast("string") == F.col("_lvl"), "left").drop("_lvl")


# ------------------------------------------------------------------ E5 E6 J3
def _te_stats(df: DataFrame, cat: str, y: str, fold: str | None) -> DataFrame:
    keys = [F.col(cat).alias("_cat")] + ([F.col(fold).alias("_fold")] if fold else [])
    return df.groupBy(*keys).agg(F.count(y).alias("_n"), F.sum("_yc").alias("_s"),
                                 F.sum(F.col("_yc") * F.col("_yc")).alias("_q"))


def _shrink(n: Column, s: Column, q: Column, mean_c: Column, var_y: Column, mean_y: Column) -> Column:
    """Empirical-Bayes blend of the category mean with the global mean.

    lambda = n*V / (n*V + s2), V = variance of y on the fitting rows,
    s2 = within-category population variance; unseen category -> global mean.
    """
    cat_mean = F.try_divide(s, n)
    within = F.try_divide(q, n) - cat_mean * cat_mean
    lam = F.try_divide(n * var_y, n * var_y + within)
    enc = lam * (cat_mean + mean_c) + (F.lit(1.0) - lam) * mean_y
    return F.when((n.isNull()) | (n == 0) | lam.isNull() | F.isnan(lam), mean_y).otherwise(enc)


def target_encode_oof(df: DataFrame, cat: str, y: str = presets.TARGET, id_col: str = "id",
                      folds: int = presets.TE_FOLDS, seed: int = presets.SEED,
                      out: str | None = None, split: str | None = "split",
                      centre: float | None = None) -> DataFrame:
    """E5: cross-fitted target encoding of the training rows.

    A row in fold k is encoded with statistics of the training rows outside
    fold k. All folds come from one ``groupBy(cat, fold)`` of (n, Σy, Σy²):
    out-of-fold sums are "category total minus own fold", so the cost is one
    aggregation regardless of the number of folds (no loop of jobs). y is
    centred on the training mean first so Σy² differences do not cancel.
    Returns the training rows with ``fold`` and the encoding column.
    """
    out = out or f"{cat}_te"
    train = _train(df, split)
    centre = F.lit(centre if centre is not None else train.agg(F.avg(y)).first()[0])
    t = (train.withColumn("fold", bucket(F.col(id_col), f"{seed}|fold", folds))
              .withColumn("_yc", F.col(y) - centre))

    per_fold = _te_stats(t, cat, y, "fold")
    per_cat = per_fold.groupBy(F.col("_cat").alias("_tcat")).agg(
        F.sum("_n").alias("_tn"), F.sum("_s").alias("_ts"), F.sum("_q").alias("_tq"))
    stats = per_fold.join(per_cat, F.col("_cat").eqNullSafe(F.col("_tcat"))).select(
        "_cat", F.col("_fold").alias("_sfold"), (F.col("_tn") - F.col("_n")).alias("_on"),
        (F.col("_ts") - F.col("_s")).alias("_os"), (F.col("_tq") - F.col("_q")).alias("_oq"))

    # Global out-of-fold mean/variance: one row per fold (a proven bound), broadcast.
    g_fold = t.groupBy(F.col("fold").alias("_gfold")).agg(
        F.count(y).alias("_gn"), F.sum("_yc").alias("_gs"), F.sum(F.col("_yc") * F.col("_yc")).alias("_gq"))
    g_all = g_fold.agg(F.sum("_gn").alias("n"), F.sum("_gs").alias("s"), F.sum("_gq").alias("q")).first()
    gn = F.lit(g_all["n"]) - F.col("_gn")
    gs = F.lit(g_all["s"]) - F.col("_gs")
    gq = F.lit(g_all["q"]) - F.col("_gq")
    g = g_fold.select("_gfold", (gs / gn).alias("_gm"), (gq / gn - (gs / gn) * (gs / gn)).alias("_gv"))

    rows = (t.join(stats, F.col(cat).eqNullSafe(F.col("_cat")) & (F.col("fold") == F.col("_sfold")), "left")
             .join(F.broadcast(g), F.col("fold") == F.col("_gfold")))
    enc = _shrink(F.col("_on"), F.col("_os"), F.col("_oq"), F.lit(0.0) + centre,
                  F.col("_gv"), F.col("_gm") + centre)
    return rows.select(*df.columns, "fold", enc.alias(out))


def target_encoding_table(df: DataFrame, cat: str, y: str, split: str | None, id_col: str, mean: float,
                          folds: int = presets.TE_FOLDS, seed: int = presets.SEED) -> DataFrame:
    """E5 and E6 in one table ``_cat, _fold, _enc``: the encoding of a training row of each fold (from the other
    folds), and under fold -1 that of any other row (from all folds).

    One pass counts (category, fold); a category's total and what is left without one fold follow from these sums, so
    rows are joined once for each category column, training rows and others alike.
    """
    rows = _train(df, split).select(F.col(cat).alias("_cat"), bucket(F.col(id_col), f"{seed}|fold", folds).alias("_fold"),
                                    (F.col(y) - F.lit(mean)).alias("_yc"))
    sums = [F.count("_yc").alias("_n"), F.sum("_yc").alias("_s"), F.sum(F.col("_yc") * F.col("_yc")).alias("_q")]
    per_fold = rows.groupBy("_cat", "_fold").agg(*sums)
    fold_sums = {r["_fold"]: r for r in per_fold.groupBy("_fold").agg(*[F.sum(c).alias(c) for c in ("_n", "_s", "_q")]).collect()}
    whole = [sum(r[c] or 0 for r in fold_sums.values()) for c in ("_n", "_s", "_q")]
    left = {-1: whole, **{k: [w - (r[c] or 0) for w, c in zip(whole, ("_n", "_s", "_q"))] for k, r in fold_sums.items()}}
    shape = [(k, s / n if n else None, q / n - (s / n) ** 2 if n else None) for k, (n, s, q) in left.items()]
    base = df.sparkSession.createDataFrame(shape, "_fold int, _gm double, _gv double")  # one row for each fold
    total = per_fold.groupBy("_cat").agg(*[F.sum(c).alias(f"{c}t") for c in ("_n", "_s", "_q")])
    # Every category with every fold (own sums 0 where it has no row there) and with fold -1.
    every = total.withColumn("_fold", F.explode(F.array(*[F.lit(k) for k in left])))
    own = every.join(per_fold.withColumnRenamed("_cat", "_c").withColumnRenamed("_fold", "_f"),
                     F.col("_cat").eqNullSafe(F.col("_c")) & (F.col("_fold") == F.col("_f")), "left")
    n, s, q = (F.col(f"{c}t") - F.coalesce(F.col(c), F.lit(0)) for c in ("_n", "_s", "_q"))
    centre = F.lit(mean)
    enc = _shrink(n, s, q, centre, F.col("_gv"), F.coalesce(F.col("_gm"), F.lit(0.0)) + centre)
    return own.join(F.broadcast(base), "_fold").select("_cat", "_fold", enc.alias("_enc"))


def join_target_encoding(df: DataFrame, table: DataFrame, cat: str, fold: str | None, mean: float, out: str) -> DataFrame:
    """Rows with their encoding: training rows by their ``fold``, others (fold -1, or no fold column) by all folds; a
    category not seen there gets the training mean (without the row's own fold, if it has one)."""
    if fold is None:
        hit = F.col(cat).eqNullSafe(F.col("_cat"))
        joined = df.join(table.where("_fold = -1").drop("_fold"), hit, "left")
    else:
        hit = F.col(cat).eqNullSafe(F.col("_cat")) & (F.col(fold) == F.col("_tfold"))
        joined = df.join(table.withColumnRenamed("_fold", "_tfold"), hit, "left")
    return joined.select(*df.columns, F.coalesce(F.col("_enc"), F.lit(mean)).alias(out))


def fit_target_encoding(df: DataFrame, cat: str, y: str = presets.TARGET, split: str | None = "split",
                        stats: tuple[float, float] | None = None) -> DataFrame:
    """E6 fit: per-category encoding from all training rows; ``stats`` = known (mean, population variance) of y."""
    train = _train(df, split)
    r = stats if stats is not None else train.agg(F.avg(y), F.var_pop(y)).first()
    centre, var_y = F.lit(r[0]), F.lit(r[1])
    t = train.withColumn("_yc", F.col(y) - centre)
    per_cat = _te_stats(t, cat, y, None)
    n, s, q = F.col("_n"), F.col("_s"), F.col("_q")
    # Statistics are centred on the training mean, whose centred mean is 0.
    enc = _shrink(n, s, q, centre, var_y, centre)
    return per_cat.select(F.col("_cat").alias(cat), enc.alias("encoding"))


def apply_target_encoding(df: DataFrame, enc: DataFrame, cat: str, y: str = presets.TARGET,
                          train: DataFrame | None = None, out: str | None = None,
                          mean: float | None = None) -> DataFrame:
    """Encoding for any rows; unseen category -> training mean."""
    out = out or f"{cat}_te"
    if mean is None:
        mean = (train if train is not None else df).agg(F.avg(y)).first()[0]
    mean = F.lit(mean)
    e = enc.select(F.col(cat).alias("_cat"), F.col("encoding").alias("_enc"))
    joined = df.join(e, F.col(cat).eqNullSafe(F.col("_cat")), "left")
    return joined.select(*df.columns, F.coalesce(F.col("_enc"), mean).alias(out))
