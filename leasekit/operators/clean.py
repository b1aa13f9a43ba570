"""Cleaning operators.

Each operator is a ``DataFrame -> DataFrame`` function that takes column
names, so ``df.transform(...)`` chains them. Nothing here runs a job except
where a statistic is needed (medians).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leasekit import presets
from leasekit.functions.numeric import to_number, unix_seconds_to_timestamp
from leasekit.functions.text import trim_all
from leasekit.operators.ranking import exact_quantiles
from leasekit.session import materialize as materialized


# --------------------------------------------------------------------------- S2
def normalize_null_tokens(df: DataFrame, tokens: Sequence[str] = presets.NULL_TOKENS,
                          columns: Sequence[str] | None = None) -> DataFrame:
    """String cells equal to a null token become null, in one projection."""
    string_cols = {f.name for f in df.schema.fields if f.dataType.simpleString() == "string"}
    targets = set(columns) if columns is not None else string_cols
    return df.select(*[
        F.when(F.col(c).isin(list(tokens)), F.lit(None).cast("string")).otherwise(F.col(c)).alias(c)
        if c in targets and c in string_cols else F.col(c)
        for c in df.columns])


# --------------------------------------------------------------------- U2 + W2
def keep_first(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """W2 (+U2): one row per key, the first by ``order``.

    Done as an aggregation with ``min_by`` rather than a ``row_number`` window:
    the aggregate combines map-side, so a key holding a third of all rows is
    reduced inside each input partition before the shuffle. Full-row
    duplicates always share their key, so this also removes them (U2). The
    whole row is appended to the ordering as a tie-break, which makes the pick
    deterministic even when ``order`` ties.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    # min over struct(order..., rest...) = the row with the smallest order, ties broken by the row itself.
    tail = [c for c in rest if c not in order]
    first = F.min(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in tail])).alias("_first")
    picked = df.groupBy(*keys).agg(first)
    return picked.select(*keys, *[F.col("_first")[c].alias(c) for c in rest]).select(*df.columns)


#: Rows up to which the marks of kept rows (a bit for each) go to all tasks; beyond, they are joined like any table.
MOST_MARKED = 1 << 29


def _row_hash(columns: Sequence[str]) -> Column:
    """64 bits that differ for different rows. Hashing passes over nulls, so their places are hashed too."""
    nulls = F.concat(F.lit(""), *[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    return F.xxhash64(nulls, *[F.col(c) for c in columns])


def with_places(df: DataFrame) -> DataFrame:
    """``df`` written once, every row with a number of its own, ``_at``."""
    return materialized(df.withColumn("_at", F.monotonically_increasing_id()))


def marked(df: DataFrame, places: DataFrame) -> DataFrame:
    """The rows of ``df`` whose ``_at`` is in ``places``, without a shuffle of ``df``: a block of 4096 rows has one array of
    64 words, with a bit for each row."""
    at = F.col("_at")
    word = F.shiftright(at, 6).bitwiseAND(F.lit(63).cast("long"))
    bit = at.bitwiseAND(F.lit(63).cast("long")).cast("int")
    words = places.groupBy(F.shiftright(at, 12).alias("_block"), word.alias("_word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("_bits"))
    blocks = materialized(words.groupBy("_block").agg(
        F.array(*[F.max(F.when(F.col("_word") == i, F.col("_bits"))) for i in range(64)]).alias("_marks")))
    blocks = F.broadcast(blocks) if blocks.count() << 12 <= MOST_MARKED else blocks
    joined = df.join(blocks, F.shiftright(at, 12) == F.col("_block"))
    return joined.where(F.getbit(F.element_at("_marks", word.cast("int") + 1), bit) == 1).select(*df.columns)


def keep_first_placed(placed: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """:func:`keep_first` of a table :func:`with_places`, in which only narrow rows are shuffled.

    The first row of a key is found by ``order`` and the hash of the whole row, and its number marks it. Only keys that
    have different rows equal in ``order`` are compared by whole rows. (Rows of one key and order are taken to be different
    only if their 64-bit hashes are.)
    """
    keys = [key] if isinstance(key, str) else list(key)
    columns = [c for c in placed.columns if c != "_at"]
    by = {c: f"_order_{i}" for i, c in enumerate(order)}
    narrow = placed.select(*keys, *[F.col(c).alias(n) for c, n in by.items()], "_at", _row_hash([c for c in columns if c not in keys]).alias("_hash"))
    least, most = (F.min(F.struct(*by.values(), *more)) for more in (("_hash", "_at"), (F.bitwise_not("_hash").alias("_hash"),)))
    firsts = materialized(narrow.groupBy(*keys).agg(least.alias("_first"), most["_hash"].alias("_most"))
                          .select(*keys, F.col("_first._at").alias("_at"), (F.col("_first._hash") != F.bitwise_not("_most")).alias("_tied")))
    kept = marked(placed, firsts.where("not _tied").select("_at")).select(*columns)
    named = {k: f"_tied_{i}" for i, k in enumerate(keys)}
    tied = materialized(firsts.where("_tied").select(*[F.col(k).alias(n) for k, n in named.items()]))
    if tied.isEmpty():
        return kept
    same = F.lit(True)
    for k, n in named.items():
        same = same & F.col(k).eqNullSafe(F.col(n))
    return kept.unionByName(keep_first(placed.select(*columns).join(tied, same, "left_semi"), keys, order))


def drop_duplicates(df: DataFrame, key: str = "id", order: Sequence[str] = (), written: bool = False) -> DataFrame:
    """Full-row dedupe then keep-first per id. Rows have no order of their own on a cluster: ``order`` names the columns
    that give it (none: the smallest row by its columns). ``written`` writes the table first, so that only narrow rows are
    shuffled; else whole rows are, in one lazy pass."""
    return keep_first_placed(with_places(df), key, order) if written else keep_first(df, key, order)


# ------------------------------------------------------------------- P1 P2 P3
def cast_types(df: DataFrame, numeric: Sequence[str] = presets.NUMERIC_COLUMNS,
               time_col: str = "time", out_time: str = "posted_at",
               trim: Sequence[str] = presets.TRIM_COLUMNS) -> DataFrame:
    """Coerce numeric columns, derive the timestamp, trim categorical labels."""
    exprs: list[Column] = []
    for c in df.columns:
        if c in numeric:
            exprs.append(to_number(c).alias(c))
        elif c in trim:
            exprs.append(trim_all(F.col(c).cast("string")).alias(c))
        else:
            exprs.append(F.col(c))
    if time_col in df.columns:
        exprs.append(unix_seconds_to_timestamp(time_col).alias(out_time))
    return df.select(*exprs)


# ----------------------------------------------------------------------- P4
def normalize_price_units(df: DataFrame, price: str = "price", unit: str = "price_type",
                          unit_value: str = "Weekly", target_unit: str = "Monthly",
                          factor: float = presets.WEEKS_PER_MONTH) -> DataFrame:
    """Weekly prices -> monthly, relabelled; both columns derived from the old label."""
    weekly = F.coalesce(trim_all(unit), F.lit("")) == F.lit(unit_value)
    return df.withColumns({
        price: F.when(weekly, F.col(price) * F.lit(factor)).otherwise(F.col(price)),
        unit: F.when(weekly, F.lit(target_unit)).otherwise(F.col(unit)),
    })


def unit_exceptions(df: DataFrame, unit: str = "price_type", expected: str = "Monthly",
                    columns: Sequence[str] = ("id", "price", "price_type")) -> DataFrame:
    """Rows whose unit is not the expected one (null counts as different)."""
    return df.filter(~F.col(unit).eqNullSafe(F.lit(expected))).select(*columns)


def range_price_rows(df: DataFrame, display: str = "price_display",
                     columns: Sequence[str] = ("id", "price", "price_display")) -> DataFrame:
    """Rows whose price text is a range ``a - b``."""
    return df.filter(F.col(display).contains(" - ")).select(*columns)


# ------------------------------------------------------------------ P5 P6 P7
def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(how="any", subset=list(columns))


def fill_empty(df: DataFrame, columns: Sequence[str] = presets.MULTI_SELECT_COLUMNS) -> DataFrame:
    return df.fillna("", subset=[c for c in columns if c in df.columns])


# ----------------------------------------------------------------------- P8
def fill_median(df: DataFrame, columns: Sequence[str] = presets.MEDIAN_FILL_COLUMNS,
                approx: bool = False, accuracy: int = 10000) -> DataFrame:
    """Fill nulls with the column's table median (exact, interpolated).

    The medians come from range-sorted value counts (``ranking.exact_quantiles``), so no task holds a column;
    ``approx=True`` takes ``percentile_approx`` in one aggregate instead.
    """
    if approx:
        row = df.agg(*[F.percentile_approx(c, 0.5, accuracy).cast("double").alias(c) for c in columns]).first()
        medians = {c: row[c] for c in columns}
    else:
        medians = {c: v[0] for c, v in exact_quantiles(df, columns, [0.5]).items()}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(medians[c])) for c in columns if medians[c] is not None})


# ---------------------------------------------------------------------- P9 P11
def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*[c for c in columns if c in df.columns])


# ----------------------------------------------------------------------- P10
def range_filter(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """Inclusive range filters; null fails the test (pushed down to the scan when possible)."""
    cond = None
    for c, (lo, hi) in bounds.items():
        part = F.col(c).between(F.lit(lo), F.lit(hi))
        cond = part if cond is None else cond & part
    return df.filter(cond)


DEFAULT_BOUNDS = {"price": (presets.PRICE_MIN, presets.PRICE_MAX),
                  "square_feet": (presets.SQFT_MIN, presets.SQFT_MAX)}


# ----------------------------------------------------------------------- P15
def clean_data(df: DataFrame, key: str = "id", order: Sequence[str] = (),
               target: str = presets.TARGET, bounds: dict | None = None,
               approx_median: bool = False, materialize: bool = False, columns: Sequence[str] | None = None) -> DataFrame:
    """Whole cleaning chain in the fixed order
    dedupe -> cast -> units -> target -> geo -> fill -> drop sparse -> outliers.

    ``materialize=True`` writes the deduplicated rows, so the median pass and
    the main pass read a table instead of repeating the dedupe, in which whole
    rows are not shuffled. ``columns``: those read of the cleaned rows (None: all), so that no others are written again.
    """
    bounds = bounds or DEFAULT_BOUNDS
    kept = (df.transform(lambda d: drop_duplicates(d, key, order, written=materialize))
              .transform(cast_types)
              .transform(normalize_price_units)
              .transform(lambda d: drop_missing(d, [target]))
              .transform(lambda d: drop_missing(d, presets.GEO_COLUMNS))
              .transform(fill_empty))
    if columns is not None:
        read = {*columns, *presets.MEDIAN_FILL_COLUMNS, *bounds}
        kept = kept.select(*[c for c in kept.columns if c in read])
    if materialize:
        kept = materialized(kept)
    return (kept.transform(lambda d: fill_median(d, approx=approx_median))
              .transform(lambda d: drop_columns(d, presets.SPARSE_COLUMNS))
              .transform(lambda d: range_filter(d, bounds)))


# ----------------------------------------------------------------------- P14
def clean_audit(df: DataFrame, key: str = "id", order: Sequence[str] = (),
                target: str = presets.TARGET, bounds: dict | None = None) -> DataFrame:
    """Rows removed by every cleaning step, from aggregations over a table written once instead of a job per step.

    Full duplicates are rows of one id with one hash of the whole row. Returns ``(step_no, step, rows_removed, rows_after)``.
    """
    bounds = bounds or DEFAULT_BOUNDS
    placed = with_places(df)
    unique = keep_first_placed(placed, key, order)
    # Null is an id too.
    whole = placed.select(key, _row_hash([c for c in df.columns if c != key]).alias("_hash"))
    raw = whole.groupBy(key, "_hash").agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_raw"), F.count(F.lit(1)).alias("n_distinct"))
    typed = unique.transform(cast_types).transform(normalize_price_units)
    no_target = F.col(target).isNull()
    no_geo = F.lit(False)
    for c in presets.GEO_COLUMNS:
        no_geo = no_geo | F.col(c).isNull()
    (plo, phi), (slo, shi) = bounds["price"], bounds["square_feet"]
    bad_price = ~F.coalesce(F.col("price").between(plo, phi), F.lit(False))
    bad_sqft = ~F.coalesce(F.col("square_feet").between(slo, shi), F.lit(False))
    kept = materialized(typed.agg(
        F.count_if(no_target).alias("r_target"),
        F.count_if(~no_target & no_geo).alias("r_geo"),
        F.count_if(~no_target & ~no_geo & bad_price).alias("r_price"),
        F.count_if(~no_target & ~no_geo & ~bad_price & bad_sqft).alias("r_sqft"), F.count(F.lit(1)).alias("n_ids")))
    steps = [
        (1, "full_duplicates", F.col("n_raw") - F.col("n_distinct")),
        (2, "duplicate_ids", F.col("n_distinct") - F.col("n_ids")),
        (3, "missing_target", F.col("r_target")),
        (4, "missing_geo", F.col("r_geo")),
        (5, "price_outliers", F.col("r_price")),
        (6, "sqft_outliers", F.col("r_sqft")),
    ]
    combined = raw.select("*", *[kept.select(c).scalar().alias(c)
                                 for c in ["r_target", "r_geo", "r_price", "r_sqft", "n_ids"]])
    rows = combined.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("step_no"), F.lit(name).alias("step"),
                 removed.cast("bigint").alias("rows_removed"))
        for i, name, removed in steps])).alias("s"), "n_raw")
    from pyspark.sql import Window

    w = Window.orderBy("step_no").rowsBetween(Window.unboundedPreceding, 0)
    # 6 rows only: a global window over an aggregated table is fine.
    return rows.select("s.*", "n_raw").select(
        "step_no", "step", "rows_removed",
        (F.col("n_raw") - F.sum("rows_removed").over(w)).cast("bigint").alias("rows_after"))
