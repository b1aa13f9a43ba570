"""Numbers rows by an order without gathering them in one task, and exact quantiles built on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leasekit.session import materialize


def numbered(df: DataFrame, order: Sequence[str], out: str) -> tuple[DataFrame, int]:
    """``df`` with ``out`` = 0, 1, … in ``order`` (ties in any order), and the number of rows.

    The rows are range-partitioned and sorted by ``order`` and written once with their place in their range; the ranges'
    sizes (one row each) give every range its first number.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = materialize(ranged.withColumns({"_place": F.monotonically_increasing_id()}))
    # monotonically_increasing_id: the partition above bit 33, the row in it below.
    part, row = F.shiftright("_place", 33), F.col("_place").bitwiseAND((1 << 33) - 1)
    first, total = {}, 0
    for size in placed.groupBy(part.alias("p")).agg(F.count("*").alias("n")).orderBy("p").collect():
        first[size.p], total = total, total + size.n
    if not total:
        return placed.withColumn(out, F.lit(0).cast("long")).drop("_place"), 0
    start = F.create_map(*[F.lit(x) for pair in first.items() for x in pair])
    return placed.withColumn(out, F.element_at(start, part) + row).drop("_place"), total


def exact_quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float]) -> dict[str, list[float | None]]:
    """Interpolated quantiles of each column, exact, with no task that holds a column.

    The columns are unpivoted to (column, value) and counted by value; the counts are range-sorted, and the ranges'
    sums tell which ones hold the wanted ranks. Only the two values around each rank come to the driver.
    """
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("k"), F.col(c).cast("double").alias("v"))
                                          for i, c in enumerate(columns)])).alias("p")).select("p.k", "p.v")
    counts = pairs.where("v is not null").groupBy("k", "v").agg(F.count("*").alias("n"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(counts.repartitionByRange(parts, "k", "v").sortWithinPartitions("k", "v")
                         .withColumn("_part", F.spark_partition_id()))
    sums = placed.groupBy("k", "_part").agg(F.sum("n").alias("n")).orderBy("k", "_part").collect()
    total = {i: sum(s.n for s in sums if s.k == i) for i in range(len(columns))}
    ranks = {i: sorted({r for q in shares for x in [q * (n - 1)] for r in (int(x), min(int(x) + 1, n - 1))})
             for i, n in total.items() if n}
    wanted, before = [], {}
    for s in sums:  # ranges in order: ranks before them, and which wanted ranks they hold
        at = before.get(s.k, 0)
        wanted += [(s.k, s["_part"], at, r) for r in ranks[s.k] if at <= r < at + s.n]
        before[s.k] = at + s.n
    found: dict[tuple[int, int], float] = {}
    if wanted:
        near = df.sparkSession.createDataFrame(sorted({w[:3] for w in wanted}), "k int, _part int, first long")
        # Within a range: its own values, at most one range of a column at a time.
        upto = F.sum("n").over(Window.partitionBy("k", "_part").orderBy("v")) + F.col("first")
        held = placed.join(F.broadcast(near), ["k", "_part"]).withColumn("upto", upto)
        asks = df.sparkSession.createDataFrame([(w[0], w[1], w[3]) for w in wanted], "k int, _part int, rank long")
        hit = held.join(F.broadcast(asks), ["k", "_part"]).where("rank < upto and rank >= upto - n")
        found = {(h.k, h["rank"]): h.v for h in hit.select("k", "rank", "v").collect()}
    out: dict[str, list[float | None]] = {}
    for i, c in enumerate(columns):
        out[c] = []
        for q in shares:
            if not total[i]:
                out[c].append(None)
                continue
            x = q * (total[i] - 1)
            low, high = found[i, int(x)], found[i, min(int(x) + 1, total[i] - 1)]
            out[c].append(low * (int(x) + 1 - x) + high * (x - int(x)) if high != low else low)
    return out


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """``left`` with ``right``'s other columns, joined where all ``keys`` are equal or both null."""
    other = right.withColumnsRenamed({k: f"_right_{i}" for i, k in enumerate(keys)})
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_right_{i}"))
    return left.join(other, same, how).drop(*[f"_right_{i}" for i in range(len(keys))])


def grouped_quantiles(df: DataFrame, keys: Sequence[str], columns: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """One row per group of ``keys`` (null is a group) with, for each column, its interpolated quantiles as an array.

    Exact for any number and size of groups, with nothing collected and no task that holds a group: the values are
    counted by (group, column, value), which map tasks do first; the counts are range-sorted and written once; a table
    with a row for each group in each range gives the ranks before it, and the rows around the wanted ranks are found by
    running sums inside a range. Only ranges that hold a wanted rank are read again. A group without values has nulls;
    NaN is the largest value.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [f"_key_{i}" for i in range(len(keys))]
    named = df.select(*[F.col(k).alias(b) for k, b in zip(keys, by)],
                      F.explode(F.array(*[F.struct(F.lit(i).alias("k"), F.col(c).cast("double").alias("v"))
                                          for i, c in enumerate(columns)])).alias("p"))
    counts = named.groupBy(*by, F.col("p.k").alias("k"), F.col("p.v").alias("v")).agg(F.count("*").alias("n"))
    cell = [*by, "k"]
    placed = materialize(counts.repartitionByRange(parts, *cell, "v").sortWithinPartitions(*cell, "v")
                         .withColumn("_part", F.spark_partition_id()))
    filled = placed.where("v is not null")
    # At most one row for each range of a group: the window below never holds more than `parts` rows of a group.
    sums = filled.groupBy(*cell, "_part").agg(F.sum("n").alias("here"))
    order = Window.partitionBy(*cell).orderBy("_part")
    sums = sums.withColumns({"first": F.sum("here").over(order) - F.col("here"),
                             "total": F.sum("here").over(Window.partitionBy(*cell))})
    place = [F.lit(q) * (F.col("total") - 1) for q in shares]
    low = [F.floor(x) for x in place]
    high = [F.least(a + 1, F.col("total") - 1) for a in low]

    def within(rank: Column, start: Column, n: Column) -> Column:
        return (rank >= start) & (rank < start + n)

    holds = F.lit(False)
    for r in (*low, *high):
        holds = holds | within(r, F.col("first"), F.col("here"))
    held = null_safe(filled, sums.where(holds), [*cell, "_part"], "inner")
    upto = F.sum("n").over(Window.partitionBy(*cell, "_part").orderBy("v")) + F.col("first")
    held = held.withColumn("from", upto - F.col("n"))
    picked = [F.max(F.when(within(r, F.col("from"), F.col("n")), F.col("v"))).alias(f"{side}{j}")
              for j in range(len(shares)) for side, r in (("low", low[j]), ("high", high[j]))]
    cells = held.groupBy(*cell).agg(F.max("total").alias("total"), *picked)

    def value(j: int) -> Column:
        a, b, part = F.col(f"low{j}"), F.col(f"high{j}"), place[j] - low[j]
        # As the closed form: lower times (next rank - place) plus upper times (place - rank).
        return F.when(a == b, a).otherwise(a * (low[j] + 1 - place[j]) + b * part)

    cells = cells.select(*cell, F.array(*[value(j) for j in range(len(shares))]).alias("q"))
    nothing = F.array(*[F.lit(None).cast("double") for _ in shares])
    wide = cells.groupBy(*by).agg(*[F.max(F.when(F.col("k") == i, F.col("q"))).alias(f"_q{i}") for i in range(len(columns))])
    groups = placed.where("k = 0").select(*by).distinct()
    return null_safe(groups, wide, by).select(*[F.col(b).alias(k) for k, b in zip(keys, by)],
                                              *[F.coalesce(f"_q{i}", nothing).alias(c) for i, c in enumerate(columns)])


def grouped_mode(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """One row per group of ``keys`` with the most frequent non-null value of ``column`` (ties: the smallest).

    Two partial aggregations; no buffer holds a group's values. A group without values has null.
    """
    counts = df.groupBy(*keys, F.col(column).alias("_value")).agg(F.count("*").alias("_n"))
    # Without a value last of all, whatever its count.
    first = F.min(F.struct(F.col("_value").isNull(), -F.col("_n"), F.col("_value").alias("_value")))
    return counts.groupBy(*keys).agg(first["_value"].alias(column))
