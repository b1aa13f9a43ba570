"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leasekit.llm.common import drop_written, written


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (a, b); root: the smallest node of its component.

    Each round is written to the shared folder; the rounds' number grows with the logarithm of a component's size.
    Only neighbour minima are aggregated (partial sums in each task), so a node with very many links is never
    gathered in one place.
    """
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(now)
    while state[0]:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = written(large, "edges")
        # Every edge now points down (a > b): the smaller neighbours of a and a itself go to their minimum.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        following = written(small.where("a <> b").distinct(), "edges")
        drop_written(large)
        drop_written(now)
        now, last, state = following, state, _state(following)
        if state == last:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x"), F.sum(F.expr("xxhash64(b, a) % 1000003")).alias("s")).first()
    return row.n, row.x, row.s
