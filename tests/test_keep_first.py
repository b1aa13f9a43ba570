"""Keep-first over a written table: narrow rows find each key's first row, marks pick it, ties compare whole rows."""

from pyspark.sql import functions as F

ROWS = [(1, 5.0, "b", None), (1, 4.0, "z", "x"), (1, 4.0, "z", "x"), (2, None, None, "q"), (2, None, "q", None), (2, 1.0, "a", "a"),
        (None, 2.0, "n", "n"), (None, 3.0, "m", "m"), (3, 7.0, "k", None), (4, 1.0, None, "t"), (4, 1.0, "t", None), (5, float("nan"), "s", "s"),
        (5, 0.5, "r", "r")]


def _table(spark, copies=1):
    rows = spark.createDataFrame(ROWS, "id long, o double, a string, b string").repartition(3)
    return rows.crossJoin(spark.range(copies).select(F.col("id").alias("copy"))).withColumn("id", F.col("id") + F.col("copy") * 10)


def _rows(df):
    return sorted(map(str, df.collect()))


def test_written_keep_first_equals_the_lazy_one(spark):
    from leasekit.operators import clean as C

    for order in (["o"], [], ["o", "a"]):
        for copies in (1, 400):
            df = _table(spark, copies)
            assert _rows(C.drop_duplicates(df, "id", order, written=True)) == _rows(C.drop_duplicates(df, "id", order)), (order, copies)
    empty = _table(spark).where("false")
    assert C.drop_duplicates(empty, "id", ["o"], written=True).count() == 0


def test_written_keep_first_does_not_shuffle_whole_rows(spark):
    from leasekit.operators import clean as C

    df = spark.range(2000).select((F.col("id") % 1500).alias("id"), F.col("id").alias("o"), F.repeat(F.lit("long text "), 50).alias("a"))
    plan = C.drop_duplicates(df, "id", ["o"], written=True)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "Sort" not in plan, plan


def test_clean_audit_counts_full_duplicates_and_ids(spark, raw_frame):
    from leasekit.operators import clean as C

    twice = raw_frame.unionByName(raw_frame.where("id in ('L05', 'L08')"))
    steps = {r.step: (r.rows_removed, r.rows_after) for r in C.clean_audit(twice, key="id", order=["row_no"]).collect()}
    assert steps["full_duplicates"] == (2, 37) and steps["duplicate_ids"] == (1, 36)


def test_counts_are_joined_without_shuffling_the_rows(spark):
    from leasekit.operators import features as FE

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
    try:
        df = spark.range(30000).select("id", F.concat(F.lit("c"), F.col("id") % 7).alias("cityname"))
        plan = FE.attach_counts(df, "cityname", "n")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan, plan
