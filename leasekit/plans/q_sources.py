"""Queries for sources and sinks (S1-S7, S9): write what the tables give, read it back, work on that."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from leasekit.operators import lookup as L
from leasekit.plans import oracle_sql as S
from leasekit.plans.q_clean import MISSING
from leasekit.plans.q_split import split_features
from leasekit.plans.registry import ORACLE, query, raw_lv, rnd
from leasekit.session import ensure_checkpoint_dir
from leasekit.sources.tables import read_prepared, read_table, write_prepared


def _folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


_CSV_COLUMNS = ["id", "category", "title", "body", "amenities", "bathrooms", "bedrooms", "currency", "fee", "has_photo",
                "pets_allowed", "price", "price_display", "price_type", "square_feet", "address", "cityname", "state",
                "latitude", "longitude", "source", "time"]


@query("csv_round_trip", "S1 S2", sql=lambda: S.with_lv(S.raw_lv_cte()) + "SELECT " + ", ".join(
    f"CASE WHEN CAST({c} AS VARCHAR) IN {MISSING} THEN NULL ELSE CAST({c} AS VARCHAR) END AS {c}" for c in _CSV_COLUMNS) + " FROM raw_lv")
def q_csv(spark, d):
    """The export, all its columns, as ';'-separated Windows-1252 text, written and read with its null tokens."""
    from leasekit.sources.delimited import read_listings_csv, write_listings_csv

    path = _folder(spark, "export")
    rows = raw_lv(spark, d).select(*[F.col(c).cast("string").alias(c) for c in _CSV_COLUMNS])
    write_listings_csv(rows, path)
    return read_listings_csv(spark, path, columns=rows.columns)


@query("prepared_round_trip", "S3 S4 S8 F18", sql=f"""
SELECT o_orderkey, round(o_totalprice, 2) AS o_totalprice, o_orderstatus,
  coalesce(o_orderpriority, '') || ' ' || coalesce(o_orderstatus, '') AS text_joined
FROM orders WHERE {S.md5_unit('o_orderkey', '42|sample')} < 0.8""")
def q_prepared(spark, d):
    path = _folder(spark, "prepared")
    orders = read_table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    write_prepared(orders, path, partition_by=["o_orderstatus"])
    back = read_prepared(spark, path, sample_fraction=0.8, key="o_orderkey", text_columns=["o_orderpriority", "o_orderstatus"])
    return back.select("o_orderkey", rnd("o_totalprice", 2).alias("o_totalprice"), "o_orderstatus", "text_joined")


@query("run_log", "S5 S6", sql="""
SELECT l_returnflag AS model, round(avg(abs(l_extendedprice - 1000 * l_quantity)), 3) AS mae,
  CAST(count(*) AS DOUBLE) AS n FROM lineitem GROUP BY l_returnflag""")
def q_run_log(spark, d):
    """Two runs appended to one log; the second one read back as a (model x metric) table."""
    from leasekit.sources.runlog import load_runs, run_metrics, save_run

    path = _folder(spark, "runs")
    li = read_table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("model")).agg(
        F.avg(F.abs(F.col("l_extendedprice") - 1000 * F.col("l_quantity"))).alias("mae"), F.count("*").cast("double").alias("n"))
    metrics = li.select("model", F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value"))
                                                     for m in ("mae", "n")])).alias("x")).select("model", "x.*")
    save_run(spark, path, "first", metrics.withColumn("value", F.col("value") + 1))
    save_run(spark, path, "second", metrics, {"factor": 1000})
    back = run_metrics(load_runs(spark, path), "second")
    return back.select("model", rnd("mae", 3).alias("mae"), "n")


@query("reference_store", "S7 A5", sql=lambda: ORACLE["city_reference"]())
def q_reference(spark, d):
    path = _folder(spark, "reference")
    c = split_features(spark, d).filter(F.col("split") == "train")
    L.save_reference({"city": L.city_reference(c), "state": L.state_reference(c), "defaults": L.defaults(c)}, path)
    return L.load_reference(spark, path)["city"]


@query("model_artifact", "S9 M2", sql="""
SELECT l_linenumber, count(*) AS n, round(avg(a + b * l_quantity), 3) AS mean_prediction
FROM lineitem, (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem)
GROUP BY l_linenumber""")
def q_artifact(spark, d):
    """A fitted pipeline is saved, loaded and applied."""
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    from leasekit.sources.artifacts import load_model, save_model

    li = read_table(spark, d, "lineitem").select("l_linenumber", F.col("l_quantity").cast("double").alias("q"),
                                                 F.col("l_extendedprice").cast("double").alias("label"))
    path = _folder(spark, "model")
    save_model(Pipeline(stages=[VectorAssembler(inputCols=["q"], outputCol="features"), LinearRegression(solver="normal")]).fit(li), path)
    scored = load_model(PipelineModel, path).transform(li)
    return scored.groupBy("l_linenumber").agg(F.count("*").alias("n"), rnd(F.avg("prediction"), 3).alias("mean_prediction"))
