"""Sources/sinks round trips and the driver contract."""

import os
import tempfile

from pyspark.sql import functions as F


def test_csv_cp1252_round_trip(spark):
    from leasekit.sources.delimited import read_listings_csv

    d = tempfile.mkdtemp(prefix="leasekit-csv-")
    path = os.path.join(d, "listings.csv")
    text = ('id;title;price\n'
            '1;"Café ""loft""";1200\n'
            '2;null;NULL\n'
            '3;plain;\n')
    with open(path, "wb") as f:
        f.write(text.encode("cp1252"))
    df = read_listings_csv(spark, path, columns=["id", "title", "price"])
    rows = {r["id"]: r for r in df.collect()}
    assert rows["1"]["title"] == 'Café "loft"'
    assert rows["2"]["title"] is None and rows["2"]["price"] is None
    assert rows["3"]["price"] is None


def test_run_log_round_trip(spark):
    from leasekit.sources.runlog import load_runs, run_metrics, save_run

    d = tempfile.mkdtemp(prefix="leasekit-runs-")
    m = spark.createDataFrame([("ridge", "mae", 10.0), ("ridge", "r2", 0.5), ("gbt", "mae", 8.0)],
                              "model string, metric string, value double")
    save_run(spark, d, "r1", m, {"alpha": 1.0}, "note")
    runs = load_runs(spark, d)
    assert runs.count() == 3
    t = {r["model"]: r["mae"] for r in run_metrics(runs, "r1").collect()}
    assert t == {"ridge": 10.0, "gbt": 8.0}


def test_model_save_load(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression, LinearRegressionModel

    from leasekit.sources.artifacts import load_model, save_model

    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(
        spark.createDataFrame([(float(i), 2.0 * i + 1) for i in range(20)], "x double, label double"))
    model = LinearRegression().fit(df)
    d = tempfile.mkdtemp(prefix="leasekit-model-")
    save_model(model, d)
    back = load_model(LinearRegressionModel, d)
    assert abs(back.coefficients[0] - 2.0) < 1e-6


def test_entry_and_catalogue(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["state", "median_price", "n"]
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 100


def test_stream_dedupe(spark):
    from leasekit.streaming.stream import stream_dedupe_counts

    out = stream_dedupe_counts(spark, "/root/testdata/sf0.001")
    n = out.agg(F.sum("n")).first()[0]
    distinct = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id").distinct().count()
    assert n == distinct
