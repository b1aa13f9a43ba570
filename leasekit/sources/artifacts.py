"""Model artifacts (S9): MLlib models by the ML writer; our own (``Prep``, ``Ensemble``) as Parquet tables and JSON."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def write_json(spark: SparkSession, path: str, value: dict) -> None:
    """One small document as a text file that any Hadoop file system holds."""
    spark.createDataFrame([(json.dumps(value, ensure_ascii=False),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_json(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first().value)


def save_model(model, path: str) -> None:
    if hasattr(model, "save") and not hasattr(model, "write"):
        model.save(path)
    else:
        model.write().overwrite().save(path)


def load_model(cls, path: str, spark: SparkSession | None = None):
    """``cls`` is the fitted class: an MLlib model, or ``Prep`` or ``Ensemble`` (which need the session)."""
    return cls.load(spark, path) if spark is not None else cls.load(path)
