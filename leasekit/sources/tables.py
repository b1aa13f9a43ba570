"""Parquet sources and sinks (S3, S4) and access to the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table; projections and filters applied later are pushed to the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_prepared(spark: SparkSession, path: str, sample_fraction: float | None = None,
                  seed: int = 42, key: str = "id", text_columns: list[str] | None = None) -> DataFrame:
    """S3: read a prepared parquet dataset, optionally a deterministic sample, plus a joined text column."""
    from leasekit.functions.text import join_text
    from leasekit.operators.split import hash_fraction_sample

    df = spark.read.parquet(path)
    if sample_fraction is not None:
        df = hash_fraction_sample(df, sample_fraction, key=key, seed=seed)
    if text_columns:
        df = df.withColumn("text_joined", join_text(*text_columns))
    return df


def write_prepared(df: DataFrame, path: str, partition_by: list[str] | None = None,
                   mode: str = "overwrite") -> None:
    """Write a prepared dataset; partitioning by ``split`` lets later reads prune parts."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
