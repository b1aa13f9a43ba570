"""Session helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings the operators assume. AQE re-plans joins from measured shuffle
# sizes (runtime broadcast decision, skew-join splitting, partition coalescing).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults."""
    builder = SparkSession.builder.appName("leasekit")
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if master and master.startswith("local"):
        # Local mode: the driver JVM is the only executor.
        conf.setdefault("spark.driver.memory", os.environ.get("LEASEKIT_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Folder for checkpoints and materialised tables.

    On a cluster ``spark.checkpoint.dir`` names shared storage and is always
    used. Only when it is unset (local tests) is a folder chosen here: the
    context's existing checkpoint folder, else ``fallback``, else (only if the driver is the one executor) a fresh temp
    folder.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    existing = sc.getCheckpointDir()
    if existing:
        return existing
    if fallback is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        import tempfile

        fallback = tempfile.mkdtemp(prefix="leasekit-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(fallback)
    return sc.getCheckpointDir() or fallback


def _tables(spark: SparkSession) -> str:
    """Folder of this application's materialised tables."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{spark.sparkContext.applicationId}"


def drop_materialized(spark: SparkSession) -> None:
    """Delete all tables that this application materialised; call it when no DataFrame made from them is used any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_tables(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df, mode: str | None = None, compression: str | None = None):
    """Cut lineage at a table that several later steps read.

    ``table`` (default) writes the rows as a parquet table under the shared
    folder named by ``spark.checkpoint.dir`` and reads it back: later stages
    scan it (with column pruning, filter pushdown and real size statistics for
    AQE) instead of re-running joins and shuffles, and a lost executor does not
    force a recomputation from the source files. ``checkpoint`` uses an RDD
    checkpoint in the same folder, ``persist`` keeps it in executor
    memory/disk, ``none`` returns the plan unchanged. ``compression``: of the table, if not the session's.
    """
    spark = df.sparkSession
    mode = mode or spark.conf.get("leasekit.materialize", "table")
    if mode == "none":
        return df
    if mode == "table":
        import uuid

        path = f"{_tables(spark)}/{uuid.uuid4().hex}"
        df.write.mode("overwrite").parquet(path, compression=compression)
        return spark.read.parquet(path)
    if mode == "persist":
        from pyspark import StorageLevel

        return df.persist(StorageLevel.MEMORY_AND_DISK)
    ensure_checkpoint_dir(spark)
    return df.checkpoint(eager=True)
