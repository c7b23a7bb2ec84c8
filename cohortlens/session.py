"""Spark session settings shared by the library, the tests and the bench."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "cohortlens", checkpoint_dir: str | None = None) -> SparkSession:
    """Session tuned for the feature builds and similarity joins.

    AQE stays on so that shuffle partitions are coalesced at run time and
    skewed join partitions are split; the web UI is off.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus) * 2))
        .config("spark.driver.memory", os.environ.get("COHORTLENS_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder, set as Spark's checkpoint folder.

    It is read from ``spark.checkpoint.dir``.  Where that is unset, a local
    master (tests) gets a scratch folder once a context; a cluster gets an
    error, as a machine-local folder would not be seen by its executors."""
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = getattr(sc, "_cohortlens_scratch", None)
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that driver and executors share")
        current = sc._cohortlens_scratch = tempfile.mkdtemp(prefix="cohortlens-ckpt-")
    sc.setCheckpointDir(current)
    return current


def materialize(df):
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Computes its input once, cuts the lineage (a lost executor does not trigger
    a recomputation from the raw tables), and lets later readers prune columns
    and push filters down, which checkpointed rows do not."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cohortlens-tmp/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
