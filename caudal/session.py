"""Session settings and the shared folder that intermediate tables are written to."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app_name: str = "caudal", **conf: object) -> SparkSession:
    """Session with adaptive execution on. Partition counts and memory stay the cluster's own."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def _work_root(spark: SparkSession) -> str:
    app = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_KEY, None) or app.getCheckpointDir()
    if not root:
        raise ValueError(f"{CHECKPOINT_KEY} must name a folder shared by all executors")
    return f"{root.rstrip('/')}/caudal-{app.applicationId}"


def work_dir(spark: SparkSession) -> str:
    """A new folder name under the cluster's checkpoint folder.

    Every executor must see that folder, so a missing setting is an error.
    """
    return f"{_work_root(spark)}/{uuid.uuid4().hex}"


def clean_work(spark: SparkSession) -> bool:
    """Delete what this application has written under the checkpoint folder, once its results are stored."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_work_root(spark))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def store(df: DataFrame) -> str:
    """Write ``df`` to a new folder in the shared one and return its path."""
    path = work_dir(df.sparkSession)
    df.write.parquet(path)
    return path


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage, survives executor loss."""
    return df.sparkSession.read.schema(df.schema).parquet(store(df))


def slice_count(spark: SparkSession) -> int:
    """How many range slices to cut ordered data into: the session's shuffle parallelism."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
