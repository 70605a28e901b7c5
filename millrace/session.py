"""What every query needs from its session: workers that can import the package, and a shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import uuid

from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

#: Used only where spark.checkpoint.dir is unset and Spark runs on one machine, as in tests.
LOCAL_SCRATCH = "/tmp/checkpoints"
#: Python workers live on between tasks; with these they give memory back that a task has freed.
THRIFT = {"MALLOC_TRIM_THRESHOLD_": "1000000", "MALLOC_MMAP_THRESHOLD_": "1000000", "ARROW_DEFAULT_MEMORY_POOL": "system"}


def ship(spark: SparkSession) -> SparkSession:
    """Let Python workers started from now on import this package, and be thrifty."""
    env = spark.sparkContext.environment
    for name, value in THRIFT.items():
        env.setdefault(name, value)
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
    return spark


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path below the cluster's shared checkpoint folder; a cluster without one is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        # one machine: a folder of this process, gone when it ends
        base = f"{LOCAL_SCRATCH}/{os.getpid()}"
        if not os.path.isdir(base):
            os.makedirs(base)
            atexit.register(shutil.rmtree, base, ignore_errors=True)
            spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str = "written") -> DataFrame:
    """df written to the scratch folder and read back, for what is used more than once: computed once, whatever executors are lost."""
    path = scratch(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local(cores: int | str = "*", partitions: int = 8, memory: str = "4g", **conf: str) -> SparkSession:
    """A session for one machine: UTC, adaptive plans, few shuffle partitions."""
    builder = SparkSession.builder.master(f"local[{cores}]").config("spark.driver.memory", memory).config("spark.sql.shuffle.partitions", partitions)
    builder = builder.config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    return ship(builder.getOrCreate())
