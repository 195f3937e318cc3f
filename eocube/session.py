"""Spark session with the settings the engine relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def session(name: str = "eocube", cores: int | None = None, **conf: str) -> SparkSession:
    """UTC, adaptive execution and Arrow are on; on a cluster the master and partition counts come from its configuration."""
    builder = SparkSession.builder.appName(name)
    if cores:
        builder = builder.master(f"local[{cores}]").config("spark.sql.shuffle.partitions", str(2 * cores))
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if "SPARK_DRIVER_MEMORY" in os.environ:
        base["spark.driver.memory"] = os.environ["SPARK_DRIVER_MEMORY"]
    for k, v in (base | conf).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """A new folder that driver and executors share: under ``spark.checkpoint.dir``, one of this machine only where Spark is local."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="eocube-work-")
    return f"{found.rstrip('/')}/eocube-{uuid.uuid4().hex[:12]}"
