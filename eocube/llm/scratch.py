"""Intermediate tables in the folder that driver and executors share.

Lineage is cut with written Parquet tables, never with local checkpoints: an
executor that is lost takes no intermediate result with it.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_open: dict[str, list["Scratch"]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; one of our own only where that is unset and all is one machine (tests, local mode)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="eocube-scratch-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


#: Rows that a Python worker gets at once; documents may be long, and several copies of a batch live at a time.
SCAN_ROWS = "spark.sql.parquet.columnarReaderBatchSize"
BATCH_ROWS, BATCH_BYTES = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def careful(spark: SparkSession):
    """Shuffle files go as soon as the job that wrote them has ended, and Python workers get small batches."""
    new = {SHUFFLE_CLEANUP: "true", BATCH_ROWS: "1000", BATCH_BYTES: "8m", SCAN_ROWS: "512"}
    before = {k: spark.conf.get(k, None) for k in new}
    for k, v in new.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


class Scratch:
    """A folder of tables that belong to one call of an operator."""

    def __init__(self, spark: SparkSession, name: str, owner: str = ""):
        self.spark, self.path = spark, f"{shared_dir(spark)}/eocube/{name}-{uuid.uuid4().hex[:12]}"
        # tables of a result that is still read lazily can't go before the session does
        _open.setdefault(owner or "session", []).append(self)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it again: the plan so far is run once and forgotten."""
        path = f"{self.path}/{name}"
        with careful(self.spark):
            df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str = "") -> None:
        """Remove one table that is no longer read, or all."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(owner: str) -> None:
    """Remove what ``owner`` has open: for owners that store each result before they go on."""
    for s in _open.pop(owner, ()):
        s.drop()


@atexit.register
def _release_all() -> None:
    for owner in list(_open):
        for s in _open.pop(owner):
            try:
                s.drop()
            except Exception:  # noqa: BLE001 - the session has ended already
                return
