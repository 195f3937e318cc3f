"""Streaming ingestion of items: late data, duplicates, and micro-batch inserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..model import ITEM


def read_item_stream(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of items, as files arrive; ``event_time`` is the item's time."""
    return spark.readStream.schema(ITEM).json(path).withColumn("event_time", F.col("datetime").cast("timestamp"))


def new_items(stream: DataFrame, late: str = "60 minutes") -> DataFrame:
    """Each (collection, id) once within the watermark."""
    return stream.withWatermark("event_time", late).dropDuplicatesWithinWatermark(["collection", "id"])


def append_new(stream: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Insert what the table at path ``table`` lacks, batch by batch; stops when the input is through."""

    def batch(df: DataFrame, _id: int) -> None:
        spark = df.sparkSession
        # the batch may bring the table's first rows
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(table)
        there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
        rows = df.drop("event_time")
        fresh = rows.join(spark.read.schema(ITEM).parquet(table).select("collection", "id"), ["collection", "id"], "left_anti") if there else rows
        fresh.write.mode("append").parquet(table)

    return new_items(stream).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, window: str = "1 day", late: str = "60 minutes") -> DataFrame:
    """Items by window and collection, final once the watermark has passed."""
    return stream.withWatermark("event_time", late).groupBy(F.window("event_time", window), "collection").agg(F.count("*").alias("n"))
