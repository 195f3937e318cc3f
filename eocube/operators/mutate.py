"""Mutations of item tables: single items, bulk insert and delete, exports, orders."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..errors import CatalogError
from ..model import ITEM, JOB

SUBSET = 10


def upsert(items: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """``new`` replaces what has its key."""
    return items.join(new.select(*key), key, "left_anti").unionByName(new, allowMissingColumns=True)


def insert(items: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """``new`` without what is there already."""
    return items.unionByName(new.join(items.select(*key), key, "left_anti"), allowMissingColumns=True)


def delete(items: DataFrame, ids: DataFrame, key: list[str]) -> DataFrame:
    return items.join(ids.select(*key), key, "left_anti")


def create_item(items: DataFrame, new: DataFrame) -> DataFrame:
    key = ["collection", "id"]
    if new.join(items.select(*key), key, "left_semi").limit(1).count():
        raise CatalogError("the item exists already")
    return items.unionByName(new, allowMissingColumns=True)


def update_item(items: DataFrame, new: DataFrame) -> DataFrame:
    key = ["collection", "id"]
    if new.join(items.select(*key), key, "left_anti").limit(1).count():
        raise CatalogError("no such item")
    return upsert(items, new, key)


def parse_items(lines: DataFrame, mode: str = "CONTINUE") -> tuple[DataFrame, DataFrame]:
    """Items of JSON lines (column ``value``) and the lines that are none; STOP fails at the first of those."""
    if mode not in ("CONTINUE", "STOP"):
        raise ValueError(f"error handling is CONTINUE or STOP, not {mode!r}")
    read = lines.select("value", F.from_json("value", ITEM, {"mode": "PERMISSIVE"}).alias("item"))
    good = F.coalesce(F.col("item.id").isNotNull(), F.lit(False))
    if mode == "STOP":
        checked = read.select(F.when(good, F.col("item")).otherwise(F.raise_error(F.concat(F.lit("not an item: "), F.substring("value", 1, 80)))).alias("item"))
        return checked.select("item.*"), read.where(F.lit(False)).select("value")
    return read.where(good).select("item.*"), read.where(~good).select("value")


def _counted(rows: DataFrame, name: str, mark: Column) -> DataFrame:
    """One row: how many there are, how many are marked, and the first few names of those."""
    few = rows.where(mark).select(F.col(name).cast("string").alias("n")).orderBy("n").limit(SUBSET).agg(F.sort_array(F.collect_list("n")).alias("subset"))
    return rows.agg(F.count("*").alias("total"), F.count_if(mark).alias("marked")).crossJoin(few)


def bulk_insert(items: DataFrame, new: DataFrame, conflict: str = "SKIP", key: tuple[str, ...] = ("collection", "id"), errors: DataFrame | None = None, order: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The table after the insert, and the job's one row of counts; nothing is written yet (status READY), see ``commit``.

    Of new rows with one key the last counts: by ``order``, else by their place in ``new``.
    """
    if conflict not in ("SKIP", "OVERRIDE"):
        raise ValueError(f"conflict resolution is SKIP or OVERRIDE, not {conflict!r}")
    cols = list(key)
    seen = items.select(*cols, F.lit(True).alias("_there")).distinct()
    place = F.col(order) if order else F.monotonically_increasing_id()
    last = Window.partitionBy(*cols).orderBy(F.col("_place").desc())
    one = new.withColumn("_place", place).withColumn("_rank", F.row_number().over(last)).where("_rank = 1").drop("_place", "_rank")
    marked = one.select(*cols).join(seen, cols, "left")
    counts = _counted(marked, cols[-1], F.col("_there").isNotNull())
    skip = conflict == "SKIP"
    counts = counts.crossJoin(_counted(errors.withColumn("text", F.substring("value", 1, 80)), "text", F.lit(True)).select(F.col("total").alias("bad"), F.col("subset").alias("bads"))) if errors is not None else counts.withColumns({"bad": F.lit(0).cast("long"), "bads": F.array().cast("array<string>")})
    job = counts.select(
        F.lit(str(uuid.uuid4())).alias("job_id"), F.lit("INSERT").alias("job_type"), F.lit("READY").alias("status"), F.lit(None).cast("string").alias("message"),
        (F.col("total") + F.col("bad")).alias("items_total_count"), (F.col("total") - (F.col("marked") if skip else F.lit(0))).alias("items_written_count"), F.lit(0).cast("long").alias("items_deleted_count"),
        (F.col("marked") if skip else F.lit(0)).cast("long").alias("items_skipped_count"), F.col("bad").alias("items_error_count"),
        (F.col("subset") if skip else F.array().cast("array<string>")).alias("items_skipped_subset"), F.col("bads").alias("item_errors_subset"),
    )
    return (insert if skip else upsert)(items, one, cols), job.select(*JOB.names)


def bulk_delete(items: DataFrame, ids: DataFrame, key: tuple[str, ...] = ("id",)) -> tuple[DataFrame, DataFrame]:
    """The table after the delete, and the job's row (READY, see ``commit``); ids that aren't there are skipped."""
    cols = list(key)
    seen = items.select(*cols, F.lit(True).alias("_there")).distinct()
    counts = _counted(ids.select(*cols).distinct().join(seen, cols, "left"), cols[-1], F.col("_there").isNull())
    zero, none = F.lit(0).cast("long"), F.array().cast("array<string>")
    job = counts.select(
        F.lit(str(uuid.uuid4())).alias("job_id"), F.lit("DELETE").alias("job_type"), F.lit("READY").alias("status"), F.lit(None).cast("string").alias("message"),
        F.col("total").alias("items_total_count"), zero.alias("items_written_count"), (F.col("total") - F.col("marked")).alias("items_deleted_count"), F.col("marked").alias("items_skipped_count"), zero.alias("items_error_count"),
        F.col("subset").alias("items_skipped_subset"), none.alias("item_errors_subset"),
    )
    return delete(items, ids, cols), job.select(*JOB.names)


def commit(table: DataFrame, job: DataFrame, path: str) -> DataFrame:
    """Write what a bulk job made of a table to another path, then the job's row: COMPLETED, with the rows now there in its message."""
    done = job.sparkSession.createDataFrame(job.collect(), job.schema)  # one row, taken before anything changes
    table.write.mode("error").parquet(path)
    n = job.sparkSession.read.parquet(path).count()
    return done.withColumns({"status": F.lit("COMPLETED"), "message": F.lit(f"{n} items at {path}")})


def export(items: DataFrame, path: str, export_format: str = "parquet") -> None:
    if export_format in ("parquet", "geoparquet"):
        items.write.mode("overwrite").parquet(path)
    elif export_format in ("json", "stacjson"):
        items.write.mode("overwrite").json(path)
    else:
        raise ValueError(f"unknown export format {export_format!r}")


def order_lines(orders: DataFrame, version: str = "1") -> DataFrame:
    """A line for each item of an order (order_id, order_type, items), named and numbered."""
    lines = orders.select("order_id", "order_type", F.posexplode("items").alias("line", "item_id"))
    return lines.withColumn("name", F.concat_ws("_", F.lit("eocube"), F.lit(version), F.lower("order_type"), F.col("order_id").cast("string"), F.col("line").cast("string")))
