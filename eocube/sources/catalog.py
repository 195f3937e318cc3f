"""Catalogue scans: search over a table of items, by predicates that reach the scan."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..errors import NoItemsFoundError
from ..functions import geometry as G
from ..functions import query_lang as Q
from ..model import ITEM


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """Items from Parquet, or JSON lines in the item schema."""
    return spark.read.parquet(path) if path.rstrip("/").endswith(".parquet") else spark.read.schema(ITEM).json(path)


def parsed(items: DataFrame, path: str) -> DataFrame:
    """Items with their properties as a VARIANT, written once and read again: searches take typed paths and parse no text.

    Properties that are no JSON are missing.
    """
    items.withColumn("properties", F.try_parse_json("properties")).write.mode("overwrite").parquet(path)
    return items.sparkSession.read.parquet(path)


def search(items: DataFrame, *, collections=None, datetime=None, bbox=None, intersects=None, ids=None, query=None, filter=None, post_query=None, sortby=None, fields=None, assets=None, max_items=None, days_per_chunk=None, max_items_per_chunk=None) -> DataFrame:
    """Items that meet all predicates given.

    ``intersects`` is a geometry; its bounding box is compared with the item's
    first, then the outlines: that of the item is its ``geometry`` (GeoJSON, a
    polygon or several) where the table has one, else its bbox. With ``max_items_per_chunk``, each chunk of the time range gives so
    many items at most, the newest chunk first.
    """
    if max_items is not None and days_per_chunk is not None:
        raise ValueError("max_items and days_per_chunk don't go together; use max_items_per_chunk")
    if max_items_per_chunk is not None and datetime is None:
        raise ValueError("chunks need a datetime")
    out, keep = items, []
    if collections is not None:
        keep.append(F.col("collection").isin([collections] if isinstance(collections, str) else list(collections)))
    if datetime is not None:
        keep.append(Q.in_range(F.col("datetime"), datetime))
    if ids is not None:
        keep.append(F.col("id").isin([ids] if isinstance(ids, (str, int)) else list(ids)))
    if bbox is not None:
        keep.append(G.boxes_meet(F.col("bbox"), G.parse_bbox(bbox)))
    if intersects is not None:
        parts = G.parse(intersects)
        keep.append(G.boxes_meet(F.col("bbox"), G.total_bounds(parts)))
        edges = G.item_edges(F.col("geometry") if dict(items.dtypes).get("geometry") == "string" else None, F.col("bbox"))
        keep.append(reduce(lambda a, b: a | b, (G.edges_meet(edges, p) for p in parts)))
    if query:
        keep.append(Q.stac_query(items, query))
    if filter:
        keep.append(Q.cql2(items, filter))
    if post_query:
        keep.append(Q.post_query(items, post_query))
    for c in keep:
        out = out.where(c)
    if max_items_per_chunk is not None:
        out = limit_per_chunk(out, datetime, days_per_chunk or "auto", max_items_per_chunk)
    if assets is not None:
        out = select_assets(out, assets)
    if sortby is not None:
        out = out.orderBy(*Q.sort_keys(out, sortby))
    if max_items is not None:
        out = out.limit(max_items) if sortby is not None else out.orderBy("datetime", "id").limit(max_items)
    if fields is not None:
        out = out.select(*fields)
    return out


def require_items(items: DataFrame) -> DataFrame:
    """The same, or an error where there are none."""
    if not items.limit(1).count():
        raise NoItemsFoundError("no items found")
    return items


def chunk_of(time: Column, datetime, days="auto") -> Column:
    """The number of the chunk that a time is in, 0 for the newest."""
    chunks = Q.split_range(datetime, days)  # all of one length but the newest, which may be shorter
    (_, hi), (lo, stop) = chunks[0], chunks[-1]
    micros = lambda t: F.unix_micros(t.cast("timestamp"))
    at = F.floor((micros(time) - micros(F.lit(lo).cast("timestamp_ntz"))) / F.lit(((stop - lo) // timedelta(microseconds=1)) + 1))
    inside = time.between(F.lit(lo).cast("timestamp_ntz"), F.lit(hi).cast("timestamp_ntz"))
    return F.when(inside, F.lit(len(chunks) - 1) - at).cast("int")


def limit_per_chunk(items: DataFrame, datetime, days, most: int) -> DataFrame:
    w = Window.partitionBy("_chunk").orderBy(F.col("datetime"), F.col("id"))
    ranked = items.withColumn("_chunk", chunk_of(F.col("datetime"), datetime, days)).withColumn("_rank", F.row_number().over(w))
    return ranked.where((F.col("_rank") <= most) & F.col("_chunk").isNotNull()).drop("_chunk", "_rank")


def get_item(items: DataFrame, collection: str, item_id: str) -> DataFrame:
    return items.where((F.col("collection") == collection) & (F.col("id") == item_id))


def select_assets(items: DataFrame, assets: list[str] | dict[str, str]) -> DataFrame:
    """Only these assets; a dict renames them."""
    names = list(assets)
    kept = F.map_filter("assets", lambda k, _: k.isin(names))
    if isinstance(assets, dict):
        new = F.create_map(*[F.lit(x) for kv in assets.items() for x in kv])
        kept = F.transform_keys(kept, lambda k, _: new[k])
    return items.withColumn("assets", kept)


def explore(items: DataFrame, collection: str | None = None) -> DataFrame:
    """The collections, or the first item of one."""
    if collection is None:
        return items.select("collection").distinct().orderBy("collection")
    return items.where(F.col("collection") == collection).orderBy("datetime", "id").limit(1)


def asset_names(items: DataFrame) -> DataFrame:
    return items.select("collection", F.explode(F.map_keys("assets")).alias("asset")).distinct()


def cloud_mask_items(items: DataFrame, masks: DataFrame, mask: str = "cloud_mask") -> DataFrame:
    """Mask items that items with an available mask refer to: an equi semi join on collection and id."""
    wanted = items.where(Q.property_of(items, f"eda:{mask}_available").cast("boolean")).select(Q.property_of(items, f"eda:{mask}_collection_id").alias("collection"), Q.property_of(items, f"eda:{mask}_item_id").alias("id"))
    return masks.join(wanted, ["collection", "id"], "left_semi")


def mask_available(items: DataFrame, mask: str, query: dict | None = None) -> DataFrame:
    """Items whose mask is available and that also meet the caller's own query."""
    return items.where(Q.stac_query(items, {f"eda:{mask}_available": {"eq": True}} | (query or {})))
