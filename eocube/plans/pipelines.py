"""Composed queries: the one-call cube pipeline and collection helpers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..cube import Datacube
from ..functions import geometry as G
from ..functions import indices as I
from ..functions import query_lang as Q
from ..model import CubeMeta
from ..operators import build, mask, mutate, ops, temporal, xcal, zonal
from ..operators import items as items_ops
from ..sources import catalog


@dataclass(frozen=True)
class SpatioTemporalGeometry:
    """A geometry and a span of time: the usual area of interest."""

    geometry: object
    time_range: tuple | str | None = None
    crs: str = "EPSG:4326"

    def of_items(self, items: DataFrame) -> DataFrame:
        out = items.where(G.boxes_meet(F.col("bbox"), G.total_bounds(G.parse(self.geometry))))
        return out.where(Q.in_range(F.col("datetime"), self.time_range)) if self.time_range else out


def legacy_cube(pixels: DataFrame, mask_band: str, exclude: list[int], nodata: dict[str, float] | None = None, geometry=None, rules: DataFrame | None = None, platform: str | None = None, clear_cover: float | None = None, method: str = "mean") -> DataFrame:
    """Missing values, calibration, clip, mask, one image a date, clear-cover filter: one lazy plan in this order."""
    df = pixels
    if nodata:
        df = df.withColumns({b: F.when(F.col(b) != v, F.col(b)) for b, v in nodata.items()})
    if rules is not None and platform:
        df = xcal.calibrate(df, rules, platform)
    if platform:
        df = df.drop(platform)
    if geometry is not None:
        df = ops.clip(df, geometry, keep_rectangle=False)
    clear = mask.clear_condition(df, mask_band, exclude_values=exclude)
    marked = mask.mask_pixels(df, mask_band, clear).withColumn("_clear", clear.cast("int")).drop(mask_band)
    daily = temporal.temporal_aggregate(marked, method, groupby="time.date")
    if clear_cover is None:
        return daily.drop("_clear")
    cells = mask.usable_pixels(daily)
    stats = daily.groupBy("time").agg(F.sum((F.col("_clear") > 0).cast("int")).alias("n")).crossJoin(F.broadcast(cells))
    enough = stats.where(mask.legacy_percent(F.col("n"), F.col("usable_pixels")) >= clear_cover)
    return daily.drop("_clear").join(enough.select("time"), "time", "left_semi")


def sentinel2_cube(pixels: DataFrame, items: DataFrame, most_cloud: float = 20.0, mask_band: str = "scl", exclude: list[int] = mask.SCL_CLOUDS) -> tuple[DataFrame, DataFrame]:
    """Pixels of items under a cloud cover, masked by scene class, and the mask statistics."""
    times = items.where(Q.property_of(items, "eo:cloud_cover").cast("double") < most_cloud).select(F.col("datetime").alias("time")).distinct()
    df = pixels.join(times, "time", "left_semi")
    clear = mask.clear_condition(df, mask_band, exclude_values=exclude)
    return mask.mask_pixels(df, mask_band, clear), mask.statistics(df, clear)


def sentinel1_items(items: DataFrame, polarizations: list[str] | None = None, orbit_state: str | None = None, mode: str | None = None) -> DataFrame:
    """Items with these polarisations, orbit direction and instrument mode."""
    query = {k: {"eq": v} for k, v in (("sat:orbit_state", orbit_state), ("sar:instrument_mode", mode)) if v}
    out = catalog.search(items, query=query) if query else items
    return items_ops.filter_by_polarization(out, polarizations) if polarizations else out


def index_by_zone(pixels: DataFrame, zones, mask_band: str, exclude: list[int], least_clear: float, index: str, reducers: list[str], **letters: str) -> DataFrame:
    """Masked, clear enough, an index, its monthly mean, and that by zone: the flagship query."""
    clear = mask.clear_condition(pixels, mask_band, exclude_values=exclude)
    good = mask.clear_cover(mask.mask_pixels(pixels, mask_band, clear), mask.statistics(pixels, clear), least_clear)
    values = I.add_indices(good, [index], **letters).select("time", "y", "x", index)
    monthly = temporal.temporal_aggregate(values, "mean", "1ME")
    # cells of the whole grid have owners, as the grid doesn't depend on what is clear
    owner = zonal.owners(pixels, zones)
    out = monthly.join(owner, ["y", "x"]).groupBy(F.col("zone").alias("feature"), F.col("time").alias("month"))
    return out.agg(*(zonal.REDUCERS[r](F.col(index)).alias(f"{index.lower()}_{r}") for r in reducers))




def legacy_search(items: DataFrame, *, assets=None, alternate: str | None = "download", raise_no_items: bool = True, deduplicate: bool = True, **search) -> DataFrame:
    """Search in the order of time, with chosen assets, alternate addresses and near-duplicates left out."""
    out = catalog.search(items, **search)
    if assets is not None:
        out = catalog.select_assets(out, assets)
    if alternate and "assets" in out.columns:
        out = items_ops.replace_hrefs(out, f"alternate.{alternate}.href")
    if raise_no_items:
        catalog.require_items(out)
    if deduplicate:
        out = items_ops.near_duplicates(out.withColumn("_place", items_ops.footprint(out)), ["_place"]).drop("_place", "group_start")
    return out.orderBy("datetime", "id")


def batched_search(items: DataFrame, datetime, days: int | str = "auto", **search) -> DataFrame:
    """The search by spans of ``days``, the newest first: one scan with the span's number, no request for each."""
    found = catalog.search(items, datetime=datetime, **search)
    return found.withColumn("batch", catalog.chunk_of(F.col("datetime"), datetime, days))


def bulk_search(items: DataFrame, path: str, export_format: str = "parquet", **search) -> DataFrame:
    """Export the items found; the job's one row."""
    found = catalog.search(items, **search)
    mutate.export(found, path, export_format)
    written = found.sparkSession.read.format("json" if "json" in export_format else "parquet").schema(found.schema).load(path)
    zero, none = F.lit(0).cast("long"), F.array().cast("array<string>")
    return written.agg(F.count("*").alias("n")).select(
        F.uuid().alias("job_id"), F.lit("SEARCH").alias("job_type"), F.lit("COMPLETED").alias("status"), F.lit(path).alias("message"), F.col("n").alias("items_total_count"), F.col("n").alias("items_written_count"),
        zero.alias("items_deleted_count"), zero.alias("items_skipped_count"), zero.alias("items_error_count"), none.alias("items_skipped_subset"), none.alias("item_errors_subset"),
    )


def create_cube(items: DataFrame, pixels: DataFrame, assets=None, deduplicate_by=None, deduplicate_keep: str = "last", properties: list[str] | None = None, params: DataFrame | None = None) -> Datacube:
    """Pixels of the times of (de-duplicated) items, scaled, with properties as coordinates of time."""
    chosen = items_ops.deduplicate(items, deduplicate_by, deduplicate_keep) if deduplicate_by else items
    df = build.build(pixels.sparkSession, pixels, assets=assets).join(chosen.select(F.col("datetime").alias("time")).distinct(), "time", "left_semi")
    if params is not None:
        df = build.scale_offset(df, params)
    coords = build.time_properties(df, chosen, properties) if properties else None
    return Datacube(df, CubeMeta(attrs={"engine": "spark"}), coords)


def helper_items(items: DataFrame, geometry=None, intersects=None, time_range=None, **search) -> DataFrame:
    """Items of one geometry and span of time."""
    if geometry is not None and intersects is not None:
        raise ValueError("geometry and intersects don't go together")
    return catalog.search(items, intersects=geometry if geometry is not None else intersects, datetime=time_range, **search)
