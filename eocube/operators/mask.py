"""Masking pixels and counting what stays clear."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import DatacubeMaskingError
from ..functions import geometry as G
from ..functions.collections import NATIVE_MASKS
from ..model import bands_of

#: Classes that are no clear ground.
SCL_LEGACY = [1, 3, 8, 9, 10, 11]
SCL_CLOUDS = [3, 8, 9, 10]


def clear_condition(df: DataFrame, mask: str, clear_values: list | None = None, exclude_values: list | None = None, custom: Callable[[DataFrame], Column] | None = None) -> Column:
    """What is clear: a custom condition first, then values that are clear, then values that aren't.

    A missing mask pixel isn't among the clear values, nor among the excluded ones.
    """
    if custom is not None:
        out = custom(df)
        if not isinstance(out, Column):
            raise DatacubeMaskingError("a custom mask returns a boolean column")
        return F.coalesce(out, F.lit(False))
    if mask not in df.columns:
        raise DatacubeMaskingError(f"no mask band {mask!r}; there are {bands_of(df)}")
    if clear_values is not None:
        return F.coalesce(F.col(mask).isin(list(clear_values)), F.lit(False))
    if exclude_values is not None:
        return ~F.coalesce(F.col(mask).isin(list(exclude_values)), F.lit(False))
    raise DatacubeMaskingError("clear values, excluded values or a custom mask are needed")


def native_clear(df: DataFrame, collection: str, band: str | None = None) -> Column:
    """What a collection's own mask calls clear: scene classes without clouds, label 0, or the bits of a QA band."""
    if collection not in NATIVE_MASKS:
        raise DatacubeMaskingError(f"no native mask of {collection!r}; there are {sorted(NATIVE_MASKS)}")
    name, asset = NATIVE_MASKS[collection]
    band = band or asset
    if name == "scl":
        return clear_condition(df, band, exclude_values=SCL_LEGACY)
    if name == "landsat_qa_pixel":
        return clear_condition(df, band, custom=lambda d: qa_pixel_clear(d[band]))
    return clear_condition(df, band, clear_values=[0])


def mask_pixels(df: DataFrame, mask: str, clear: Column, fill: float | None = None, drop: bool = False) -> DataFrame:
    """All bands but the mask where it is clear, else ``fill``; one projection."""
    kinds = dict(df.dtypes)
    new = {b: F.when(clear, F.col(b)).otherwise(F.lit(fill).cast(kinds[b])) for b in bands_of(df) if b != mask}
    out = df.withColumns(new)
    return out.drop(mask) if drop else out


def _area(geometry=None, bbox=None) -> G.Geometry | None:
    if bbox is not None:  # a box is taken before a geometry here
        return G.box(*G.parse_bbox(bbox))
    return G.dissolve(G.parse(geometry)) if geometry is not None else None


def usable_pixels(df: DataFrame, geometry=None, bbox=None) -> DataFrame:
    """One row: the cells of the grid, or of it within a geometry."""
    area, cells = _area(geometry, bbox), df.select("y", "x").distinct()
    if area is not None:
        cells = cells.where(G.contains(area, F.col("x"), F.col("y")))
    return cells.agg(F.count("*").alias("usable_pixels"))


def statistics(df: DataFrame, clear: Column, geometry=None, bbox=None, grid_cells: int | None = None) -> DataFrame:
    """(time, clear_pixels int, clear_percent float): clear pixels of each time against all usable ones.

    The usable cells are counted once for the grid, not for each time.
    """
    area = _area(geometry, bbox)
    inside = clear if area is None else clear & G.contains(area, F.col("x"), F.col("y"))
    counted = df.groupBy("time").agg(F.sum(F.coalesce(inside, F.lit(False)).cast("int")).cast("int").alias("clear_pixels"))
    usable = df.sparkSession.range(1).select(F.lit(grid_cells).alias("usable_pixels")) if grid_cells else usable_pixels(df, geometry, bbox)
    percent = F.least(F.lit(100.0), F.greatest(F.lit(0.0), 100.0 * F.col("clear_pixels") / F.nullif("usable_pixels", F.lit(0))))
    return counted.crossJoin(F.broadcast(usable)).select("time", "clear_pixels", percent.cast("float").alias("clear_percent"))


def clear_cover(df: DataFrame, stats: DataFrame, least: float) -> DataFrame:
    """Times that are clear enough; the statistics stay a plan, nothing is collected."""
    if "clear_percent" not in stats.columns:
        raise DatacubeMaskingError("clear cover needs mask statistics")
    return df.join(stats.where(F.col("clear_percent") >= least).select("time"), "time", "left_semi")


def legacy_percent(clear: Column, usable: Column) -> Column:
    """The percentage cut to a whole number."""
    return F.floor(100.0 * clear / usable).cast("tinyint")


def qa_pixel_clear(qa: Column, strict: bool = True) -> Column:
    """Bit 6 of a Landsat QA value; ``strict`` takes only values of 15 bits for clear."""
    bit = F.getbit(qa.cast("int"), F.lit(6)) == 1
    return F.coalesce(bit & qa.between(16384, 32767) if strict else bit, F.lit(False))


def first_mask(columns: list[Column]) -> Column:
    """The first mask that has a value."""
    return F.coalesce(*columns)


def round_to_seconds(time: Column) -> Column:
    """To the nearest second, halves to the even one."""
    micros = F.unix_micros(time.cast("timestamp"))
    return F.timestamp_micros((F.bround(micros / 1_000_000.0) * 1_000_000).cast("long")).cast("timestamp_ntz")
