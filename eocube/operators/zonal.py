"""Zonal statistics: zones are turned into owners of grid cells once, then joined to pixels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..model import bands_of
from .cover import cells_in

#: Reducers by name; missing values are skipped, the smallest of equally frequent values is the mode.
REDUCERS = {
    "mean": F.avg,
    "median": F.median,
    "min": F.min,
    "max": F.max,
    "sum": lambda c: F.coalesce(F.sum(c), F.lit(0.0)),
    "std": F.stddev_pop,
    "var": F.var_pop,
    "mode": lambda c: F.mode(c, True),
    "count": F.count,
}


#: Sides of all zones together up to which each cell is held against each zone's box.
FEW_SIDES = 256


def owners(df: DataFrame, zones: DataFrame | list, all_touched: bool = False, overlap: str = "last", dx: float = 1.0, dy: float = 1.0) -> DataFrame:
    """(y, x, zone): the zone that owns each cell of the grid, the later one of several (``overlap="all"``: all).

    The cells of the grid are distinct first, so times don't multiply the work. A
    few zones that the driver has go to all tasks; others become squares of a tree
    (``cover``), which cells meet by an equi-join, and only cells on a zone's edge
    take the exact test.
    """
    cells = df.select("y", "x").distinct()
    x, y = F.col("x").cast("double"), F.col("y").cast("double")
    if not isinstance(zones, DataFrame) and sum(len(z.edges) for z in zones) <= FEW_SIDES:
        z = G.zones_frame(df.sparkSession, zones).drop("geometry")
        hx, hy = (abs(dx) / 2, abs(dy) / 2) if all_touched else (0.0, 0.0)
        near = (x >= F.col("xmin") - hx) & (x <= F.col("xmax") + hx) & (y >= F.col("ymin") - hy) & (y <= F.col("ymax") + hy)
        exact = G.touches(x, y, F.col("edges"), dx, dy) if all_touched else G.inside(x, y, F.col("edges"), dy < 0)
        hit = cells.join(F.broadcast(z), near & exact).select("y", "x", "zone")
    else:
        z = zones if isinstance(zones, DataFrame) else G.zones_frame(df.sparkSession, zones)
        hit = cells_in(cells, z, dx, dy, all_touched)
    return hit if overlap == "all" else hit.groupBy("y", "x").agg(F.max("zone").alias("zone"))


def zonal_stats(df: DataFrame, zones: DataFrame | list, reducers: list[str] | None = None, all_touched: bool = True, overlap: str = "last", dx: float = 1.0, dy: float = 1.0, attributes: DataFrame | None = None, wkt: bool = False) -> DataFrame:
    """(feature, time, <band>_<reducer> ...): zones without a pixel have no row.

    ``attributes`` (zone, ...) are joined by the zone's number; ``wkt`` adds the zone's geometry as text.
    """
    names = reducers or ["mean"]
    unknown = [r for r in names if r not in REDUCERS]
    if unknown:
        raise ValueError(f"unknown reducers {unknown}; there are {sorted(REDUCERS)}")
    own = owners(df, zones, all_touched, overlap, dx, dy)
    aggs = [REDUCERS[r](F.col(b)).alias(f"{b}_{r}") for b in bands_of(df) for r in names]
    out = df.join(own, ["y", "x"]).groupBy(F.col("zone").alias("feature"), "time").agg(*aggs)
    if wkt:
        z = zones if isinstance(zones, DataFrame) else G.zones_frame(df.sparkSession, zones)
        out = out.join(z.select(F.col("zone").alias("feature"), "geometry"), "feature")
    return out if attributes is None else out.join(attributes.withColumnRenamed("zone", "feature"), "feature", "left")


def long_form(stats: DataFrame, bands: list[str], reducers: list[str]) -> DataFrame:
    """(feature, time, band, zonal_statistic, value): a row for each number."""
    parts = ", ".join(f"'{b}', '{r}', cast(`{b}_{r}` as double)" for b in bands for r in reducers)
    return stats.selectExpr("feature", "time", f"stack({len(bands) * len(reducers)}, {parts}) as (band, zonal_statistic, value)")


def require_overlap(stats: DataFrame) -> DataFrame:
    if not stats.limit(1).count():
        raise ValueError("no zone has a pixel of the cube")
    return stats


def reducer(name: str, c: Column) -> Column:
    return REDUCERS[name](c)
