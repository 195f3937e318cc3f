"""Zones grown or shrunk by a distance, as outlines with round corners.

What lies within a distance of an outline is a strip along each side and, at each
vertex, a fan in every gap of more than half a turn between the sides that meet
there. A grown zone is the union of the zone, its strips and its fans, a shrunk one
the zone without them; ``overlay`` makes one outline of them by joins. A side's strip
is a row of its own, so a zone of many sides is many rows until its outline is done.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from . import overlay, zonal
from .regions import stored

#: Chords that stand for a quarter of a circle.
QUARTER = 16
#: Vertices are on a grid of this share of the distance (a power of two), so that equal ones are equal.
GRAIN = 2.0**-28
RING = "transform(sequence(0, size(ps) - 1), k -> struct(ps[k].x as x1, ps[k].y as y1, ps[(k + 1) % size(ps)].x as x2, ps[(k + 1) % size(ps)].y as y2))"
RINGS = "transform(sequence(0, size(xs) - 1), k -> struct(xs[k] as x1, ys[k] as y1, xs[(k + 1) % size(xs)] as x2, ys[(k + 1) % size(xs)] as y2))"


def zones_of(spark: SparkSession, shapes) -> DataFrame:
    """(zone, area, edges): polygons, lines and points alike; a point is a side without length."""
    rows = [(i, g.kind in ("Polygon", "MultiPolygon"), [tuple(map(float, e)) for p in G._paths(g) for e in p]) for i, g in enumerate(G.parse(shapes))]
    return spark.createDataFrame(rows, f"zone int, area boolean, edges {G.EDGE}")


def _point(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def _strips(sides: DataFrame, d: float) -> DataFrame:
    """(zone, ps): the rectangle that reaches ``d`` to either side of a side."""
    length = F.sqrt((F.col("x2") - F.col("x1")) ** 2 + (F.col("y2") - F.col("y1")) ** 2)
    nx, ny = -(F.col("y2") - F.col("y1")) * d / length, (F.col("x2") - F.col("x1")) * d / length
    corner = lambda k, s: _point(F.col(f"x{k}") + nx * s, F.col(f"y{k}") + ny * s)
    return sides.where(length > 0).select("zone", F.array(corner(1, -1), corner(2, -1), corner(2, 1), corner(1, 1)).alias("ps"))


def _fans(sides: DataFrame, d: float, quarter: int) -> DataFrame:
    """(zone, ps): a fan of ``d`` in each gap between the sides at a vertex; a whole circle about a vertex without any."""
    turn = F.when((F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2")), F.atan2(F.col("y2") - F.col("y1"), F.col("x2") - F.col("x1")))
    back = F.when(turn.isNotNull(), F.atan2(F.col("y1") - F.col("y2"), F.col("x1") - F.col("x2")))
    ends = sides.select("zone", F.explode(F.array(F.struct(F.col("x1").alias("x"), F.col("y1").alias("y"), turn.alias("t")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y"), back.alias("t")))).alias("e")).select("zone", "e.*")
    met = ends.groupBy("zone", "x", "y").agg(F.sort_array(F.collect_set("t")).alias("ts"))
    gaps = F.expr(f"transform(sequence(0, size(ts) - 1), k -> struct(ts[k] as t, if(k + 1 < size(ts), ts[k + 1], ts[0] + {2 * math.pi!r}D) - ts[k] as wide))")
    gaps = F.when(F.size("ts") > 0, F.filter(gaps, lambda g: g["wide"] > math.pi + 1e-9)).otherwise(F.array(F.struct(F.lit(0.0).alias("t"), F.lit(4 * math.pi).alias("wide"))))
    fan = met.select("zone", "x", "y", F.explode(gaps).alias("g"))
    # the fan lies between the ends of the strips, a quarter turn from the sides; the circle has no tip
    whole = F.col("g.wide") > 3 * math.pi
    start = F.when(whole, F.lit(0.0)).otherwise(F.col("g.t") + math.pi / 2)
    angle = F.when(whole, F.lit(2 * math.pi)).otherwise(F.col("g.wide") - math.pi)
    steps = F.ceil(angle / (math.pi / 2 / quarter) - 1e-6).cast("int")
    at = lambda k: start + k * angle / steps
    arc = F.transform(F.sequence(F.when(whole, 1).otherwise(0), steps), lambda k: _point(F.col("x") + F.cos(at(k)) * d, F.col("y") + F.sin(at(k)) * d))
    return fan.select("zone", F.when(whole, arc).otherwise(F.concat(F.array(_point(F.col("x"), F.col("y"))), arc)).alias("ps"))


def buffer(zones: DataFrame, distance: float, work: str, quarter: int = QUARTER) -> DataFrame:
    """(zone, edges): the outlines of ``zones(zone, edges)`` grown by ``distance`` in the units of their coordinates, shrunk if it is negative.

    Each zone is a geometry of its own. A column ``area`` that is false marks lines
    and points, which have no inside; without the column all have one. Zones that
    are null or have no side, and those that shrink to nothing, have no row; zero
    gives the outline of the zone without inner edges. Arcs are ``quarter`` chords
    to a quarter turn, with their ends on the circle, so they lie within it by at
    most distance * (1 - cos(pi / 4 / quarter)).
    """
    if not math.isfinite(distance):
        raise ValueError("the distance of a buffer is a number")
    kind = zones.schema["zone"].dataType
    d = abs(distance)
    area = F.coalesce(F.col("area"), F.lit(True)) if "area" in zones.columns else F.lit(True)
    own = zones.where("zone is not null and size(edges) > 0").select(F.col("zone").alias("of"), area.alias("area"), "edges")
    parts = own.where("area").select("of", F.lit(False).alias("away"), "edges")
    if d:
        grain = 2.0 ** math.floor(math.log2(d)) * GRAIN
        sides = own.select(F.col("of").alias("zone"), F.explode("edges").alias("e")).select("zone", "e.*")
        near = _strips(sides, d).unionByName(_fans(sides, d, quarter))
        edges = F.filter(F.expr(RING), lambda e: (e["x1"] != e["x2"]) | (e["y1"] != e["y2"]))
        on = lambda v: F.rint(v / grain) * grain
        snapped = near.select("zone", F.transform("ps", lambda p: _point(on(p["x"]), on(p["y"]))).alias("ps"))
        snap = lambda e: F.struct(*(on(e[n]).alias(n) for n in ("x1", "y1", "x2", "y2")))
        parts = parts.withColumn("edges", F.transform("edges", snap)).unionByName(snapped.select(F.col("zone").alias("of"), F.lit(distance < 0).alias("away"), edges.alias("edges")))
    numbered = stored(parts.withColumn("zone", F.monotonically_increasing_id()), f"{work}/parts")
    rings = overlay.union(numbered, work, "of", "away")
    sides = F.expr(RINGS)
    return rings.groupBy(F.col("part").cast(kind).alias("zone")).agg(F.flatten(F.collect_list(sides)).alias("edges"))


def _projected(zones: DataFrame, source: int, target: int) -> DataFrame:
    """The ends of all sides in another system, as columns."""

    def side(e: Column) -> Column:
        a, b = (G.transform_point(e[f"x{k}"], e[f"y{k}"], source, target, F) for k in (1, 2))
        return F.struct(a[0].alias("x1"), a[1].alias("y1"), b[0].alias("x2"), b[1].alias("y2"))

    rest = [c for c in zones.columns if c != "edges"]
    one = zones.select(*rest, F.posexplode("edges").alias("_k", "e")).select(*rest, "_k", side(F.col("e")).alias("e"))
    return one.groupBy(*rest).agg(F.transform(F.array_sort(F.collect_list(F.struct("_k", "e"))), lambda s: s["e"]).alias("edges"))


def buffer_metres(zones: DataFrame, metres: float, work: str, crs: str | int = "EPSG:4326", metres_crs: str | int = "EPSG:6933", quarter: int = QUARTER) -> DataFrame:
    """``buffer`` of zones in ``crs`` by metres of ``metres_crs`` (a cylinder of equal areas unless told otherwise), in ``crs`` again.

    Metres are those of the plane of ``metres_crs``; where they should be true on
    the ground, name a system that is true there, such as the UTM zone.
    """
    source, target = G.epsg(crs), G.epsg(metres_crs)
    keep = zones.select(*(c for c in ("zone", "area", "edges") if c in zones.columns))
    return _projected(buffer(_projected(keep, source, target), metres, work, quarter), target, source)


def zonal_stats(df: DataFrame, zones: DataFrame, metres: float, work: str, crs: str | int = "EPSG:4326", metres_crs: str | int = "EPSG:6933", **how) -> DataFrame:
    """``zonal.zonal_stats`` of zones grown (shrunk) by metres; the pixels' coordinates are in ``crs``."""
    return zonal.zonal_stats(df, buffer_metres(zones, metres, work, crs, metres_crs), **how)
