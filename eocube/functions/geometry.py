"""Geometries on the driver, and tests of pixels against them as columns.

Polygons become arrays of edges; a pixel centre is inside if an odd number of
edges lies to its left. Edges are half open in y and a centre on an edge belongs
to the polygon on its left, so polygons that share an edge never share a pixel.
"""

from __future__ import annotations

import json
import math
import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .projections import SYSTEMS

Ring = list[tuple[float, float]]
RADIUS = 6378137.0  # fixed value: WGS 84 equatorial radius in metres


@dataclass(frozen=True)
class Geometry:
    """Rings of a (multi)polygon; points and lines keep their vertices only."""

    kind: str
    rings: tuple[tuple[tuple[float, float], ...], ...]
    attrs: dict = field(default_factory=dict, hash=False)
    crs: str = "EPSG:4326"

    @property
    def bbox(self) -> tuple[float, float, float, float]:
        xs = [x for r in self.rings for x, _ in r]
        ys = [y for r in self.rings for _, y in r]
        return min(xs), min(ys), max(xs), max(ys)

    @property
    def edges(self) -> list[tuple[float, float, float, float]]:
        return [(*a, *b) for r in self.rings for a, b in zip(r, r[1:] + r[:1], strict=True) if a != b]

    def wkt(self) -> str:
        body = ", ".join("(" + ", ".join(f"{x:.15g} {y:.15g}" for x, y in r) + ")" for r in self.rings)
        return f"POLYGON ({body})" if self.kind in ("Polygon", "MultiPolygon") else f"{self.kind.upper()} {body}"

    def geojson(self) -> str:
        return json.dumps({"type": self.kind, "coordinates": [[list(p) for p in r] for r in self.rings]})


def _rings(kind: str, c) -> list[Ring]:
    if kind == "Point":
        return [[tuple(c[:2])]]
    if kind in ("MultiPoint", "LineString"):
        return [[tuple(p[:2]) for p in c]]
    if kind in ("Polygon", "MultiLineString"):
        return [[tuple(p[:2]) for p in r] for r in c]
    if kind == "MultiPolygon":
        return [[tuple(p[:2]) for p in r] for poly in c for r in poly]
    raise ValueError(f"unknown geometry type {kind!r}")


def _from_geojson(g: dict) -> list[Geometry]:
    kind = g.get("type")
    if kind == "FeatureCollection":
        return [x for f in g["features"] for x in _from_geojson(f)]
    if kind == "Feature":
        return [Geometry(x.kind, x.rings, dict(g.get("properties") or {})) for x in _from_geojson(g["geometry"])]
    if kind == "GeometryCollection":
        return [x for h in g["geometries"] for x in _from_geojson(h)]
    if "coordinates" not in g:
        raise ValueError("not a GeoJSON geometry")
    return [Geometry(kind, tuple(map(tuple, _rings(kind, g["coordinates"]))))]


def _from_wkt(text: str) -> Geometry:
    m = re.match(r"\s*(?:SRID=\d+;)?\s*([A-Za-z]+)\s*(?:Z|M|ZM)?\s*(\(.*\))\s*$", text, re.S)
    kinds = {k.upper(): k for k in ("Point", "MultiPoint", "LineString", "MultiLineString", "Polygon", "MultiPolygon")}
    if not m or m[1].upper() not in kinds:
        raise ValueError(f"not a geometry: {text[:60]!r}")
    lists = [[tuple(map(float, p.replace("(", " ").replace(")", " ").split()[:2])) for p in r.split(",")] for r in re.findall(r"\(([^()]*)\)", m[2])]
    kind = kinds[m[1].upper()]
    if kind == "MultiPoint":
        lists = [[p for r in lists for p in r]]
    return Geometry(kind, tuple(map(tuple, lists)))


def parse(geometry) -> list[Geometry]:
    """WKT, GeoJSON (text or dict), a ``Geometry`` or a list of any of these."""
    if isinstance(geometry, Geometry):
        return [geometry]
    if isinstance(geometry, dict):
        return _from_geojson(geometry)
    if isinstance(geometry, (list, tuple)) and geometry and not isinstance(geometry[0], (int, float)):
        return [x for g in geometry for x in parse(g)]
    if isinstance(geometry, str):
        text = geometry.strip()
        return _from_geojson(json.loads(text)) if text.startswith("{") else [_from_wkt(text)]
    raise ValueError(f"not a geometry: {type(geometry).__name__}")


def parse_bbox(bbox) -> tuple[float, float, float, float]:
    """Four numbers, or six with heights; a list, a tuple or text with commas."""
    values = [float(v) for v in (bbox.split(",") if isinstance(bbox, str) else bbox)]
    if len(values) == 6:
        values = [values[0], values[1], values[3], values[4]]
    if len(values) != 4:
        raise ValueError(f"a bbox has 4 values, not {len(values)}")
    return tuple(values)  # type: ignore[return-value]


def box(xmin: float, ymin: float, xmax: float, ymax: float, **attrs) -> Geometry:
    return Geometry("Polygon", (((xmin, ymin), (xmax, ymin), (xmax, ymax), (xmin, ymax)),), attrs)


@dataclass(frozen=True)
class Union(Geometry):
    """Several geometries as one: its inside is that of any part, so parts may overlap."""

    parts: tuple[Geometry, ...] = ()


def dissolve(parts: list[Geometry]) -> Geometry:
    if len(parts) == 1:
        return parts[0]
    return Union("MultiPolygon", tuple(r for p in parts for r in p.rings), parts=tuple(parts))


def total_bounds(parts: list[Geometry]) -> tuple[float, float, float, float]:
    b = [p.bbox for p in parts]
    return min(x[0] for x in b), min(x[1] for x in b), max(x[2] for x in b), max(x[3] for x in b)


# -- coordinate systems: closed forms only ------------------------------------------------


def epsg(crs: str | int) -> int:
    m = re.search(r"(\d+)$", str(crs))
    if not m:
        raise ValueError(f"not an EPSG code: {crs!r}")
    return int(m[1])


def to_mercator(lon, lat, m=math):
    """Numbers with the module ``math``, columns with Spark's functions; so in all of these."""
    return m.radians(lon) * RADIUS, m.log(m.tan(m.radians(lat) / 2 + math.pi / 4)) * RADIUS


def from_mercator(x, y, m=math):
    return m.degrees(x / RADIUS), m.degrees(m.atan(m.exp(y / RADIUS)) * 2 - math.pi / 2)


def _krueger():
    f = 1 / 298.257223563
    n = f / (2 - f)
    a = RADIUS / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    beta = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480)
    delta = (2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15)
    return n, a, alpha, beta, delta


def to_utm(lon, lat, zone: int, south: bool = False, m=math):
    """Krueger's series to third order: millimetres within a zone."""
    n, a, alpha, _, _ = _krueger()
    s = 2 * math.sqrt(n) / (1 + n)
    phi, lam = m.radians(lat), m.radians(lon - (6 * zone - 183))
    t = m.sinh(m.atanh(m.sin(phi)) - m.atanh(m.sin(phi) * s) * s)
    xi, eta = m.atan2(t, m.cos(lam)), m.atanh(m.sin(lam) / m.sqrt(t * t + 1))
    east = eta + sum(m.cos(xi * (2 * j + 2)) * m.sinh(eta * (2 * j + 2)) * k for j, k in enumerate(alpha))
    north = xi + sum(m.sin(xi * (2 * j + 2)) * m.cosh(eta * (2 * j + 2)) * k for j, k in enumerate(alpha))
    return east * (0.9996 * a) + 500000, north * (0.9996 * a) + (1e7 if south else 0)


def from_utm(x, y, zone: int, south: bool = False, m=math):
    _, a, _, beta, delta = _krueger()
    xi, eta = (y - (1e7 if south else 0)) / (0.9996 * a), (x - 500000) / (0.9996 * a)
    u = xi - sum(m.sin(xi * (2 * j + 2)) * m.cosh(eta * (2 * j + 2)) * k for j, k in enumerate(beta))
    v = eta - sum(m.cos(xi * (2 * j + 2)) * m.sinh(eta * (2 * j + 2)) * k for j, k in enumerate(beta))
    chi = m.asin(m.sin(u) / m.cosh(v))
    lat = chi + sum(m.sin(chi * (2 * j + 2)) * k for j, k in enumerate(delta))
    return m.degrees(m.atan2(m.sinh(v), m.cos(u))) + (6 * zone - 183), m.degrees(lat)


def transform_point(x, y, source: int, target: int, m=math):
    """A point between EPSG:4326, EPSG:3857, the UTM zones (326zz north, 327zz south) and the systems of ``projections``."""
    if source == target:
        return x, y
    if source == 3857:
        x, y = from_mercator(x, y, m)
    elif source // 100 in (326, 327):
        x, y = from_utm(x, y, source % 100, source // 100 == 327, m)
    elif source in SYSTEMS:
        x, y = SYSTEMS[source].back(x, y, m)
    elif source != 4326:
        raise ValueError(f"EPSG:{source} is not supported")
    if target == 3857:
        return to_mercator(x, y, m)
    if target // 100 in (326, 327):
        return to_utm(x, y, target % 100, target // 100 == 327, m)
    if target in SYSTEMS:
        return SYSTEMS[target].forward(x, y, m)
    if target != 4326:
        raise ValueError(f"EPSG:{target} is not supported")
    return x, y


def reproject(g: Geometry, crs: str | int) -> Geometry:
    source, target = epsg(g.crs), epsg(crs)
    if source == target:
        return g
    return Geometry(g.kind, tuple(tuple(transform_point(*p, source, target) for p in r) for r in g.rings), g.attrs, f"EPSG:{target}")


def utm_of(g: Geometry) -> int:
    """The UTM zone of a geographic geometry's middle, as an EPSG code: metres for what is counted in metres."""
    b = g.bbox
    zone = min(60, int((b[0] + b[2]) / 2 + 180) // 6 + 1)
    return (32600 if b[1] + b[3] >= 0 else 32700) + zone


# -- columns ------------------------------------------------------------------------------

EDGE = "array<struct<x1:double,y1:double,x2:double,y2:double>>"


def zones_frame(spark: SparkSession, zones: list[Geometry]) -> DataFrame:
    """(zone, geometry, xmin, ymin, xmax, ymax, edges): a row for each geometry, in order."""
    rows = [(i, z.wkt(), *map(float, z.bbox), [tuple(map(float, e)) for e in z.edges]) for i, z in enumerate(zones)]
    return spark.createDataFrame(rows, f"zone int, geometry string, xmin double, ymin double, xmax double, ymax double, edges {EDGE}")


def _edges(g: Geometry) -> Column:
    return F.array(*[F.struct(*[F.lit(float(v)).alias(n) for n, v in zip(("x1", "y1", "x2", "y2"), e, strict=True)]) for e in g.edges])


def inside(x: Column, y: Column, edges: Column, down: bool = False) -> Column:
    """Is the centre inside? ``down``: rows go down, so the half-open side in y is the other one."""

    def left(e):
        below = (lambda v: v < y) if down else (lambda v: v <= y)
        crosses = below(e["y1"]) != below(e["y2"])
        return crosses & (e["x1"] + (y - e["y1"]) * (e["x2"] - e["x1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)) < x)

    return F.size(F.filter(edges, lambda e: F.coalesce(left(e), F.lit(False)))) % 2 == 1


def meets_pixel(x: Column, y: Column, edges: Column, dx: float, dy: float) -> Column:
    """Does an edge meet the pixel's rectangle?"""
    hx, hy = abs(dx) / 2, abs(dy) / 2

    def meets(e):
        apart = (F.greatest(e["x1"], e["x2"]) < x - hx) | (F.least(e["x1"], e["x2"]) > x + hx) | (F.greatest(e["y1"], e["y2"]) < y - hy) | (F.least(e["y1"], e["y2"]) > y + hy)
        side = [(e["x2"] - e["x1"]) * (y + b - e["y1"]) - (e["y2"] - e["y1"]) * (x + a - e["x1"]) for a in (-hx, hx) for b in (-hy, hy)]
        return ~apart & (F.least(*side) <= 0) & (F.greatest(*side) >= 0)

    return F.exists(edges, meets)


def touches(x: Column, y: Column, edges: Column, dx: float, dy: float) -> Column:
    """Does the pixel's rectangle meet the polygon at all?"""
    return inside(x, y, edges) | meets_pixel(x, y, edges, dx, dy)


def in_box(x: Column, y: Column, b: tuple[float, float, float, float]) -> Column:
    return x.between(b[0], b[2]) & y.between(b[1], b[3])


def _any(g: Geometry, test) -> Column:
    """A test of each part of a geometry, or-ed."""
    return reduce(lambda a, b: a | b, (test(p) for p in (g.parts if isinstance(g, Union) else [g])))


def contains(g: Geometry, x: Column, y: Column, down: bool = False) -> Column:
    """Bounding box first, which reaches the scan, then the exact test."""
    return in_box(x, y, g.bbox) & _any(g, lambda p: inside(x, y, _edges(p), down))


def distance_to(g: Geometry, x: Column, y: Column) -> Column:
    """Distance to the nearest edge, in the units of the coordinates."""

    def one(e):
        ex, ey = e["x2"] - e["x1"], e["y2"] - e["y1"]
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((x - e["x1"]) * ex + (y - e["y1"]) * ey) / (ex * ex + ey * ey)))
        return F.sqrt(F.pow(x - e["x1"] - t * ex, 2) + F.pow(y - e["y1"] - t * ey, 2))

    return F.array_min(F.transform(_edges(g), one))


def within_buffer(g: Geometry, x: Column, y: Column, distance: float, down: bool = False) -> Column:
    """Inside the geometry grown by ``distance``."""
    b = g.bbox
    grown = (b[0] - distance, b[1] - distance, b[2] + distance, b[3] + distance)
    return in_box(x, y, grown) & (_any(g, lambda p: inside(x, y, _edges(p), down)) | (distance_to(g, x, y) <= distance))


def within_metres(g: Geometry, x: Column, y: Column, metres: float) -> Column:
    """Inside a geographic geometry grown by metres: distances are those of its UTM zone, pixels are projected as columns."""
    code = utm_of(g)
    east, north = transform_point(x, y, 4326, code, F)
    return within_buffer(reproject(g, code), east, north, metres)


def _paths(g: Geometry) -> list[list[tuple]]:
    """Pieces of a geometry's outline; lines aren't closed, a point is an edge without length."""
    closed = g.kind in ("Polygon", "MultiPolygon")
    if g.kind in ("Point", "MultiPoint"):
        return [[(*p, *p)] for r in g.rings for p in r]
    return [[(*a, *b) for a, b in zip(r, r[1:] + (r[:1] if closed else ()), strict=False) if a != b] for r in g.rings]


def item_edges(geometry: Column | None, bbox: Column) -> Column:
    """The outline of an item: that of its GeoJSON polygon or multipolygon, else of its bbox."""
    flat = lambda c: F.transform(c, lambda r: F.transform(F.sequence(F.lit(0), F.size(r) - 2), lambda i: F.struct(r[i][0].alias("x1"), r[i][1].alias("y1"), r[i + 1][0].alias("x2"), r[i + 1][1].alias("y2"))))
    right = F.when(F.size(bbox) == 6, F.element_at(bbox, 4)).otherwise(F.element_at(bbox, 3))
    top = F.when(F.size(bbox) == 6, F.element_at(bbox, 5)).otherwise(F.element_at(bbox, 4))
    left, low = F.element_at(bbox, 1), F.element_at(bbox, 2)
    ring = F.array(*[F.array(a, b) for a, b in ((left, low), (right, low), (right, top), (left, top), (left, low))])
    box_ = F.flatten(flat(F.array(ring)))
    if geometry is None:
        return box_
    kind, coords = F.get_json_object(geometry, "$.type"), F.get_json_object(geometry, "$.coordinates")
    one = F.from_json(coords, "array<array<array<double>>>")
    many = F.flatten(F.from_json(coords, "array<array<array<array<double>>>>"))
    return F.coalesce(F.when(kind == "Polygon", F.flatten(flat(one))).when(kind == "MultiPolygon", F.flatten(flat(many))), box_)


def _side(a, b, c, d, x, y):
    return (c - a) * (y - b) - (d - b) * (x - a)


def edges_meet(edges: Column, g: Geometry) -> Column:
    """Does an outline (array of edges) meet a geometry: do edges cross or touch, or lies one within the other?"""
    own = [e for path in _paths(g) for e in path]
    literal = F.array(*[F.struct(*[F.lit(float(v)).alias(n) for n, v in zip(("x1", "y1", "x2", "y2"), e, strict=True)]) for e in own])

    def cross(e, f):
        near = (F.greatest(e["x1"], e["x2"]) >= F.least(f["x1"], f["x2"])) & (F.greatest(f["x1"], f["x2"]) >= F.least(e["x1"], e["x2"])) & (F.greatest(e["y1"], e["y2"]) >= F.least(f["y1"], f["y2"])) & (F.greatest(f["y1"], f["y2"]) >= F.least(e["y1"], e["y2"]))
        s = [_side(e["x1"], e["y1"], e["x2"], e["y2"], f[p], f[q]) for p, q in (("x1", "y1"), ("x2", "y2"))]
        t = [_side(f["x1"], f["y1"], f["x2"], f["y2"], e[p], e[q]) for p, q in (("x1", "y1"), ("x2", "y2"))]
        return near & (F.signum(s[0]) * F.signum(s[1]) <= 0) & (F.signum(t[0]) * F.signum(t[1]) <= 0)

    out = F.exists(edges, lambda e: F.exists(literal, lambda f: cross(e, f)))
    if g.kind in ("Polygon", "MultiPolygon"):
        out = out | F.exists(edges, lambda e: inside(e["x1"], e["y1"], literal))
    corner = [r[0] for r in g.rings]
    return out | reduce(lambda a, b: a | b, (inside(F.lit(float(x)), F.lit(float(y)), edges) for x, y in corner))


def boxes_meet(bbox: Column, b: tuple[float, float, float, float]) -> Column:
    """Does an item's bbox (4 or 6 numbers) meet the box?"""
    upper = F.when(F.size(bbox) == 6, F.element_at(bbox, 4)).otherwise(F.element_at(bbox, 3))
    top = F.when(F.size(bbox) == 6, F.element_at(bbox, 5)).otherwise(F.element_at(bbox, 4))
    return (F.element_at(bbox, 1) <= b[2]) & (upper >= b[0]) & (F.element_at(bbox, 2) <= b[3]) & (top >= b[1])
