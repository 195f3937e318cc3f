import math
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from eocube.functions import collections as C
from eocube.functions import geometry as G
from eocube.functions.freq import parse, step_of
from eocube.model import GridSpec
from eocube.operators import ops, regions, whittaker
from eocube.sources import tiff


@pytest.mark.parametrize(("kind", "samples", "deflate"), [("u1", 1, True), ("u2", 3, True), ("i2", 1, False), ("f4", 2, True)])
def test_tiff_round_trip(kind, samples, deflate):
    a = np.random.default_rng(1).integers(0, 100, (37, 21, samples)).astype(kind)
    raw = tiff.encode(a, 16, deflate, (100.0, 50.0, 2.0, 3.0), 32631)
    got, top, left = tiff.pixels(raw)
    assert (got == a).all() and (top, left) == (0, 0)
    got, top, left = tiff.pixels(raw, (10, 5, 20, 100))
    assert (got == a[10:30, 5:]).all() and (top, left) == (10, 5)
    h = tiff.header(raw)
    assert h["transform"] == [2.0, 0.0, 100.0, 0.0, -3.0, 50.0] and h["epsg"] == 32631 and h["samples"] == samples


def strips(a, packing):
    """A TIFF of strips of four rows, as other writers make it."""
    rows = [a[r : r + 4].tobytes() for r in range(0, len(a), 4)]
    rows = [zlib.compress(x) for x in rows] if packing == 8 else rows
    n, head = len(rows), 8 + 2 + 12 * 8 + 4
    tags = [(256, 4, 1, a.shape[1]), (257, 4, 1, a.shape[0]), (258, 3, 1, 8), (259, 3, 1, packing), (273, 4, n, head), (277, 3, 1, 1), (278, 4, 1, 4), (279, 4, n, head + 4 * n)]
    at = head + 8 * n
    starts = [at + sum(map(len, rows[:i])) for i in range(n)]
    return b"II*\0" + struct.pack("<IH", 8, 8) + b"".join(struct.pack("<HHII", *t) for t in tags) + bytes(4) + struct.pack(f"<{2 * n}I", *starts, *map(len, rows)) + b"".join(rows)


@pytest.mark.parametrize("packing", [1, 8])
def test_strips(packing):
    a = np.arange(10 * 7, dtype="u1").reshape(10, 7)
    assert (tiff.pixels(strips(a, packing))[0][:, :, 0] == a).all()
    assert (tiff.pixels(strips(a, packing), (5, 2, 3, 3))[0][:, :, 0] == a[5:8, 2:5]).all()


def test_unknown_packing_is_an_error(spark, tmp_path):
    (tmp_path / "a.tif").write_bytes(strips(np.zeros((8, 3), "u1"), 7))
    with pytest.raises(Exception, match="compression 7"):
        tiff.read_pixels(spark, str(tmp_path)).collect()


def test_polygons_of_regions(spark, tmp_path):
    """A ring with a hole and a single cell that touches it at a corner."""
    cells = [(x, y) for x in range(3) for y in range(3) if (x, y) != (1, 1)] + [(3, 3)]
    df = spark.createDataFrame([(1, float(y), float(x)) for x, y in cells], "time int, y double, x double")
    grid = GridSpec(0.0, 0.0, 1.0, 1.0, 10, 10)
    found = regions.connected_regions(df, F.lit(True), grid, str(tmp_path / "w"))
    wkt = {r.region: G.parse(r.wkt)[0] for r in regions.region_polygons(found, grid, str(tmp_path / "p")).collect()}
    assert sorted(len(g.rings) for g in wkt.values()) == [1, 2]
    assert wkt[33].bbox == (2.5, 2.5, 3.5, 3.5) and wkt[0].bbox == (-0.5, -0.5, 2.5, 2.5)


def area(ring):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1], strict=True)) / 2


def test_outlines_through_many_tiles(spark, tmp_path, monkeypatch):
    """A spiral, a comb and noise over tiles of four cells: areas, holes and turns are those of the raster."""
    monkeypatch.setattr(regions, "TILE", 4)
    rng = np.random.default_rng(6)
    grid = GridSpec(100.0, 50.0, 2.0, -3.0, 40, 30)
    masks = {0: np.ones((30, 40), bool), 1: rng.random((30, 40)) < 0.62, 2: np.zeros((30, 40), bool), 3: np.add.outer(np.arange(30) % 2 == 0, np.arange(40) == 0)}
    y, x, step = 0, 0, [(0, 1), (1, 0), (0, -1), (-1, 0)]
    for k in range(24):
        for _ in range(max(1, 28 - k)):
            masks[2][y, x] = True
            ny, nx = y + step[k % 4][0], x + step[k % 4][1]
            if not (0 <= ny < 30 and 0 <= nx < 40):
                break
            y, x = ny, nx
    rows = [(t, 50.0 - 3 * j, 100.0 + 2 * i) for t, m in masks.items() for j, i in zip(*np.nonzero(m), strict=True)]
    df = spark.createDataFrame([(t, float(y), float(x)) for t, y, x in rows], "time int, y double, x double")
    found = regions.connected_regions(df, F.lit(True), grid, str(tmp_path / "w"))
    label = {(r.time, round((50 - r.y) / 3), round((r.x - 100) / 2)): r.region for r in found.collect()}
    got = {(r.time, r.region): G.parse(r.wkt)[0] for r in regions.region_polygons(found, grid, str(tmp_path / "p")).collect()}
    assert set(got) == {(t, r) for (t, _, _), r in label.items()}
    for (t, region), g in got.items():
        own = {(j, i) for (u, j, i), r in label.items() if (u, r) == (t, region)}
        assert sum(area(r) for r in g.rings) == pytest.approx(6 * len(own)) and area(g.rings[0]) > 0 and all(area(r) < 0 for r in g.rings[1:])
        turns = sum(abs(sum(s for a, b, s in ((0, 0, 1), (1, 1, 1), (0, 1, -1), (1, 0, -1)) if (j - a, i - b) in own)) for j in range(31) for i in range(41))
        assert all(r[0] == r[-1] for r in g.rings) and sum(len(r) - 1 for r in g.rings) == turns
    assert len(got[0, 0].rings) == 1 and len(got[0, 0].rings[0]) == 5


def test_buffer_in_metres(spark):
    field = G.box(10.0, 45.0, 10.01, 45.01)
    df = spark.createDataFrame([(0, 45.005, 10.0 - m / (111_320 * math.cos(math.radians(45.005))), 1.0) for m in (50.0, 90.0, 110.0, 500.0)], "time int, y double, x double, b double")
    assert ops.clip(df, field, keep_rectangle=False, metres=100.0).count() == 2


@pytest.mark.parametrize("epsg", [3857, 32631, 32733])
def test_points_there_and_back(spark, epsg):
    there = G.transform_point(2.5, -10.25 if epsg > 32700 else 41.25, 4326, epsg)
    back = G.transform_point(*there, epsg, 4326)
    assert back == pytest.approx((2.5, -10.25 if epsg > 32700 else 41.25), abs=1e-9)
    row = spark.range(1).select(*G.transform_point(F.lit(there[0]), F.lit(there[1]), epsg, 4326, F)).first()
    assert tuple(row) == pytest.approx(back, abs=1e-9)


@pytest.mark.parametrize("kernel", sorted(ops.WEIGHTS))
def test_kernels_keep_constants_and_planes(spark, kernel):
    df = spark.createDataFrame([(0, float(y), float(x), 5.0, float(x)) for x in range(12) for y in range(12)], "time int, y double, x double, c double, p double")
    rows = ops.regrid(df, GridSpec(0.0, 0.0, 1.0, 1.0, 12, 12), GridSpec(4.3, 4.6, 1.0, 1.0, 3, 3), kernel).collect()
    assert len(rows) == 9 and all(r.c == pytest.approx(5.0) for r in rows)
    if kernel in ("bilinear", "cubic", "cubic_spline"):
        assert all(r.p == pytest.approx(r.x) for r in rows)


def test_regrid_onto_another_system(spark):
    df = spark.createDataFrame([(0, y / 10, x / 10, float(x)) for x in range(20) for y in range(20)], "time int, y double, x double, b double")
    x, y = G.to_mercator(0.7, 0.5)
    out = ops.regrid(df, GridSpec(0.0, 0.0, 0.1, 0.1, 20, 20), GridSpec(x, y, 1000.0, 1000.0, 1, 1), "bilinear", 4326, 3857).collect()
    assert len(out) == 1 and out[0].b == pytest.approx(7.0, abs=1e-6)


def test_series_side_by_side_equal_series_alone():
    rng = np.random.default_rng(8)
    series, day, value = [], [], []
    for s in range(40):
        own = np.sort(rng.choice(rng.integers(4, 90), rng.integers(1, 4) if s % 5 == 0 else 4, replace=False)) + rng.integers(0, 1000)
        series += [s] * len(own)
        day += own.tolist()
        value += rng.normal(size=len(own)).tolist()
    series, day, value = np.array(series), np.array(day), np.array(value)
    got = whittaker.smooth_rows(series, day, np.ones(len(day)), value, 100.0)
    for s in range(40):
        own = series == s
        at = day[own] - day[own][0]
        y, w = np.full((1, at[-1] + 1), np.nan), np.zeros((1, at[-1] + 1))
        y[0, at], w[0, at] = value[own], 1.0
        assert got[own] == pytest.approx(whittaker.solve(y, w, 100.0)[0, at], abs=1e-6)


def test_bands_and_frequencies():
    assert C.band_info("red")["band_id"] == "B04" and C.band_info("scl")["band_id"] == "scl"
    assert step_of("6h") == "6 hours" and step_of("7D") is None and parse("W-SUN") == (1, "W", "SUN")


@pytest.mark.parametrize(("code", "points"), [
    (3035, [(5.0, 50.0), (10.0, 52.0), (-20.0, 35.0), (40.0, 70.0)]), (2154, [(3.0, 46.5), (-4.0, 42.0), (8.0, 51.0)]), (3034, [(10.0, 52.0), (30.0, 40.0)]),
    (3031, [(0.0, -75.0), (170.0, -89.0), (-100.0, -61.0)]), (3413, [(-45.0, 70.0), (30.0, 85.0), (120.0, 61.0)]), (3995, [(10.0, 80.0)]),
    (5070, [(-96.0, 23.0), (-120.0, 48.0), (-70.0, 30.0)]), (3577, [(132.0, -25.0), (115.0, -40.0), (150.0, -12.0)]), (6933, [(0.0, 0.0), (-170.0, 80.0), (100.0, -60.0)]),
])
def test_projections_there_and_back(spark, code, points):
    from eocube.functions.projections import SYSTEMS

    for lon, lat in points:
        x, y = G.transform_point(lon, lat, 4326, code)
        assert G.transform_point(x, y, code, 4326) == pytest.approx((lon, lat), abs=1e-8)  # a millimetre
        h = 1e-5  # area or angles are kept
        (xe, ye), (xn, yn) = G.transform_point(lon + h, lat, 4326, code), G.transform_point(lon, lat + h, 4326, code)
        e2, s = 0.0066943799901413165, math.sin(math.radians(lat))
        wide = 6378137 * math.cos(math.radians(lat)) / math.sqrt(1 - e2 * s * s) * math.radians(h)
        high = 6378137 * (1 - e2) / (1 - e2 * s * s) ** 1.5 * math.radians(h)
        across, up = (xe - x, ye - y), (xn - x, yn - y)
        area = (across[0] * up[1] - across[1] * up[0]) / (wide * high)
        if "EqualArea" in type(SYSTEMS[code]).__name__:
            assert area == pytest.approx(1.0, abs=1e-5)
        else:
            assert math.hypot(*across) / wide == pytest.approx(math.hypot(*up) / high, rel=1e-5)
    cols = G.transform_point(F.lit(points[0][0]), F.lit(points[0][1]), 4326, code, F)
    assert tuple(spark.range(1).select(*cols).first()) == pytest.approx(G.transform_point(*points[0], 4326, code), abs=1e-6)
    lons, lats = np.array(points).T
    assert np.allclose(np.stack(G.transform_point(lons, lats, 4326, code, np), 1), [G.transform_point(*p, 4326, code) for p in points], atol=1e-6)


def test_projections_at_known_points():
    assert G.transform_point(5.0, 50.0, 4326, 3035) == pytest.approx((3962799.45, 2999718.85), abs=0.01)
    assert G.transform_point(3.0, 46.5, 4326, 2154) == pytest.approx((700_000.0, 6_600_000.0), abs=1e-6)
    assert G.transform_point(10.0, 52.0, 4326, 3035) == pytest.approx((4_321_000.0, 3_210_000.0), abs=1e-6)
    assert G.transform_point(180.0, 0.0, 4326, 6933)[0] == pytest.approx(17367530.45, abs=0.01)
    with pytest.raises(ValueError, match="not supported"):
        G.transform_point(0.0, 0.0, 4326, 27700)
