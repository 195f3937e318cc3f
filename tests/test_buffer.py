import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from eocube.cube import Datacube
from eocube.functions import geometry as G
from eocube.model import CubeMeta
from eocube.operators import buffer as B

from .test_zonal import blob


def hits(edges, x, y):
    """Inside the outline, by an odd number of sides to the left."""
    hit = np.zeros(len(x), bool)
    for x1, y1, x2, y2 in edges:
        if y1 != y2:
            hit ^= ((y1 <= y) != (y2 <= y)) & (x1 + (y - y1) * (x2 - x1) / (y2 - y1) < x)
    return hit


def distance(edges, x, y):
    best = np.full(len(x), np.inf)
    for x1, y1, x2, y2 in edges:
        dx, dy = x2 - x1, y2 - y1
        n = dx * dx + dy * dy
        t = np.clip(((x - x1) * dx + (y - y1) * dy) / n, 0, 1) if n else 0.0
        best = np.minimum(best, np.hypot(x - x1 - t * dx, y - y1 - t * dy))
    return best


def grown(spark, shapes, d, tmp_path, **how):
    rows = B.buffer(B.zones_of(spark, shapes), d, str(tmp_path / "w"), **how).collect()
    return {r.zone: [tuple(e) for e in r.edges] for r in rows}


def area(edges):
    return sum(x1 * y2 - x2 * y1 for x1, y1, x2, y2 in edges) / 2


def test_boxes_lines_points_and_a_frame(spark, tmp_path):
    """Two boxes, a line that turns, a point, a frame whose hole closes, and a point twice."""
    frame = "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0), (4 4, 6 4, 6 6, 4 6, 4 4))"
    got = grown(spark, [G.box(0, 0, 10, 4), G.box(3, 1, 5, 9), "LINESTRING (0 0, 5 0, 5 5)", "POINT (2 3)", frame, "MULTIPOINT (0 0, 0 0)"], 1.0, tmp_path)
    disc = 32 * math.sin(math.pi / 32)
    assert area(got[0]) == pytest.approx(40 + 28 + disc)
    assert area(got[1]) == pytest.approx(16 + 20 + disc)
    assert area(got[3]) == pytest.approx(disc) and area(got[5]) == pytest.approx(disc)
    # two strips share a square at the turn, a quarter of a circle fills its other side, and both ends are round
    assert area(got[2]) == pytest.approx(20 - 1 + disc / 4 + disc)
    assert area(got[4]) == pytest.approx(100 + 40 + disc)


@pytest.mark.parametrize("d", [0.7, -0.35])
def test_stars_against_distances(spark, tmp_path, d):
    """Shapes with inner corners, one box of many, and one that vanishes when it shrinks."""
    rng = np.random.default_rng(3)
    zones = [blob(rng, int(rng.integers(3, 12)), *rng.uniform(0, 6, 2), rng.uniform(1, 4)) for _ in range(6)]
    zones += [G.box(0, 0, 9, 3), G.box(0, 5, 9, 5.6)]
    x, y = (v.reshape(-1) for v in np.meshgrid(np.arange(-6, 12, 0.11) + 0.0123, np.arange(-6, 12, 0.11) + 0.0177))
    got = grown(spark, zones, d, tmp_path)
    assert (7 in got) == (d > 0)
    for k, z in enumerate(zones):
        far, within = distance(z.edges, x, y), hits(z.edges, x, y)
        want = within | (far <= d) if d > 0 else within & (far > -d)
        near = np.abs(far - abs(d)) < abs(d) * (1 - math.cos(math.pi / 64)) + 1e-9  # between arc and chord
        assert (hits(got.get(k, []), x, y) == want)[~near].all(), k


def test_many_zones_and_empty_ones(spark, tmp_path):
    zones = spark.range(300).select(F.col("id").alias("zone"), F.expr("array(struct(id * 3D as x1, 0D as y1, id * 3D + 1 as x2, 0D as y2), struct(id * 3D + 1 as x1, 0D as y1, id * 3D as x2, 1D as y2), struct(id * 3D as x1, 1D as y1, id * 3D as x2, 0D as y2))").alias("edges"))
    none = spark.sql("select cast(null as bigint) as zone, array(struct(0D as x1, 0D as y1, 1D as x2, 1D as y2)) as edges union all select 1000L, array() union all select 1001L, null")
    rows = B.buffer(zones.unionByName(none), 0.25, str(tmp_path / "w")).collect()
    assert len(rows) == 300
    want = 0.5 + 0.25 * (2 + math.sqrt(2)) + math.pi / 16
    assert all(area([tuple(e) for e in r.edges]) == pytest.approx(want, rel=1e-3) for r in rows)
    assert B.buffer(zones.limit(0), 1.0, str(tmp_path / "v")).count() == 0
    with pytest.raises(ValueError):
        B.buffer(zones, math.nan, str(tmp_path / "u"))


def test_metres_and_back(spark, tmp_path):
    """A point's circle of 1,000 m in a UTM zone."""
    r = B.buffer_metres(B.zones_of(spark, "POINT (5.1 45.2)"), 1000.0, str(tmp_path / "w"), metres_crs=32631).collect()[0]
    east, north = G.transform_point(5.1, 45.2, 4326, 32631)
    ends = [G.transform_point(e.x1, e.y1, 4326, 32631) for e in r.edges]
    assert len(ends) == 64
    assert all(math.hypot(a - east, b - north) == pytest.approx(1000, abs=0.01) for a, b in ends)


def test_statistics_of_a_point_grown_by_metres(cube):
    """In a system of metres the pixels within the distance count; without a buffer a point has none."""
    rows = [("2024-01-01", float(y), float(x), float(x + 100 * y)) for y in range(500_000, 500_009) for x in range(400_000, 400_009)]
    df = cube(rows, ["red"])
    c = Datacube(df, CubeMeta(crs="EPSG:32631"))
    got = c.zonal_stats("POINT (400004 500004)", ["count", "mean"], all_touched=False, buffer_metres=2.1, metres_crs="EPSG:32631").collect()
    near = [r[3] for r in rows if (r[2] - 400_004) ** 2 + (r[1] - 500_004) ** 2 <= 2.1**2]
    assert [(r.feature, r.red_count) for r in got] == [(0, len(near))]
    assert got[0].red_mean == pytest.approx(sum(near) / len(near))
    assert c.zonal_stats("POINT (400004 500004)", ["count"], all_touched=False).count() == 0
