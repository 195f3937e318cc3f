import numpy as np
import pytest
from pyspark.sql import functions as F

from eocube.functions import geometry as G
from eocube.operators import overlay

from .test_zonal import blob


def area(r):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r, r[1:] + r[:1], strict=True)) / 2


def shapes(spark, zones, tmp_path):
    rows = overlay.dissolve(G.zones_frame(spark, zones).select("zone", "edges"), str(tmp_path / "w")).collect()
    return [G.parse(r.wkt)[0] for r in rows]


def test_boxes_that_share_edges_overlap_and_touch(spark, tmp_path):
    """A frame of four boxes with a hole, a box within it, one that touches a corner, one twice."""
    zones = [G.box(0, 0, 10, 2), G.box(0, 8, 10, 10), G.box(0, 2, 2, 8), G.box(8, 1, 10, 9), G.box(4, 4, 6, 6), G.box(4, 4, 6, 6), G.box(10, 10, 12, 12), G.box(20, 0, 21, 1), G.box(21, 0, 22, 1)]
    got = shapes(spark, zones, tmp_path)
    total = sum(area(r) for g in got for r in g.rings)
    assert total == pytest.approx(100 - 36 + 4 + 4 + 2)
    assert sorted((len(g.rings), round(area(g.rings[0]), 6)) for g in got) == [(1, 2.0), (1, 4.0), (1, 4.0), (2, 100.0)]


def test_stars_against_points(spark, tmp_path):
    """The union's area against a count of points, and its outline against the exact test."""
    rng = np.random.default_rng(12)
    zones = [blob(rng, int(rng.integers(3, 14)), *rng.uniform(0, 20, 2), rng.uniform(1, 7)) for _ in range(25)]
    got = shapes(spark, zones, tmp_path)
    x, y = (v.reshape(-1) for v in np.meshgrid(np.arange(-8, 28, 0.05) + 0.0123, np.arange(-8, 28, 0.05) + 0.0177))

    def inside(rings):
        hit = np.zeros(len(x), bool)
        for r in rings:
            for (x1, y1), (x2, y2) in zip(r, r[1:] + r[:1], strict=True):
                if y1 != y2:
                    hit ^= ((y1 <= y) != (y2 <= y)) & (x1 + (y - y1) * (x2 - x1) / (y2 - y1) < x)
        return hit

    want = np.logical_or.reduce([inside(z.rings) for z in zones])
    assert (inside([r for g in got for r in g.rings]) == want).all()
    assert sum(area(r) for g in got for r in g.rings) == pytest.approx(want.sum() * 0.0025, rel=0.01)


def test_nothing(spark, tmp_path):
    none = G.zones_frame(spark, [G.box(0, 0, 1, 1)]).limit(0).select("zone", "edges")
    assert overlay.union(none, str(tmp_path / "w")).count() == 0


def test_one_union_for_each_part(spark, tmp_path):
    zones = G.zones_frame(spark, [G.box(0, 0, 2, 2), G.box(1, 0, 3, 2), G.box(1, 1, 4, 4)]).withColumn("of", F.expr("zone div 2"))
    got = overlay.union(zones.select("zone", "of", "edges"), str(tmp_path / "w"), "of").select("part", overlay.ring_area().alias("a")).collect()
    assert sorted((r.part, round(r.a, 6)) for r in got) == [("0", 6.0), ("1", 9.0)]
