import numpy as np
import pytest
from pyspark.sql import functions as F

from eocube.functions import geometry as G
from eocube.operators import buffer as B
from eocube.operators import overlay
from eocube.operators.cover import cells_in, cover

from .test_zonal import blob


def sums(rows, part):
    return {r[part]: (r.n, pytest.approx(r.a, abs=1e-6), pytest.approx(r.l, abs=1e-6)) for r in rows.groupBy(part).agg(F.count("*").alias("n"), F.sum(overlay.ring_area()).alias("a"), F.sum(overlay.ring_length()).alias("l")).collect()}


def test_small_parts_equal_those_by_joins(spark, tmp_path, monkeypatch):
    """Stars, boxes that share edges, a frame with a hole and a zone taken away, several parts of each: united in a task, by joins, and some by each."""
    rng = np.random.default_rng(5)
    zones, of = [], []
    for k in range(12):
        zones += [blob(rng, int(rng.integers(3, 12)), *rng.uniform(0, 9, 2), rng.uniform(1, 5)) for _ in range(k)]
        zones += [G.box(0, 0, 10, 2), G.box(0, 8, 10, 10), G.box(0, 2, 2, 8), G.box(8, 2, 10, 8), G.box(20, 0, 21, 1), G.box(21, 0, 22, 1), G.box(22, 1, 23, 2)]
        of += [k] * (len(zones) - len(of))
    frame = G.zones_frame(spark, zones).select("zone", "edges").join(spark.createDataFrame(list(enumerate(of)), "zone int, of int"), "zone")
    frame = frame.withColumn("away", F.col("zone") % 5 == 4)
    got = []
    for n, few in enumerate((10_000, 0, 70)):
        monkeypatch.setattr(overlay, "SMALL", few)
        got.append(sums(overlay.union(frame, str(tmp_path / str(n)), "of", "away"), "part"))
    assert len(got[0]) == 12 and got[0] == got[1] == got[2]


@pytest.mark.parametrize("d", [0.8, -0.4])
def test_buffers_of_many_zones_need_few_stages(spark, tmp_path, monkeypatch, d):
    """No table of sides, squares or ranks is written for small zones, and outlines are those by joins."""
    rng = np.random.default_rng(6)
    zones = G.zones_frame(spark, [blob(rng, 5, 20.0 * k, 0.0, 4.0) for k in range(20)]).select("zone", "edges")
    ring = lambda edges: F.aggregate(edges, F.lit(0.0), lambda a, e: a + (e["x1"] * e["y2"] - e["x2"] * e["y1"]) / 2)
    areas = lambda w: {r.zone: pytest.approx(r.a, abs=1e-6) for r in B.buffer(zones, d, w).select("zone", ring("edges").alias("a")).collect()}
    got = areas(str(tmp_path / "a"))
    assert {p.name for p in (tmp_path / "a").iterdir()} == {"parts", "zones", "sizes"}
    monkeypatch.setattr(overlay, "SMALL", 0)
    assert got == areas(str(tmp_path / "b"))


def test_small_zones_are_squares_of_their_size(spark):
    """A zone of three pixels isn't met by all pixels of the largest square."""
    z = G.zones_frame(spark, [G.box(9, 9, 12, 12), G.box(-2, -2, 1, 1)])
    assert {r._level for r in cover(z, 1.0, 1.0).collect()} == {0}
    cells = spark.range(10_000).selectExpr("cast(id div 100 as double) - 10 as y", "cast(id % 100 as double) - 10 as x")
    assert cells_in(cells, z, 1.0, 1.0).count() == 18
