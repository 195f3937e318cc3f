import numpy as np
import pytest
from pyspark.sql import functions as F

from eocube.functions import geometry as G
from eocube.operators import zonal
from eocube.operators.cover import SIDES, cells_in, cover

OK2 = G.Geometry("Polygon", (((1.0, 1.0), (9.0, 1.0), (9.0, 2.1)),))
ZONES = [G.box(0, 0, 1.2, 1.2), G.box(0, 0, 0.5, 0.5), OK2]


def golden(cube, c=7.0):
    rows = [("2024-01-01", float(y), float(x), float(y * 8 + x)) for y in range(3) for x in range(8)]
    return cube(rows + [("2024-01-02", y, x, c) for _, y, x, _ in rows], ["v"])


def test_golden_min_max_and_dropped_zone(cube):
    out = {(r.feature, str(r.time)[:10]): (r.v_min, r.v_max) for r in zonal.zonal_stats(golden(cube), ZONES, ["min", "max"], all_touched=False).collect()}
    assert out == {(0, "2024-01-01"): (1, 9), (0, "2024-01-02"): (7, 7), (2, "2024-01-01"): (10, 15), (2, "2024-01-02"): (7, 7)}


def test_later_zone_owns_or_all(cube):
    df = golden(cube)
    two = [G.box(-1, -1, 5, 5), G.box(-1, -1, 2, 2)]
    last = {(r.y, r.x): r.zone for r in zonal.owners(df, two).collect()}
    assert last[0.0, 1.0] == 1 and last[0.0, 5.0] == 0
    assert zonal.owners(df, two, overlap="all").where("x = 1 and y = 0").count() == 2


def test_zones_that_share_an_edge_share_no_pixel(cube):
    df = golden(cube)
    both = zonal.owners(df, [G.box(0, 0, 3, 3), G.box(3, 0, 7, 3)], overlap="all")
    assert both.count() == both.select("y", "x").distinct().count() == 21


def test_all_touched_takes_more(cube):
    df = golden(cube)
    small = [G.box(1.6, 0.6, 1.7, 0.7)]
    assert zonal.owners(df, small).count() == 0
    assert {(r.y, r.x) for r in zonal.owners(df, small, all_touched=True).collect()} == {(1.0, 2.0)}


def test_reducers(cube):
    rows = [("2024-01-01", 0.0, float(x), v) for x, v in enumerate([1.0, 1.0, 2.0, 2.0, None, 6.0])]
    r = zonal.zonal_stats(cube(rows, ["v"]), [G.box(-1, -1, 9, 9)], list(zonal.REDUCERS), all_touched=False).first()
    assert (r.v_count, r.v_sum, r.v_mean, r.v_median, r.v_mode, r.v_min, r.v_max) == (5, 12, 2.4, 2, 1, 1, 6)
    assert r.v_var == pytest.approx(3.44) and r.v_std == pytest.approx(3.44**0.5)
    with pytest.raises(ValueError, match="unknown reducers"):
        zonal.zonal_stats(cube(rows, ["v"]), [G.box(0, 0, 1, 1)], ["nanmost"])


def test_sum_of_missing_values_is_zero_and_attributes_follow(spark, cube):
    df = cube([("2024-01-01", 0.0, 0.0, None)], ["v"])
    names = spark.createDataFrame([(0, "far"), (1, "inside")], "zone int, name string")
    r = zonal.zonal_stats(df, [G.box(100, 100, 110, 110), G.box(-1, -1, 1, 1)], ["sum", "mean"], attributes=names).collect()
    assert [(x.name, x.v_sum, x.v_mean) for x in r] == [("inside", 0.0, None)]


def test_against_a_plain_raster(cube):
    star = G.Geometry("Polygon", (((1.3, 0.2), (6.9, 1.1), (4.2, 2.4), (5.1, 0.9), (0.7, 2.2)),))
    df = golden(cube)
    got = {(r.y, r.x) for r in zonal.owners(df, [star]).collect()}

    def inside(x, y):
        n = 0
        for x1, y1, x2, y2 in star.edges:
            if (y1 <= y) != (y2 <= y) and x1 + (y - y1) * (x2 - x1) / (y2 - y1) < x:
                n += 1
        return n % 2 == 1

    assert got == {(float(y), float(x)) for y in range(3) for x in range(8) if inside(x, y)}


def blob(rng, n, x, y, size, least=0.3):
    """A star of n corners."""
    turn = np.sort(rng.uniform(0, 2 * np.pi, n))
    r = size * rng.uniform(least, 1.0, n)
    return G.Geometry("Polygon", (tuple(zip((x + r * np.cos(turn)).tolist(), (y + r * np.sin(turn)).tolist(), strict=True)),))


@pytest.mark.parametrize("all_touched", [False, True])
@pytest.mark.parametrize(("dx", "dy"), [(1.0, 1.0), (0.5, -0.25)])
def test_squares_equal_the_exact_test(spark, all_touched, dx, dy):
    """Stars of few and many corners, a box along cells' centres, one zone as large as the grid: with and without squares."""
    rng = np.random.default_rng(3)
    zones = [blob(rng, n, rng.uniform(-20, 90) * dx, rng.uniform(-10, 50) * abs(dy), s * dx) for n, s in ((3, 5), (9, 30), (40, 40), (4, 2), (150, 90), (3, 0.3))]
    zones += [G.box(10 * dx, 10 * abs(dy), 20 * dx, 20 * abs(dy)), G.box(-1e3, -1e3, 1e3, 1e3), G.box(1e6, 1e6, 1e6 + 1, 1e6 + 1)]
    cells = spark.range(110 * 50).selectExpr(f"(id div 110 - 15) * {dy} as y", f"(id % 110 - 30) * {dx} as x")
    z = G.zones_frame(spark, zones)
    got = {(r.y, r.x, r.zone) for r in cells_in(cells, z, dx, dy, all_touched).collect()}
    hit = G.touches(F.col("x"), F.col("y"), F.col("edges"), dx, dy) if all_touched else G.inside(F.col("x"), F.col("y"), F.col("edges"), dy < 0)
    want = {(r.y, r.x, r.zone) for r in cells.crossJoin(z).where(hit).select("y", "x", "zone").collect()}
    assert got == want and {z for _, _, z in want} >= {1, 2, 4, 7}


def test_few_cells_take_the_exact_test(spark):
    """Inside, squares are whole; a square on the edge carries few sides, and no square has more than 256 pixels on a side."""
    zones = [blob(np.random.default_rng(4), 1000, 4000.0, 4000.0, 3800.0, 0.99), G.box(0, 0, 9000, 9000)]
    c = cover(G.zones_frame(spark, zones), 1.0, 1.0).withColumn("area", F.element_at(F.array(*(F.lit(s * s) for s in SIDES)), F.col("_level") + 1))
    r = c.where("zone = 0").agg(F.sum(F.when(F.col("whole"), F.col("area"))).alias("whole"), F.sum(F.when(~F.col("whole"), F.col("area"))).alias("edge"), F.expr("percentile(case when not whole then size(edges) end, 0.9)").alias("most")).first()
    assert r.whole > r.edge / 4 and r.most <= 40
    assert c.where("zone = 1 and not whole").agg(F.max(F.size("edges"))).first()[0] <= 4
    assert c.where("zone = 1 and whole").count() > 1000


def test_zone_join_has_equal_keys(spark):
    df = spark.createDataFrame([(0, 1.0, 1.0, 2.0)], "time int, y double, x double, b double")
    plan = zonal.owners(df, G.zones_frame(spark, [G.box(0, 0, 3, 3), G.box(0, 0, 300, 300)]))._jdf.queryExecution().executedPlan().toString()
    assert "HashJoin [_level" in plan or "SortMergeJoin [_level" in plan
    few = zonal.owners(df, [G.box(0, 0, 3, 3)])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" in few and "MapInArrow" not in few
