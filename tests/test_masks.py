import pytest
from pyspark.sql import functions as F

from eocube.cube import Datacube
from eocube.errors import DatacubeMaskingError
from eocube.functions.geometry import box
from eocube.model import GridSpec
from eocube.operators import filters, mask


def grid(cube, value, t="2024-01-01", n=10):
    return cube([(t, float(y), float(x), 5.0, float(value(y, x))) for y in range(n) for x in range(n)], ["red", "m"])


def strategies(y, _x):
    return 2 if y < 3 else 3 if y < 6 else 4 if y < 8 else 1


@pytest.mark.parametrize(("how", "percent"), [({"clear_values": [1]}, 20), ({"exclude_values": [2, 3]}, 40), ({"exclude_values": [2, 3, 4]}, 20)])
def test_golden_percentages(cube, how, percent):
    df = grid(cube, strategies)
    out = mask.statistics(df, mask.clear_condition(df, "m", **how)).first()
    assert (out.clear_pixels, out.clear_percent) == (percent, percent)


def test_clear_cover_keeps_only_clear_times(cube):
    df = grid(cube, lambda y, x: 1).union(grid(cube, lambda y, x: 1 + (y >= 5), "2024-01-02")).union(grid(cube, lambda y, x: 2, "2024-01-03"))
    out = Datacube(df).apply_mask("m", clear_values=[1], statistics=True, clear_cover=60)
    assert [str(r.time)[:10] for r in out.timestamps.collect()] == ["2024-01-01"]
    assert [r.clear_percent for r in out.time_coords.collect()] == [100.0]


def test_clear_wins_over_excluded_and_custom_over_both(cube):
    df = grid(cube, lambda y, x: x % 3, n=3)
    count = lambda c: df.where(c).count()
    assert count(mask.clear_condition(df, "m", [1], [0, 1])) == 3
    assert count(mask.clear_condition(df, "m", [1], [0], lambda d: d["m"] >= 1)) == 6


def test_missing_mask_pixel(cube):
    df = cube([("2024-01-01", 0.0, 0.0, 1.0, None), ("2024-01-01", 0.0, 1.0, 1.0, 1.0)], ["red", "m"])
    assert df.where(mask.clear_condition(df, "m", clear_values=[1])).count() == 1
    assert df.where(mask.clear_condition(df, "m", exclude_values=[1])).count() == 1


def test_fill_and_mask_band_untouched(cube):
    df = grid(cube, lambda y, x: x % 2, n=2)
    out = mask.mask_pixels(df, "m", mask.clear_condition(df, "m", [1]), fill=-1.0)
    assert {(r.m, r.red) for r in out.collect()} == {(0.0, -1.0), (1.0, 5.0)}


def test_geometry_statistics_bounds(cube):
    df = grid(cube, lambda y, x: 1)
    out = mask.statistics(df, mask.clear_condition(df, "m", [1]), geometry=box(2, 2, 6, 6)).first()
    assert out.clear_pixels == 16 and out.clear_percent == 100
    both = mask.statistics(df, mask.clear_condition(df, "m", [1]), geometry=box(2, 2, 6, 6), bbox=[0, 0, 1, 1]).first()
    assert both.clear_pixels == 1  # the box is taken before the geometry


def test_errors(cube):
    df = grid(cube, lambda y, x: 1, n=2)
    for bad in (dict(mask_band="none", clear_values=[1]), dict(mask_band="m"), dict(mask_band="m", custom=lambda d: 1), dict(mask_band="m", clear_values=[1], clear_cover=5)):
        with pytest.raises(DatacubeMaskingError):
            Datacube(df).apply_mask(**bad)


def test_mask_of_another_cube(cube):
    df = grid(cube, lambda y, x: 1, n=2)
    out = Datacube(df.drop("m")).apply_mask("m", clear_values=[1], mask_cube=Datacube(df.select("time", "y", "x", "m")))
    assert out.df.where("red = 5").count() == 4


def test_qa_values(spark):
    df = spark.createDataFrame([(21824,), (64,), (32832,), (21760,), (None,)], "qa int")
    got = [r.c for r in df.select(mask.qa_pixel_clear(F.col("qa")).alias("c")).collect()]
    assert got == [True, False, False, False, False]
    assert [r.c for r in df.select(mask.qa_pixel_clear(F.col("qa"), strict=False).alias("c")).collect()][1]


def test_lee_filter_dense_and_sparse_agree(cube):
    rows = [("2024-01-01", float(y), float(x), float((y * 7 + x * 3) % 11)) for y in range(8) for x in range(8)]
    df, g = cube(rows, ["b"]), GridSpec(0, 0, 1, 1, 8, 8)
    a = {(r.y, r.x): r.b for r in filters.lee(df, "b", 3, g).collect()}
    b = {(r.y, r.x): r.b for r in filters.lee(df, "b", 3, g, dense=True).collect()}
    assert a == pytest.approx(b)
    flat = filters.lee(cube([("2024-01-01", float(y), float(x), 2.0) for y in range(4) for x in range(4)], ["b"]), "b", 3, g)
    assert {r.b for r in flat.collect()} == {2.0}
