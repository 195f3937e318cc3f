import pytest
from pyspark.sql import functions as F

from eocube import options
from eocube.cube import Datacube
from eocube.errors import DatacubeCreationError, DatacubeMergeError, DatacubeOperationError, DatacubeValidationError, DatacubeVisualizationError
from eocube.functions import geometry as G
from eocube.functions import indices as I
from eocube.model import GridSpec
from eocube.operators import build, ops, xcal
from eocube.operators.xcal import RULES
from eocube.sources import loaders


def square(cube, t="2024-01-01", n=3, v=1.0, band="red"):
    return cube([(t, float(y), float(x), v) for y in range(n) for x in range(n)], [band])


def test_scale_offset_golden(spark, cube):
    df = square(cube, n=2, v=1000.0)

    def run(rows, names="time, red_scale, red_offset, pos"):
        p = spark.sql(f"SELECT cast(a as timestamp_ntz) AS time, b AS red_scale, c AS red_offset, d AS pos FROM VALUES {rows} AS t(a, b, c, d)")
        return {round(r.red, 9) for r in build.scale_offset(df, p, order="pos").collect()}

    assert run("('2024-01-01', 0.0001D, 0D, 0)") == {0.1}
    assert run("('2024-01-01', 0.0001D, -0.1D, 0)") == {0.0}
    assert run("('2024-01-02', 0.0001D, -0.1D, 0)") == {1000.0}
    assert run("('2024-01-01', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), 0)") == {1000.0}
    assert run("('2024-01-01', 5D, 0D, 0), ('2024-01-01', 0.0001D, 0D, 1)") == {0.1}  # the last item of a time counts


def test_longitude_golden(cube):
    df = cube([("2024-01-01", 0.0, float(x), 0.0) for x in (0, 90, 180, 270, 350)], ["b"])
    assert sorted(r.x for r in build.wrap_longitude(df).collect()) == [-180, -90, -10, 0, 90]
    west = cube([("2024-01-01", 0.0, -10.0, 0.0)], ["b"])
    assert build.wrap_longitude(west) is west


def test_build_errors_and_rename(spark, cube):
    df = square(cube).withColumn("nir", F.lit(float("nan")))
    with pytest.raises(DatacubeCreationError, match="missing assets"):
        build.build(spark, df, assets=["red", "blue"])
    with pytest.raises(DatacubeCreationError):
        build.build(spark, df.drop("y"))
    out = build.build(spark, df, assets={"red": "r", "nir": "n"}, nodata={"red": 1.0})
    assert out.columns == ["time", "y", "x", "r", "n"] and out.where("r is not null or n is not null").count() == 0


def test_loader_registry(spark, cube):
    loaders.register_engine_loader("mine", lambda s, p: square(cube))
    assert build.build(spark, "anywhere", engine="mine").count() == 9
    loaders.unregister_engine_loader("mine")
    with pytest.raises(DatacubeCreationError):
        build.build(spark, "anywhere", engine="mine")
    with pytest.raises(TypeError):
        loaders.register_engine_loader("bad", 3)
    with pytest.raises(KeyError):
        loaders.unregister_engine_loader("bad")


def test_merge_modes(cube):
    a, b = square(cube, n=2), square(cube, n=3, v=2.0)
    assert {r.red for r in ops.merge(a, b, "override").collect()} == {1.0, None}
    for mode in ("no_conflicts", "equals", "identical"):
        with pytest.raises(DatacubeMergeError):
            ops.merge(a, b, mode, check_now=True)
        with pytest.raises(Exception, match="DatacubeMergeError"):
            ops.merge(a, b, mode).collect()
    same = ops.merge(a, square(cube, n=3), "no_conflicts")
    assert same.count() == 9 and same.where("red = 1").count() == 9
    assert ops.merge(a, square(cube, n=2), "identical").count() == 4
    with pytest.raises(ValueError):
        ops.merge(a, b, "any")


def test_clip(cube):
    df = square(cube, n=5)
    assert ops.clip(df, G.box(0, 0, 2, 2), keep_rectangle=False).count() == 4
    kept = ops.clip(df, {"type": "Feature", "properties": {}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [4, 0], [4, 4], [0, 0]]]}})
    assert kept.count() == 25 and 0 < kept.where("red is not null").count() < 25
    with pytest.raises(DatacubeOperationError):
        ops.clip(df, G.box(50, 50, 60, 60), check=True)
    assert ops.clip(df, G.box(2, 2, 2.5, 2.5), keep_rectangle=False, buffer=1.0).count() > 1


def test_union_and_grids(cube):
    a = square(cube, n=2)
    b = square(cube, "2024-01-01 09:00:00", n=2, v=4.0).withColumn("nir", F.lit(2.0))
    assert {(r.red, r.nir) for r in ops.union(a, b).collect()} == {(2.5, 2.0)}
    ops.same_grid(a, b)
    with pytest.raises(ValueError):
        ops.same_grid(a, square(cube, n=3))
    with pytest.raises(DatacubeValidationError):
        ops.union()


def test_calibration_golden(spark, cube):
    rows = [(t, 0.0, float(x), float(x)) for t in ("1987-04-22", "1998-07-29") for x in range(12)]
    df = cube(rows, ["v"]).withColumn("platform", F.lit("P"))

    def run(rules):
        r = spark.sql(f"SELECT * FROM VALUES {rules} AS t({', '.join(c.split()[0] for c in RULES.split(', '))})").select(*(F.col(c.split()[0]).cast(c.split()[1]) for c in RULES.split(", ")))
        return {(r.time.year, r.x): r.v for r in xcal.calibrate(df, r).collect()}

    one = run("(0, 'P', '1980-01-01', NULL, 'v', NULL, NULL, 2D, .5D)")
    assert one[1987, 3.0] == 6.5 and one[1998, 0.0] == 0.5
    parts = run("(0, 'P', '1980-01-01', NULL, 'v', -1D, 6D, 1D, .5D), (0, 'P', '1980-01-01', NULL, 'v', 6D, 12D, 2D, 0D)")
    assert parts[1987, 6.0] == 6.5 and parts[1998, 7.0] == 14.0
    dated = run("(0, '', '1980-01-01', '1989-12-31', 'v', NULL, NULL, 2D, 10D), (1, '', '1990-01-01', NULL, 'v', NULL, NULL, 1D, .5D)")
    assert dated[1987, 1.0] == 12.0 and dated[1998, 1.0] == 1.5
    assert run("(0, 'Q', '1980-01-01', NULL, 'v', NULL, NULL, 2D, 10D)")[1987, 1.0] == 1.0  # nothing matches: unchanged


def test_all_indices_evaluate(spark):
    letters = sorted({n for f in I.FORMULAS.values() for n in I.names_in(f)} - set(I.CONSTANTS))
    df = spark.range(1).select(*(F.lit(0.1 * (i + 2)).alias(n.lower()) for i, n in enumerate(letters)))
    values = {n: 0.1 * (i + 2) for i, n in enumerate(letters)}
    out = I.add_indices(df, list(I.FORMULAS), **{n: n.lower() for n in letters}).first()
    import math

    for name, formula in I.FORMULAS.items():
        scope = I.CONSTANTS | I.SPECIAL.get(name, {}) | values | {"sqrt": math.sqrt, "pow": pow}
        assert out[name] == pytest.approx(eval(formula, {"__builtins__": {}}, scope)), name  # noqa: S307


def test_index_errors_and_zero(spark):
    df = spark.sql("SELECT 0D AS nir, 0D AS red")
    assert I.add_indices(df, ["NDVI"]).first().NDVI is None
    for bad in ([], ["NOPE"], ["EVI"]):
        with pytest.raises(ValueError):
            I.add_indices(df, bad)
    with pytest.raises(ValueError):
        I.add_indices(df, {"x": "red + drop_table"})
    assert "NDVI" in I.available(["nir", "red"]) and "EVI" not in I.available(["nir", "red"])


def test_cube_facade(cube):
    c = Datacube(square(cube, n=4)).infer_grid()
    assert c.shape == {"time": 1, "y": 4, "x": 4} and c.bands == ["red"] and c.resolution == (1.0, 1.0)
    assert c.extent == (-0.5, -0.5, 3.5, 3.5) and "red" in repr(c)
    assert c.picture(["red"]).count() == 16
    with pytest.raises(DatacubeVisualizationError):
        c.picture(["blue"])
    with pytest.raises(DatacubeValidationError):
        Datacube(square(cube).drop("x"))
    assert c.with_df(c.df, note=1).info()["note"] == 1 and "note" not in c.info()


def test_regrid_and_coarsen(cube):
    df, g = square(cube, n=4), GridSpec(0, 0, 1, 1, 4, 4)
    assert ops.coarsen(df, 2, g).count() == 4 and ops.coarsen(df, 3, g, trim=True).count() == 1
    assert ops.regrid_nearest(df, g, GridSpec(0.2, 0.2, 2, 2, 2, 2)).count() == 4
    with pytest.raises(ValueError):
        ops.coarsen(df, 2, g, "cubic")


def test_band_names():
    assert build.map_bands("sentinel-2-l2a", ["red", "swir1", "none"]) == {"red": "red", "swir16": "swir1"}
    assert build.map_bands("elsewhere", ["red"]) == ["red"] and build.map_bands("sentinel-2-l2a", None) is None
    assert list(build.map_bands("sentinel-2-l2a", ["blue", "rededge74", "lacking"])) == ["blue", "rededge2"]
    assert build.map_bands("landsat-c2l2-sr", ["nir", "swir16"]) == {"nir08": "nir", "swir16": "swir16"}
    assert list(build.map_bands("venus-l2a", ["rededge70", "rededge78"])) == ["image_file_SRE_B08", "image_file_SRE_B10"]
    assert build.common_bands("venus-l2a")["red"] == "image_file_SRE_B07"
    with pytest.raises(NotImplementedError):
        build.common_bands("elsewhere")


def test_options(spark):
    assert options.get_option(spark, "zone_overlap") == "last"
    options.set_option(spark, "zone_overlap", "all")
    assert options.list_options(spark)["zone_overlap"] == "all"
    options.reset_option(spark)
    with pytest.raises(ValueError):
        options.set_option(spark, "zone_overlap", "first")
    with pytest.raises(KeyError):
        options.describe_option("none")


@pytest.mark.parametrize("compat", ["no_conflicts", "equals"])
def test_a_conflict_stops_queries_of_other_bands(cube, compat):
    left = cube([("2024-01-01", 0.0, 0.0, 1.0, 5.0)], ["a", "b"])
    right = cube([("2024-01-01", 0.0, 0.0, 2.0, 5.0)], ["a", "b"])
    for read in (lambda df: df.select("b").collect(), lambda df: df.count(), lambda df: df.select("time").collect()):
        with pytest.raises(Exception, match="DatacubeMergeError"):
            read(ops.merge(left, right, compat))
        read(ops.merge(left, left, compat))


def test_a_date_serves_one_target(spark):
    day = lambda *ds: spark.createDataFrame([(f"2024-01-{d:02d}",) for d in ds], "time string").withColumn("time", F.to_timestamp("time"))
    got = {(r.target.day, r.date.day, r.delta) for r in ops.nearest_dates(day(10, 20), day(8, 11, 12, 19, 28), 4).collect()}
    assert got == {(11, 10, 1), (19, 20, 1)}


VALUES = {
    "ties": [1.0] * 500 + [2.0] * 3 + [3.0] * 400,
    "wide": [10.0**k * s for k in range(-300, 300, 7) for s in (-1, 1)],
    "ends": [float("-inf"), -5.0, 0.0, 1.5, float("inf"), float("inf")],
    "one": [7.25],
    "near": [1.0 + k * 2.0**-52 for k in range(300)],
    "many": [((k * 7919) % 100_003) / 7 for k in range(40_000)],
}


@pytest.mark.parametrize("name", sorted(VALUES))
def test_order_statistics_are_exact(spark, monkeypatch, name):
    monkeypatch.setattr(ops, "RANGES", 16 if name != "many" else 1 << 14)
    values = sorted(VALUES[name])
    df = spark.createDataFrame([(v, None) for v in [*values, None, float("nan")]], "v double, none double")
    shares = [0.0, 0.02, 0.5, 0.77, 0.98, 1.0]
    got = ops.order_statistics(df, [("v", p) for p in shares] + [("none", 0.5)])
    want = []
    for p in shares:
        k = p * (len(values) - 1)
        lo, hi = values[int(k)], values[-int(-k // 1)]
        want.append(lo if lo == hi else lo + (hi - lo) * (k - int(k)))
    assert list(map(str, got)) == list(map(str, [*want, None]))


def test_properties_by_position_over_days(spark):
    """Items without a time come first, items of a time by their order; times beyond the items get none."""
    items = spark.createDataFrame([("2024-01-02 10:00:00", 2, "c"), ("2024-01-02 10:00:00", 1, "b"), (None, 5, "a"), ("2024-01-03 00:00:00", 0, "d")], "t string, pos int, name string").selectExpr("cast(t as timestamp_ntz) datetime", "pos", "name")
    times = spark.createDataFrame([(f"2024-02-0{k} 00:00:00",) for k in (1, 1, 2, 3, 4, 5)], "t string").selectExpr("cast(t as timestamp_ntz) time")
    got = build.positional_properties(times, items, ["name"]).orderBy("time").collect()
    assert [r.name for r in got] == ["a", "b", "c", "d", None]
    assert build.positional_properties(times, items.limit(0), ["name"]).where("name is null").count() == 5
