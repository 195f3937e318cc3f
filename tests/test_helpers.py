import pytest
from pyspark.sql import functions as F

from eocube.errors import NoItemsFoundError
from eocube.functions import collections as C
from eocube.operators import build
from eocube.operators import items as ops
from eocube.plans import pipelines
from eocube.sources import samples


@pytest.fixture
def items(spark):
    band = "array(named_struct('scale', {s}, 'offset', CAST(NULL AS DOUBLE), 'nodata', CAST(NULL AS DOUBLE)))"
    asset = "named_struct('href', '{h}', 'raster_bands', {b}, 'proj_transform', array(1D), 'alternate', map('download', named_struct('href', '{d}')))"
    one = lambda i, s: f"({i}, 'landsat-c2l2-sr', timestamp_ntz'2024-01-0{i} 10:00:00', {i}, array(0D, 0D, 1D, 1D), map('red', {asset.format(h=f's3://b/k{i}', b=band.format(s=s), d=f's3://d/k{i}')}))"
    return spark.sql(f"SELECT * FROM VALUES {one(1, '0D')}, {one(2, '0.5D')} AS t(id, collection, datetime, updated, bbox, assets)")


def test_samples_are_closed_forms():
    for g, lat, metres in ((samples.load_pivot(), 40.5, 400), (samples.load_pivot_corumba(), -17.25, 350)):
        assert len(g.rings[0]) == 64 and g.rings[0][0][1] == pytest.approx(lat + metres / 111_195, abs=1e-6)


def test_enhance(items):
    out = ops.enhance_assets(items, http=True, add_default_scale=True).orderBy("id").collect()
    red = [r.assets["red"] for r in out]
    assert [a.href for a in red] == ["https://d.s3.amazonaws.com/k1", "https://d.s3.amazonaws.com/k2"]
    assert [(a.raster_bands[0].scale, a.raster_bands[0].offset, a.raster_bands[0].nodata) for a in red] == [(0.0000275, -0.2, 0.0), (0.5, -0.2, 0.0)]


def test_legacy_search(items):
    assert [r.id for r in pipelines.legacy_search(items, collections="landsat-c2l2-sr").collect()] == [1, 2]
    assert [r.id for r in pipelines.legacy_search(items, datetime="2024-01-02", assets={"red": "r"}).collect()] == [2]
    with pytest.raises(NoItemsFoundError):
        pipelines.legacy_search(items, ids=[9])
    with pytest.raises(ValueError):
        pipelines.helper_items(items, geometry="POINT (0 0)", intersects="POINT (0 0)")
    area = pipelines.SpatioTemporalGeometry("POINT (0.5 0.5)", "2024-01-01")
    assert [r.id for r in area.of_items(items).collect()] == [1]


def test_bulk_search(spark, items, tmp_path):
    job = pipelines.bulk_search(items, str(tmp_path / "out"), ids=[1]).first()
    assert (job.items_total_count, job.status) == (1, "COMPLETED") and spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_create_cube(spark, items, cube):
    px = cube([("2024-01-01 10:00:00", 0.0, 0.0, 5.0), ("2024-01-03 10:00:00", 0.0, 0.0, 7.0)], ["red"])
    c = pipelines.create_cube(items.withColumn("pos", F.col("id")), px, assets={"red": "r"}, deduplicate_by="date", properties=["collection"])
    assert c.bands == ["r"] and c.df.count() == 1 and c.time_coords.first().collection == "landsat-c2l2-sr"


def test_combinations_and_options():
    assert C.assets_for("dual_pol", "sentinel1") == ["vv", "vh"] and set(C.SENTINEL2_COMBINATIONS["all_spectral"]) <= set(C.SENTINEL2_BANDS)
    assert C.assets_for(["x"]) == ["x"]
    with pytest.raises(ValueError):
        C.assets_for("none")
    assert build.load_options(epsg=4326, resampling=1, bbox=[0], intersects="g", chunks=None) == {"crs": "EPSG:4326", "resampling": "bilinear", "intersects": "g"}
