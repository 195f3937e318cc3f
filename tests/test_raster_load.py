import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from eocube.functions import geometry as G
from eocube.model import GridSpec
from eocube.sources import raster, tiff


def lzw_encode(data):
    """Codes as other writers make them."""
    out, bits, have, width, table = bytearray(), 0, 0, 9, {}

    def put(code):
        nonlocal bits, have
        bits, have = bits << width | code, have + width
        while have >= 8:
            have -= 8
            out.append(bits >> have & 255)

    def clear():
        nonlocal table, width
        put(256)
        table, width = {bytes([i]): i for i in range(256)}, 9

    clear()
    now = b""
    for b in data:
        if now + bytes([b]) in table:
            now += bytes([b])
            continue
        put(table[now])
        table[now + bytes([b])] = len(table) + 2
        if len(table) + 2 in (512, 1024, 2048):
            width += 1
        now = bytes([b])
        if len(table) + 2 == 4095:
            put(table[now])
            clear()
            now = b""
    if now:
        put(table[now])
        width = 9 + sum(len(table) + 2 >= x for x in (511, 1023, 2047))
    put(257)
    out.append(bits << (8 - have) & 255)
    return bytes(out)


@pytest.mark.parametrize("n", [0, 1, 300, 5000, 70_000])
def test_lzw(n):
    rng = np.random.default_rng(n)
    raw = rng.integers(0, 3, n, dtype=np.uint8).tobytes()
    assert tiff.lzw(lzw_encode(raw)) == raw
    raw = rng.integers(0, 256, n, dtype=np.uint8).tobytes()
    assert tiff.lzw(lzw_encode(raw)) == raw


def test_packbits():
    assert tiff.packbits(bytes([2, 1, 2, 3, 254, 7, 128, 0, 9])) == bytes([1, 2, 3, 7, 7, 7, 9])


def striped(a, packing, big=False, order="<", planes=False):
    """Strips of four rows, classic or big, of either byte order, samples together or in planes."""
    pack = {1: bytes, 5: lzw_encode, 8: zlib.compress, 50000: lambda x: pa.Codec("zstd").compress(x, asbytes=True)}[packing]
    kind = a.dtype.newbyteorder(order)
    parts = [a[:, :, s : s + 1] for s in range(a.shape[2])] if planes else [a]
    rows = [pack(p[r : r + 4].astype(kind).tobytes()) for p in parts for r in range(0, len(a), 4)]
    n, code = len(rows), {"u": 1, "i": 2, "f": 3}[a.dtype.kind]
    tags = [(256, 4, [a.shape[1]]), (257, 4, [a.shape[0]]), (258, 3, [8 * a.dtype.itemsize]), (259, 3, [packing]), (273, 4, [0] * n), (277, 3, [a.shape[2]]), (278, 4, [4]), (279, 4, [len(x) for x in rows]), (284, 3, [2 if planes else 1]), (339, 3, [code])]
    inline, start = (8, 16) if big else (4, 8)
    body = start + (8 if big else 2) + len(tags) * (20 if big else 12) + inline
    sizes = {3: 2, 4: 4}
    at = body + sum(s for _, k, v in tags if (s := sizes[k] * len(v)) > inline)
    tags[4] = (273, 4, (at + np.concatenate([[0], np.cumsum([len(x) for x in rows[:-1]])])).astype(int).tolist())
    table, extra = b"", b""
    for tag, k, v in tags:
        raw = struct.pack(f"{order}{len(v)}{'H' if k == 3 else 'I'}", *v)
        cell = raw.ljust(inline, b"\0") if len(raw) <= inline else struct.pack(order + ("Q" if big else "I"), body + len(extra))
        extra += raw if len(raw) > inline else b""
        table += struct.pack(order + ("HHQ" if big else "HHI"), tag, k, len(v)) + cell
    mark = b"II" if order == "<" else b"MM"
    head = mark + (struct.pack(order + "HHHQ", 43, 8, 0, 16) if big else struct.pack(order + "HI", 42, 8))
    return head + struct.pack(order + ("Q" if big else "H"), len(tags)) + table + bytes(inline) + extra + b"".join(rows)


@pytest.mark.parametrize("packing", [1, 5, 8, 50000])
@pytest.mark.parametrize(("big", "order", "planes"), [(False, "<", False), (True, "<", True), (False, ">", True), (True, ">", False)])
def test_files_of_other_writers(packing, big, order, planes):
    a = np.random.default_rng(2).integers(0, 50, (18, 11, 3)).astype("u2")
    raw = striped(a, packing, big, order, planes)
    assert (tiff.pixels(raw)[0] == a).all()
    got, top, left = tiff.pixels(raw, (5, 2, 9, 4))
    assert (got == a[5:14, 2:6]).all() and (top, left) == (5, 2)


@pytest.mark.parametrize("packing", ["plain", "deflate", "zstd"])
@pytest.mark.parametrize("kind", ["u1", "i2", "f4", "f8"])
def test_tiles_with_differences(packing, kind):
    a = (np.random.default_rng(3).normal(size=(40, 23, 2)) * 100).astype(kind)
    assert (tiff.pixels(tiff.encode(a, 16, packing=packing))[0] == a).all()


def test_overviews_and_nodata():
    a = np.arange(64 * 64, dtype="u2").reshape(64, 64, 1)
    raw = tiff.encode(a, 16, transform=(10.0, 20.0, 1.0, 2.0), epsg=4326, nodata=7, overviews=[a[::2, ::2], a[::4, ::4]])
    read = tiff.held(raw)
    full, half, quarter = (tiff.Image(read, k) for k in range(3))
    assert (quarter.window()[0] == a[::4, ::4]).all() and half.transform == [2.0, 0.0, 10.0, 0.0, -4.0, 20.0]
    assert full.header["epsg"] == 4326 and quarter.nodata == 7
    assert [tiff.fitting(read, c).width for c in (None, 0.5, 1.0, 1.9, 2.0, 3.9, 4.0, 50.0)] == [64, 64, 64, 64, 32, 32, 16, 16]
    with pytest.raises(ValueError, match="overview"):
        tiff.Image(read, 3)


def test_only_ranges_of_a_window_are_read(tmp_path):
    a = np.random.default_rng(4).integers(0, 60_000, (2048, 2048, 1)).astype("u2")
    (tmp_path / "a.tif").write_bytes(tiff.encode(a, 256, packing="plain"))
    read = tiff.Ranges(str(tmp_path / "a.tif"))
    got, *_ = tiff.Image(read).window((300, 300, 20, 20))
    assert (got == a[300:320, 300:320]).all() and read.total < 400_000 < read.size / 20


@pytest.fixture
def folder(tmp_path):
    for k in range(3):
        a = (np.arange(100 * 60 * 2).reshape(100, 60, 2) % 251 + k).astype("u2")
        (tmp_path / f"r{k}.tif").write_bytes(tiff.encode(a, 16, transform=(100.0 * k, 1000.0, 1.0, 2.0), epsg=32631, nodata=3))
    (tmp_path / "notes.txt").write_text("no raster")
    return str(tmp_path)


CONDITIONS = ["row between 20 and 30 and col > 50 and sample = 1", "x >= 130.2 and x < 133 and y > 950 and sample = 0", "path like '%r1.tif' and row < 2", "value is null", "row = 5 and col = 7", "row > 1000", "sample = 9", "col in (3, 4) and row = 0"]


@pytest.mark.parametrize("pixels", [1, 1 << 22])
def test_data_source(spark, folder, pixels):
    whole = raster.read_rasters(spark, folder, pixels)
    rows = [r.asDict() for r in whole.collect()]
    assert len(rows) == 3 * 100 * 60 * 2
    a = (np.arange(100 * 60 * 2).reshape(100, 60, 2) % 251 + 2).astype("u2")
    for r in rows[:: 997]:
        if r["path"].endswith("r2.tif"):
            want = int(a[r["row"], r["col"], r["sample"]])
            assert r["value"] == (None if want == 3 else want) and r["x"] == 200 + r["col"] + 0.5 and r["y"] == 1000 - 2 * (r["row"] + 0.5)
    plain = spark.createDataFrame(rows, raster.SCHEMA)
    for c in CONDITIONS:
        assert sorted(map(str, whole.where(c).collect())) == sorted(map(str, plain.where(c).collect())), c


def test_conditions_reach_the_tiles(spark, folder):
    df = raster.read_rasters(spark, folder).where("row between 20 and 30 and col > 50 and sample = 1 and value > 5")
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = [x for x in plan.splitlines() if "Filter (" in x]
    assert not any("row#" in x or "col#" in x for x in filters) and any("value#" in x for x in filters), plan
    reader = raster.RasterReader(folder, 1 << 22)
    from pyspark.sql.datasource import GreaterThanOrEqual, LessThan

    assert list(reader.pushFilters([GreaterThanOrEqual(("row",), 90), LessThan(("col",), 10)])) == []
    parts = reader.partitions()
    assert [(p.first, p.last) for p in parts] == [(90, 100)] * 3 and sum(b.num_rows for b in reader.read(parts[0])) == 10 * 10 * 2


def write(path, a, x, y, cell, code, **more):
    path.write_bytes(tiff.encode(a, 16, transform=(x, y, cell, cell), epsg=code, **more))
    return str(path)


def test_mosaic_in_order_with_early_stop(spark, tmp_path):
    """The first raster covers all cells of a chunk: those behind it aren't opened, even if they can't be read there."""
    front = write(tmp_path / "front.tif", np.full((20, 20, 1), 5, "u2"), 0.0, 20.0, 1.0, 4326, nodata=0)
    hole = np.full((20, 40, 1), 7, "u2")
    hole[3:5, 25:30] = 0
    behind = write(tmp_path / "behind.tif", hole, 0.0, 20.0, 1.0, 4326, nodata=0)
    last = write(tmp_path / "last.tif", np.full((20, 40, 1), 9, "u2"), 0.0, 20.0, 1.0, 4326)
    assets = spark.createDataFrame([(front, "2024-01-01", "a", 0), (behind, "2024-01-01", "a", 1), (last, "2024-01-01", "a", 2), (last, "2024-01-02", "b", 0)], "path string, time string, band string, place int").withColumn("time", F.to_timestamp_ntz("time"))
    grid = GridSpec(0.5, 19.5, 1.0, -1.0, 40, 20)
    rows = raster.load_cube(assets, grid, ["a", "b"], chunk=10).collect()
    got = {(str(r.time)[:10], r.y, r.x): (r.a, r.b) for r in rows}
    for j in range(20):
        for i in range(40):
            want = 5 if i < 20 else 9 if 3 <= j < 5 and 25 <= i < 30 else 7
            assert got["2024-01-01", 19.5 - j, 0.5 + i] == (want, None) and got["2024-01-02", 19.5 - j, 0.5 + i] == (None, 9)
    assert len(got) == 2 * 20 * 40
    near = raster.load_cube(assets, grid, ["a"], chunk=10, bbox=(0.0, 15.0, 3.0, 20.0))
    assert near.count() == 5 * 3 and near.agg(F.max("a")).first()[0] == 5
    days = assets.withColumn("time", F.expr("time + make_dt_interval(0, place)"))
    assert raster.load_cube(days, grid, ["a", "b"], chunk=16, by="date").select("time").distinct().count() == 2


@pytest.mark.parametrize("code", [3857, 32631, 32731])
def test_other_systems_against_points(spark, tmp_path, code):
    lon, lat = 2.6, (-20.0 if code == 32731 else 40.0)
    x, y = G.transform_point(lon, lat, 4326, code)
    a = np.random.default_rng(5).integers(1, 1000, (60, 50, 1)).astype("i2")
    path = write(tmp_path / "a.tif", a, x, y, 3000.0, code)
    assets = spark.createDataFrame([(path, "2024-01-01", "a", 0)], "path string, time string, band string, place int").withColumn("time", F.to_timestamp_ntz("time"))
    grid = GridSpec(lon - 0.3, lat + 0.2, 0.05, -0.05, 60, 50)
    got = {(round(r.x, 6), round(r.y, 6)): r.a for r in raster.load_cube(assets, grid, ["a"], chunk=17).collect()}
    want = {}
    for j in range(50):
        for i in range(60):
            px, py = grid.x0 + i * grid.dx, grid.y0 + j * grid.dy
            sx, sy = G.transform_point(px, py, 4326, code)
            c, r = int((sx - x) // 3000), int((y - sy) // 3000)
            if 0 <= c < 50 and 0 <= r < 60:
                want[round(px, 6), round(py, 6)] = float(a[r, c, 0])
    assert got == want and want


def test_bilinear_keeps_planes(spark, tmp_path):
    a = (np.arange(30)[:, None] * 3 + np.arange(30)[None, :] * 2).astype("f4")[:, :, None]
    path = write(tmp_path / "a.tif", a, 0.0, 30.0, 1.0, 4326)
    assets = spark.createDataFrame([(path, "2024-01-01", "a", 0)], "path string, time string, band string, place int").withColumn("time", F.to_timestamp_ntz("time"))
    rows = raster.load_cube(assets, GridSpec(5.2, 20.3, 0.7, -0.7, 10, 10), ["a"], resampling="bilinear").collect()
    assert len(rows) == 100 and all(r.a == pytest.approx((30 - r.y - 0.5) * 3 + (r.x - 0.5) * 2, abs=1e-4) for r in rows)


def test_files_that_cannot_be_read(spark, tmp_path):
    good = write(tmp_path / "a.tif", np.ones((4, 4, 1), "u1"), 0.0, 4.0, 1.0, 4326)
    (tmp_path / "bad.tif").write_bytes(b"II*\0no")
    assets = spark.createDataFrame([(good, "2024-01-01", "a", 0), (str(tmp_path / "bad.tif"), "2024-01-01", "a", 1), (str(tmp_path / "gone.tif"), "2024-01-01", "a", 2)], "path string, time string, band string, place int").withColumn("time", F.to_timestamp_ntz("time"))
    grid = GridSpec(0.5, 3.5, 1.0, -1.0, 4, 4)
    assert raster.load_cube(assets, grid, ["a"], fail_on_error=False).count() == 16
    with pytest.raises(Exception, match="bad.tif|gone.tif"):
        raster.load_cube(assets, grid, ["a"]).collect()


def test_grid_of_rasters(spark, tmp_path):
    paths = [write(tmp_path / "a.tif", np.ones((4, 4, 1), "u1"), 1.0, 4.0, 0.5, 4326), write(tmp_path / "b.tif", np.ones((4, 4, 1), "u1"), 2.25, 5.1, 0.25, 4326)]
    assets = spark.createDataFrame([(p, "2024-01-01", "a", i) for i, p in enumerate(paths)], "path string, time string, band string, place int").withColumn("time", F.to_timestamp_ntz("time"))
    seen = raster.footprints(assets, 4326)
    assert raster.grid_of(seen, 4326) == GridSpec(1.125, 5.125, 0.25, -0.25, 9, 13)
    assert raster.grid_of(seen, 4326, 1.0, (0.0, 0.0, 3.0, 2.0)) == GridSpec(0.5, 1.5, 1.0, -1.0, 3, 2)
    with pytest.raises(Exception, match="resolution"):
        raster.grid_of(seen, 3857)
