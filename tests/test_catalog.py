import json
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from eocube.errors import CatalogError, NoItemsFoundError
from eocube.functions import geometry as G
from eocube.functions import query_lang as Q
from eocube.operators import items as ops
from eocube.operators import mutate
from eocube.sources import catalog, config, tiff
from eocube.streaming import ingest


@pytest.fixture
def items(spark):
    rows = [("a", "c1", "2024-01-01 10:00:00", {"k": "x|y", "cc": 5}), ("b", "c1", "2024-01-01 12:00:00", {"k": "x", "cc": 50}), ("c", "c2", "2024-01-02 00:00:00", {"k": "y"}), ("d", "c2", None, {"cc": 20})]
    df = spark.createDataFrame([(i, c, t, json.dumps(p), n) for n, (i, c, t, p) in enumerate(rows)], "id string, collection string, t string, properties string, pos int")
    return df.withColumn("datetime", F.col("t").cast("timestamp_ntz")).drop("t").withColumn("bbox", F.array(*[F.col("pos").cast("double") + d for d in (0, 0, 1, 1)]))


def ids(df):
    return [r.id for r in df.collect()]


def test_dedupe_golden(items):
    assert ids(ops.deduplicate(items, "date", ordered=True)) == ["b", "c", "d"] and ids(ops.deduplicate(items, "date", "first", ordered=True)) == ["a", "c", "d"]
    assert ids(ops.deduplicate(items, ["date", "k"], ordered=True)) == ["a", "b", "c", "d"]
    assert ids(ops.deduplicate(items, ["collection_id"], ordered=True)) == ["b", "d"]
    with pytest.raises(ValueError):
        ops.deduplicate(items, "date", "any")


def test_search(items):
    assert ids(catalog.search(items, collections="c1", datetime="2024-01-01")) == ["a", "b"]
    assert ids(catalog.search(items, bbox=[0, 0, 0.5, 0.5])) == ["a"]
    assert ids(catalog.search(items, intersects="POINT (2.5 2.5)")) == ["c"]
    assert ids(catalog.search(items, query={"cc": {"lt": 20}})) == ["a"]
    assert ids(catalog.search(items, post_query={"cc": {"le": [5, 20]}})) == ["a", "d"]
    assert ids(catalog.search(items, sortby="-id", max_items=2)) == ["d", "c"]
    assert ids(catalog.search(items, filter={"op": "isNull", "args": [{"property": "datetime"}]})) == ["d"]
    with pytest.raises(ValueError):
        catalog.search(items, max_items=1, days_per_chunk=1)
    with pytest.raises(ValueError):
        catalog.search(items, post_query={"cc": {"near": 3}})
    with pytest.raises(ValueError):
        catalog.search(items, query={"cc": {"near": 3}})
    with pytest.raises(NoItemsFoundError):
        catalog.require_items(catalog.search(items, ids=["z"]))


def test_near_duplicates_keep_all_latest(spark):
    rows = [(1, "2024-01-01 00:00:00", 1), (2, "2024-01-01 00:40:00", 2), (3, "2024-01-01 01:01:00", 2), (4, "2024-01-01 01:30:00", 2)]
    df = spark.createDataFrame([(i, t, u, "p") for i, t, u in rows], "id int, t string, updated int, place string").withColumn("datetime", F.col("t").cast("timestamp_ntz"))
    assert sorted(ids(ops.near_duplicates(df, ["place"]))) == [2, 3, 4]  # the anchor of 3 is 3 itself, not 2


def test_bulk(spark):
    old = spark.sql("SELECT * FROM VALUES ('c', 1, 'old'), ('c', 2, 'old') AS t(collection, id, v)")
    new = spark.sql("SELECT * FROM VALUES ('c', 2, 'new'), ('c', 3, 'new') AS t(collection, id, v)")
    for mode, want, counts in (("SKIP", {(1, "old"), (2, "old"), (3, "new")}, (2, 1, 1)), ("OVERRIDE", {(1, "old"), (2, "new"), (3, "new")}, (2, 2, 0))):
        table, job = mutate.bulk_insert(old, new, mode)
        assert {(r.id, r.v) for r in table.collect()} == want
        j = job.first()
        assert (j.items_total_count, j.items_written_count, j.items_skipped_count) == counts
    table, job = mutate.bulk_delete(old, new.select("id"))
    assert [r.id for r in table.collect()] == [1] and job.first().items_skipped_subset == ["3"]
    with pytest.raises(CatalogError):
        mutate.create_item(old, new)
    with pytest.raises(CatalogError):
        mutate.update_item(old, new)
    assert mutate.update_item(old, new.where("id = 2")).where("v = 'new'").count() == 1
    with pytest.raises(ValueError):
        mutate.bulk_insert(old, new, "MERGE")


def test_parse_items(spark):
    lines = spark.createDataFrame([('{"id": "a", "collection": "c"}',), ("nonsense",)], "value string")
    good, bad = mutate.parse_items(lines)
    assert ids(good) == ["a"] and bad.count() == 1
    with pytest.raises(Exception, match="not an item"):
        mutate.parse_items(lines, "STOP")[0].collect()


def test_enrichment(spark):
    assets = spark.sql("SELECT * FROM VALUES (1, 'h1', 'image/tiff', NULL, 5D), (1, 'h2', 'text/xml', NULL, NULL), (2, 'h3', 'image/tiff', 4326, NULL) AS t(id, href, type, epsg, gsd)")
    headers = spark.sql("SELECT * FROM VALUES ('h1', 32631, 10D), ('h2', 32631, 10D), ('h3', 32631, 10D) AS t(href, epsg, gsd)")
    got = {r.href: (r.epsg, r.gsd) for r in ops.enrich(assets, headers).collect()}
    assert got == {"h1": (32631, 5.0), "h2": (None, None), "h3": (4326, 10.0)}
    assert {r.epsg for r in ops.enrich(assets, headers, force=True).where("type like 'image%'").collect()} == {32631}
    both = {r.id: r.epsg for r in ops.promote(assets, ["epsg"]).collect()}
    assert both == {1: None, 2: 4326}


def test_polarizations(spark):
    df = spark.createDataFrame([(1, {"vv": 1, "vh": 1}), (2, {"vv": 1}), (3, {"hh": 1})], "id int, assets map<string,int>")
    assert ids(ops.filter_by_polarization(df, ["vv", "VH"])) == [1]
    assert [r.p for r in df.select(ops.polarizations(F.col("assets")).alias("p")).collect()] == [["VV", "VH"], ["VV"], ["HH"]]


def test_geometry_inputs():
    square = [[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]
    for g in ("POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))", {"type": "Polygon", "coordinates": [square]}, json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"a": 1}, "geometry": {"type": "MultiPolygon", "coordinates": [[square]]}}]})):
        assert G.parse(g)[0].bbox == (0, 0, 1, 1)
    assert G.parse(json.dumps({"type": "Feature", "properties": {"a": 1}, "geometry": {"type": "Point", "coordinates": [1, 2]}}))[0].attrs == {"a": 1}
    assert G.parse_bbox("1,2,3,4") == G.parse_bbox([1, 2, 0, 3, 4, 9]) == (1, 2, 3, 4)
    for bad in ("nonsense", {"type": "Blob", "coordinates": []}, 5):
        with pytest.raises(ValueError):
            G.parse(bad)
    with pytest.raises(ValueError):
        G.parse_bbox([1, 2])


def test_projections():
    x, y = G.to_utm(3.0, 0.0, 31)
    assert (x, y) == pytest.approx((500000, 0), abs=1e-6)
    for lon, lat, zone in ((2.35, 48.85, 31), (-43.2, -22.9, 23)):
        assert G.from_utm(*G.to_utm(lon, lat, zone, lat < 0), zone, lat < 0) == pytest.approx((lon, lat), abs=1e-8)
        assert G.from_mercator(*G.to_mercator(lon, lat)) == pytest.approx((lon, lat))
    assert G.to_utm(2.35, 48.85, 31) == pytest.approx((452304.8, 5410989.0), abs=250)  # near Paris
    g = G.reproject(G.box(2, 48, 3, 49), 32631)
    assert G.reproject(g, 4326).bbox == pytest.approx((2, 48, 3, 49), abs=1e-7)
    with pytest.raises(ValueError):
        G.reproject(g, 27700)


def _tiff(a: np.ndarray) -> bytes:
    """A little plain GeoTIFF."""
    h, w = a.shape
    extra = struct.pack("<3d", 10.0, 10.0, 0.0) + struct.pack("<6d", 0, 0, 0, 500.0, 900.0, 0) + struct.pack("<8H", 1, 1, 0, 1, 3072, 0, 1, 32631) + a.tobytes()
    at = 8 + 2 + 12 * 11 + 4
    entries = [(256, 3, 1, w), (257, 3, 1, h), (258, 3, 1, 16), (259, 3, 1, 1), (273, 4, 1, at + 88), (277, 3, 1, 1), (278, 3, 1, h), (279, 4, 1, a.nbytes), (33550, 12, 3, at), (33922, 12, 6, at + 24), (34735, 3, 8, at + 72)]
    body = b"II" + struct.pack("<HI", 42, 8) + struct.pack("<H", len(entries))
    for tag, kind, n, v in entries:
        body += struct.pack("<HHI", tag, kind, n) + (struct.pack("<HH", v, 0) if kind == 3 and n == 1 else struct.pack("<I", v))
    return body + b"\0\0\0\0" + extra


def test_tiff(spark, tmp_path):
    a = np.arange(12, dtype="<u2").reshape(3, 4)
    (tmp_path / "a.tif").write_bytes(_tiff(a))
    h = tiff.read_headers(spark, str(tmp_path)).first()
    assert (h.width, h.height, h.data_type, h.epsg) == (4, 3, "uint16", 32631) and h.transform == [10, 0, 500, 0, -10, 900]
    assert [r.value for r in tiff.read_pixels(spark, str(tmp_path)).orderBy("row", "col").collect()] == list(map(float, range(12)))
    with pytest.raises(ValueError):
        tiff.tags(b"nonsense")


def test_config(tmp_path, monkeypatch):
    monkeypatch.setenv("EOCUBE_A", "env")
    monkeypatch.setenv("EOCUBE_B", "env")
    (tmp_path / "s.toml").write_text('b = "file"\nc = "file"')
    (tmp_path / "s.ini").write_text("[default]\nb = ini\n")
    (tmp_path / "s.json").write_text('{"b": "json"}')
    assert config.load_config(str(tmp_path / "s.toml"), c="argument") == {"a": "env", "b": "file", "c": "argument"}
    assert config.load_config(str(tmp_path / "s.ini"))["b"] == "ini" and config.load_config(str(tmp_path / "s.json"))["b"] == "json"
    with pytest.raises(ValueError):
        (tmp_path / "s.txt").write_text("")
        config.load_config(str(tmp_path / "s.txt"))


def test_cql2(items):
    node = {"op": "and", "args": [{"op": "in", "args": [{"property": "collection"}, ["c1"]]}, {"op": ">=", "args": [{"property": "cc"}, 50]}]}
    assert ids(items.where(Q.cql2(items, node))) == ["b"]
    with pytest.raises(ValueError):
        Q.cql2(items, {"op": "near", "args": []})


def test_item_stream(spark, tmp_path):
    rows = [{"id": i, "collection": "c", "datetime": "2024-01-01T00:00:00"} for i in ("a", "b", "a")]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text("\n".join(map(json.dumps, rows)))
    for _ in range(2):  # the second run finds nothing new
        ingest.append_new(ingest.read_item_stream(spark, str(tmp_path / "in")), str(tmp_path / "table"), str(tmp_path / "cp")).awaitTermination()
    assert sorted(ids(spark.read.parquet(str(tmp_path / "table")))) == ["a", "b"]


def test_properties_as_variant(spark, tmp_path):
    """The same answers as from text, and no text is parsed in a search."""
    from eocube.sources import catalog

    rows = [("a", '{"eo:cloud_cover": 5, "n": "x", "ok": true}'), ("b", '{"eo:cloud_cover": 50.5, "n": "yx"}'), ("c", "no json"), ("d", None), ("e", '{"eo:cloud_cover": null, "n": "x", "ok": false}')]
    text = spark.createDataFrame(rows, "id string, properties string")
    variant = catalog.parsed(text, str(tmp_path / "items"))
    p = lambda n: {"property": n}
    searches = [{"query": {"eo:cloud_cover": {"lt": 20}}}, {"query": {"n": {"startsWith": "x"}, "ok": {"eq": True}}}, {"post_query": {"eo:cloud_cover": {"ge": [50, 1]}}}, {"filter": {"op": "or", "args": [{"op": ">", "args": [p("eo:cloud_cover"), 20]}, {"op": "like", "args": [p("n"), "%x"]}]}}, {"filter": {"op": "isNull", "args": [p("eo:cloud_cover")]}}, {"query": {"ok": False}}]
    for s in searches:
        one, other = (sorted(r.id for r in catalog.search(t, **s).collect()) for t in (text.where("id <> 'c'"), variant.where("id <> 'c'")))
        assert one == other, s
    plan = catalog.search(variant, **searches[0])._jdf.queryExecution().optimizedPlan().toString()
    assert "parse_json" not in plan and "get_json_object" not in plan
