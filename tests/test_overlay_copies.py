from pyspark.sql import functions as F

from eocube.operators import overlay


def test_equal_zones_count_once(spark, tmp_path):
    """Copies of a zone give the same outline and are held once."""
    ring = [(0.0, 0.0), (4.0, 0.0), (4.0, 3.0), (0.0, 3.0)]
    edges = [(*p, *q) for p, q in zip(ring, ring[1:] + ring[:1], strict=True)]
    other = [(a + 2, b + 1, c + 2, d + 1) for a, b, c, d in edges]
    rows = [(i, "a", edges if i % 2 else other) for i in range(40)]
    zones = spark.createDataFrame(rows, "zone int, part string, edges array<struct<x1:double,y1:double,x2:double,y2:double>>")
    got = overlay.union(zones, str(tmp_path), "part").agg(F.sum(overlay.ring_area()), F.sum(overlay.ring_length())).first()
    assert tuple(got) == (20.0, 20.0)
    assert spark.read.parquet(f"{tmp_path}/zones").count() == 2
