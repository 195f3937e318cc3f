import random

import pytest
from pyspark.sql import functions as F

from eocube.sources import catalog, layout


@pytest.fixture(scope="module")
def items(spark):
    """Boxes of all sizes over all the earth, with some that lack a box or a time."""
    rnd = random.Random(7)
    rows = []
    for k in range(4000):
        size = 10 ** rnd.uniform(-3, 1.8)
        x, y = rnd.uniform(-180, 180 - size), rnd.uniform(-90, 90 - min(size, 100))
        box = [x, y, x + size, min(90.0, y + size * rnd.random())]
        if k % 7 == 0:
            box = [box[0], box[1], 0.0, box[2], box[3], 9.0]
        rows.append((str(k), "c", None if k % 97 == 0 else f"20{10 + k % 12}-{1 + k % 12:02d}-{1 + k % 28:02d}T05:00:00", None if k % 101 == 0 else box))
    df = spark.createDataFrame(rows, "id string, collection string, datetime string, bbox array<double>")
    return df.withColumn("datetime", F.to_timestamp_ntz("datetime"))


@pytest.fixture(scope="module")
def folder(items, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("layout") / "catalogue")
    layout.lay_out(items, path, files=24)
    return path


def scanned(df):
    """Rows that the scan gave, after folders and row groups were skipped."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


SEARCHES = [{"bbox": (5, 45, 6, 46)}, {"bbox": (-180, -90, 180, 90)}, {"bbox": (179.5, -1, 180, 1)}, {"datetime": "2015"}, {"datetime": "2015-03-02/..", "bbox": (-60, -30, -50, -20)}, {"intersects": "POLYGON ((10 10, 40 10, 25 60, 10 10))"}, {"ids": ["5", "6"]}, {"bbox": (3.0, 3.0, 3.0, 3.0)}]


@pytest.mark.parametrize("n", range(len(SEARCHES)))
def test_the_same_items_are_found(spark, items, folder, n):
    got = layout.search(spark, folder, **SEARCHES[n])
    assert got.columns == items.columns
    assert sorted(r.id for r in got.collect()) == sorted(r.id for r in catalog.search(items, **SEARCHES[n]).collect())


def test_less_is_read(spark, folder):
    everything = scanned(layout.search(spark, folder))
    month = scanned(layout.search(spark, folder, datetime="2015-05"))
    place = scanned(layout.search(spark, folder, bbox=(5, 45, 6, 46)))
    both = scanned(layout.search(spark, folder, datetime="2015", bbox=(5, 45, 6, 46)))
    assert everything == 4000 and month < 200 and both < everything / 8, (month, place, both)


@pytest.mark.parametrize("most", [4, 24, 400])
def test_ranges_hold_all_points_of_a_box(spark, most):
    rnd = random.Random(most)
    for _ in range(4):
        x, y, w = rnd.uniform(-180, 170), rnd.uniform(-90, 80), 10 ** rnd.uniform(-2, 1.5)
        box = (x, y, min(180, x + w), min(90, y + w))
        spans = layout.curve_ranges(box, most)
        assert len(spans) <= most + 4 and spans == sorted(spans)
        inside = [(rnd.uniform(box[0], box[2]), rnd.uniform(box[1], box[3])) for _ in range(100)] + [(box[0], box[1]), (box[2], box[3])]
        df = spark.createDataFrame(inside, "x double, y double").select(layout.curve(F.col("x"), F.col("y")).alias("z"))
        assert all(any(a <= r.z <= b for a, b in spans) for r in df.collect())
